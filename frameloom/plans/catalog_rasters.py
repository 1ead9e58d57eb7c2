"""Queries over frames with rasters: their measures, histograms, similarity to the frame before, and the whole filter, with DuckDB SQL for all but the filter's fold."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from frameloom.functions import rasters as k
from frameloom.operators import hands, rasters, segments
from frameloom.sources import episodes
from frameloom.sources import views as v

from . import catalog as c
from .catalog import query
from .catalog_more import _ALL

_G = f"{c.H_SQL}, {v.RASTERS_SQL}"


@query(f"{_G} SELECT video_id, seq, CAST(v AS BIGINT) AS grey, count(*) AS n FROM grey GROUP BY ALL")
def raster_histogram(spark, d):
    made = rasters.measured(v.raster_frames(spark, d), histogram=True).select("video_id", "seq", F.posexplode("histogram").alias("grey", "n"))
    return made.where("n > 0").select("video_id", "seq", F.col("grey").cast("long").alias("grey"), "n")


@query(f"""{_G}, en AS (SELECT video_id, seq, -sum(n / 64e0 * log2(n / 64e0)) AS entropy FROM (SELECT video_id, seq, v, count(*) AS n FROM grey GROUP BY ALL) GROUP BY 1, 2),
lp AS (SELECT g.video_id, g.seq, g.v, (SELECT sum(o.v) FROM grey o WHERE o.video_id = g.video_id AND o.seq = g.seq AND (o.c = g.c AND o.r = abs(g.r - 1))) AS up, u.v AS down, l.v AS lft, x.v AS rgt FROM grey g
  JOIN grey u ON u.video_id = g.video_id AND u.seq = g.seq AND u.c = g.c AND u.r = 7 - abs(7 - (g.r + 1)) JOIN grey l ON l.video_id = g.video_id AND l.seq = g.seq AND l.r = g.r AND l.c = abs(g.c - 1) JOIN grey x ON x.video_id = g.video_id AND x.seq = g.seq AND x.r = g.r AND x.c = 7 - abs(7 - (g.c + 1))),
ms AS (SELECT video_id, seq, avg(v) AS brightness, var_pop(up + down + lft + rgt - 4 * v) AS lapvar FROM lp GROUP BY 1, 2),
al AS (SELECT f.video_id, f.seq, round(brightness, 6) AS brightness, round(entropy, 6) AS entropy, round(lapvar, 6) AS lapvar, CASE WHEN brightness < 30 THEN 'too_dark' WHEN brightness > 240 THEN 'overexposed' WHEN entropy < 3 THEN 'occluded' ELSE '' END AS dark_reason FROM rep f LEFT JOIN ms USING (video_id, seq) LEFT JOIN en USING (video_id, seq))
SELECT *, CASE WHEN brightness IS NULL OR dark_reason <> '' THEN 'dark' WHEN lapvar < 50 THEN 'blur' ELSE 'good' END AS verdict FROM al""")
def raster_measures(spark, d):
    made = rasters.stateless(rasters.measured(v.raster_frames(spark, d)))
    return made.select("video_id", "seq", *[c.r6(x) for x in ("brightness", "entropy", "lapvar")], "dark_reason", "verdict")


@query(f"""{_G}, two AS (SELECT a.video_id, a.seq, a.r, a.c, CAST(a.v AS DOUBLE) AS x, CAST(b.v AS DOUBLE) AS y FROM grey a JOIN grey b ON b.video_id = a.video_id AND b.seq = a.seq - 1 AND b.r = a.r AND b.c = a.c),
win AS (SELECT video_id, seq, wr, wc, avg(x) AS mx, avg(y) AS my, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS vxy FROM two, (SELECT unnest([0, 1]) AS wr), (SELECT unnest([0, 1]) AS wc) WHERE r BETWEEN wr AND wr + 6 AND c BETWEEN wc AND wc + 6 GROUP BY ALL)
SELECT video_id, seq, round(avg((2 * mx * my + 6.5025e0) * (2 * vxy + 58.5225e0) / ((mx * mx + my * my + 6.5025e0) * (vx + vy + 58.5225e0))), 6) AS similarity FROM win GROUP BY 1, 2""")
def raster_ssim(spark, d):
    """Structural similarity of each frame and the one before it in the video, where both can be read."""
    w = Window.partitionBy("video_id").orderBy("seq")
    pairs = v.raster_frames(spark, d).select("video_id", "seq", "raster", F.lag("raster").over(w).alias("before")).where("raster is not null and before is not null")

    def work(batches):
        import pyarrow as pa

        for b in batches:
            found = [k.similarity(*(k.of_bytes(x, v.SIDE, v.SIDE) for x in two)) for two in zip(b.column("raster").to_pylist(), b.column("before").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("video_id"), b.column("seq"), pa.array(found, pa.float64())], ["video_id", "seq", "similarity"])

    return pairs.mapInArrow(work, "video_id long, seq long, similarity double").withColumn("similarity", F.round("similarity", 6))


@query()
def raster_verdicts(spark, d):
    """The whole filter; a fold with a raster as its state has no SQL, so a test holds it against a plain loop."""
    return rasters.filter_rasters(rasters.stateless(rasters.measured(v.raster_frames(spark, d)))).select("video_id", "seq", "dark_reason", "verdict")


_FIRST = lambda side: f"list_filter(hands, lambda h: h.handedness = '{side}')[1].pixels[1]"


@query(f"""{_ALL}, {v.HAND_FRAMES_SQL}, {v.RASTERS_SQL}, ends AS (SELECT video_id, seq, max(CASE WHEN r = 0 AND c = 0 THEN v END) AS first_grey, max(CASE WHEN r = 7 AND c = 7 THEN v END) AS last_grey FROM grey GROUP BY 1, 2),
fz AS (SELECT hf.video_id, hf.seq, ts, depth, {_FIRST("right")} AS rw, {_FIRST("left")} AS lw FROM hf),
es AS (SELECT s.video_id, s.segment_id, s.action, fz.seq, row_number() OVER w - 1 AS step, count(*) OVER (PARTITION BY s.video_id, s.segment_id) AS n, rw, lw, lag(rw) OVER w AS rw0, lag(lw) OVER w AS lw0, depth FROM seg s JOIN fz ON fz.video_id = s.video_id AND fz.ts BETWEEN s.start_time AND s.end_time WINDOW w AS (PARTITION BY s.video_id, s.segment_id ORDER BY fz.ts, fz.seq))
SELECT video_id, segment_id, step, step = 0 AS is_first, step = n - 1 AS is_last, step = n - 1 AS is_terminal, action AS language_instruction, CASE WHEN step > 0 THEN round(coalesce(rw.x - rw0.x, lw.x - lw0.x, 0), 2) ELSE 0 END AS dx, 196608 AS image_bytes, CAST(first_grey AS BIGINT) AS first_grey, CAST(last_grey AS BIGINT) AS last_grey, CASE WHEN depth IS NULL THEN 0 ELSE 262144 END AS depth_bytes
FROM es JOIN ends USING (video_id, seq)""")
def episode_features(spark, d):
    """What an episode's records hold, by its sizes, ends and flags."""
    s = c._segments(spark, d).select("video_id", "segment_id", "start_time", "end_time", "action")
    frames = v.hand_frames(spark, d).select("video_id", "seq", "ts", "hands", "depth").join(v.raster_frames(spark, d).drop("ts"), ["video_id", "seq"])
    steps = segments.steps(s, frames).withColumnRenamed("action", "instruction")
    moved = hands.actions(steps, "depth", v.map_at).withColumn("action", F.array("dx", "dy", "dz", "droll", "dpitch", "dyaw", "grasp"))
    made = episodes.step_features(moved)
    image, deep = F.col("`observation/image`"), F.col("`observation/depth`")
    grey = lambda at: F.conv(F.hex(F.substring(image, at, 1)), 16, 10).cast("long")
    return made.select("video_id", "segment_id", "step", "is_first", "is_last", "is_terminal", "language_instruction", F.round(F.get("action", F.lit(0)).cast("double"), 2).alias("dx"), F.length(image).alias("image_bytes"), grey(1).alias("first_grey"), grey(episodes.SIDE**2 * 3).alias("last_grey"), F.length(deep).alias("depth_bytes"))

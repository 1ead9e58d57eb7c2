"""Views with the engine's schemas over the provided tables, in DataFrame form and as DuckDB SQL for the oracles.

video_id is the partition key of every view; within one, seq counts frames and ts = seq / 2 seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.functions.geometry import box_of
from frameloom.functions.values import depth_at

#: Fixed values of the domain.
ACTIONS = ("pick_up", "place", "tighten_bolt", "inspect", "assemble")
PHASES = ("reach", "grasp", "manipulate", "hold", "release", "retract")
HANDS = ("right", "left", "both", "none")
GRASPS = ("pinch", "power", "lateral", "hook", "spherical", "none", "unknown")
OBJECTS = ("wrench", "bolt", "screw", "panel", "cable", "plate", "gear")
WIDTH, HEIGHT = 640, 480


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], at) -> Column:
    return F.get(F.array(*map(F.lit, values)), at.cast("int"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, seq, ts, k, brightness, lapvar, flow, event_type, frame_path)."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return e.select(
        F.col("user_id").alias("video_id"), (F.row_number().over(w) - 1).cast("long").alias("seq"), "k", "event_type",
        F.col("value").alias("brightness"), (2.0 * F.col("k")).alias("lapvar"), F.abs(F.col("value") - F.lag("value").over(w)).alias("flow"),
    ).withColumn("ts", F.col("seq") * 0.5).withColumn("frame_path", F.format_string("frame_%010d.jpg", F.col("seq") * 500))


FRAMES_SQL = """frames AS (
  SELECT user_id AS video_id, row_number() OVER w - 1 AS seq, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type,
         value AS brightness, 2e0 * CAST(json_extract(props, '$.k') AS BIGINT) AS lapvar, abs(value - lag(value) OVER w) AS flow,
         (row_number() OVER w - 1) * 0.5e0 AS ts, 'frame_' || lpad(CAST((row_number() OVER w - 1) * 500 AS VARCHAR), 10, '0') || '.jpg' AS frame_path
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, seq, start, end, action, confidence, phase, hand, grasp, objects): idle labels are points, others last half a second."""
    f = frames(spark, sf_dir)
    idle = F.col("brightness") < 30
    # the event type names the action, in order of the name
    kinds = Window.orderBy("event_type")
    names = table(spark, sf_dir, "events").select("event_type").distinct().withColumn("n", F.dense_rank().over(kinds) - 1).withColumn("name", _pick(ACTIONS, F.col("n") % len(ACTIONS)))
    f = f.join(F.broadcast(names), "event_type")
    return f.select(
        "video_id", "seq", F.col("ts").alias("start"), F.when(idle, F.col("ts")).otherwise(F.col("ts") + 0.5).alias("end"),
        F.when(idle, F.lit("idle")).otherwise(F.col("name")).alias("action"), ((100 - F.col("k")) / 100).alias("confidence"),
        F.coalesce(_pick((*PHASES, "idle", ""), F.col("k") % 8), F.lit("")).alias("phase"), _pick(HANDS, F.col("k") % 4).alias("hand"), _pick(GRASPS, F.col("k") % 7).alias("grasp"),
        F.array(_pick(OBJECTS, F.col("k") % 7), _pick(OBJECTS, (F.col("k") * 3) % 7)).alias("objects"),
    )


def described_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels with a description, a hierarchy and the method that made them."""
    rows = labels(spark, sf_dir)
    text = F.concat(F.lit("Do "), "action", F.lit(" with "), F.get("objects", F.lit(0)))
    levels = F.struct(F.lit("work").alias("high_level"), F.col("action").alias("mid_level"), F.col("phase").alias("low_level"))
    return rows.withColumns({"action_description": text, "task_hierarchy": levels, "labelling_method": F.when(F.col("action") == "idle", "rule").otherwise("vlm")})


def _sql_pick(values: tuple[str, ...], at: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][1 + CAST({at} AS INT)]"


LABELS_SQL = f"""kinds AS (SELECT event_type, {_sql_pick(ACTIONS, "(row_number() OVER (ORDER BY event_type) - 1) % 5")} AS name FROM (SELECT DISTINCT event_type FROM events)),
labels_v AS (
  SELECT video_id, seq, ts AS start, CASE WHEN brightness < 30 THEN ts ELSE ts + 0.5e0 END AS "end",
         CASE WHEN brightness < 30 THEN 'idle' ELSE name END AS action, (100 - k) / 100e0 AS confidence,
         {_sql_pick((*PHASES, "idle", ""), "k % 8")} AS phase, {_sql_pick(HANDS, "k % 4")} AS hand, {_sql_pick(GRASPS, "k % 7")} AS grasp,
         [{_sql_pick(OBJECTS, "k % 7")}, {_sql_pick(OBJECTS, "(k * 3) % 7")}] AS objects
  FROM frames JOIN kinds USING (event_type))"""


def hands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, seq, ts, handedness, points, pixels, depth, missing): 21 key points from the elements of an embedding."""
    w = Window.partitionBy("label").orderBy("vec_id")
    e = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("video_id"), "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"), (F.row_number().over(w) - 1).cast("long").alias("seq"))
    at = lambda i: F.get("e", i)
    points = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.struct((at(2 * i) + 0.5).alias("x"), (at(2 * i + 1) + 0.5).alias("y")))
    return e.select(
        "video_id", "seq", (F.col("seq") * 0.5).alias("ts"), F.when(F.col("vec_id") % 3 == 0, "left").otherwise("right").alias("handedness"),
        points.alias("points"), F.transform(points, lambda p: F.struct((p["x"] * WIDTH).alias("x"), (p["y"] * HEIGHT).alias("y"))).alias("pixels"),
        F.when(F.col("seq") % 5 == 0, at(F.lit(43)) + 0.5).alias("depth"), (F.abs(at(F.lit(45))) > 0.15).alias("missing"), "e", "vec_id",
    )


HANDS_SQL = """emb AS (SELECT CAST(label AS BIGINT) AS video_id, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS seq FROM embeddings),
hands_v AS (
  SELECT video_id, seq, seq * 0.5e0 AS ts, CASE WHEN vec_id % 3 = 0 THEN 'left' ELSE 'right' END AS handedness, e, vec_id,
         list_transform(range(21), lambda i: {'x': (e[2 * i + 1] + 0.5e0) * 640, 'y': (e[2 * i + 2] + 0.5e0) * 480}) AS pixels,
         CASE WHEN seq % 5 = 0 THEN e[44] + 0.5e0 END AS depth, abs(e[46]) > 0.15e0 AS missing
  FROM emb)"""


def hand_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, seq, ts, vec_id, hands, depth): frames of 0 to 3 hands (handedness, pixels, box), labels repeated among them, some hands with 5 points only. hands is null where the frame can't be read; depth is an 8 x 8 map that every third frame of each second video has."""
    h = hands(spark, sf_dir)
    at = lambda i: F.get("e", (i % 64).cast("int")) + 0.5
    vec = F.col("vec_id")

    def one(i: Column) -> Column:
        other = F.when((i == 1) & (F.floor(vec / 8) % 4 != 0), 1).otherwise(0)
        n = F.when((vec + i) % 7 == 0, 5).otherwise(21)
        points = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.struct((at(2 * j + 10 * i) * WIDTH).alias("x"), (at(2 * j + 1 + 10 * i) * HEIGHT).alias("y")))
        return F.struct(F.when((F.floor(vec / 4) + other) % 2 == 0, "right").otherwise("left").alias("handedness"), points.alias("pixels"))

    # one pass makes the hands, a second their boxes, which need the points
    rows = h.withColumn("hands", F.when(vec % 13 != 5, F.transform(F.slice(F.array(*map(F.lit, range(3))), F.lit(1), (vec % 4).cast("int")), one)))
    boxed = F.transform("hands", lambda x: F.struct(x["handedness"].alias("handedness"), x["pixels"].alias("pixels"), box_of(x["pixels"], WIDTH, HEIGHT).alias("box")))
    return rows.select("video_id", "seq", "ts", "vec_id", boxed.alias("hands"), F.when((F.col("video_id") % 2 == 0) & (F.col("seq") % 3 == 0), F.col("e")).alias("depth"))


def map_at(depth: Column, x: Column, y: Column) -> Column:
    """The 8 x 8 map's value at a pixel of the image."""
    return depth_at(depth, 8, 8, x / (WIDTH / 8), y / (HEIGHT / 8))


HAND_FRAMES_SQL = """hf AS (
  SELECT video_id, seq, ts, vec_id, CASE WHEN vec_id % 13 <> 5 THEN list_transform(range(vec_id % 4), lambda i: {
      'handedness': CASE WHEN (vec_id // 4 + CASE WHEN i = 1 AND (vec_id // 8) % 4 <> 0 THEN 1 ELSE 0 END) % 2 = 0 THEN 'right' ELSE 'left' END,
      'pixels': list_transform(range(CASE WHEN (vec_id + i) % 7 = 0 THEN 5 ELSE 21 END), lambda j: {'x': (e[1 + (2 * j + 10 * i) % 64] + 0.5e0) * 640, 'y': (e[1 + (2 * j + 1 + 10 * i) % 64] + 0.5e0) * 480})}) END AS hands,
    CASE WHEN video_id % 2 = 0 AND seq % 3 = 0 THEN e END AS depth
  FROM hands_v)"""


def map_sql(depth: str, x: str, y: str) -> str:
    return f"{depth}[1 + greatest(least(CAST(floor({y} / 60e0) AS INT), 7), 0) * 8 + greatest(least(CAST(floor({x} / 80e0) AS INT), 7), 0)]"


#: Side of the rasters that the views have.
SIDE = 8


def raster_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, seq, ts, raster, height, width): grey rasters of 8 x 8 bytes from embeddings. Runs of six frames show the video's first frame with noise, the next six do not; every fourth repeats the one before; some are dark, bright, of two greys, smooth or missing."""
    h = hands(spark, sf_dir).select("video_id", "seq", "ts", "vec_id", "e")
    w = Window.partitionBy("video_id").orderBy("seq")
    mixed = F.zip_with(F.first("e").over(w), "e", lambda b, x: 0.75 * b + 0.25 * x)
    h = h.withColumn("_e", F.when(F.floor(F.col("seq") / 6) % 2 == 0, mixed).otherwise(F.col("e")))
    h = h.withColumn("_e", F.when(F.col("seq") % 4 == 1, F.lag("_e").over(w)).otherwise(F.col("_e")))
    kind = F.col("vec_id") % 11

    def grey(x: Column, j: Column) -> Column:
        plain = F.greatest(F.least(F.floor((x + 0.5) * 255), F.lit(255)), F.lit(0))
        return F.when(kind == 0, F.floor(plain / 12)).when(kind == 1, 255 - F.floor(plain / 40)).when(kind == 2, 100 + 10 * (j % 2)).when(kind == 3, 100 + 2 * F.floor(j / SIDE)).otherwise(plain)

    data = F.unhex(F.array_join(F.transform("_e", lambda x, j: F.lpad(F.hex(grey(x, j).cast("long")), 2, "0")), ""))
    return h.select("video_id", "seq", "ts", F.when(kind != 4, data).alias("raster"), F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"))


RASTERS_SQL = """mix AS (SELECT video_id, seq, ts, vec_id, CASE WHEN (seq // 6) % 2 = 0 THEN list_transform(range(1, 65), lambda j: 0.75e0 * b[j] + 0.25e0 * e[j]) ELSE e END AS m FROM (SELECT *, first_value(e) OVER (PARTITION BY video_id ORDER BY seq) AS b FROM hands_v)),
rep AS (SELECT video_id, seq, ts, vec_id, CASE WHEN seq % 4 = 1 THEN lag(m) OVER (PARTITION BY video_id ORDER BY seq) ELSE m END AS m FROM mix),
px AS (SELECT video_id, seq, ts, vec_id, j, j // 8 AS r, j % 8 AS c, greatest(least(CAST(floor((m[j + 1] + 0.5e0) * 255) AS INT), 255), 0) AS p FROM (SELECT *, unnest(range(64)) AS j FROM rep) WHERE vec_id % 11 <> 4),
grey AS (SELECT video_id, seq, r, c, CASE vec_id % 11 WHEN 0 THEN p // 12 WHEN 1 THEN 255 - p // 40 WHEN 2 THEN 100 + 10 * (j % 2) WHEN 3 THEN 100 + 2 * r ELSE p END AS v FROM px)"""


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, seq, ordinal, class_name, confidence, bbox): two boxes for each frame."""
    h = hands(spark, sf_dir)

    def one(k: int) -> DataFrame:
        x = lambda i, size: F.floor((F.get("e", F.lit(i)) + 0.5) * size).cast("long")
        x1, y1 = x(46 + 4 * k, WIDTH), x(47 + 4 * k, HEIGHT)
        b = F.struct(x1.alias("x1"), y1.alias("y1"), (x1 + 100 + 20 * k).alias("x2"), (y1 + 80).alias("y2"))
        return h.select("video_id", "seq", F.lit(k).cast("long").alias("ordinal"), _pick(OBJECTS, (F.col("vec_id") + k) % 7).alias("class_name"), F.round(F.abs(F.get("e", F.lit(54 + k))) + 0.3, 4).alias("confidence"), b.alias("bbox"))

    return one(0).unionByName(one(1))


OBJECTS_SQL = """objects_v AS (
  SELECT video_id, seq, CAST(k AS BIGINT) AS ordinal, ['wrench', 'bolt', 'screw', 'panel', 'cable', 'plate', 'gear'][1 + CAST((vec_id + k) % 7 AS INT)] AS class_name, round(abs(e[55 + k]) + 0.3e0, 4) AS confidence,
         x1, y1, x1 + 100 + 20 * k AS x2, y1 + 80 AS y2
  FROM (SELECT *, CAST(floor((e[47 + 4 * k] + 0.5e0) * 640) AS BIGINT) AS x1, CAST(floor((e[48 + 4 * k] + 0.5e0) * 480) AS BIGINT) AS y1 FROM hands_v, (SELECT unnest([0, 1]) AS k)))"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, true_cls, pred_cls): labelled documents, and a prediction from their length."""
    d, q = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.join(q, "doc_id").select(F.col("doc_id").alias("sample_id"), F.concat(F.lit("q"), "quality", F.lit("t"), "toxic").alias("true_cls"), F.concat(F.lit("q"), F.when(F.col("n_chars") >= 400, 1).otherwise(0), F.lit("t"), F.when(F.col("doc_id") % 4 == 0, 1).otherwise(0)).alias("pred_cls"))


PREDICTIONS_SQL = """preds AS (SELECT doc_id AS sample_id, 'q' || quality || 't' || toxic AS true_cls, 'q' || CASE WHEN n_chars >= 400 THEN 1 ELSE 0 END || 't' || CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END AS pred_cls FROM documents JOIN labels USING (doc_id))"""

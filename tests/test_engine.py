"""Engine queries against their SQL, and operators against worked examples."""

import parity
import pytest
from pyspark.sql import functions as F

from frameloom.functions import geometry as g
from frameloom.operators import context, evaluate, frames, segments, tracks
from frameloom.plans import catalog


@pytest.fixture(scope="module")
def con(tiny):
    return parity.database(tiny)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, tiny, con, name):
    df = catalog.queries()[name](spark, tiny)
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert parity.difference(con, df, sql) == ""


def _labels(spark, rows):
    """rows: (start, end, action, confidence, phase, hand, objects)."""
    return spark.createDataFrame([(1, i, *r[:4], r[4], r[5], "power", r[6]) for i, r in enumerate(rows)], "video_id long, seq long, start double, end double, action string, confidence double, phase string, hand string, grasp string, objects array<string>")


SMOKE = (
    [(float(i), i + 1.0, "pick_up", 0.82 + 0.02 * i, "reach" if i <= 1 else "manipulate", "right", ["wrench"]) for i in range(5)]
    + [(5.0 + i, 6.0 + i, "tighten_bolt", 0.78 + 0.03 * i, "manipulate", "right", ["wrench", "bolt"]) for i in range(3)]
    + [(8.0 + i, 9.0 + i, "idle", 0.95, "", "none", []) for i in range(2)]
)


def test_segments_of_the_smoke_labels(spark):
    got = segments.segments(_labels(spark, SMOKE)).orderBy("segment_id").collect()
    assert [(r["action"], r["start_time"], r["end_time"], round(r["confidence_avg"], 2), r["frames_analyzed"], r["phases"], r["review_reason"]) for r in got] == [
        ("pick_up", 0, 5, 0.86, 5, ["reach", "manipulate"], None),
        ("tighten_bolt", 5, 8, 0.81, 3, ["manipulate"], None),
        ("idle", 8, 10, 0.95, 2, [], "hand_not_visible"),
    ]


@pytest.mark.parametrize(
    ("times", "chunks"),
    [([0.5 * i for i in range(12)], [0] * 5 + [1] * 5 + [2] * 2), ([0, 1.5, 2.5, 4.5, 5], [0, 0, 1, 1, 2]), ([0, 1, 2], [0, 0, 0])],
)
def test_idle_split(spark, times, chunks):
    rows = spark.createDataFrame([(1, 1, i, float(t), float(t)) for i, t in enumerate(times)], "video_id long, segment long, seq long, start double, end double")
    assert [r["chunk"] for r in segments.split_idle(rows).orderBy("seq").collect()] == chunks


def test_folds_over_one_long_video_are_linear(spark):
    """200,000 frames of one video, and an idle run of 200,000 labels, against plain loops."""
    import random
    import time

    rnd, n = random.Random(2), 200_000
    made = [(1, i, i / 10, rnd.choice([20.0, 90.0, 92.0, 120.0, 160.0]), rnd.choice([10.0, 80.0, 90.0]), rnd.choice([None, 1.0, 20.0, 30.0])) for i in range(n)]
    began = time.time()
    got = frames.filter_frames(spark.createDataFrame(made, "video_id long, seq long, ts double, brightness double, lapvar double, flow double")).select("seq", "verdict").collect()
    last, flows, want = None, [], {}
    for _, i, _, bright, sharp, flow in made:
        if bright < 30:
            want[i] = "dark"
        elif sharp < 50:
            want[i] = "blur"
        elif last is not None and 1 - abs(bright - last) / 100 > 0.95:
            want[i] = "duplicate"
        else:
            flows = [flow or 0.0, *flows][:3]
            want[i] = "transition" if len(flows) == 3 and min(flows[:2]) > 15 else "good"
            last = bright if want[i] == "good" else last
    assert {r["seq"]: r["verdict"] for r in got} == want and len(set(want.values())) == 5
    labels = spark.createDataFrame([(1, 1, i, i / 2, i / 2 + 0.5) for i in range(n)], "video_id long, segment long, seq long, start double, end double")
    chunks = {r["seq"]: r["chunk"] for r in segments.split_idle(labels).collect()}
    assert chunks == {i: i // 4 for i in range(n)}
    assert time.time() - began < 120


def test_transitions_come_after_a_group_of_the_same_start(spark):
    groups = segments.groups_of(segments.group_labels(_labels(spark, SMOKE)))
    ranges = spark.createDataFrame([(1, 5.0, 6.5)], "video_id long, start double, end double")
    placed = segments.insert_transitions(groups, ranges).orderBy("place").collect()
    assert [r["action"] for r in placed] == ["pick_up", "tighten_bolt", "transition", "idle"]
    short = spark.createDataFrame([(1, 5.0, 5.2)], "video_id long, start double, end double")
    assert segments.segments(_labels(spark, SMOKE), short).count() == 3


@pytest.mark.parametrize(
    ("values", "filled"),
    [
        ([1, None, None, 4], [1, 1, 4, 4]), ([1, None, None, None, 5], [1, 1, 3, 5, 5]), ([1, None, 3], [1, 1, 3]), ([None, None, 3], [3, 3, 3]),
        ([1, *[None] * 6, 9], [1, *[None] * 6, 9]), ([1, *[None] * 5, 9], [1, 1, 3, 5, 7, 9, 9]),
    ],
)
def test_gap_fill(spark, values, filled):
    rows = spark.createDataFrame([(1, "left", i, None if x is None else float(x)) for i, x in enumerate(values)], "video_id long, handedness string, seq long, x double")
    assert [r["x"] for r in tracks.fill_gaps(rows, "x").orderBy("seq").collect()] == filled


def test_smoothing_keeps_quadratics(spark):
    rows = spark.createDataFrame([(1, "left", i, 3.0 * i * i - 2 * i + 1) for i in range(9)], "video_id long, handedness string, seq long, x double")
    assert [r["x"] for r in tracks.smooth(rows, "x").orderBy("seq").collect()] == pytest.approx([3.0 * i * i - 2 * i + 1 for i in range(9)])
    few = rows.where("seq < 4")
    assert [r["x"] for r in tracks.smooth(few, "x").orderBy("seq").collect()] == [1, 2, 9, 22]


def test_contact_scores(spark):
    boxes = spark.range(1).select(g.iou(g.box(*map(F.lit, (0, 0, 100, 100))), g.box(*map(F.lit, (50, 50, 150, 150)))).alias("iou"))
    got = boxes.select("iou", *[g.contact_score(F.col("iou"), F.lit(d).cast("double"), F.lit(n)).alias(f"s{k}") for k, (d, n) in enumerate([(None, 1), (None, 0), (0.02, 1)])]).first()
    assert got["iou"] == pytest.approx(0.142857, abs=1e-6)
    assert list(got[1:]) == pytest.approx([0.4083, 0.25, 0.6])


def test_costs_and_names(spark):
    got = frames.estimate_cost(spark.createDataFrame([(1, 685, 298), (2, 0, 0)], "video_id long, total long, kept long")).orderBy("video_id").collect()
    assert (got[0]["n_batches"], got[0]["keep_ratio"], got[0]["cost_gemini"], got[0]["cost_claude_sonnet"]) == (60, 0.435, 3.0, 21.0)
    assert (got[1]["n_batches"], got[1]["keep_ratio"], got[1]["cost_inr"]) == (0, 0.0, 0.0)
    named = frames.name_frames(spark.createDataFrame([(1, "frame_00000004.jpg"), (1, "other.png")], "video_id long, file string"), 2.0, 0.015).collect()
    assert [(r["ts"], r["frame_name"]) for r in named] == [(1.515, "frame_0000001515.jpg")]
    stride = frames.sample_stride(spark.range(300).select(F.lit(1).alias("video_id"), F.col("id").alias("seq")), 30, 2)
    assert sorted(r["ts"] for r in stride.collect()) == [0.5 * i for i in range(20)]


def test_metrics_and_weights(spark):
    pairs = [("pick_up", "pick_up")] * 8 + [("pick_up", "place")] * 2 + [("tighten", "tighten")] * 5 + [("tighten", "place")] * 5 + [("place", "place")] * 10
    m = evaluate.confusion_matrix(spark.createDataFrame(pairs, "true_cls string, pred_cls string"))
    got = {r["cls"]: r for r in evaluate.class_metrics(m).collect()}
    assert [round(got[c]["precision"], 4) for c in ("pick_up", "tighten", "place")] == [1.0, 1.0, 0.5882]
    assert [got[c]["recall"] for c in ("pick_up", "tighten", "place")] == [0.8, 0.5, 1.0]
    assert {(r["class_a"], r["rate"]) for r in evaluate.confused_pairs(m).collect()} == {("tighten", 0.5), ("pick_up", 0.2)}
    w = evaluate.class_weights(spark.createDataFrame([("a",)] * 3 + [("b",)], "action string")).orderBy("action").collect()
    assert [r["weight"] for r in w] == [0.5, 1.5]


def test_clock_and_phases(spark):
    one = spark.range(1).select(segments.clock(F.lit(6015.0)).alias("c"), *[segments.phases_valid(F.array(*map(F.lit, p))).alias(f"p{i}") for i, p in enumerate([["reach", "manipulate", "hold"], ["release", "grasp"], ["idle", "grasp", "foo"]])]).first()
    assert list(one) == ["100:15", True, False, True]


def test_entry_points(spark, tiny):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_score_summary(spark):
    rows = [("a", x) for x in (0.8, 0.6, 0.59, 0.2, 0.1, None)] + [("b", None)]
    (r,) = segments.score_summary(spark.createDataFrame(rows, "video_id string, q double"), "q").collect()
    assert (r["median"], r["min"], r["max"], r["n"]) == (0.59, 0.1, 0.8, 5)
    assert [r[k] for k in ("excellent", "good", "fair", "poor", "discard")] == [1, 1, 1, 1, 1]


def test_csv_sink(spark, tmp_path):
    from frameloom.sources import sinks

    segs = spark.createDataFrame(
        [("v", 2, 1.0, 2.0, 1.0, "place", ["cup", 'a "b", c'], "none", "right", ["reach", "hold"], 0.5, False, None), ("v", 1, 0.0, 1.0, 1.0, "idle", [], None, "none", [], 0.25, True, "low_confidence")],
        "video_id string, segment_id long, start_time double, end_time double, duration double, action string, objects array<string>, grasp_type string, hand_used string, phases array<string>, confidence_avg double, needs_review boolean, review_reason string",
    )
    sinks.write_csv(segs, f"{tmp_path}/out", spark.createDataFrame([("v", 2, 0.75)], "video_id string, segment_id long, quality_score double"))
    got = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/out").orderBy("segment_id").collect()
    assert tuple(got[0].asDict()) == (*sinks.CSV_COLUMNS, "video_id")
    assert (got[1]["objects"], got[1]["manipulation_phases"], got[1]["quality_score"], got[1]["review_reason"]) == ('cup; a "b", c', "reach -> hold", "0.75", None)
    assert (got[0]["objects"], got[0]["quality_score"], got[0]["needs_review"]) == (None, None, "true")


def test_whole_videos_are_strided_and_named(spark):
    from frameloom.sources import views

    d = "/root/testdata/sf0.01"
    count = views.frames(spark, d).count()
    assert catalog.queries()["frame_names_whole"](spark, d).count() == count
    assert catalog.queries()["frame_stride_whole"](spark, d).count() == views.frames(spark, d).where("seq % 4 = 0").count()


def test_batch_context(spark):
    frames = spark.createDataFrame([(1, 0, 0.0, 0.9), (1, 0, 0.5, 0.7), (1, 1, 2.5, 0.2), (1, 1, 3.0, 0.2)], "video_id long, batch_id long, ts double, activity double")
    hands = spark.createDataFrame([(1, 0, 0, "right", 0.5), (1, 0, 1, "left", 0.9), (1, 0, 1, "right", 0.75)], "video_id long, batch_id long, seq long, handedness string, confidence double")
    seen = [(1, 0, 0, 0, "nut", 0.5, 1, 2), (1, 0, 0, 1, "bolt", 0.5, 3, 4), (1, 0, 1, 0, "bolt", 0.5, 9, 9), (1, 0, 1, 1, "gear", 0.8, 5, 6)]
    objects = spark.createDataFrame(seen, "video_id long, batch_id long, seq long, ordinal long, class_name string, confidence double, cx int, cy int")
    held = [(1, 0, "left", "nut", 0.25, "pinch", 0.75, 0, 0), (1, 0, "left", "nut", 0.5, "hook", 0.5, 1, 0), (1, 0, "right", "gear", 0.1, "power", 0.5, 1, 1)]
    contacts = spark.createDataFrame(held, "video_id long, batch_id long, hand string, class_name string, iou double, grasp_type string, contact_score double, seq long, ordinal long")
    got = {r["batch_id"]: r["context"].split("\n") for r in context.batch_context(frames, hands, objects, contacts).collect()}
    assert got[0] == [
        "Local CV metadata for frames 0.0s - 0.5s:",
        "  Hands: right hand detected (conf 0.63), left hand detected (conf 0.90)",
        "  Objects: gear (conf 0.80, center [5,6]), nut (conf 0.50, center [1,2]), bolt (conf 0.50, center [3,4])",
        "  Interactions: left hand contacting nut (IoU 0.25, grasp: pinch, conf 0.75); right hand contacting gear (IoU 0.10, grasp: power, conf 0.50)",
        "  Activity: 0.80 (active manipulation)",
    ]
    assert got[1][1:] == ["  Hands: none detected", "  Objects: none detected", "  Interactions: none detected", "  Activity: 0.20 (idle/observing)"]
    assert context.batch_context(frames.limit(0), hands, objects, contacts).isEmpty()

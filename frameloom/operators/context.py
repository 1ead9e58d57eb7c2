"""Text about a batch of frames, for prompts: what was seen in it, one line for each kind."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.operators import hands as many
from frameloom.operators.labels import top_interactions

KEY = ["video_id", "batch_id"]
#: The text's wording, and the mean activity above which a batch has a name; how many contacts the short text and the line on depth tell of.
NONE = "none detected"
ACTIVE, POSSIBLE = (many.ACTIVE, "active manipulation"), (many.POSSIBLE, "possible activity")
SHORT, DEEP = 3, 2
QUIET = "idle/observing"


def digits(v: Column, n: int = 2) -> Column:
    """v with n digits; what lies between two goes up, whatever v's last bit."""
    return F.format_string(f"%.{n}f", v + 1e-9)


def activity_name(mean: Column) -> Column:
    """Name of a mean activity, taken to nine digits so that the order of a sum doesn't tell."""
    m = F.round(mean, 9)
    return F.when(m > ACTIVE[0], ACTIVE[1]).when(m > POSSIBLE[0], POSSIBLE[1]).otherwise(QUIET)


def _line(parts: DataFrame, by: list[Column], text: Column, name: str, sep: str = ", ") -> DataFrame:
    """One row a batch: its parts' texts in order. A batch has few parts: one for each hand, class, or strong contact."""
    found = parts.select(*KEY, F.struct(*[c.alias(f"_{i}") for i, c in enumerate(by)], text.alias("text")).alias("p"))
    return found.groupBy(*KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["text"]), sep).alias(name))


def hand_line(hands: DataFrame) -> DataFrame:
    """(video_id, batch_id, hands): each hand of hands (video_id, batch_id, seq, handedness, confidence) with its mean confidence, in order of appearance."""
    each = hands.groupBy(*KEY, "handedness").agg(F.avg("confidence").alias("c"), F.min("seq").alias("first"))
    return _line(each, [F.col("first"), F.col("handedness")], F.concat("handedness", F.lit(" hand detected (conf "), digits(F.col("c")), F.lit(")")), "hands")


def object_line(objects: DataFrame) -> DataFrame:
    """(video_id, batch_id, objects): the surest object of each class of objects (video_id, batch_id, seq, ordinal, class_name, confidence, cx, cy), the first of equals; surest class first, then by appearance."""
    order = F.struct("confidence", -F.col("seq"), -F.col("ordinal"))
    each = objects.groupBy(*KEY, "class_name").agg(F.max_by(F.struct("confidence", "cx", "cy"), order).alias("b"), F.min(F.struct("seq", "ordinal")).alias("first"))
    text = F.concat("class_name", F.lit(" (conf "), digits(F.col("b.confidence")), F.lit(", center ["), F.col("b.cx").cast("string"), F.lit(","), F.col("b.cy").cast("string"), F.lit("])"))
    return _line(each, [-F.col("b.confidence"), F.col("first")], text, "objects")


def contact_line(contacts: DataFrame) -> DataFrame:
    """(video_id, batch_id, contacts): the strongest contacts, by top_interactions(), of rows that also have iou and grasp_type."""
    text = F.concat("hand", F.lit(" hand contacting "), "class_name", F.lit(" (IoU "), digits(F.col("iou")), F.lit(", grasp: "), "grasp_type", F.lit(", conf "), digits(F.col("contact_score")), F.lit(")"))
    return _line(top_interactions(contacts), [F.col("rank")], text, "contacts", "; ")


def depth_line(frames: DataFrame, contacts: DataFrame, depth: str, look_up: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """(video_id, batch_id, deep): depths in the first frame of a batch that has a map, under each of its hands' wrists and under the strongest contacts' objects. Only batches with contacts have the line.

    frames is (video_id, batch_id, seq, hands, a map or null), contacts (video_id, batch_id, class_name, contact_score, seq, ordinal, cx, cy).
    """
    first = frames.where(F.col(depth).isNotNull()).groupBy(*KEY).agg(F.min_by(F.struct("hands", F.col(depth).alias("map")), "seq").alias("f")).select(*KEY, "f.*")
    strongest = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("contact_score"), "seq", "ordinal"))
    best = contacts.withColumn("_r", strongest).where(F.col("_r") <= DEEP).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("_r", "class_name", "cx", "cy"))).alias("best"))
    rows = first.join(best, KEY)
    seen = F.filter("hands", lambda h: F.size(h["pixels"]) > 0)
    wrist = F.transform(seen, lambda h: F.concat(F.lit("hand at "), digits(look_up(F.col("map"), F.get(h["pixels"], F.lit(0))["x"], F.get(h["pixels"], F.lit(0))["y"]))))
    held = F.transform("best", lambda b: F.concat(b["class_name"], F.lit(" at "), digits(look_up(F.col("map"), b["cx"], b["cy"]))))
    return rows.select(*KEY, F.array_join(F.concat(F.coalesce(wrist, F.expr("cast(array() as array<string>)")), held), ", ").alias("deep"))


def heading(start: Column, end: Column) -> Column:
    return F.concat(F.lit("Local CV metadata for frames "), digits(start, 1), F.lit("s - "), digits(end, 1), F.lit("s:"))


def short_context(frames: DataFrame, hands: DataFrame, objects: DataFrame, contacts: DataFrame) -> DataFrame:
    """(video_id, batch_id, context): the short text of a batch. Hands by name, the surest confidence of each class, the three strongest contacts, mean activity; what a batch doesn't have has no line, but for hands.

    frames, hands, objects and contacts are as for batch_context(); contacts need no iou and no grasp_type.
    """
    span = frames.groupBy(*KEY).agg(F.min("ts").alias("_a"), F.max("ts").alias("_z"), F.avg("activity").alias("_m"))
    named = hands.groupBy(*KEY).agg(F.array_join(F.array_sort(F.collect_set("handedness")), ", ").alias("hands"))
    each = objects.groupBy(*KEY, "class_name").agg(F.max("confidence").alias("c"), F.min(F.struct("seq", "ordinal")).alias("first"))
    classes = _line(each, [-F.col("c"), F.col("first")], F.concat("class_name", F.lit(" (conf "), digits(F.col("c")), F.lit(")")), "objects")
    strongest = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("contact_score"), "seq", "ordinal"))
    top = contacts.withColumn("rank", strongest).where(F.col("rank") <= SHORT)
    held = _line(top, [F.col("rank")], F.concat("hand", F.lit(" hand -> "), "class_name", F.lit(" (score "), digits(F.col("contact_score")), F.lit(")")), "contacts", "; ")
    rows = span.join(named, KEY, "left").join(classes, KEY, "left").join(held, KEY, "left")
    lines = [heading(F.col("_a"), F.col("_z")), F.concat(F.lit("  Hands: "), F.coalesce(F.concat("hands", F.lit(" detected")), F.lit(NONE)))]
    lines += [F.concat(F.lit("  Objects: "), "objects"), F.concat(F.lit("  Interactions: "), "contacts"), F.concat(F.lit("  Activity score: "), digits(F.col("_m")))]
    return rows.select(*KEY, F.concat_ws("\n", *lines).alias("context"))


def batch_context(frames: DataFrame, hands: DataFrame, objects: DataFrame, contacts: DataFrame, deep: DataFrame | None = None) -> DataFrame:
    """(video_id, batch_id, mean_activity, activity_name, context) for each batch of frames (video_id, batch_id, ts, activity).

    The other three are as for their lines; a batch without rows in one says so. deep is what depth_line() gives; without it, or for a batch that it lacks, depth is not told.
    """
    span = frames.groupBy(*KEY).agg(F.min("ts").alias("_a"), F.max("ts").alias("_z"), F.avg("activity").alias("mean_activity"))
    for part in (hand_line(hands), object_line(objects), contact_line(contacts)):
        span = span.join(part, KEY, "left")
    name = activity_name(F.col("mean_activity"))
    lines = [heading(F.col("_a"), F.col("_z"))]
    lines += [F.concat(F.lit(f"  {title}: "), F.coalesce(c, F.lit(NONE))) for title, c in (("Hands", "hands"), ("Objects", "objects"), ("Interactions", "contacts"))]
    lines += [F.concat(F.lit("  Activity: "), digits(F.col("mean_activity")), F.lit(" ("), name, F.lit(")"))]
    if deep is not None:
        span = span.join(deep, KEY, "left")
        lines.append(F.concat(F.lit("  Depth: "), "deep"))
    return span.select(*KEY, "mean_activity", name.alias("activity_name"), F.concat_ws("\n", *lines).alias("context"))

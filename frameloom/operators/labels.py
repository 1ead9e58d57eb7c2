"""Labels from responses, their union with idle frames, routing to the fallback, and summaries over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields that a response must have, and the label of an idle frame.
REQUIRED = ("actions",)
IDLE = {"action": "idle", "description": "No productive manipulation activity detected", "hand": "none", "grasp": "none", "phase": "idle", "confidence": 0.95}
ACTION = "struct<action:string,action_description:string,objects_involved:array<string>,grasp_type:string,hand_used:string,manipulation_phase:string,high_level_task:string,confidence:double,is_idle:boolean,is_transition:boolean>"


def unfenced(text: Column) -> Column:
    """text without white space around it and without a code fence."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"^```(?:json)?\s*\n?", ""), r"\n?```\s*$", ""))


def parse_responses(responses: DataFrame, text: str = "response") -> DataFrame:
    """responses with error (null, not_json, not_object, missing_fields) and the label of the first action; without actions it is unknown."""
    body = unfenced(F.col(text))
    rows = responses.withColumn("_body", body).withColumn("_v", F.try_parse_json("_body"))
    kind = F.schema_of_variant("_v")
    keys = F.json_object_keys("_body")
    lacking = F.size(F.array_except(F.array(*map(F.lit, REQUIRED)), keys)) > 0
    error = F.when(F.col("_v").isNull(), "not_json").when(~kind.startswith("OBJECT"), "not_object").when(lacking, "missing_fields")
    rows = rows.withColumn("error", error).withColumn("_a", F.when(F.col("error").isNull(), F.get(F.from_json(F.get_json_object("_body", "$.actions"), f"array<{ACTION}>"), F.lit(0))))
    a, none = F.col("_a"), F.col("_a").isNull()
    field = lambda name, default, empty=None: F.when(F.col("error").isNull(), F.when(none, F.lit(empty if empty is not None else default)).otherwise(F.coalesce(a[name], F.lit(default))))
    return rows.select(
        *responses.columns, "error", field("action", "unknown").alias("action"), field("action_description", "", "VLM returned no actions").alias("description"),
        F.when(F.col("error").isNull(), F.coalesce(a["objects_involved"], F.expr("cast(array() as array<string>)"))).alias("objects"),
        field("grasp_type", "none").alias("grasp"), field("hand_used", "none").alias("hand"), field("manipulation_phase", "unknown").alias("phase"),
        F.when(F.col("error").isNull() & ~none, F.coalesce(a["high_level_task"], F.lit("unknown"))).alias("high_level"),
        field("confidence", 0.0).alias("confidence"), field("is_idle", False).alias("is_idle"), field("is_transition", False).alias("is_transition"),
    )


def at_frames(frames: DataFrame, annotations: DataFrame, order: str = "seq") -> DataFrame:
    """frames (video_id, ts, ...) with the annotation of their time (video_id, ts, ...): joined by whole milliseconds, which doubles of one time share. Of several for one time the last by `order` counts; frames without one are dropped. Columns that both have are the frame's."""
    ms = F.round(F.col("ts") * 1000).cast("long")
    mine = [c for c in annotations.columns if c not in frames.columns]
    last = annotations.withColumn("_ms", ms).groupBy("video_id", "_ms").agg(F.max_by(F.struct(*mine), order).alias("_a"))
    return frames.withColumn("_ms", ms).join(last, ["video_id", "_ms"]).select(*[F.col(c) for c in frames.columns], "_a.*")


def with_idle(labels: DataFrame, idle_frames: DataFrame) -> DataFrame:
    """labels (video_id, start, end, action, hand, grasp, phase, confidence) and a point label for each idle frame (video_id, ts), with place by start; on a tie labels come first."""
    mine = labels.select("video_id", "start", "end", *[c for c in IDLE if c != "description"], F.lit(0).alias("_rank"), F.col("seq").alias("_seq"))
    idle = idle_frames.select("video_id", F.col("ts").alias("start"), F.col("ts").alias("end"), *[F.lit(x).alias(c) for c, x in IDLE.items() if c != "description"], F.lit(1).alias("_rank"), F.col("seq").alias("_seq"))
    place = F.row_number().over(Window.partitionBy("video_id").orderBy("start", "_rank", "_seq")).cast("long")
    return mine.unionByName(idle).withColumn("place", place).drop("_rank", "_seq")


def route(predictions: DataFrame, names: DataFrame, confused: DataFrame, threshold: float = 0.4, available: bool = True) -> DataFrame:
    """predictions (class_id, confidence, ...) with action (class_<id> if it has no name) and fallback: sent on if unsure, or if the action is one of a confused pair (class_a, class_b)."""
    named = predictions.join(F.broadcast(names.select("class_id", F.col("name").alias("_name"))), "class_id", "left")
    named = named.withColumn("action", F.coalesce("_name", F.concat(F.lit("class_"), F.col("class_id").cast("string")))).drop("_name")
    either = confused.select(F.col("class_a").alias("action")).union(confused.select("class_b")).distinct().withColumn("_confused", F.lit(True))
    out = named.join(F.broadcast(either), "action", "left")
    return out.withColumn("fallback", F.lit(available) & ((F.col("confidence") < threshold) | F.coalesce("_confused", F.lit(False)))).drop("_confused")


def batch_summary(results: DataFrame) -> DataFrame:
    """One row over per-video results (status, segments, cost_inr, needs_review, quality_mean): sums and the mean quality are over complete ones, and a quality of 0 or none doesn't count."""
    done = F.col("status") == "complete"
    n = lambda s: F.count_if(F.col("status") == s)
    total = lambda c, zero: F.coalesce(F.sum(F.when(done, F.col(c))), F.lit(zero))
    good = F.when(done & (F.col("quality_mean") != 0), F.col("quality_mean"))
    return results.agg(n("complete").alias("n_complete"), n("skipped").alias("n_skipped"), n("error").alias("n_error"), total("segments", 0).alias("segments"), total("needs_review", 0).alias("needs_review"), F.round(total("cost_inr", 0.0), 2).alias("cost_inr"), F.round(F.coalesce(F.avg(good), F.lit(0.0)), 3).alias("mean_quality"))


def call_costs(calls: DataFrame, price: float) -> DataFrame:
    """(video_id, total_calls, total_cost_inr, cost_per_call_inr) of calls (video_id, succeeded): only those that succeeded are paid."""
    n = calls.groupBy("video_id").agg(F.count_if("succeeded").alias("total_calls"))
    cost = F.col("total_calls") * price
    return n.withColumn("total_cost_inr", F.round(cost, 2)).withColumn("cost_per_call_inr", F.coalesce(F.round(F.try_divide(cost, F.col("total_calls").cast("double")), 4), F.lit(0.0)))


def top_interactions(contacts: DataFrame, first: int = 5) -> DataFrame:
    """contacts (video_id, batch_id, hand, class_name, contact_score, seq, ordinal): the `first` strongest of a batch, then of those the strongest of each (hand, class_name), with rank."""
    order = [F.desc("contact_score"), "seq", "ordinal"]
    top = contacts.withColumn("_r", F.row_number().over(Window.partitionBy("video_id", "batch_id").orderBy(*order))).where(F.col("_r") <= first)
    once = top.withColumn("_k", F.row_number().over(Window.partitionBy("video_id", "batch_id", "hand", "class_name").orderBy("_r"))).where("_k = 1")
    return once.withColumn("rank", F.row_number().over(Window.partitionBy("video_id", "batch_id").orderBy("_r")).cast("long")).drop("_r", "_k")

"""Training tables and classifier evaluation."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.geometry import area, contact_score, dist, iou, tips_inside

#: Actions that are no training classes.
NOT_TRAINED = ("idle", "transition", "unknown")


def training_samples(segs: DataFrame, min_confidence: float = 0.6) -> DataFrame:
    """Segments to learn from, with class_id: dense, in order of action. The vocabulary has one row per action."""
    kept = segs.where((F.round("confidence_avg", 4) >= min_confidence) & ~F.col("action").isin(*NOT_TRAINED))
    return kept.join(vocabulary(kept), "action")


def vocabulary(samples: DataFrame, column: str = "action") -> DataFrame:
    classes = samples.select(column).distinct()
    return classes.withColumn("class_id", (F.row_number().over(Window.orderBy(column)) - 1).cast("long"))


def class_weights(samples: DataFrame) -> DataFrame:
    """(action, n, weight): inverse frequency, scaled to a mean of 1 over the classes."""
    n = samples.groupBy("action").agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    raw = n.withColumn("_w", F.sum("n").over(every) / (F.count("*").over(every) * F.greatest("n", F.lit(1))))
    return raw.withColumn("weight", F.col("_w") / F.avg("_w").over(every)).drop("_w")


def class_distribution(samples: DataFrame, classes: DataFrame) -> DataFrame:
    """(action, n) for every action of classes, zeros included."""
    return classes.select("action").distinct().join(samples.groupBy("action").agg(F.count("*").alias("n")), "action", "left").fillna({"n": 0})


def metadata_features(segs: DataFrame) -> DataFrame:
    """segs (with path_length, max_velocity, grasp_events) with features: twelve numbers, floats for training."""
    is_hand = lambda h: F.when(F.col("hand_used") == h, 1.0).otherwise(0.0)
    parts = ["confidence_avg", "confidence_min", "duration", "frames_analyzed", is_hand("right"), is_hand("left"), is_hand("both"), F.size("objects"), F.size("phases"), "path_length", "max_velocity", "grasp_events"]
    return segs.withColumn("features", F.array(*[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("float"), F.lit(0.0).cast("float")) for c in parts]))


#: Bits of a hash that one histogram of the split tells apart, and rows that may be put in order at once: neither depends on the samples.
SPLIT_BITS, SPLIT_ROWS = 12, 4096


def train_val_split(samples: DataFrame, *key: str, split: float = 0.2, seed: int = 42) -> DataFrame:
    """samples with is_validation: exactly max(1, int(n * split)) rows, those with the smallest hashes (n is the number of rows; none of none).

    The border hash is found by histograms: of the first bits of all hashes, then of the next bits inside the border's
    bucket, until few rows are left, whose hashes and keys are put in order. Then each row is compared with the border
    on its own: no join and no table that grows with the samples. Rows of one key have one side, so key should be
    unique; equal ones at the border are all in.
    """
    h = F.xxhash64(*key, F.lit(seed))
    hashed = samples.select(h.alias("_h"), *key).persist(StorageLevel.DISK_ONLY)  # read a few times; a lost block is made again
    inside, left, shift = hashed, None, 64
    while True:
        shift = max(0, shift - SPLIT_BITS)
        bucket = F.shiftright("_h", shift)
        counts = sorted((r["b"], r["n"]) for r in inside.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect())  # 2 ** SPLIT_BITS rows at most
        if not counts:
            hashed.unpersist()
            return samples.withColumn("is_validation", F.lit(False))
        left = max(1, int(sum(n for _, n in counts) * split)) if left is None else left
        for border, n in counts:
            if left <= n:
                break
            left -= n
        inside = inside.where(bucket == border)
        if n <= SPLIT_ROWS or not shift:
            # with all bits used, only rows of one hash are left: of these no more are fetched than count
            last = inside.orderBy("_h", *key).limit(min(left, SPLIT_ROWS)).collect()[-1]
            break
    hashed.unpersist()
    place = F.struct(h.alias("_h"), *[F.col(k).alias(k) for k in key])
    kinds = inside.schema
    limit = samples.sparkSession.createDataFrame([tuple(last)], kinds).select(F.struct("_h", *key).alias("_last"))
    return samples.join(F.broadcast(limit)).withColumn("is_validation", place <= F.col("_last")).drop("_last")


def confusion_matrix(preds: DataFrame) -> DataFrame:
    """(true_cls, pred_cls, n) for every pair of classes that occur, zeros included: the grid is as small as the classes are few."""
    n = preds.groupBy("true_cls", "pred_cls").agg(F.count("*").alias("n"))
    classes = n.select(F.col("true_cls").alias("c")).union(n.select("pred_cls")).distinct()
    grid = classes.select(F.col("c").alias("true_cls")).crossJoin(classes.select(F.col("c").alias("pred_cls")))
    return grid.join(n, ["true_cls", "pred_cls"], "left").fillna({"n": 0})


def class_metrics(matrix: DataFrame) -> DataFrame:
    """(cls, support, precision, recall, f1) from a confusion matrix."""
    by_true = matrix.groupBy(F.col("true_cls").alias("cls")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("true_cls") == F.col("pred_cls"), F.col("n")).otherwise(0)).alias("hit"))
    by_pred = matrix.groupBy(F.col("pred_cls").alias("cls")).agg(F.sum("n").alias("predicted"))
    m = by_true.join(by_pred, "cls")
    m = m.withColumn("precision", F.col("hit") / F.greatest("predicted", F.lit(1))).withColumn("recall", F.col("hit") / F.greatest("support", F.lit(1)))
    both = F.col("precision") + F.col("recall")
    return m.select("cls", "support", "precision", "recall", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0).alias("f1"))


def overall_metrics(matrix: DataFrame) -> DataFrame:
    """One row: n, accuracy, and f1 as the classes' plain mean and by their support."""
    f1 = class_metrics(matrix).agg(F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / F.greatest(F.sum("support"), F.lit(1))).alias("weighted_f1"))
    hit = matrix.agg(F.sum("n").alias("n"), (F.sum(F.when(F.col("true_cls") == F.col("pred_cls"), F.col("n")).otherwise(0)) / F.greatest(F.sum("n"), F.lit(1))).alias("accuracy"))
    return hit.crossJoin(f1)


def confused_pairs(matrix: DataFrame, threshold: float = 0.10) -> DataFrame:
    """(class_a, class_b, rate): how often a is taken for b, where that is over threshold."""
    total = F.sum("n").over(Window.partitionBy("true_cls"))
    rated = matrix.withColumn("rate", F.col("n") / F.greatest(total, F.lit(1)))
    return rated.where((F.col("true_cls") != F.col("pred_cls")) & (F.col("rate") > threshold)).select(F.col("true_cls").alias("class_a"), F.col("pred_cls").alias("class_b"), "rate")


def contacts(hands: DataFrame, objects: DataFrame, least: float = 0.3) -> DataFrame:
    """Hand-object pairs of a frame with iou, tips, contact_score and their rank in the frame, best first; weak ones are dropped."""
    both = hands.join(objects, ["video_id", "seq"])
    scored = both.withColumn("iou", iou(F.col("hand_box"), F.col("bbox"))).withColumn("tips", tips_inside(F.col("pixels"), F.col("bbox")))
    scored = scored.withColumn("contact_score", contact_score(F.col("iou"), F.lit(None).cast("double"), F.col("tips"))).where(F.col("contact_score") >= least)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("video_id", "seq").orderBy(F.desc("contact_score"), "ordinal")).cast("long"))


def best_object_per_class(objects: DataFrame) -> DataFrame:
    """The surest object of each class in each video, the first of equals."""
    best = objects.groupBy("video_id", "class_name").agg(F.max_by(F.struct("seq", "ordinal", "confidence"), F.struct("confidence", -F.col("seq"), -F.col("ordinal"))).alias("b"))
    return best.select("video_id", "class_name", "b.*")


def activity_lite(hands: DataFrame) -> DataFrame:
    """hands (video_id, seq, handedness, pixels, missing), one row per frame, with activity: presence, and the motion of wrist and key points since the frame before if it shows the same hand. 0 without a hand."""
    w = Window.partitionBy("video_id").orderBy("seq")
    rows = hands.withColumn("_p", F.lag("pixels").over(w)).withColumn("_same", ~F.lag("missing").over(w) & (F.lag("handedness").over(w) == F.col("handedness")))
    steps = F.zip_with("pixels", "_p", dist)
    mean = F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size("pixels"), F.lit(1))
    motion = 0.35 * F.least(F.lit(1.0), F.get(steps, F.lit(0)) / 50) + 0.25 * F.least(F.lit(1.0), mean / 30)
    return rows.withColumn("activity", F.when(F.col("missing"), 0.0).otherwise(F.least(F.lit(1.0), 0.4 * 0.5 + F.when(F.col("_same"), motion).otherwise(0.0)))).drop("_p", "_same")


def activity(hands: DataFrame) -> DataFrame:
    """hands (video_id, seq, handedness, pixels, hand_box, missing), one row per readable frame, with activity: presence, and since the frame before, if it shows the same hand, the motion of wrist and key points and the change of the box's area."""
    w = Window.partitionBy("video_id").orderBy("seq")
    rows = hands.withColumn("_a", area(F.col("hand_box"))).withColumns({"_p": F.lag("pixels").over(w), "_pa": F.lag("_a").over(w), "_same": ~F.lag("missing").over(w) & (F.lag("handedness").over(w) == F.col("handedness"))})
    steps = F.zip_with("pixels", "_p", dist)
    mean = F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / (F.size("pixels") + 1e-8)
    grown = F.when(F.col("_pa") > 0, F.abs(F.col("_a") - F.col("_pa")) / F.col("_pa") / (1 + 1e-8)).otherwise(0.0)
    one = F.lit(1.0)
    motion = 0.3 * F.least(one, F.get(steps, F.lit(0)) / 50) + 0.2 * F.least(one, mean / 30) + 0.1 * F.least(one, grown / 0.3)
    return rows.withColumn("activity", F.when(F.col("missing"), 0.0).otherwise(F.least(one, 0.4 * 0.5 + F.when(F.col("_same"), motion).otherwise(0.0)))).drop("_a", "_p", "_pa", "_same")


def visibility(handedness: str | Column) -> Column:
    """Class of a set of handedness labels."""
    has = lambda h: F.array_contains(handedness, h)
    return F.when(F.size(handedness) == 0, "no_hands").when(has("left") & has("right"), "both_full").when(has("left"), "left_only").when(has("right"), "right_only").otherwise("partial")

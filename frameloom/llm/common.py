"""What the corpus operators share: tables in the cluster's shared folder, text rules, hot-key joins, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A side is broadcast only if its counted rows are at most this many; beyond, the same join shuffles.
BROADCAST_ROWS = 500_000
#: At most HOT_SHARE keys can each hold 1/HOT_SHARE of the rows, so the list of such keys has a proven bound.
HOT_SHARE = 512
HOT_SALTS = 64
#: While a table is written, its shuffle files go as soon as it is there, and Python workers get few rows at once: whole texts can be long.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
#: Words of 64 bits of a sieve: a fixed size, sent to every worker.
SIEVE_WORDS = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and all executors can reach: under spark.checkpoint.dir, which is only set here where it is unset in local mode (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and (found := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        base = found.get()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="frameloom-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/frameloom-{uuid.uuid4().hex}"


@contextmanager
def while_writing(spark: SparkSession) -> Iterator[None]:
    """WHILE_WRITING holds inside, the session's own values after."""
    before = {k: spark.conf.get(k, None) for k in WHILE_WRITING}
    for k, v in WHILE_WRITING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written once to the shared folder and read again: lineage ends there and a lost executor costs nothing but a reread. Shuffle files of the write are gone after it."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    with while_writing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by written() that nothing reads any more."""
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sieved(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is in wanted (one column), and some others: those whose key shares a bit with one of them. No shuffle of rows; a broadcast of at most SIEVE_WORDS rows, whatever the sizes."""
    place = lambda k: F.pmod(F.xxhash64(k), F.lit(64 * SIEVE_WORDS))
    bits = wanted.select(place(wanted.columns[0]).alias("_at")).selectExpr("shiftright(_at, 6) as _word", "shiftleft(1L, cast(_at & 63 as int)) as _bit")
    words = written(bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), "sieve")
    at = rows.where(F.col(key).isNotNull()).withColumn("_at", place(key)).withColumn("_word", F.expr("shiftright(_at, 6)"))
    return at.join(F.broadcast(words), "_word").where("shiftright(_bits, cast(_at & 63 as int)) & 1 = 1").select(*rows.columns)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def one_row(**cols: Column):
    """Generator that evaluates cols once and hands them on as columns; unlike a plain projection, the optimizer never copies their expressions into lambdas."""
    return F.inline(F.array(F.struct(*[c.alias(k) for k, c in cols.items()])))


def hot_keys(counts: DataFrame, key: str, n: str) -> DataFrame:
    """Of counts (key, n): the keys that hold at least 1/HOT_SHARE of all rows, so at most HOT_SHARE of them, whatever their number."""
    total = counts.agg(F.sum(n).alias("_total"))
    return counts.select(F.col(key).alias("_hot"), F.col(n).alias("_n")).where("_n > 1000").join(F.broadcast(total)).where(F.col("_n") * HOT_SHARE >= F.col("_total")).select("_hot")


def hot_salt(df: DataFrame, key: str) -> DataFrame:
    """The keys of df that hold at least 1/HOT_SHARE of its rows with one: at most HOT_SHARE rows, whatever df's size."""
    return hot_keys(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), key, "n")


def hot_table(counts: DataFrame, key: str, n: str = "n") -> DataFrame | None:
    """The keys of hot_keys, found at once and kept as a local table, so plans don't carry the search along; None where no key is hot. At most HOT_SHARE keys come to the driver."""
    with while_writing(counts.sparkSession):
        total, most = counts.agg(F.sum(n), F.max(n)).first()
    least = max(1001, -(-(total or 0) // HOT_SHARE))
    if not most or most < least:
        return None
    rows = counts.where(F.col(n) >= least).select(F.col(key).alias("_hot"))
    with while_writing(counts.sparkSession):
        return counts.sparkSession.createDataFrame(rows.collect(), rows.schema)


def hot_rows(df: DataFrame, key: str) -> DataFrame | None:
    """hot_table of the rows of df."""
    return hot_table(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), key)


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None, by: Column, how: str = "inner") -> DataFrame:
    """left join right on key, with right unique on key; left rows of a hot key are spread over HOT_SALTS partitions by the hash of `by`. A plain join where hot is None."""
    if hot is None:
        return left.join(right, key, how)
    hot = F.broadcast(hot)
    left = left.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(by), F.lit(HOT_SALTS))).otherwise(F.lit(0).cast("long"))).drop("_hot")
    right = right.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0).cast("long"), F.lit(HOT_SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long"))))).drop("_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node reachable. Raises if `rounds` are not enough.

    Alternating large-star and small-star steps: each is one shuffle whose per-node state is a running minimum,
    so a hub with a third of all edges is combined before the shuffle. Every step is a written table.
    """
    first = cur = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    nodes = cur.select(F.col("a").alias("node")).union(cur.select("b")).distinct()
    seen = None
    for _ in range(rounds):
        both = cur.union(cur.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "low")
        large = written(salted_join(both.where("v > u"), low.drop("n"), "u", hot_table(low, "u"), F.col("v")).select(F.col("v").alias("u"), F.col("m").alias("b")).where("u <> b").distinct(), "large")
        down = large.groupBy("u").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = salted_join(large, down.drop("n"), "u", hot_table(down, "u"), F.col("b"))
        new = written(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("u", "m")).where("a <> b").distinct(), "edges")
        dropped(low, large)
        state = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if cur is not first:
            dropped(cur)
        cur = new
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not converge in {rounds} rounds")
    stars = cur.groupBy("a").agg(F.min("b").alias("m"))
    return nodes.join(stars, nodes.node == stars.a, "left").select("node", F.coalesce("m", "node").alias("component"))


def union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

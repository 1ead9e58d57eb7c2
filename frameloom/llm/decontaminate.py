"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's windows are 13 consecutive words (all of them where an item has fewer). Seen as a set of shingles, a
window can only be contained in a document whose shingles include every one of it; so it is enough to join one
shingle of each window, and the rarest one in the corpus makes the fewest candidates. A candidate's place follows
from the shingle's place in its window; places that would reach outside the document are dropped, and the rest are
compared word by word. Document words are exploded inside generated code and only candidates become rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ascii_lower, hot_salt, one_row, salted_join, union, written

#: All but the word characters of the contract, before A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 4
#: Beyond a broadcast of the windows, places are first filtered by so many bits of their keys: at most 2^FILTER_BITS rows, whatever the benchmark.
FILTER_BITS = 21


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def shingle_key(words: str, at: Column, k: int) -> Column:
    """Hash of k words, in Unicode lower case word by word: equal for words that are equal once A-Z are lower-cased."""
    return F.xxhash64(F.lit(k), *[F.lower(F.get(F.col(words), at + j)) for j in range(k)])


def phrase(words: Column) -> Column:
    """Words as one string: no word has a space, so equal strings are equal words. Without a lambda, it stays in generated code."""
    return ascii_lower(F.array_join(words, " "))


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(words, m, item_ids): each different window once, m words long, with the items that have it."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), one_row(w=words_of(F.col(text)))).where(F.size("w") > 0)
    items = items.select("item_id", one_row(w=F.transform("w", ascii_lower)))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    each = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s + 1, window))).alias("words"))
    return each.groupBy("words").agg(F.collect_set("item_id").alias("item_ids")).withColumn("m", F.size("words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, percent: int = 5, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, item_ids (sorted as strings), contaminated (n_hit > 0 and 100 * n_hit >= percent * n_words).

    Null and empty texts have no words and are clean; repeated document rows each get their row; items without words
    have no window, repeated items count once for each different id, and an item with a null id marks words but is not counted. An empty benchmark leaves everything clean.
    """
    windows = written(item_windows(benchmark, item_id, item_text, window), "windows").withColumn("wid", F.xxhash64("words"))
    lengths = sorted(r[0] for r in windows.select(F.least("m", F.lit(SHINGLE))).distinct().collect())  # at most SHINGLE values
    # every shingle of every window, its length and its place
    places = windows.select("words", "m", "item_ids", "wid", F.posexplode(F.sequence(F.lit(0), F.greatest(F.col("m") - SHINGLE, F.lit(0)))).alias("offset", "_o"))
    keyed = F.lit(None).cast("long")
    for k in lengths:
        keyed = F.when(F.least("m", F.lit(SHINGLE)) == k, shingle_key("words", F.col("offset"), k)).otherwise(keyed)
    places = written(places.select(phrase(F.col("words")).alias("phrase"), "m", "item_ids", "wid", "offset", keyed.alias("key")), "places")
    size = places.agg(F.count("*").alias("n"), F.sum(F.octet_length("phrase") + 16 * F.size("item_ids")).alias("bytes")).first()
    few = size["n"] <= broadcast_rows and (size["bytes"] or 0) <= 256 * broadcast_rows
    bits = lambda key: key.bitwiseAND((1 << FILTER_BITS) - 1)

    def met(at: DataFrame, keys: DataFrame) -> DataFrame:
        """Rows of at whose key is one of keys, or, beyond the bound of a broadcast, may be."""
        if few:
            return at.join(F.broadcast(keys.select("key").distinct()), "key", "left_semi")
        return at.join(F.broadcast(keys.select(bits(F.col("key")).alias("_bits")).distinct()), bits(F.col("key")) == F.col("_bits"), "left_semi")

    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull()).alias("_th"), one_row(w=words_of(F.col(text))))

    def shingles(of: DataFrame, lead: list[str]) -> DataFrame:
        each = of.select(*lead, "w", F.posexplode("w").alias("pos", "_x"))
        keys = [shingle_key("w", F.col("pos"), k) for k in lengths]
        return each.withColumn("key", keys[0] if len(keys) == 1 else F.explode(F.array(*keys)))

    if lengths:
        counts = met(shingles(base, []).select("key"), places).groupBy("key").agg(F.count("*").alias("df"))
        rare = places.join(counts, "key", "left").groupBy("wid").agg(F.min_by(F.struct("phrase", "m", "item_ids", "offset", "key"), F.struct(F.coalesce("df", F.lit(0)), "key", "offset")).alias("p"))
        prefix = written(rare.select("p.*"), "prefix")
        start = F.col("pos") - F.col("offset")
        if few:
            cand = shingles(base, ["doc_id", "_th"]).join(F.broadcast(prefix), "key")
            fits = (start >= 0) & (start + F.col("m") <= F.size("w"))
            same = phrase(F.slice("w", start + 1, F.col("m"))) == F.col("phrase")
        else:  # the words around a place travel instead of the document, and only of places that the filter lets through
            near = met(shingles(base, ["doc_id", "_th"]), prefix).select("doc_id", "_th", "pos", "key", F.size("w").alias("n"), F.slice("w", F.greatest(F.col("pos") - window + 1, F.lit(0)) + 1, 2 * window).alias("w"))
            cand = salted_join(near, prefix, "key", hot_salt(near, "key"), F.struct("doc_id", "pos"))
            fits = (start >= 0) & (start + F.col("m") <= F.col("n"))
            same = phrase(F.slice("w", start - F.greatest(F.col("pos") - window + 1, F.lit(0)) + 1, F.col("m"))) == F.col("phrase")
        hits = cand.where(F.when(fits, same).otherwise(F.lit(False))).select("doc_id", "_th", start.alias("s"), (start + F.col("m")).alias("e"), "item_ids", F.lit(None).cast("long").alias("n_words"))
    else:
        hits = base.where(F.lit(False)).select("doc_id", "_th", F.lit(0).alias("s"), F.lit(0).alias("e"), F.array(F.lit("")).alias("item_ids"), F.lit(None).cast("long").alias("n_words"))
    plain = base.select("doc_id", "_th", F.lit(None).cast("int").alias("s"), F.lit(None).cast("int").alias("e"), F.lit(None).cast("array<string>").alias("item_ids"), F.size("w").cast("long").alias("n_words"))
    return covered(union(plain, hits), percent)


def covered(rows: DataFrame, percent: int) -> DataFrame:
    """rows: for each document row one with n_words, for each hit window one with its words s to e. Repeated documents share (doc_id, _th) and so their hits."""
    key = ["doc_id", "_th"]
    # a copy of a document finds the same windows again; per start only the longest end counts
    spans = rows.groupBy(*key, "s").agg(F.max("e").alias("e"), F.flatten(F.collect_set("item_ids")).alias("item_ids"), F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"))
    return spans.groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"),
        F.array_sort(F.collect_list(F.when(F.col("s").isNotNull(), F.struct("s", "e")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
    ).select(
        "doc_id", "n_words", "copies", "item_ids",
        F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"), (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["end"]), F.lit(0))).alias("n")), lambda a: a["n"]).alias("n_hit"),
    ).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"),
    ).drop("_copy")

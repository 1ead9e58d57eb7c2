"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Entities that fixed patterns find are seeds. The words before them and the shapes they have induce lexical patterns;
patterns and the instances they match form a graph on which scores are passed to and fro: a pattern is as good as its
instances, an instance as good as its patterns. Instances of high-confidence patterns that no fixed pattern knows are
new identifiers, next to the fixed patterns' own matches, which always stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_salt, one_row, salted_join, written

#: The contract's patterns, in forms that Java runs in linear time; length and digit checks follow.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "context")
#: A word that may be an identifier, and what a word is.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
TELLING = r"\p{L}|[0-9][^0-9]*[0-9][^0-9]*[0-9][^0-9]*[0-9]"
SPACE = r"[\x20\x09-\x0D]+"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value made once: a lambda over an array of one."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, op: Callable[[Column, Column], Column], zero: Column, levels: int = 3, block: int = 128) -> Column:
    """What op makes of zero and the elements before each element. A fold that appends copies its array at each step, so
    blocks are folded alone and then joined by their totals' own running values: linear for some hundred million elements."""

    def fold(a: Column) -> Column:
        return F.aggregate(a, F.array(zero), lambda s, v: F.concat(s, F.array(op(F.element_at(s, -1), v))))

    def joined(blocks: Column) -> Column:
        totals = running(F.transform(blocks, lambda b: F.element_at(b, -1)), op, zero, levels - 1, block)
        return bound(totals, lambda t: F.flatten(F.transform(blocks, lambda b, i: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda v: op(v, F.get(t, i))))))

    if levels == 1:
        return fold(values)
    last = lambda a: F.greatest(F.floor((F.size(a) - 1) / block).cast("int"), F.lit(0))
    return bound(values, lambda a: bound(F.transform(F.sequence(F.lit(0), last(a)), lambda k: fold(F.slice(a, k * block + 1, F.lit(block)))), joined))


WORD = "struct<start:bigint,end:bigint,value:string,left:string>"


def with_seeds(words: Column, base: Column) -> Column:
    """words (of type WORD) with seed: whether a span of base overlaps the word. Both are sorted together: a word meets a
    span if, of those that start before its end, the furthest end is beyond its start."""
    event = lambda at, tag, reach, word: F.struct(at.alias("at"), F.lit(tag).alias("tag"), reach.alias("reach"), word.alias("word"))
    nothing = F.lit(-1).cast("long")
    events = F.concat(F.transform(words, lambda w: event(w["end"], 0, nothing, w.cast(WORD))), F.transform(base, lambda b: event(b["start"], 1, b["end"], F.lit(None).cast(WORD))))

    def marked(e: Column) -> Column:
        reach = running(F.transform(e, lambda x: x["reach"]), F.greatest, nothing)
        seeds = bound(reach, lambda r: F.transform(e, lambda x, i: F.struct(x["word"].alias("word"), (F.get(r, i) > x["word"]["start"]).alias("seed"))))
        return F.filter(seeds, lambda x: x["word"].isNotNull())

    return bound(F.sort_array(events), marked)


def matches(text: Column, pattern: str, possible: Column) -> Column:
    """Array of (start, end, value) of the pattern's matches, in code points. The text is marked at each match and cut at the marks, so it is matched once, and only where `possible`."""
    marked = F.regexp_replace(F.translate(text, "\x01\x02", "\x03\x03"), pattern, "\x01$0\x02")
    parts = F.split(marked, "[\x01\x02]")
    none = F.lit(None).cast("array<string>")

    def spans(p: Column) -> Column:
        ends = running(F.transform(p, F.length), lambda a, n: a + n, F.lit(0))
        odd = F.sequence(F.lit(1), F.size(p) - 2, F.lit(2))
        return bound(ends, lambda e: F.transform(odd, lambda i: F.struct(F.get(e, i).alias("start"), F.get(e, i + 1).alias("end"), F.get(p, i).alias("value"), F.get(p, i - 1).alias("before"))))

    kept = F.when(possible, parts).otherwise(none)
    return F.coalesce(F.element_at(F.transform(F.array(kept), lambda p: F.when(F.size(p) > 2, spans(p))), 1), F.expr("cast(array() as array<struct<start:int,end:int,value:string,before:string>>)"))


def luhn(digits: Column) -> Column:
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_entities(text: Column) -> dict[str, Column]:
    """Kind -> array of (start, end, value, before): leftmost non-overlapping matches that pass the kind's checks."""
    digits = lambda v: F.translate(v, " ().+-", "")
    part = F.lit(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$")
    return {
        "email": matches(text, EMAIL, text.contains("@")),
        "ip": F.filter(matches(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda x: F.regexp(x["value"], part)),
        "card": F.filter(matches(text, CARD, text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9]")), lambda x: F.when(F.length(digits(x["value"])).between(12, 19), luhn(digits(x["value"]))).otherwise(F.lit(False))),
        "phone": F.filter(matches(text, PHONE, text.contains("+")), lambda x: F.length(digits(x["value"])).between(9, 15)),
    }


def shape(value: Column) -> Column:
    """Letters and digits of an instance by class, runs as one: 9-9 for 555-0199."""
    return F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), r"\p{L}+", "a")


def _ranked(rank: int, kind: str):
    return lambda x: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end"), x["value"].alias("value"))


def extract(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rounds: int = 3, support: int = 5, confidence: float = 0.9, out: str = "entities") -> DataFrame:
    """(doc_id, entities) for each row of docs; entities: array of (kind, start, end, value) by start, then kind as listed in KINDS; code points, end exclusive.

    A "context" entity is a word with a digit or an @, and a letter or four digits, that overlaps no other entity and whose pattern (word
    before, lower-cased, and shape) matched at least `support` different seeds and scores `confidence` or more. Every
    word with a digit or an @ counts for or against its pattern; identifiers of several words are found only by the fixed patterns.
    Null and empty texts have no entities; repeated rows each get theirs. Other columns of docs are ignored.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    with_digits = t.rlike("[0-9@]")
    found = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("th"), one_row(**base_entities(t), words=matches(t, CANDIDATE, with_digits)))
    base = F.concat(*[F.transform(k, _ranked(i, k)) for i, k in enumerate(KINDS[:4])])
    trimmed = lambda x: F.regexp_extract(x["value"], r"^[^\p{L}0-9@+]*(.*?)[^\p{L}0-9]*$", 1)
    lead = lambda x: F.length(F.regexp_extract(x["value"], r"^[^\p{L}0-9@+]*", 0))
    # the whole last word before the candidate, however long; the one before that is another candidate's, if it has a digit
    left = lambda c: F.lower(F.coalesce(F.nullif(F.substring_index(F.rtrim(F.translate(c, "\t\n\x0b\x0c\r", "     ")), " ", -1), F.lit("")), F.lit("^")))
    words = F.transform("words", lambda x: F.struct((x["start"] + lead(x)).cast("long").alias("start"), (x["start"] + lead(x) + F.length(trimmed(x))).cast("long").alias("end"), trimmed(x).alias("value"), left(x["before"]).alias("left")))
    table = written(found.select("doc_id", "th", F.array_sort(base).alias("base"), words.alias("words")), "entities")

    cand = table.where(F.size("words") > 0).select("doc_id", "th", F.explode(with_seeds(F.col("words"), F.col("base"))).alias("x")).select("doc_id", "th", "x.word.*", "x.seed")
    cand = cand.withColumn("pattern", F.concat_ws(" ", "left", shape(F.col("value"))))
    cand = written(cand.select("doc_id", "th", "start", "end", "value", "pattern", "seed"), "candidates")
    # the graph: each pattern and instance that meet, once; both sides' sums are combined before they are shuffled
    edges = written(cand.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "graph")
    score = edges.groupBy("value").agg(F.max("seed").cast("double").alias("s"))
    hot_values, hot_patterns = hot_salt(edges, "value"), hot_salt(edges, "pattern")
    for _ in range(rounds):
        patterns = salted_join(edges, score, "value", hot_values, F.col("pattern")).groupBy("pattern").agg((F.sum("s") / F.count("*")).alias("q"), F.sum(F.col("seed").cast("long")).alias("seeds"))
        trusted = patterns.where(F.col("seeds") >= support)
        score = written(salted_join(edges, trusted, "pattern", hot_patterns, F.col("value"), "left").groupBy("value").agg(F.max(F.when(F.col("seed"), 1.0).otherwise(F.coalesce("q", F.lit(0.0)))).alias("s")), "scores")
    # the word's own pattern decides, not what its value met elsewhere; a few digits alone identify nobody
    sure = written(trusted.where(F.col("q") >= confidence).select("pattern"), "patterns")
    free = cand.where(~F.col("seed") & F.col("value").rlike(TELLING))
    new = salted_join(free, sure, "pattern", hot_salt(free, "pattern"), F.struct("doc_id", "start")).select("doc_id", "th", "start", "end", "value")
    new = new.distinct().groupBy("doc_id", "th").agg(F.collect_list(F.struct(F.lit(4).alias("rank"), F.lit("context").alias("kind"), "start", "end", "value")).alias("new"))
    joined = table.alias("t").join(new.alias("n"), F.col("t.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("t.th") == F.col("n.th")), "left")
    whole = F.array_sort(F.transform(F.concat("base", F.coalesce("new", F.expr("cast(array() as array<struct<rank:int,kind:string,start:bigint,end:bigint,value:string>>)"))), lambda x: F.struct(x["start"], x["rank"], x["kind"], x["end"], x["value"])))
    return joined.select(F.col("t.doc_id").alias("doc_id"), F.transform(whole, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))).alias(out))

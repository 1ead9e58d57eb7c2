"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams (rarest first, as far as a sketch of all n-grams can tell, then by hash) is cut into
fragments; the overlaps of a pair's fragments are counted separately and added up to the exact size of the intersection.

Candidates share a token of their prefixes, the rarest n-grams that a similarity makes necessary. Tokens that few
documents share make their pairs at once, and these prefixes' overlaps, the first fragment, already rule out pairs
whose other fragments could not make up for what is missing. The documents of a hot token become a group, whose order is cut once more:
a core (the n-grams that most of a sample of the group have, any set would do) and the rest. For a document x with r
n-grams of the core C missing and a others, the core fragment's part of a pair's overlap is |C| - r(x) - r(y) plus the
missing ones they share, so with w = 100 r + p a two documents are linked just when
    (100 - p) |C| + (100 + p) o >= w(x) + w(y),
o being the overlap of their differences from the core. Hence no link between two documents whose differences share
nothing needs a comparison: those that the smallest w allows are linked to its document, and so to one another. All
other links need shared differences. Their order in a group is by exact counts there, rarest first; a pair is joined at
a shared one only where both have room left for all that a link of theirs needs, and hot ones are the next level's
tokens. The core's n-grams, which make a group of near copies quadratic, are never joined, and no link is lost whatever
the core or the sketch is.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, dropped, hot_rows, hot_table, salted_join, sieved, union, written

FRAGMENTS = 8
#: Counters of the sketch that orders n-grams: a fixed size, sent to every worker; and the parts in which it is summed.
SKETCH_BITS, SKETCH_PARTS = 23, 64
#: Windows, and bytes, that are hashed at once, and rows that are handed on at once: they bound a worker's memory.
HASHED_AT_ONCE, BYTES_AT_ONCE, ROWS_AT_ONCE = 1 << 16, 1 << 20, 1000
#: Longer words stand as their digests.
LONG_WORD = 256
#: A token makes its pairs at once if at most FAN documents have it; a group's, if one of two sides has at most FAN and both FAN_ROWS.
FAN, FAN_ROWS = 32, 1024
#: The same for tokens of groups' differences, where a join row must also fit by its place: one more level of groups costs more than so many comparisons a row.
NEAR_FAN = 128
#: A group's core is what most of at most this many of its documents have.
CORE_SAMPLE = 32
_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def normal(text: str | None) -> bytes:
    """The text's words in UTF-8, one space between: bytes.lower() changes A-Z only and bytes.split() cuts at \\x20 and \\x09-\\x0D only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return b" ".join([w if len(w) <= LONG_WORD else b"\0" + hashlib.sha256(w).hexdigest().encode() for w in words])


def distinct(g: np.ndarray) -> np.ndarray:
    """Sorted, each once; a sort in vector code is faster here than a general unique."""
    g.sort()
    keep = np.ones(len(g), dtype=bool)
    np.not_equal(g[1:], g[:-1], out=keep[1:])
    return g[keep]


class Hasher:
    """Distinct 64-bit hashes of a normal text's n-grams.

    A polynomial's prefix sums over the bytes give every n-gram's hash as a difference of two of them, divided by the
    power at which it begins; so the cost is a few vector operations for each byte, whatever n is. Modulo 2^64, words
    of equal hash can be built on purpose; ordinary texts don't hold them.
    """

    def __init__(self, n: int = 5):
        self.n = n
        self.grow(1 << 12)

    def grow(self, length: int) -> None:
        """Powers of the base and of its inverse, up to length."""
        steps = np.full((2, length), [[_BASE], [pow(_BASE, -1, 1 << 64)]], dtype=np.uint64)
        steps[:, 0] = 1
        self.powers, self.inverse = np.cumprod(steps, axis=1)

    def windows(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) > len(self.powers):
            self.grow(2 * len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * self.powers[: len(data)], out=sums[1:])
        g = (sums[ends] - sums[starts]) * self.inverse[starts]
        for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
            g ^= g >> np.uint64(shift)
            g *= np.uint64(factor)
        return g ^ g >> np.uint64(32)

    def set_of(self, text: bytes) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.uint64)
        data = np.frombuffer(text, dtype=np.uint8)
        gaps = np.flatnonzero(data == 32)
        n = min(self.n, len(gaps) + 1)
        starts = np.concatenate(([0], gaps[: len(gaps) - n + 2] + 1))[: len(gaps) - n + 2]
        ends = np.concatenate((gaps[n - 1 :], [len(data)]))
        parts, k = [], 0
        while k < len(starts):
            m = max(k + 1, min(k + HASHED_AT_ONCE, int(np.searchsorted(ends, starts[k] + BYTES_AT_ONCE, "right"))))
            parts.append(self.windows(data[starts[k] : ends[m - 1]], starts[k:m] - starts[k], ends[k:m] - starts[k]))
            k = m
        return distinct(parts[0] if len(parts) == 1 else np.concatenate(parts))


def order_keys(g: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """N-grams as numbers in the global order: 4 bits of frequency class, then the hash. Sorted."""
    return np.sort(classes[g & np.uint64(len(classes) - 1)].astype(np.uint64) << np.uint64(60) | g >> np.uint64(4))


def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(doc_id, text, whether what was made should be handed on now) of each row."""
    for b in batches:
        for k, (i, t) in enumerate(zip(b["doc_id"], b["text"], strict=True), 1):
            yield i, t, k % ROWS_AT_ONCE == 0 or k == len(b)


def read_documents(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, key, n_shingles) of each row, key standing for its words; and the frequency class of each of the sketch's counters. One pass."""
    size, wide = 1 << SKETCH_BITS, (1 << SKETCH_BITS) // SKETCH_PARTS

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, hasher = np.zeros(size, dtype=np.uint32), Hasher(n)
        mask, out = np.uint64(size - 1), []
        for i, t, last in rows_of(batches):
            words = normal(t)
            g = hasher.set_of(words)
            np.add.at(counts, (g & mask).astype(np.int64), np.uint32(1))
            out.append((i, hashlib.md5(words).digest() if words else None, len(g), None, None))
            if last:
                yield pd.DataFrame(out, columns=names)
                out = []
        for k, part in enumerate(np.split(counts, SKETCH_PARTS)):
            if part.any():
                yield pd.DataFrame([(None, None, None, k, zlib.compress(np.minimum(part, 65535).astype("<u2").tobytes(), 1))], columns=names)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b["block"], b["counts"], strict=True):
                totals.setdefault(k, np.zeros(wide, dtype=np.int64))
                totals[k] += np.frombuffer(zlib.decompress(v), dtype="<u2")
        for k, total in totals.items():
            yield pd.DataFrame([(k, zlib.compress(np.minimum(2 * np.log2(1 + total), 255).astype(np.uint8).tobytes(), 1))], columns=["block", "counts"])

    names = ["doc_id", "key", "n_shingles", "block", "counts"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = written(docs.select("doc_id", "text").mapInPandas(read, f"doc_id {kind}, key binary, n_shingles long, block int, counts binary"), "read")
    sums = made.where("block is not null").select("block", "counts").repartition("block").mapInPandas(add, "block int, counts binary").collect()  # SKETCH_PARTS rows of fixed length
    raw = np.zeros(size, dtype=np.uint8)
    for r in sums:
        raw[r["block"] * wide : (r["block"] + 1) * wide] = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint8)
    # sixteen classes: all counts up to the ordinary one are alike, then steps of half a doubling
    usual = int(np.median(raw))
    return made.where("block is null").select("doc_id", "key", "n_shingles"), np.clip(raw.astype(np.int16) - usual - 1, 0, 15).astype(np.uint8)


def ceil_div(a, b: int):
    """a / b rounded up, of columns as of numbers."""
    return F.floor((a + (b - 1)) / F.lit(b)) if isinstance(a, Column) else -(-a // b)


def cut_sets(docs: DataFrame, shared, wanted: DataFrame, n: int) -> DataFrame:
    """(doc, v, n, parts) of the wanted documents, and a few others: their n-grams in order, cut into FRAGMENTS parts; v tells texts of one doc_id apart. No text is shuffled. Class 0 holds nearly all n-grams and makes all parts but the last."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, out = Hasher(n), []
        for i, t, last in rows_of(batches):
            if words := normal(t):
                keys = order_keys(hasher.set_of(words), shared.value)
                f = np.where(keys >> np.uint64(60) > 0, FRAGMENTS - 1, (keys >> np.uint64(44) & np.uint64(0xFFFF)).astype(np.int64) * (FRAGMENTS - 1) >> 16)
                out.append((i, zlib.crc32(words), len(keys), np.split(keys.astype(np.int64), np.searchsorted(f, np.arange(1, FRAGMENTS)))))
            if last:
                yield pd.DataFrame(out, columns=["doc", "v", "n", "parts"])
                out = []

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = sieved(docs.select("doc_id", "text"), "doc_id", wanted)
    return written(own.mapInPandas(cut, f"doc {kind}, v long, n long, parts array<array<long>>"), "sets")


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose overlaps, counted fragment by fragment and added, reach percent of their union."""
    parts = sets.select("doc", "v", "n", F.posexplode("parts").alias("fragment", "grams"))
    side = lambda x: parts.select(F.col("doc").alias(x), F.col("v").alias(f"v{x}"), F.col("n").alias(f"n{x}"), "fragment", F.col("grams").alias(f"g{x}"))
    both = salted_join(pairs, side("a"), "a", hot_rows(pairs, "a"), F.col("b"))
    at = F.struct("b", "fragment").alias("at")
    hot = hot_rows(pairs, "b")
    hot = hot and hot.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)), lambda f: F.struct(F.col("_hot").alias("b"), f.alias("fragment")))).alias("_hot"))
    both = salted_join(both.select("*", at), side("b").select(at, "vb", "nb", "gb"), "at", hot, F.col("a"))
    key = ["a", "b", "va", "vb"]
    # repeated rows of a document give the same overlap again
    once = both.select(*key, "fragment", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("o")).groupBy(*key, "fragment").agg(*[F.max(x).alias(x) for x in ("o", "na", "nb")])
    sums = once.groupBy(*key).agg(F.sum("o").alias("o"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    return written(sums.where(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b"), "links")


def similar_whole(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """As similar, with one row a pair: its overlap is counted on whole sets at once."""
    side = lambda x: sets.select(F.col("doc").alias(x), F.flatten("parts").alias(f"g{x}"))
    both = salted_join(pairs, side("a"), "a", hot_rows(pairs, "a"), F.col("b"))
    both = salted_join(both, side("b"), "b", hot_rows(pairs, "b"), F.col("a"))
    o = F.size(F.array_intersect("ga", "gb"))
    found = both.select("a", "b", o.alias("o"), (F.size("ga") + F.size("gb")).alias("n")).where(100 * F.col("o") >= percent * (F.col("n") - F.col("o")))
    return written(found.select("a", "b").distinct(), "links")


def shared_by(rows: DataFrame, name: str, counts: dict[str, Column], possible: str) -> DataFrame:
    """rows (token, doc, ...) of tokens that can make a pair, with the token's counts, g of its rows among them. Counted with a combine before the shuffle; hot tokens are then spread by document."""
    found = written(rows.groupBy("token").agg(F.count("*").alias("g"), *[c.alias(k) for k, c in counts.items()]).where(possible), "counts")
    out = written(salted_join(rows, found, "token", hot_table(found, "token", "g"), F.col("doc")), name)
    dropped(found)
    return out


def first_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of documents whose prefixes, made of tokens of few documents, share enough that the rest can reach percent. Pairs that also share a hot token may be missing; its group has them."""
    side = lambda x: rows.select("token", F.col("doc").alias(x), F.col("d").alias(f"n{x}"))
    na, nb = F.col("na"), F.col("nb")
    alike = (F.col("a") < F.col("b")) & (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
    shares = side("a").join(side("b"), "token").where(alike).groupBy("a", "b").agg(F.count("*").alias("c"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    # up to the smaller of the two prefixes' ends all shared n-grams are in both; what may follow is bounded by the rest of a set
    rest = F.greatest(ceil_div(percent * na, 100), ceil_div(percent * nb, 100)) - 1
    return shares.where(F.col("c") + rest >= ceil_div(percent * (na + nb), 100 + percent)).select("a", "b")


def rarest_first(rows: DataFrame) -> DataFrame:
    """rows (row, token, d, ...) of all d tokens of each row: those whose token another row has too, with their place pos in the order of their tokens' exact counts, rarest first. Tokens of one row alone come before all others."""
    rows = shared_by(rows, "counted", {}, "g > 1")
    own = Window.partitionBy("row")
    return rows.withColumn("pos", F.col("d") - F.count("*").over(own) + F.row_number().over(own.orderBy("g", "token")) - 1).drop("g")


def pairs_of(rows: DataFrame, unit: int) -> DataFrame:
    """(a, b) of documents that share tokens of their prefixes and may link: x with the larger w, or document where equal, by its long prefix, y by its short one.

    From the first token that a linked pair shares, both still have room for all that it needs to share; so a token that
    leaves either less room makes no row, and pairs that share only such tokens are no candidates. Pairs that also share
    a hot token may be missing; its group has them.
    """
    side = lambda x, which: rows.where(which).select("token", *[F.col(c).alias(c + x) for c in ("doc", "cc", "w", "room")])
    larger = (F.col("wx") > F.col("wy")) | ((F.col("wx") == F.col("wy")) & (F.col("docx") > F.col("docy")))
    need = ceil_div(F.col("wx") + F.col("wy") - F.col("ccx"), unit)
    fits = larger & (F.col("docx") != F.col("docy")) & (need <= F.least("roomx", "roomy"))
    return side("x", "long").join(side("y", "short").drop("ccy"), "token").where(fits).select(F.greatest("docx", "docy").alias("a"), F.least("docx", "docy").alias("b")).distinct()


def groups(hot: DataFrame) -> DataFrame:
    """(gid, doc): the documents of each hot token, as members of the group that is named by the token's first document in a hashed order. That order is the same for all tokens, so tokens of the same near copies name few groups."""
    first = hot.groupBy("token").agg(F.min_by("doc", F.struct(F.xxhash64("doc"), "doc")).alias("gid"))
    counts = hot.groupBy("token").agg(F.count("*").alias("g"))
    return written(salted_join(hot.select("token", "doc"), first, "token", hot_table(counts, "token", "g"), F.col("doc")).select("gid", "doc").distinct(), "members")


def differences(members: DataFrame, sets: DataFrame, percent: int, hot: DataFrame | None) -> DataFrame:
    """(row, gid, doc, cc, w, d, tokens) of each member's text, numbered by row: tokens are the d n-grams in which it differs from its group's core."""
    whole = sets.select("doc", F.flatten("parts").alias("grams"))
    sample = members.groupBy("gid", F.pmod(F.xxhash64("doc", "gid"), F.lit(CORE_SAMPLE)).alias("k")).agg(F.min_by("doc", F.struct(F.xxhash64("doc"), "doc")).alias("doc"))
    seen = sample.join(whole, "doc").select("gid", "doc", F.explode("grams").alias("gram")).distinct().groupBy("gid", "gram").agg(F.count("*").alias("c"))
    size = sample.groupBy("gid").agg(F.count("*").alias("m"))
    core = seen.join(size, "gid").where("2 * c > m").groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("c", "gram")))["gram"].alias("core"))
    core = written(core, "core")
    with_sets = salted_join(members, whole, "doc", hot_rows(members, "doc"), F.col("gid"))
    at = salted_join(with_sets, core, "gid", hot, F.col("doc"), "left")
    at = at.select("gid", "doc", "grams", F.coalesce("core", F.expr("cast(array() as array<bigint>)")).alias("core"))
    at = at.select("gid", "doc", F.size("core").alias("c"), F.array_except("grams", "core").alias("more"), F.array_except("core", "grams").alias("less"))
    out = at.select(F.monotonically_increasing_id().alias("row"), "gid", "doc", (F.col("c") * (100 - percent)).cast("long").alias("cc"), (100 * F.size("less") + percent * F.size("more")).cast("long").alias("w"), (F.size("less") + F.size("more")).cast("long").alias("d"), F.concat("more", "less").alias("tokens"))
    out = written(out, "differences")
    dropped(core)
    return out


def group_links(members: DataFrame, sets: DataFrame, percent: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """For members (gid, doc) of groups: links (a, b), and pairs (a, b) that may be links, which together connect all linked members of each group.

    No pair is made of members whose differences from the core share none of their rarest n-grams. A hot difference
    makes a group of its own. It is never a whole group: what all members have is in the core, which most of a sample
    have. So groups shrink from level to level and the loop ends, about halving them each time.
    """
    unit, pairs, links = 100 + percent, [], []
    d, pos, w, cc, low = map(F.col, ("d", "pos", "w", "cc", "low"))
    while not members.isEmpty():
        hot = hot_rows(members, "gid")
        made = differences(members, sets, percent, hot)
        least = made.groupBy("gid").agg(F.min(F.struct("w", "doc")).alias("least"))
        own = salted_join(made, least, "gid", hot, F.col("doc"))
        own = own.select("row", "gid", "doc", "cc", "w", "d", "tokens", F.col("least.w").alias("low"), F.col("least.doc").alias("near"))
        links.append(written(own.where("w + low <= cc and doc <> near").select(F.col("near").alias("a"), F.col("doc").alias("b")), "links"))
        # only a document beyond the core's reach needs partners; its own prefix is long, for partners of any smaller w, that of partners is short
        long = F.when(w + low > cc, d - ceil_div(w + low - cc, unit) + 1).otherwise(0)
        short = d - ceil_div(w + F.greatest(w, cc - low + 1) - cc, unit) + 1
        own = own.select("row", "gid", "doc", "cc", "w", "d", long.alias("_l"), short.alias("_s"), "tokens").where("greatest(_l, _s) > 0")
        rows = own.select("row", F.explode("tokens").alias("token"), "gid", "doc", "cc", "w", "d", "_l", "_s").withColumn("token", F.xxhash64("gid", "token"))
        counted = rarest_first(rows)
        prefixes = counted.select("token", "gid", "doc", "cc", "w", (d - pos).alias("room"), (pos < F.col("_l")).alias("long"), (pos < F.col("_s")).alias("short")).where("long or short")
        prefixes = written(prefixes, "prefixes")
        dropped(counted)
        rows = shared_by(prefixes, "shared", {"l": F.count_if("long"), "s": F.count_if("short")}, "g > 1 and l > 0 and s > 0")
        dropped(prefixes)
        few = (F.least("l", "s") <= NEAR_FAN) & (F.col("g") <= FAN_ROWS)
        pairs.append(written(pairs_of(rows.where(few), unit), "pairs"))
        less = groups(rows.where(~few))
        dropped(members, made, rows)
        members = less
    return links, pairs


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included).

    A document's set is its distinct n-word shingles (all its words as one, if fewer). Null and empty texts have no
    set and link with nothing. Repeated rows are linked copies; rows that share a doc_id but not their text count
    as one node of the graph and are told apart only in n_shingles. Rows without doc_id are their own component (null).
    Other columns of docs are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ids, classes = read_documents(docs, n)
    shared = spark.sparkContext.broadcast(classes)
    named = ids.where("key is not null and doc_id is not null")
    # copies: the smallest id of each key stands for all; the aggregate is combined before its shuffle
    first = written(named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")), "copies")

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, out = Hasher(n), []
        for i, t, last in rows_of(batches):
            if words := normal(t):
                keys = order_keys(hasher.set_of(words), shared.value)
                # of a link's two sets, the larger has this many of its n-grams in the other
                out.append((i, hashlib.md5(words).digest(), len(keys), keys[: len(keys) - ceil_div(percent * len(keys), 100) + 1].astype(np.int64)))
            if last:
                yield pd.DataFrame(out, columns=["doc", "key", "d", "prefix"])
                out = []

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.where("doc_id is not null").mapInPandas(prefixes, f"doc {kind}, key binary, d long, prefix array<long>")
    # one set of each key: equal keys have equal sets, so any will do, and equal ones are dropped before the shuffle
    kept = written(made.groupBy("key").agg(F.min("doc").alias("doc"), F.any_value("d").alias("d"), F.any_value("prefix").alias("prefix")).drop("key"), "prefixes")
    rows = shared_by(kept.select("doc", "d", F.explode("prefix").alias("token")), "shared", {}, "g > 1")
    dropped(kept)
    pairs = written(first_pairs(rows.where(F.col("g") <= FAN), percent), "pairs")
    members = groups(rows.where(F.col("g") > FAN))
    dropped(rows)
    sets = cut_sets(docs, shared, members.select("doc").union(pairs.select("a")).union(pairs.select("b")), n)
    links, more = group_links(members, sets, percent)
    candidates = written(union(pairs, *more).distinct(), "candidates")
    dropped(pairs, *more)
    links.append(similar(candidates, sets, percent))
    dropped(candidates, sets)
    copies = salted_join(named, first.where("c > 1"), "key", hot_rows(named, "key"), F.col("doc_id")).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    labels = components(union(copies, *links))
    return ids.join(labels, ids.doc_id == labels.node, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))

"""Best-fit packing planned on the histogram of lengths.

Documents become pieces of at most `size` tokens. The planner sees only how many pieces have each length (at most
`size` numbers, whatever the corpus), and packs those counts best-fit, longest first. Its plan gives each run of
ranks within a length its sequences and offset; pieces then take their slots by joining on rank within length.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Words whose ids a worker remembers; beyond, they are encoded each time.
REMEMBERED = 400_000
#: Pieces of one length are ranked in buckets of about this many.
BUCKET_ROWS = 20_000


class _Words(dict):
    """Word after a space -> its ids as little-endian bytes. A space between words always starts a new pre-token, so ids can be joined word by word."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = np.asarray(self.encode(" " + word), dtype="<u4").tobytes()
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids


def encoder(ranks: str, pattern: str):
    """text -> ids as little-endian unsigned 32-bit bytes; ranks is the vocabulary as a file of ranks, its ids those of the same vocabulary in the tokenizers library."""
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
    words = _Words(encode)
    odd = re.compile(r"\s (?!\S)|^ ")  # a space that doesn't start a pre-token

    def ids(text: str) -> bytes:
        if odd.search(text):
            return np.asarray(encode(text), dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        return b"".join(chain([np.asarray(encode(first), dtype="<u4").tobytes()], map(words.__getitem__, rest)))

    return ids


def with_added(encode, vocabulary: str):
    """encode, but the added tokens of the vocabulary (a file of the tokenizers library) have their own ids where a text has them literally, as that library gives by default."""
    with open(vocabulary, "rb") as f:
        added = json.load(f)["added_tokens"]
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("an added token that isn't matched literally")
    own = {t["content"]: np.asarray([t["id"]], dtype="<u4").tobytes() for t in added}
    if not own:
        return encode
    cut = re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")")

    def ids(text: str) -> bytes:
        parts = cut.split(text)
        if len(parts) == 1:
            return encode(text)
        return b"".join(own[x] if k % 2 else encode(x) if x else b"" for k, x in enumerate(parts))

    return ids


def pieces(docs: DataFrame, ranks: str, pattern: str, *, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text", size: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and end_id, cut into pieces if longer than size; all but the first are then full.

    Null and empty texts are end_id alone; every row is a document of its own. Without a vocabulary, added tokens in a
    text are ordinary characters.
    """
    end = np.asarray([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(ranks, pattern)
        if vocabulary:
            encode = with_added(encode, vocabulary)
        for b in batches:
            out = []
            for i, t in zip(b["doc_id"], b["text"], strict=True):
                data = (encode(t) if t else b"") + end
                n = len(data) // 4
                first = n % size or size
                for k, (s, e) in enumerate(zip([0, *range(first, n, size)], [first, *range(first + size, n + 1, size)], strict=True)):
                    own = data[4 * s : 4 * e]
                    out.append((i, k, s, e - s, zlib.crc32(own), *[own] * with_ids))
            yield pd.DataFrame(out, columns=names)

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    out = rows.mapInPandas(cut, "doc_id string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def plan(counts: dict[int, int], size: int = 1024) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, end rank, first sequence, pieces for each sequence, offset).

    Sequences with as much room left are one run of numbers; a step fills whole runs or splits one, so the plan's
    length depends on size alone. Rank r takes sequence first + (r - first rank) // each, at offset + (r - first rank) % each * length.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # tokens left -> runs (first sequence, sequences)
    lefts: list[int] = []
    out, opened = [], 0

    def put(left: int, run: tuple[int, int]) -> None:
        if left:
            if left not in room:
                bisect.insort(lefts, left)
            room.setdefault(left, []).append(run)

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            k = bisect.bisect_left(lefts, length)
            if k == len(lefts):
                each = size // length
                n = -(-todo // each)
                first, left = opened, size
                opened += n
            else:
                left = lefts[k]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left]
                    lefts.pop(k)
            each = left // length
            full = min(n, todo // each)
            if full:
                out.append((length, rank, rank + full * each, first, each, size - left))
                put(left - each * length, (first, full))
                rank, todo = rank + full * each, todo - full * each
            if full < n and todo:  # fewer than fill one more sequence
                out.append((length, rank, rank + todo, first + full, todo, size - left))
                put(left - todo * length, (first + full, 1))
                rank, todo, full = rank + todo, 0, full + 1
            if full < n:
                put(left, (first + full, n - full))
    return out


def pack(cut: DataFrame, size: int = 1024) -> DataFrame:
    """cut (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset: gapless sequences of at most size tokens.

    Ranks within a length are counted in buckets by hash, then shifted by the counts of the buckets before, so a length
    that most pieces have is no single task's work. Repeated rows are pieces of their own. Further columns stay;
    columns sequence_id and offset are replaced. An empty table gives an empty plan.
    """
    spark = cut.sparkSession
    cut = written(cut.drop("sequence_id", "offset"), "pieces")
    # as many buckets as tasks at least, so that a length that most pieces have is dealt to all of them
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cut.count() // BUCKET_ROWS))
    own = F.struct(*cut.columns).alias("_own")
    cut = cut.select(own, F.col("length").alias("_length"), F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).alias("_b"))
    sizes = written(cut.groupBy("_length", "_b").agg(F.count("*").alias("_n")), "sizes")
    counts = {r["_length"]: r["_n"] for r in sizes.groupBy("_length").agg(F.sum("_n").alias("_n")).collect()}  # at most `size` rows
    if any(k > size for k in counts):
        raise ValueError("a piece is longer than a sequence")
    slots = spark.createDataFrame(plan(counts, size) or [(0,) * 6], "_len long, _r0 long, _r1 long, _first long, _each long, _at long")
    before = sizes.select("_length", "_b", (F.sum("_n").over(Window.partitionBy("_length").orderBy("_b")) - F.col("_n")).alias("_before"))
    local = cut.withColumn("_r", F.row_number().over(Window.partitionBy("_length", "_b").orderBy("_own.doc_id", "_own.piece", "_own.ids_crc32")) - 1)
    ranked = local.join(before, ["_length", "_b"]).withColumn("_r", F.col("_r") + F.col("_before"))
    # the plan is a few thousand rows at most, whatever the corpus: it is broadcast
    placed = ranked.join(F.broadcast(slots), (F.col("_length") == F.col("_len")) & (F.col("_r") >= F.col("_r0")) & (F.col("_r") < F.col("_r1")))
    step = F.col("_r") - F.col("_r0")
    return placed.select("_own.*", (F.col("_first") + F.floor(step / F.col("_each"))).alias("sequence_id"), (F.col("_at") + (step % F.col("_each")) * F.col("_length")).alias("offset"))


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, doc_ids, offsets, ids): the sequences themselves, of pieces that carry ids; at most `size` pieces meet in one."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return parts.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"), F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))

"""Small functions on depth maps, sizes and distributions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def depth_at(depth: Column, height: int, width: int, x: Column, y: Column) -> Column:
    """The value of a map (an array, row by row) at a pixel, which is moved inside."""
    inside = lambda v, most: F.greatest(F.least(F.floor(v).cast("int"), F.lit(most - 1)), F.lit(0))
    return F.get(depth, inside(y, height) * width + inside(x, width))


def spread_depth(depth: Column) -> Column:
    """A map from 0 to 1; all 0 where it is flat."""
    lo, hi = F.array_min(depth), F.array_max(depth)
    return F.transform(depth, lambda v: F.when(hi > lo, (v - lo) / (hi - lo)).otherwise(0.0))


def size_text(size: Column) -> Column:
    """1.5 KB and the like."""
    text, unit = F.format_string("%.1f TB", size / 1024.0**4), 1024.0**3
    for name in ("GB", "MB", "KB", "B"):
        text, unit = F.when(size < unit * 1024, F.format_string(f"%.1f {name}", size / unit)).otherwise(text), unit / 1024
    return text


def fourcc(code: Column) -> Column:
    """The four characters of a codec's number, the lowest byte first."""
    return F.concat(*[F.chr(F.shiftright(code, 8 * i).bitwiseAND(255).cast("long")) for i in range(4)])


def entropy(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, entropy): Shannon's, in bits, of each key's values. Counts are combined before they are shuffled."""
    n = rows.groupBy(key, value).agg(F.count("*").alias("_n"))
    return n.groupBy(key).agg((F.log2(F.sum("_n")) - F.sum(F.col("_n") * F.log2("_n")) / F.sum("_n")).alias("entropy"))


def text_entropy(text: Column | str) -> Column:
    """Bits of the distribution of a text's characters, counted inside the row; null for null and empty texts.

    A worker turns one text at a time into characters. To leave out null results, filter by the text: a filter by the
    result makes Spark evaluate it twice, by two workers a task.
    """

    def one(t: str | None) -> float | None:
        if not t:
            return None
        n = np.unique(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), return_counts=True)[1] / len(t)
        return float(-(n * np.log2(n)).sum()) + 0.0

    @F.arrow_udf("double")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array((one(t.as_py()) for t in texts), pa.float64())

    return made(text)

"""Stages of work on rows whose failures stay with their rows: a poisoned row gets a null and an error, all others their results."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

ERRORS = "array<struct<stage:string,error:string>>"
#: Longer messages are cut.
MESSAGE = 500


@dataclass(frozen=True)
class Stage:
    """A function from lists, one for each input column, to a list of results of Spark type `kind`. Inputs may be columns of the rows or earlier stages. Rows with a null among `needs` are passed over: null, no error."""

    name: str
    inputs: tuple[str, ...]
    kind: str
    work: Callable[..., Sequence[Any]]
    needs: tuple[str, ...] = ()


def attempt(work: Callable[..., Sequence[Any]], columns: list[list], convert: Callable[[list], Any]) -> tuple[list, list[str | None]]:
    """Results and messages of each row. The whole batch is tried at once; where that fails it is halved, so k bad rows of n take about k log n calls. `convert` refuses results of a wrong type, which counts as failing."""
    n = len(columns[0]) if columns else 0
    if not n:
        return [], []
    try:
        found = list(work(*columns))
        if len(found) != n:
            raise ValueError(f"{len(found)} results for {n} rows")
        convert(found)
        return found, [None] * n
    except Exception as e:  # noqa: BLE001  whatever a stage raises is its row's error
        if n == 1:
            return [None], [f"{type(e).__name__}: {e}"[:MESSAGE]]
    half = n // 2
    parts = [attempt(work, [c[:half] for c in columns], convert), attempt(work, [c[half:] for c in columns], convert)]
    return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]


def run(rows: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    """rows with a column for each stage and `errors`, which lists the stages that failed for the row. One Arrow pass without a shuffle; a stage's name must not be a column of rows."""
    taken = [s.name for s in stages if s.name in rows.columns or s.name == "errors"]
    if taken or len({s.name for s in stages}) < len(stages):
        raise ValueError(f"stages need names of their own: {taken}")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"`{k}` {t}" for k, t in kinds.items()), *(f"`{s.name}` {s.kind}" for s in stages), f"errors {ERRORS}"])

    types = {s.name: to_arrow_type(_parse_datatype_string(s.kind)) for s in stages}

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            at: dict[str, list] = {}
            get = lambda c: at[c] if c in at else at.setdefault(c, b.column(c).to_pylist())  # noqa: B023, E731
            errors: list[list] = [[] for _ in range(b.num_rows)]
            for s in stages:
                needs = [get(c) for c in s.needs]
                there = [i for i in range(b.num_rows) if all(c[i] is not None for c in needs)]
                found, messages = attempt(s.work, [[get(c)[i] for i in there] for c in s.inputs], lambda v, t=types[s.name]: pa.array(v, t))
                at[s.name] = [None] * b.num_rows
                for i, v, message in zip(there, found, messages, strict=True):
                    at[s.name][i] = v
                    if message:
                        errors[i].append({"stage": s.name, "error": message})
            found = [pa.array(at[s.name], types[s.name]) for s in stages]
            yield pa.RecordBatch.from_arrays([*b.columns, *found, pa.array(errors, pa.list_(pa.struct([("stage", pa.string()), ("error", pa.string())])))], [*b.schema.names, *(s.name for s in stages), "errors"])

    return rows.mapInArrow(work, schema)


def failures(done: DataFrame, *key: str) -> DataFrame:
    """(*key, stage, error): one row for each stage that failed for a row."""
    return done.select(*key, F.explode("errors").alias("_e")).select(*key, "_e.stage", "_e.error")


def counts(done: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    """(stage, n_ok, n_failed, n_passed_over): one row for each stage, in one pass."""
    failed = F.transform("errors", lambda e: e["stage"])
    parts = [F.struct(F.lit(i).alias("place"), F.lit(s.name).alias("stage"), F.array_contains(failed, s.name).alias("failed"), F.col(s.name).isNotNull().alias("ok")) for i, s in enumerate(stages)]
    each = done.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
    out = each.groupBy("place", "stage").agg(F.count_if(F.col("ok")).alias("n_ok"), F.count_if("failed").alias("n_failed"), F.count_if(~F.col("ok") & ~F.col("failed")).alias("n_passed_over"))
    return out.orderBy("place").drop("place")

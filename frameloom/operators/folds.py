"""Folds over rows in order, for what depends on what was decided before."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


def fold_in_order(rows: DataFrame, keys: list[str], order: list[str], values: list[str], start: tuple, step: Callable, name: str, kind: str) -> DataFrame:
    """rows with name (of type kind): step(state, *values) gives the next state and the row's result; each key begins with start.

    All rows of a key must be in one partition already, as after repartition(*keys) or a window over keys. They are sorted
    there by the JVM, which spills, and go by in Arrow batches: time is linear in a key's rows and memory does not grow
    with them. Null keys are a key of their own.
    """
    schema = StructType([*rows.schema.fields, StructField(name, _parse_datatype_string(kind))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        of = to_arrow_type(schema[name].dataType)
        at, state = None, start
        for b in batches:
            out = []
            for key, *row in zip(zip(*(b.column(k).to_pylist() for k in keys), strict=True), *(b.column(v).to_pylist() for v in values), strict=True):
                if key != at:
                    at, state = key, start
                state, found = step(state, *row)
                out.append(found)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, of)], names=[*b.schema.names, name])

    return rows.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)

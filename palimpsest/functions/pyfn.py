"""Bridges from plain Python functions over one value to Arrow batches of a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def _struct(schema: str) -> T.StructType:
    return T._parse_datatype_string(schema)


def with_columns(df: DataFrame, inputs: Sequence[str], outputs: str, fn: Callable[..., tuple]) -> DataFrame:
    """All columns of df and the new ones that fn gives for the inputs of each row.

    ``outputs`` is a schema such as "frozen string, tokens array<string>"; new columns replace
    columns of the same name. fn sees null as None and is called once for each row.
    """
    new = _struct(outputs)
    kept = [f for f in df.schema if f.name not in {n.name for n in new}]
    args = [f"__arg{i}__" for i in range(len(inputs))]
    taken = df.select(*(F.col(f"`{f.name}`") for f in kept), *(F.col(c).alias(a) for c, a in zip(inputs, args)))
    types = [to_arrow_type(f.dataType) for f in new]

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            at = batch.num_columns - len(args)
            rows = [fn(*row) for row in zip(*(batch.column(at + i).to_pylist() for i in range(len(args))))]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], *(pa.array(c, t) for c, t in zip(columns, types))], [*batch.schema.names[:at], *new.names]
            )

    return taken.mapInArrow(run, T.StructType([*kept, *new.fields]))


def exploded(df: DataFrame, keys: Sequence[str], inputs: Sequence[str], outputs: str, fn: Callable[..., Iterable[tuple]]) -> DataFrame:
    """keys and the rows that fn gives for the inputs of each row, in order; none where it gives none."""
    new = _struct(outputs)
    kept = [df.schema[k] for k in keys]
    args = [f"__arg{i}__" for i in range(len(inputs))]
    taken = df.select(*(F.col(k) for k in keys), *(F.col(c).alias(a) for c, a in zip(inputs, args)))
    types = [to_arrow_type(f.dataType) for f in new]
    slice_rows = 20_000

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            take: list[int] = []
            rows: list[tuple] = []

            def out() -> pa.RecordBatch:
                at = pa.array(take, pa.int64())
                columns = list(zip(*rows)) or [()] * len(types)
                return pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(at) for i in range(len(keys))), *(pa.array(c, t) for c, t in zip(columns, types))],
                    [*keys, *new.names],
                )

            for n, row in enumerate(zip(*(batch.column(len(keys) + i).to_pylist() for i in range(len(args))))):
                for found in fn(*row):
                    take.append(n)
                    rows.append(found)
                if len(rows) >= slice_rows:
                    yield out()
                    take.clear()
                    rows.clear()
            yield out()

    return taken.mapInArrow(run, T.StructType([*kept, *new.fields]))

"""Order within groups without gathering a group in one task.

Rows are sorted into range partitions of (group, order), so a group of any size is spread over
several; what a row needs from elsewhere in its group is handed over by small tables with one row
for each group and partition, or by an equi-join on the row's position.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.session import stored


def _ranged(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with the number of their range partition, written once so that it stays the same."""
    return stored(df.repartitionByRange(*group, *order).withColumn("__part__", F.spark_partition_id()))


def positions(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "position") -> DataFrame:
    """The place of each row in its group, from 0; the order must tell the rows of a group apart."""
    ranged = _ranged(df, group, order)
    keys = [*group, "__part__"]
    sizes = ranged.groupBy(*keys).agg(F.count("*").alias("__n__"))
    before = Window.partitionBy(*group).orderBy("__part__").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start__", F.coalesce(F.sum("__n__").over(before), F.lit(0))).drop("__n__")
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    placed = ranged.withColumn("__local__", local)
    joined = _joined(placed, starts, keys, "inner")
    return joined.withColumn(out, F.col("__start__") + F.col("__local__")).drop("__start__", "__local__", "__part__")


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """An equi-join in which null keys are equal; the left side's keys are kept."""
    other = right.withColumnsRenamed({k: f"__right_{k}__" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__right_{k}__"))
    return left.join(other, on, how).drop(*(f"__right_{k}__" for k in keys))


def neighbours(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, before: int = 1, behind: int = 1) -> DataFrame:
    """df with previous and next: arrays of the value in the rows before and behind, in order.

    Each row sends its value to the places that see it, so a group costs its rows times the width.
    """
    placed = stored(positions(df, group, order))
    offsets = [*range(-behind, 0), *range(1, before + 1)]
    sent = placed.select(*group, F.col(value).alias("__v__"), "position", F.explode(F.array(*(F.lit(o) for o in offsets))).alias("__o__"))
    sent = sent.select(*group, (F.col("position") + F.col("__o__")).alias("position"), F.struct((-F.col("__o__")).alias("o"), F.col("__v__").alias("v")).alias("__s__"))
    got = sent.groupBy(*group, "position").agg(F.array_sort(F.collect_list("__s__")).alias("__all__"))  # at most before + behind
    joined = _joined(placed, got, [*group, "position"], "left")
    every = F.coalesce(F.col("__all__"), F.array().cast(got.schema["__all__"].dataType))
    pick = lambda side: F.transform(F.filter(every, side), lambda s: s["v"])
    return joined.withColumns({"previous": pick(lambda s: s["o"] < 0), "next": pick(lambda s: s["o"] > 0)}).drop("__all__")


def local_context(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
    before: int = P.PREVIOUS_SEGMENTS, behind: int = P.NEXT_SEGMENTS, most: int = P.CONTEXT_CHARS, next_head: bool = False,
) -> DataFrame:
    """df with previous_context and next_context: neighbouring texts, blank ones dropped, joined, white space
    normalised, the last characters kept (of the next one the first, if next_head)."""
    near = neighbours(df, group, order, value, before, behind)
    full = lambda c: F.array_join(F.filter(F.transform(c, X.normal_space), lambda t: t != ""), " ")
    after = F.substring(X.normal_space(full(F.col("next"))), 1, most) if next_head else X.trimmed_context(full(F.col("next")), most)
    return near.withColumns({"previous_context": X.trimmed_context(full(F.col("previous")), most), "next_context": after}).drop("previous", "next")


def carried(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, out: str) -> DataFrame:
    """df with the last value before each row that isn't null, null where there is none."""
    ranged = _ranged(df.withColumn("__v__", value), group, order)
    keys = [*group, "__part__"]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    lasts = ranged.groupBy(*keys).agg(F.max_by("__v__", F.struct(F.col("__v__").isNotNull(), *order)).alias("__last__"))
    before = Window.partitionBy(*group).orderBy("__part__").rowsBetween(Window.unboundedPreceding, -1)
    handed = lasts.withColumn("__carry__", F.last("__last__", ignorenulls=True).over(before)).drop("__last__")
    here = ranged.withColumn("__here__", F.last("__v__", ignorenulls=True).over(inside))
    joined = _joined(here, handed, keys, "inner")
    return joined.withColumn(out, F.coalesce("__here__", "__carry__")).drop("__v__", "__here__", "__carry__", "__part__")


def batches(df: DataFrame, order: Sequence[str], size: int, out: str = "batch") -> DataFrame:
    """df in batches of a fixed size, numbered from 0 in the order given."""
    placed = positions(df.withColumn("__all__", F.lit(0)), ["__all__"], order)
    return placed.withColumn(out, F.floor(F.col("position") / size).cast("int")).drop("__all__", "position")


def packed(df: DataFrame, group: Sequence[str], order: Sequence[str], size: Column, most: int, glue: int = 0, out: str = "chunk") -> DataFrame:
    """df with the number of its chunk: rows go into one chunk as long as their sizes, and glue between them, stay within
    ``most``; a larger row is alone.

    The fold is sequential by nature. It runs over sorted batches with one running sum, so a group
    is never held in memory, whatever its size; a null size counts 0.
    """
    sized = df.withColumn("__size__", F.coalesce(size, F.lit(0)).cast("bigint"))
    ordered = sized.repartition(*group).sortWithinPartitions(*group, *order)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.IntegerType())])

    def run(batches):
        last, chunk, filled, empty = None, 0, 0, True
        for batch in batches:
            at = batch.schema.get_field_index
            keys = list(zip(*(batch.column(at(g)).to_pylist() for g in group)))
            numbers = []
            for key, n in zip(keys, batch.column(at("__size__")).to_pylist()):
                if key != last:
                    last, chunk, filled, empty = key, 0, 0, True
                added = n + (0 if empty else glue)
                if not empty and filled + added > most:
                    chunk, filled, added = chunk + 1, 0, n
                filled += added
                empty = False
                numbers.append(chunk)
            columns = [batch.column(at(f.name)) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers, pa.int32())], [f.name for f in schema.fields])

    return ordered.mapInArrow(run, schema)

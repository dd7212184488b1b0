"""Running sums and ordinals over a total order, without one task seeing all rows.

An unpartitioned window collapses to one task.  Here rows are range-partitioned by the order and
sorted within their range, one streaming pass adds the running sum inside the range, and the result is
written once, so that lost executors cannot move a border.  The sums per range (one row per range and
group) are accumulated and added back.  Rows, however wide, are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..storage import written


def _within(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.RecordBatch]:
    """Adds _l: the exclusive running sum of _v within this partition and group."""
    held: dict[tuple, int] = {}
    for batch in batches:
        v = batch.column("_v").to_numpy(zero_copy_only=False)
        out = np.zeros(len(v), np.int64)
        if group:
            keys = list(zip(*(batch.column(g).to_pylist() for g in group)))
            place: dict[tuple, list[int]] = {}
            for i, k in enumerate(keys):
                place.setdefault(k, []).append(i)
            for k, at in place.items():
                ends = np.cumsum(v[at])
                out[at] = held.get(k, 0) + ends - v[at]
                held[k] = held.get(k, 0) + int(ends[-1])
        elif len(v):
            ends = np.cumsum(v)
            out = held.get((), 0) + ends - v
            held[()] = held.get((), 0) + int(ends[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, "_l"])


def running_sum(df: DataFrame, value: Column, order: list[str], group: list[str] | None = None, name: str = "before", ranges: int | None = None) -> DataFrame:
    """Adds the exclusive running sum of value in the order, within each group.

    order must name columns that together are unique within a group; null values count as 0.
    """
    group = group or []
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_v", F.coalesce(value.cast("bigint"), F.lit(0)))
    ranged = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_r", F.spark_partition_id())
    schema = StructType([*ranged.schema.fields, StructField("_l", LongType())])
    parts = written(ranged.mapInArrow(lambda batches: _within(batches, group), schema), "ranges")
    sums = parts.groupBy(*group, "_r").agg(F.sum("_v").alias("_s"))
    # One row per range and group: a few thousand, whatever the size of the data, where groups are few.
    over = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_r")
    base = sums.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_r").alias("_r2"), (F.sum("_s").over(over) - F.col("_s")).alias("_b"))
    on = parts["_r"] == base["_r2"]
    for g in group:
        on = on & parts[g].eqNullSafe(base[f"_g_{g}"])
    out = parts.join(base, on).withColumn(name, F.col("_b") + F.col("_l"))
    return out.select(*df.columns, name)


def ordinal(df: DataFrame, order: list[str], group: list[str] | None = None, name: str = "ord", ranges: int | None = None) -> DataFrame:
    """Adds the place of each row in the order, from 0."""
    return running_sum(df, F.lit(1), order, group, name, ranges)

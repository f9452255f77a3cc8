"""Row numbers without a window over all rows or over a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.session import cut


def numbered(df: DataFrame, keys: list[str], order: list[str | Column], out: str = "place") -> DataFrame:
    """df with each row's number, from 1, in the order of `order` among the rows of its keys (of all rows without keys).

    Rows are put in order by ranges of keys and order, so a hot key is spread over as many tasks as it fills. Numbers within a range are then raised by the
    number of the key's rows in the ranges before, of which there are no more than tasks. Rows that tie get different numbers in no fixed order.
    """
    by = [F.col(k).asc_nulls_first() for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    parts = cut(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*by))
    on = (F.col("_part") == F.col("_p")) if not keys else (F.col("_part") == F.col("_p")) & _all([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return parts.withColumn("_rank", rank).join(starts, on).select(*df.columns, (F.col("_rank") + F.col("_before")).cast("long").alias(out))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def next_page(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """The first `size` rows behind `last` in the order of a key; from the start if last is None."""
    rest = df if last is None else df.where(F.col(key) > F.lit(last))
    return rest.orderBy(key).limit(size)

"""Statistics as column expressions and as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def g2(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Log-likelihood of a 2 x 2 table; a cell without observations adds nothing."""
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    n = a + b + c + d
    total = F.lit(0.0)
    for o, row, col in ((a, a + b, a + c), (b, a + b, b + d), (c, c + d, a + c), (d, c + d, b + d)):
        e = F.try_divide(row * col, n)
        total = total + F.coalesce(F.when((o > 0) & (e > 0), o * F.ln(F.try_divide(o, e))), F.lit(0.0))
    return 2 * total


def round_js(c: Column, digits: int = 1) -> Column:
    """Halves go up, also below zero. What the order of a sum leaves beyond six further digits doesn't decide a half."""
    k = float(10**digits)
    return F.floor(F.round(c * k, 6) + 0.5) / k


def share(df: DataFrame, keys: list[str], n: str, out: str = "share") -> DataFrame:
    """Each row's part of its group's total; NULL where the total is 0."""
    return df.withColumn(out, F.try_divide(F.col(n).cast("double"), F.sum(n).over(Window.partitionBy(*keys))))


def share_map(df: DataFrame, keys: list[str], item: str, n: str, out: str = "shares") -> DataFrame:
    """One row a group with a map of each item's part of the total; an empty map where the total is 0."""
    x = df.groupBy(*keys).agg(F.collect_list(F.struct(F.col(item).alias("k"), F.col(n).cast("double").alias("v"))).alias("_e"), F.sum(n).alias("_t"))
    made = F.map_from_entries(F.transform("_e", lambda e: F.struct(e["k"], F.try_divide(e["v"], F.col("_t")))))
    return x.select(*keys, F.when(F.col("_t") > 0, made).otherwise(F.map_from_entries(F.slice(F.transform("_e", lambda e: F.struct(e["k"], e["v"])), 1, 0))).alias(out))


def chi_square(counts: DataFrame, row: str, col: str, n: str) -> DataFrame:
    """One row (chi2, df, n, v) of a contingency table given as cells; cells that aren't there are 0."""
    cells = counts.groupBy(row, col).agg(F.sum(n).cast("double").alias("o"))
    rows = cells.groupBy(row).agg(F.sum("o").alias("r"))
    cols = cells.groupBy(col).agg(F.sum("o").alias("c"))
    # sum((o - e)^2 / e) over all cells = n * (sum(o^2 / (r c)) - 1): empty cells needn't be made
    joined = cells.join(rows, row).join(cols, col)
    total = joined.agg(F.sum("o").alias("n"), F.sum(F.try_divide(F.col("o") * F.col("o"), F.col("r") * F.col("c"))).alias("s"))
    size = rows.agg(F.count("*").alias("nr")).crossJoin(cols.agg(F.count("*").alias("nc")))  # one row each
    chi2 = F.col("n") * (F.col("s") - 1)
    return total.crossJoin(size).select(
        chi2.alias("chi2"), ((F.col("nr") - 1) * (F.col("nc") - 1)).alias("df"), F.col("n").cast("long").alias("n"),
        F.sqrt(F.try_divide(chi2, F.col("n") * (F.least("nr", "nc") - 1))).alias("v"),
    )


def dissimilarity(df: DataFrame, keys: list[str], group: str, demand: str, supply: str, merge_2_3: str) -> DataFrame:
    """Half the sum of absolute differences by key: group 0 is left out, 2 and 3 count as one where merge_2_3 holds, missing supply is 0."""
    merged = df.where(F.col(group) != 0).withColumn("_g", F.when(F.col(merge_2_3) & (F.col(group) == 3), F.lit(2)).otherwise(F.col(group)))
    summed = merged.groupBy(*keys, "_g").agg(F.sum(F.coalesce(F.col(demand), F.lit(0.0))).alias("d"), F.sum(F.coalesce(F.col(supply), F.lit(0.0))).alias("e"))
    return summed.groupBy(*keys).agg((F.sum(F.abs(F.col("d") - F.col("e"))) / 2).alias("dissimilarity"))


def polarization(df: DataFrame, keys: list[str], group: str, demand: str, supply: str, merge_2_3: str) -> DataFrame:
    """(high skill demand - supply) - (routine and manual demand - supply), each rounded from unrounded sums. The supply of group 3 is in 2 where merged."""
    d, e = (F.coalesce(F.col(x), F.lit(0.0)) for x in (demand, supply))
    high, low = F.col(group).between(1, 3), F.col(group).between(4, 9)
    counted = high & ~(F.col(merge_2_3) & (F.col(group) == 3))
    sums = df.groupBy(*keys).agg(*(F.sum(F.when(w, x).otherwise(0.0)).alias(n) for n, w, x in (("hd", high, d), ("he", counted, e), ("ld", low, d), ("le", low, e))))
    return sums.select(*keys, round_js(F.col("hd") - F.col("he") - (F.col("ld") - F.col("le"))).alias("polarization"))


def location_quotient(df: DataFrame, place: str, group: str, value: str) -> DataFrame:
    """Each share over the unweighted mean of the group's shares across places."""
    return df.withColumn("lq", F.try_divide(F.col(value), F.avg(value).over(Window.partitionBy(group))))

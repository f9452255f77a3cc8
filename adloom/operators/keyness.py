"""Which concepts are typical of a group: counts in it against all other groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.functions.stats import g2
from adloom.operators.upsert import top_per_group


def keyness(mentions: DataFrame, group: str, concept: str, min_group: int = 3, min_global: int = 10, top: int = 15) -> DataFrame:
    """(group, concept, a, c, g2, lift, rank) of concepts that are more frequent in the group than elsewhere.

    a: mentions in the group, c: elsewhere; totals are mentions, not documents. lift is NULL if there are none elsewhere.
    Counting is the only work on all mentions; windows run over counts.
    """
    counts = mentions.groupBy(F.col(group).alias("_group"), F.col(concept).alias("_concept")).agg(F.count("*").alias("a"))
    by_concept, all_ = Window.partitionBy("_concept"), Window.partitionBy(F.lit(1))
    totals = counts.groupBy("_group").agg(F.sum("a").alias("t"))  # a row for each group
    totals = totals.withColumn("n", F.sum("t").over(all_))
    x = (
        counts.withColumn("g", F.sum("a").over(by_concept)).join(totals, "_group")
        .withColumn("c", F.col("g") - F.col("a")).withColumn("b", F.col("t") - F.col("a")).withColumn("o", F.col("n") - F.col("t")).withColumn("d", F.col("o") - F.col("c"))
        .withColumn("rate", F.try_divide("a", "t")).withColumn("other", F.coalesce(F.try_divide("c", "o"), F.lit(0.0)))
        .where((F.col("a") >= min_group) & (F.col("g") >= min_global) & (F.col("d") >= 0) & (F.col("rate") > F.col("other")))
        .withColumn("g2", g2(*(F.col(k) for k in "abcd"))).withColumn("lift", F.try_divide("rate", "other"))
    )
    ranked = top_per_group(x, ["_group"], [F.round("g2", 6).desc(), F.col("a").desc(), F.col("_concept")], top)
    return ranked.select(F.col("_group").alias(group), F.col("_concept").alias(concept), "a", "c", "g2", "lift", "rank")

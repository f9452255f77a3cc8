"""Problem 4: copies that differ only in form or in the order of fields.

Every record becomes a multiset of (field name, normalized value) pairs; its
fingerprint is the sum of the pairs' 128-bit hashes, so order can't matter
and nothing is sorted. Fields whose values may be exchanged share one name; a
field whose lines may be reordered gives one pair a line. A second
fingerprint takes that field as one run of characters, as line breaks are whitespace too.
Records are grouped by fingerprint and each is then compared, pair by pair, with the
first of its group.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.normal import bare
from adloom.operators.components import components
from adloom.session import cut, free

_MASK = (1 << 128) - 1
#: Members of a group that one copy of its first record serves in the comparison join.
SHARE = 20_000


def pairs(swap: list[str | None], lines: str | None) -> Counter:
    """The record as a multiset of (name, value)."""
    found = Counter(("head", bare(x)) for x in swap)
    for line in (lines or "").splitlines():
        if value := bare(line):
            found["line", value] += 1
    return found


def _hash(name: str, value: str) -> int:
    return xxhash.xxh3_128_intdigest(f"{name}\x00{value}")


def fingerprints(swap: list[str | None], lines: str | None) -> tuple[bytes, bytes]:
    """By lines and as a whole."""
    heads = sum(_hash("head", bare(x)) for x in swap)
    by_line, whole = heads, []
    for line in (lines or "").splitlines():
        if value := bare(line):
            by_line += _hash("line", value)
            whole.append(value)
    return (by_line & _MASK).to_bytes(16), (heads + _hash("whole", "".join(whole)) & _MASK).to_bytes(16)


def same(a_swap, a_lines, b_swap, b_lines) -> bool:
    """Field equality without sorting: equal multisets, or equal heads and an equal whole."""
    return pairs(a_swap, a_lines) == pairs(b_swap, b_lines) or (
        Counter(map(bare, a_swap)) == Counter(map(bare, b_swap)) and bare(a_lines) == bare(b_lines)
    )


def copy_groups(df: DataFrame, id_col: str, swap: tuple[str, ...], lines: str, needed: tuple[str, ...]) -> DataFrame:
    """(first_id, copy_id): one row for each record that is a copy of the group's first.

    swap: fields whose values may be exchanged; lines: the field whose lines may be reordered;
    needed: fields without which (NULL, or nothing but whitespace) a row is no case. NULL in another
    field equals ''. Rows with a NULL id are left out; a repeated id counts once. Empty input gives no rows.
    Other columns are ignored whatever their names.

    Hot groups: grouping keeps one row a fingerprint and task (least id and count), and
    in the comparison the first record is copied once for each SHARE members.
    """
    blank = [~F.coalesce(F.col(c), F.lit("")).rlike(r"(?U)\S") for c in needed]
    cases = df.select(F.col(id_col).cast("long").alias("_id"), *[F.col(c).alias(f"_s{i}") for i, c in enumerate(swap)], F.col(lines).alias("_lines")).where(F.col("_id").isNotNull())
    for b, c in zip(blank, needed):
        name = "_lines" if c == lines else f"_s{swap.index(c)}"
        cases = cases.where(F.coalesce(F.col(name), F.lit("")).rlike(r"(?U)\S"))
    n = len(swap)

    def prints(batches):
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(n + 2)]
            got = [fingerprints(list(row[1:-1]), row[-1]) for row in zip(*cols)]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array([x for x, _ in got], pa.binary()), pa.array([y for _, y in got], pa.binary())], ["_id", "by_line", "whole"])

    printed = cut(cases.mapInArrow(prints, "_id long, by_line binary, whole binary"))
    keyed = printed.select("_id", F.explode(F.array(F.concat(F.lit(b"l"), "by_line"), F.concat(F.lit(b"w"), "whole"))).alias("key"))
    groups = keyed.groupBy("key").agg(F.min("_id").alias("rep"), F.count("*").alias("n")).where("n > 1")
    # (rep, _id) of both fingerprints; mostly the same pairs
    links = keyed.join(groups, "key").where("_id <> rep").groupBy("rep", "_id").agg(F.max("n").alias("n"))
    salted = links.withColumn("salt", F.pmod(F.xxhash64("_id"), F.floor(F.col("n") / SHARE) + 1))
    firsts = (
        links.groupBy("rep").agg(F.max("n").alias("n")).join(cases.withColumnRenamed("_id", "rep"), "rep")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / SHARE)))).drop("n")
    )
    ren = {f"_s{i}": f"_t{i}" for i in range(n)} | {"_lines": "_tlines"}
    both = salted.join(cases, "_id").join(firsts.withColumnsRenamed(ren), ["rep", "salt"])

    def verify(batches):
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            keep = [(r[0], r[1]) for r in zip(*cols) if same(r[2 : 2 + n], r[2 + n], r[3 + n : 3 + 2 * n], r[3 + 2 * n])]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in keep], pa.int64()), pa.array([y for _, y in keep], pa.int64())], ["a", "b"])

    order = ["rep", "_id", *[f"_s{i}" for i in range(n)], "_lines", *[f"_t{i}" for i in range(n)], "_tlines"]
    edges = both.select(*order).mapInArrow(verify, "a long, b long")
    found = components(edges).where("node <> component").select(F.col("component").alias("first_id"), F.col("node").alias("copy_id"))
    free(printed)
    return found


def collapsed(df: DataFrame, id_col: str, swap: tuple[str, ...], lines: str, needed: tuple[str, ...]) -> DataFrame:
    """(id, copies): one row for each record, that of the least id of its copies, with how many there are, itself included.

    Rows that are no cases stand for themselves. Rows with a NULL id are left out; a repeated id counts once.
    """
    groups = cut(copy_groups(df, id_col, swap, lines, needed))
    ids = df.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    counts = groups.groupBy(F.col("first_id").alias("id")).agg((F.count("*") + 1).alias("copies"))
    kept = ids.join(groups.select(F.col("copy_id").alias("id")).hint("merge"), "id", "left_anti")
    return kept.join(counts.hint("merge"), "id", "left").select("id", F.coalesce("copies", F.lit(1)).cast("long").alias("copies"))

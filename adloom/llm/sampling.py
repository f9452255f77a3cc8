"""Bounded samples of rows that don't depend on where the rows lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a table that models are fitted on at most, all models on the same ones.
SAMPLE = 6_000
_SPACE = 1 << 30


def row_sample(df: DataFrame, id_col: str, columns: list[Column], most: int = SAMPLE) -> list:
    """At most `most` rows, those of the least hash of their id, read in one pass. A threshold from the number of rows, which a columnar table
    tells without reading any column, keeps all but about that many on the executors, so what reaches the driver doesn't grow with the table or
    its partitions. An empty table gives no rows."""
    n = df.count()
    h = F.pmod(F.xxhash64(F.col(id_col)), F.lit(_SPACE).cast("long"))
    if n > most:
        df = df.where(h < int(_SPACE * min(1.0, (most + 5 * most**0.5) / n)))
    return sorted(df.select(h.alias("_h"), *columns).collect(), key=lambda r: (r[0], str(r)))[:most]

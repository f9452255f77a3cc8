"""Problem 8 on tables: token ids of whole texts. The method is bpe.py's."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.bpe import DEFAULT_TOKENIZER, encoder, portions


def encode_corpus(df: DataFrame, id_col: str, text_col: str, tokenizer: str = DEFAULT_TOKENIZER, out_id: str | None = None) -> DataFrame:
    """(id, ids): the text's ids without special tokens, one row for each row of df.

    NULL and empty texts have the empty list. Texts are encoded whole, whatever their length; the strings of special tokens are ordinary
    text. A NULL or repeated id is kept; an empty table gives no rows; other columns don't matter. No shuffle.
    """
    name = out_id or id_col

    def read(batches):
        e = encoder(tokenizer)
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            for lo, hi in portions(texts):
                flat, counts = e.encode(texts[lo:hi])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists], [name, "ids"])

    return df.select(F.col(id_col).cast("long").alias(name), F.col(text_col)).mapInArrow(read, f"`{name}` long, ids array<int>")

"""Functions that SQL text can call once they are registered in a session."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from adloom.functions.text import token_set_ratio
from adloom.operators.sentences import clean_line, sentences


def register(spark: SparkSession) -> None:
    """clean_line(text), token_set_ratio(text, text) in Arrow batches, and the table function ad_sentences(text) with columns pos and sentence. NULL gives NULL, or no rows."""

    @F.pandas_udf("string")
    def cleaned(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None else clean_line(v))

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else token_set_ratio(set(x.split()), set(y.split())) for x, y in zip(a, b)], dtype="float64")

    @F.udtf(returnType="pos int, sentence string")
    class AdSentences:
        def eval(self, text: str):
            yield from enumerate(sentences(text))

    spark.udf.register("clean_line", cleaned)
    spark.udf.register("token_set_ratio", ratio)
    spark.udtf.register("ad_sentences", AdSentences)

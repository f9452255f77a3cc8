"""Steps around models: budgets, pluggable classifiers, results of batches, redundancy among matches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adloom.functions.text import parsed_task
from adloom.operators.upsert import fill_blanks
from adloom.sources.tables import exists


def within_budget(text: Column, tokens: Callable[[str], list], join: Callable[[list], str], budget: int) -> Column:
    """A text cut to `budget` tokens. One of at most budget / 3 characters is never sent to Python's tokenizer: it can't be longer."""

    @F.pandas_udf("string")
    def shorten(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else v if len(t := tokens(v)) <= budget else join(t[:budget]))

    return F.when(F.length(text) <= budget // 3, text).otherwise(shorten(text))


def token_budget(model: int, new: int, prompt: int, spare: int) -> int:
    """Tokens of a text that fit into a model beside its answer, the prompt and some to spare."""
    return max(0, model - new - prompt - spare)


def generate(df: DataFrame, text: str, load: Callable[[], Callable[[list[str]], list[str]]], out: str = "answer", batch: int = 256) -> DataFrame:
    """df with the answer of a model to each text. load gives a function from prompts to answers and is called once a task; NULL texts aren't sent and have no answer."""

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for b in batches:
            sent = b.dropna()
            said: list[str] = []
            for k in range(0, len(sent), batch):
                said += model(sent.iloc[k : k + batch].tolist())
            yield pd.Series(said, sent.index, dtype=object).reindex(b.index)

    return df.withColumn(out, answer(F.col(text)))


def cached(spark: SparkSession, path: str, model: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What make gives, kept for one model: read again as long as the model is the same, made anew for another."""
    place = f"{path}/model={hashlib.sha256(model.encode()).hexdigest()[:24]}"
    if not exists(spark, f"{place}/_SUCCESS"):
        make().write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)


def classify(sentences: DataFrame, text: str, load: Callable[[], Callable[[list[str]], np.ndarray]], threshold: float = 0.5) -> DataFrame:
    """sentences with the score of a model that is loaded once a worker, and those at or above the threshold only. load gives
    a function from texts to scores of class 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for b in batches:
            yield pd.Series(np.asarray(model(b.fillna("").tolist()), float))

    return sentences.withColumn("score", score(F.col(text))).where(F.col("score") >= threshold)


def classify_distinct(df: DataFrame, column: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run dear work once for each different value and join the result back. work keeps `column`."""
    return df.join(work(df.select(column).where(F.col(column).isNotNull()).distinct()), column, "left")


def apply_batch_results(target: DataFrame, results: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Target with blank cells filled from results (custom_id, value, ord) whose id is table:id:field; ill-formed ids are skipped and
    the last value of an id counts. fields: column by field name."""
    r = results.withColumn("t", parsed_task(F.col("custom_id"))).where("t is not null").select(F.col("t.id").alias("id"), F.col("t.field").alias("field"), "value", "ord")
    for field, column in fields.items():
        target = fill_blanks(target, r.where(F.col("field") == field).withColumnRenamed("value", "_value"), "id", column, "_value", F.col("ord"), last=True)
    return target


def without_redundant(dots: DataFrame, sentence: str, token: str, candidate: str, score: str, first_last: bool = True) -> DataFrame:
    """(sentence, candidate) that win at least one token by score. With first_last the first and last token of a sentence don't count; sentences of
    up to two tokens, and single candidates, are kept as they are."""
    w = Window.partitionBy(sentence)
    x = dots.withColumn("_lo", F.min(token).over(w)).withColumn("_hi", F.max(token).over(w)).withColumn("_n", F.max(candidate).over(w) != F.min(candidate).over(w))
    few = (F.col("_hi") - F.col("_lo") < 2) | ~F.col("_n")
    inner = (F.col(token) > F.col("_lo")) & (F.col(token) < F.col("_hi")) if first_last else F.lit(True)
    won = x.where(~few & inner).groupBy(sentence, token).agg(F.max_by(candidate, F.struct(F.col(score), -F.col(candidate))).alias(candidate)).select(sentence, candidate)
    return won.unionAll(x.where(few).select(sentence, candidate)).distinct()


def first_text(c: Column, strict: bool = False) -> Column:
    """The first non-empty text of output[].content[], or with strict that of the very first content."""
    if strict:
        return F.get_json_object(c, "$.output[0].content[0].text")
    parsed = F.from_json(c, "output array<struct<content:array<struct<text:string>>>>")
    texts = F.flatten(F.transform(F.coalesce(parsed["output"], F.array()), lambda o: F.coalesce(F.transform(o["content"], lambda x: x["text"]), F.array())))
    return F.try_element_at(F.filter(texts, lambda t: t != ""), F.lit(1))

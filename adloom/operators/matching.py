"""Matching terms to titles from cheap to dear, and vectors to vectors.

Terms are made distinct first and each step sees only what the steps before it left over.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.functions.text import bare_key, token_set_ratio

#: Largest list of titles that is sent to every task; beyond it the steps that need it raise.
MOST_TITLES = 200_000


def _bounded(titles: DataFrame, columns: list[str]) -> list:
    rows = titles.select(*columns).limit(MOST_TITLES + 1).collect()
    if len(rows) > MOST_TITLES:
        raise ValueError("too many titles to send to every task")
    return rows


def exact_steps(terms: DataFrame, titles: DataFrame, term: str, title: str, code: str) -> DataFrame:
    """terms with (code, step): by lower case title, else by letters and digits only; titles that share a key: the least code."""
    low = titles.groupBy(F.lower(title).alias("_low")).agg(F.min(code).alias("_c1"))
    bare = titles.groupBy(bare_key(F.col(title)).alias("_bare")).agg(F.min(code).alias("_c2")).where(F.col("_bare") != "")
    x = terms.withColumn("_low", F.lower(term)).withColumn("_bare", bare_key(F.col(term))).join(low, "_low", "left").join(bare, "_bare", "left")
    return x.withColumn(code, F.coalesce("_c1", "_c2")).withColumn("step", F.when(F.col("_c1").isNotNull(), "exact").when(F.col("_c2").isNotNull(), "bare")).drop("_low", "_bare", "_c1", "_c2")


def longest_contained(terms: DataFrame, titles: DataFrame, term: str, title: str, code: str, least: int = 4) -> DataFrame:
    """terms with the code and title of the longest title that a term contains (ties: the least title).

    The titles are checked to be few and stand in an automaton in each task: one pass over a term finds all
    of them, where a join on contains would compare every pair.
    """
    entries = sorted((r[0].lower(), r[1]) for r in _bounded(titles, [title, code]) if r[0] and len(r[0]) >= least)
    shared = terms.sparkSession.sparkContext.broadcast(entries)

    @F.pandas_udf("struct<code:string,title:string>")
    def find(values: pd.Series) -> pd.DataFrame:
        import ahocorasick

        a = ahocorasick.Automaton()
        for t, c in reversed(shared.value):
            a.add_word(t, (len(t), t, c))
        if len(a):
            a.make_automaton()
        out = []
        for v in values:
            hits = [x for _, x in a.iter(v.lower())] if v and len(a) else []
            best = min(hits, key=lambda x: (-x[0], x[1])) if hits else None
            out.append((best[2], best[1]) if best else (None, None))
        return pd.DataFrame(out, columns=["code", "title"])

    return terms.withColumn("_f", find(F.col(term))).select(*terms.columns, F.col("_f.code").alias(code), F.col("_f.title").alias("found"))


def _characters(texts: list[str]) -> np.ndarray:
    """(texts, 128) counts of ASCII characters."""
    out = np.zeros((len(texts), 128), np.int32)
    for i, t in enumerate(texts):
        np.add.at(out[i], np.frombuffer(t.encode("ascii"), np.uint8), 1)
    return out


def fuzzy(terms: DataFrame, titles: DataFrame, term: str, title: str, code: str, cutoff: float = 82.0) -> DataFrame:
    """terms with the code and score of the best title by token-set ratio (ties: most shared words, then the least code), if at least cutoff. Of titles that share no word
    with a term those are scored whose length and counts of characters let the ratio reach the cutoff."""
    entries = [(bare, r[1]) for r in _bounded(titles, [title, code]) if (bare := "".join(c for c in (r[0] or "").lower() if c.isascii() and (c.isalnum() or c == " ")).strip())]
    shared = terms.sparkSession.sparkContext.broadcast(entries)

    @F.pandas_udf("struct<code:string,score:double>")
    def best(values: pd.Series) -> pd.DataFrame:
        sets = [(frozenset(t.split()), c) for t, c in shared.value]
        counts = _characters([" ".join(sorted(s)) for s, _ in sets])
        lengths = counts.sum(1)
        by_word: dict = {}
        for i, (s, _) in enumerate(sets):
            for w in s:
                by_word.setdefault(w, []).append(i)
        out = []
        for v in values:
            words = set("".join(c for c in (v or "").lower() if c.isascii() and (c.isalnum() or c == " ")).split())
            near = {i for w in words for i in by_word.get(w, ())}
            # without a shared word the ratio is that of the texts, and no more characters match than both have
            own = _characters([" ".join(sorted(words))])[0]
            near.update(np.flatnonzero(200.0 * np.minimum(counts, own).sum(1) >= cutoff * (lengths + own.sum())).tolist())
            got = min(((-token_set_ratio(words, set(sets[i][0])), -len(words & sets[i][0]), sets[i][1]) for i in near), default=(0.0, 0, None))
            out.append((got[2], -got[0]) if -got[0] >= cutoff and len(" ".join(words)) > 2 else (None, None))
        return pd.DataFrame(out, columns=["code", "score"])

    return terms.withColumn("_f", best(F.col(term))).select(*terms.columns, F.col("_f.code").alias(code), F.col("_f.score").alias("score"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def nearest(queries: DataFrame, base: DataFrame, id_col: str, vector: str, k: int = 2, most_queries: int = 200_000) -> DataFrame:
    """(query, neighbour, score, rank): the k vectors of base with the largest dot product, ties by id.

    The stated queries are held in every task, after a check of their number, and go against base in blocks by matrix
    products; a task keeps k candidates of each query, so what is shuffled doesn't grow with base but with its tasks.
    """
    rows = queries.select(id_col, vector).limit(most_queries + 1).collect()
    if len(rows) > most_queries:
        raise ValueError("too many queries at once: send them in parts")
    ids = np.array([r[0] for r in rows], np.int64)
    matrix = np.array([r[1] for r in rows], np.float64) if rows else np.zeros((0, 1))
    shared = base.sparkSession.sparkContext.broadcast((ids, matrix))

    def scan(batches):
        q, m = shared.value
        top_s, top_i = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, np.int64)
        for b in batches:
            if not len(b) or not len(q):
                continue
            v, i = np.stack(b[vector].to_numpy()).astype(np.float64), b[id_col].to_numpy()
            for lo in range(0, len(q), 2048):
                s = m[lo : lo + 2048] @ v.T
                s[q[lo : lo + 2048, None] == i[None, :]] = -np.inf
                both, who = np.hstack([top_s[lo : lo + 2048], s]), np.hstack([top_i[lo : lo + 2048], np.broadcast_to(i, s.shape)])
                order = np.lexsort((who, -both), axis=1)[:, :k]
                top_s[lo : lo + 2048], top_i[lo : lo + 2048] = np.take_along_axis(both, order, 1), np.take_along_axis(who, order, 1)
        keep = np.isfinite(top_s)
        yield pd.DataFrame({"query": np.repeat(q, k)[keep.ravel()], "neighbour": top_i[keep], "score": top_s[keep]})

    found = base.select(id_col, vector).mapInPandas(scan, "query long, neighbour long, score double")
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_entry(queries: DataFrame, entries: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(query, entry, score): the entry with the largest dot product of each query, ties by id. The entries are a checked, small list in every task; queries are read in batches, without a shuffle."""
    rows = _bounded(entries, [id_col, vector])
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    ids = np.array([rows[k][0] for k in order], np.int64)
    matrix = np.array([rows[k][1] for k in order], np.float64) if rows else np.zeros((0, 1))
    shared = queries.sparkSession.sparkContext.broadcast((ids, matrix))

    def find(batches):
        i, m = shared.value
        for b in batches:
            if not len(b) or not len(i):
                continue
            s = np.stack(b[vector].to_numpy()).astype(np.float64) @ m.T
            at = s.argmax(1)
            yield pd.DataFrame({"query": b[id_col], "entry": i[at], "score": s[np.arange(len(at)), at]})

    return queries.select(id_col, vector).mapInPandas(find, "query long, entry long, score double")


def effective_threshold(threshold: float, redundancy_filter: bool, default: float = 0.48, unfiltered: float = 0.53) -> float:
    """The threshold asked for; where it was left at its default and redundant matches aren't filtered, the higher one."""
    return unfiltered if not redundancy_filter and threshold == default else threshold


def attention(tokens: DataFrame, skills: DataFrame, sentence: str, token: str, vector: str, skill: str, skill_vector: str, threshold: float = 0.48) -> DataFrame:
    """(sentence, skill, score): the softmax over a sentence's tokens of their dot products with a skill weighs their cosines with it.

    The skills are a checked, small list in every task. A sentence's tokens are brought together once.
    """
    rows = _bounded(skills, [skill, skill_vector])
    names = [r[0] for r in rows]
    z = np.array([r[1] for r in rows], np.float64) if rows else np.zeros((0, 1))
    shared = tokens.sparkSession.sparkContext.broadcast((names, z))

    def score(key, t):
        names, z = shared.value
        x = np.stack(t[vector].to_numpy()).astype(np.float64)
        d = x @ z.T
        w = np.exp(d - d.max(0))
        cosine = d / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(z, axis=1)[None, :])
        s = (w / w.sum(0) * cosine).sum(0)
        return pd.DataFrame({"sentence": key[0], "skill": names, "score": s})[s >= threshold]

    return tokens.select(F.col(sentence).cast("long").alias("sentence"), vector).groupBy("sentence").applyInPandas(score, "sentence long, skill long, score double")

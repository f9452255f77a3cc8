"""Language codes where they are missing. The detector is a column expression, so another can take its place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.text import is_blank, strip

#: Scripts that name a language by themselves, in the order in which they count, and usual words of languages in Latin letters.
SCRIPTS = (("JA", r"[ぁ-ゖァ-ヺ]"), ("KO", r"[가-힣]"), ("ZH", r"[一-鿿]"))
WORDS = {"EN": ("the", "and", "of", "for", "with", "to", "in"), "DE": ("der", "die", "das", "und", "für", "mit", "sie"), "PT": ("de", "para", "com", "uma", "os", "do", "da"), "ID": ("yang", "dan", "untuk", "dengan", "kami", "di"), "VI": ("và", "của", "cho", "với", "các", "tại")}


def _among(words: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda x: x.isin(*words)


def by_script_and_words(text: Column) -> Column:
    """The ISO 639-1 code in upper case: of the first script that occurs, else of the language most of whose usual words occur (ties: as listed); NULL if none does."""
    words = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "), " ")
    codes = F.array(*map(F.lit, WORDS))

    def usual(w: Column) -> Column:
        counts = F.array(*(F.size(F.filter(w, _among(ws))) for ws in WORDS.values()))
        return F.transform(F.array(counts), lambda n: F.when(F.array_max(n) > 0, F.element_at(codes, F.array_position(n, F.array_max(n)).cast("int"))))[0]

    out = F.when(text.isNull(), F.lit(None).cast("string"))
    for code, pattern in SCRIPTS:
        out = out.when(text.rlike(pattern), F.lit(code))
    # the words are bound once for all counts
    return out.otherwise(F.transform(F.array(words), usual)[0])


def fill_languages(df: DataFrame, fields: dict[str, str], detect: Callable[[Column], Column] = by_script_and_words) -> DataFrame:
    """df with the language columns (by text column) filled where they are blank; blank texts give NULL, what is there stays as it is."""
    new = {}
    for text, lang in fields.items():
        t = strip(F.col(text))
        new[lang] = F.when(~is_blank(F.col(lang)), F.col(lang)).otherwise(detect(F.nullif(t, F.lit(""))))
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])

"""Column functions on text. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"


def sql_trim(c: Column) -> Column:
    """SQL's TRIM: spaces only."""
    return F.trim(c)


def strip(c: Column) -> Column:
    """All Unicode whitespace at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    """NULL, or nothing after TRIM. Never NULL itself."""
    return c.isNull() | (F.trim(c) == "")


def filled(c: Column) -> Column:
    """The trimmed value, or NULL if blank."""
    return F.nullif(F.trim(c), F.lit(""))


def day(c: Column) -> Column:
    """The day of a date or timestamp as text, years first with dashes or slashes or days first with dots; NULL if it can't be read."""
    x = F.regexp_replace(strip(c), r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    x = F.regexp_replace(x, r"^(\d{1,2})\.(\d{1,2})\.(\d{4})", "$3-$2-$1")
    return x.try_cast("timestamp_ntz").cast("date")


def collapse(c: Column) -> Column:
    """Runs of whitespace as one space, none at the ends; NULL as ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))


def label_key(c: Column) -> Column:
    """A label for comparison: lower case, whitespace (non-breaking too) collapsed."""
    return F.trim(F.regexp_replace(F.lower(c), SPACE, " "))


def bare_key(c: Column) -> Column:
    """Lower case, only a-z, 0-9 and spaces."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", ""))


def url_domain(c: Column) -> Column:
    """The part after the second slash; NULL if there is none."""
    return F.try_element_at(F.split(c, "/"), F.lit(3))


def skill_branch(code: Column) -> Column:
    """S and one more character of codes that start with S."""
    return F.when(code.startswith("S"), F.substring(code, 1, 2))


def knowledge_branch(code: Column) -> Column:
    """The first three digits, NULL if there are fewer."""
    digits = F.regexp_replace(code, "[^0-9]", "")
    return F.when(F.length(digits) >= 3, F.substring(digits, 1, 3))


def top_category(code: Column, kind: Column, with_language: bool = True) -> Column:
    """Language, Transversal, S1 to S8, or three knowledge digits (fewer are padded with zeros); else NULL."""
    digits = F.regexp_replace(code, "[^0-9]", "")
    return (
        F.when(kind == "language_skills", F.lit("Language") if with_language else F.lit(None).cast("string"))
        .when(kind == "transversal_skills", F.lit("Transversal"))
        .when(kind == "skills", F.nullif(F.regexp_extract(code, r"^(S\d)", 1), F.lit("")))
        .when(kind == "knowledge", F.when(digits != "", F.lpad(F.substring(digits, 1, 3), 3, "0")))
    )


#: What a translation may be wrapped in, in the order in which it is taken off.
LEADS = ("Translation:", "English:", "Translated:", "Result:")
END_MARKS = ("</s>", "<end_of_turn>", "<eos>")


def clean_translation(c: Column) -> Column:
    """A translation without lead-ins and end marks; NULL if nothing is left."""
    x = strip(c)
    for lead in LEADS:
        x = strip(F.regexp_replace(x, f"^(?i:{lead})", ""))
    for mark in END_MARKS:
        x = strip(F.regexp_replace(x, f"{mark}$", ""))
    return F.nullif(x, F.lit(""))


def ellipsis(c: Column, n: int) -> Column:
    """At most n characters, the rest as one sign."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def task_id(table: Column, key: Column, field: Column) -> Column:
    return F.concat_ws(":", table, key.cast("string"), field)


def parsed_task(c: Column) -> Column:
    """struct(table, id, field) of a well-formed task id, else NULL."""
    parts = F.split(c, ":")
    return F.when((F.size(parts) == 3) & parts[1].rlike(r"^\d+$"), F.struct(parts[0].alias("table"), parts[1].cast("long").alias("id"), parts[2].alias("field")))


def skill_list(c: Column) -> Column:
    """The strings of a model's list: of the outermost brackets read as JSON if that is possible, else whatever stands in double quotes.
    Entries are stripped and need two characters. NULL gives an empty list."""
    inside = F.regexp_extract(c, r"(?s)\[.*\]", 0)
    parsed = F.try_parse_json(inside).cast("array<variant>")
    texts = F.transform(F.filter(parsed, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: v.cast("string"))
    quoted = F.regexp_extract_all(c, F.lit('"([^"]{2,})"'), F.lit(1))
    read = F.when((inside != "") & parsed.isNotNull(), texts).otherwise(quoted)
    stripped = F.transform(read, strip)
    return F.coalesce(F.filter(stripped, lambda x: F.length(x) >= 2), F.array().cast("array<string>"))


def table_name(c: Column) -> Column:
    """A canonical table name: names that have the prefix stay, the board's name goes, double underscores collapse once, 'table' if nothing is left."""
    x = F.regexp_replace(c, "indeed|Indeed|INDEED", "")
    x = F.regexp_replace(F.replace(x, F.lit("__"), F.lit("_")), "^_+|_+$", "")
    return F.when(c.startswith("jobads_"), c).otherwise(F.concat(F.lit("jobads_"), F.when(x == "", F.lit("table")).otherwise(x)))


def prefixed_table(c: Column, iso: Column | None = None) -> Column:
    """The name with the prefix, and with a country's code where there is one."""
    code = F.lit("") if iso is None else F.when(iso.isNull(), F.lit("")).otherwise(F.concat(iso, F.lit("_")))
    return F.concat(F.lit("jobads_"), code, c)


def between_affixes(c: Column, prefix: str, suffix: str) -> Column:
    """A name without its prefix and suffix."""
    return F.regexp_replace(F.regexp_replace(c, f"^{prefix}", ""), f"{suffix}$", "")


def second_part(c: Column) -> Column:
    """The part behind the first underscore, up to the next, in upper case."""
    return F.upper(F.try_element_at(F.split(c, "_"), F.lit(2)))


def output_name(c: Column, ending: str, by: str) -> Column:
    """The name of a step's output: the file's ending is replaced, or added if it isn't there."""
    stem = F.regexp_replace(c, r"\.jsonl$", "")
    return F.concat(F.regexp_replace(stem, f"{ending}$", ""), F.lit(f"{by}.jsonl"))


#: How sentences are told apart.
SENTENCE_BREAK = r'(?<=[.!?])\s+(?=[A-Z0-9("])'


def line_sentences(c: Column, least_chars: int = 10, least_words: int = 2) -> Column:
    """Sentences of one line with enough characters and words."""
    parts = F.transform(F.split(c, SENTENCE_BREAK), lambda s: F.trim(F.regexp_replace(s, SPACE, " ")))
    return F.filter(parts, lambda s: (F.length(s) >= least_chars) & (F.regexp_count(s, F.lit(r"[\p{L}\p{N}_]+")) >= least_words))


def token_set_ratio(left: set[str], right: set[str]) -> float:
    """Similarity from 0 to 100 of two sets of words: the best of the shared words and either side's rest put together."""
    from difflib import SequenceMatcher

    both, a, b = (" ".join(sorted(x)) for x in (left & right, left - right, right - left))
    one, two = f"{both} {a}".strip(), f"{both} {b}".strip()
    if both and (not a or not b):
        return 100.0
    pairs = [(one, two)] + ([(both, one), (both, two)] if both else [])
    return max(200.0 * sum(m.size for m in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()) / (len(x) + len(y)) for x, y in pairs)

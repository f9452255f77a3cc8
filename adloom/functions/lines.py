"""Lines of ads as column expressions: what sentences.py does to one line, for use without sentences."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.operators.sentences import CLEANING, CONNECTING, HEADINGS, PARTICULARS, VERBS

WORD = r"[\p{L}\p{N}_]+"


def cleaned(line: Column) -> Column:
    """A line without links, marks and bullets, in the order of CLEANING."""
    for pattern, by in CLEANING:
        line = F.regexp_replace(line, f"(?U){pattern}", re.sub(r"\\(\d)", r"$\1", by))
    return F.regexp_replace(line, r"(?U)^\s+|\s+$", "")


def clean_lines(text: Column) -> Column:
    """The cleaned lines of a text that hold anything."""
    return F.filter(F.transform(F.split(text, "\n"), cleaned), lambda x: x != "")


def is_particular(line: Column) -> Column:
    """Whether a line states a particular, or is a single token of 40 characters or more."""
    return line.rlike(rf"(?iU)^(?:{PARTICULARS})\s*[:\-]") | line.rlike(r"(?U)^\S{40,}$")


def is_heading(line: Column) -> Column:
    """Whether a line is a heading: in brackets, a known phrase, or up to six words before a colon."""
    bare = F.regexp_replace(F.regexp_replace(line, r"(?U)^#+\s*", ""), r"[\[\]()*:_]", " ")
    key = F.lower(F.trim(F.regexp_replace(bare, r"(?U)\s+", " ")))
    short = F.regexp_count(key, F.lit(WORD)) <= 6
    return (key != "") & (line.rlike(r"^\[.+\]$") | (short & (key.isin(*sorted(HEADINGS)) | line.rlike(r"(?U):\s*$"))))


_TOKEN = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_'\-]*[\p{L}\p{N}_])?"


def may_go_on(line: Column) -> Column:
    """Whether a line may go on in the next: after a comma or a connecting word, or as it has up to three words and names nothing to do; never after a stop."""
    words = F.regexp_extract_all(line, F.lit(f"({_TOKEN})"), F.lit(1))
    last = F.lower(F.try_element_at(words, F.lit(-1)))
    few = (F.size(words) > 0) & (F.size(words) <= 3) & ~line.rlike(rf"(?iU)\b(?:{VERBS})\b")
    return ~line.rlike(r"[.!?:;]$") & (line.endswith(",") | F.coalesce(last.isin(*sorted(CONNECTING)), F.lit(False)) | few)


def goes_on(line: Column) -> Column:
    """Whether a line goes on from the one before: it starts in lower case, with a closing mark or with a connecting word."""
    first = F.regexp_replace(F.lower(F.regexp_extract(line, r"(?U)^\s*(\S+)", 1)), r"""^[.,;:()\[\]"']+|[.,;:()\[\]"']+$""", "")
    return line.rlike(r"^[\p{Ll},;)\]]") | first.isin(*sorted(CONNECTING))

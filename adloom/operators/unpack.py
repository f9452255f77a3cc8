"""Problem 6: several values packed in one field.

A finite-state tokenizer reads a field from left to right. Its states are: before a value,
inside a bare value, inside a quoted value or a quoted part of a bare one (with its closing quote; a backslash or a doubled
quote keeps the state), and its nesting depth. Delimiters count only outside quotes and
parentheses and not after a backslash, which then isn't part of the value. Where a field's values may hold a delimiter unquoted, they come from
a list of whole values, tried at the start of a value and closed by a delimiter or the end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUOTES = {'"': '"', "'": "'", "“": "”", "「": "」", "『": "』", "＂": "＂"}
OPENING, CLOSING = "([（", ")]）"
_MARK = re.compile(r"[-*•・‣●■–]\s+")
#: Entries of a list of whole values the driver takes at most; beyond it the list must be split first.
MOST_WHOLE = 100_000


@dataclass
class Grammar:
    """delimiters: single characters that always separate; spaced: those that do so only between whitespace;
    whitespace: whether runs of whitespace separate too; whole: values that may hold delimiters unquoted."""

    delimiters: str = ",;|、，；\n\t"
    spaced: str = ""
    whitespace: bool = False
    whole: list[str] = field(default_factory=list)
    cache: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        stops = re.escape(self.delimiters)
        quotes = re.escape("".join(QUOTES))
        nests = re.escape(OPENING + CLOSING)
        self._special = re.compile(f"[{stops}{quotes}{nests}\\\\{re.escape(self.spaced)}" + (r"\s" if self.whitespace else "") + "]")
        self._escape = re.compile(rf"\\({self._special.pattern})")
        inner = [w for w in self.whole if self._special.search(w)]
        self._whole = re.compile("(?:" + "|".join(map(re.escape, sorted(inner, key=len, reverse=True))) + rf")(?=\s*(?:[{stops}{re.escape(self.spaced)}\]]|$))", re.I) if inner else None


def _separates(text: str, i: int, g: Grammar) -> bool:
    c = text[i]
    if c in g.delimiters or (g.whitespace and c.isspace()):
        return True
    return c in g.spaced and 0 < i < len(text) - 1 and text[i - 1].isspace() and text[i + 1].isspace()


def tokens(text: str | None, g: Grammar) -> list[str]:
    """The non-empty values of a field in order. NULL, blank and empty brackets give []."""
    if text is None:
        return []
    text = text.strip().lstrip("﻿")
    if len(text) > 1 and text[0] in "[(（" and text[-1] in "])）" and _encloses(text):
        text = text[1:-1]
    out, i, n = [], 0, len(text)
    closing = max(map(text.rfind, CLOSING))
    while i < n:
        # before a value: skip whitespace, delimiters and list marks
        while i < n and (text[i].isspace() or _separates(text, i, g)):
            i += 1
        if i >= n:
            break
        if m := _MARK.match(text, i):
            i = m.end()
            continue
        if g._whole and (m := g._whole.match(text, i)):
            out.append(m[0])
            i = m.end()
            continue
        if text[i] in QUOTES:
            value, j = _quoted(text, i)
            k = j
            while k < n and text[k].isspace() and text[k] not in g.delimiters:
                k += 1
            if j > 0 and (k >= n or _separates(text, k, g) or (g.whitespace and k > j) or (text[k] in g.spaced)):
                if value.strip():
                    out.append(value.strip())
                i = k
                continue
        # a bare value: up to a delimiter outside parentheses and quotes
        start, depth, escaped = i, 0, False
        while m := g._special.search(text, i):
            c, i = m[0], m.start()
            if c == "\\" and i + 1 < n and g._special.match(text, i + 1):
                escaped = True
                i += 1
            elif c in QUOTES and (i == start or text[i - 1].isspace() or text[i - 1] in OPENING) and (j := _quoted(text, i)[1]) and (j >= n or not text[j].isalnum()):
                i = j - 1  # a quoted part; an apostrophe or an inch mark stands after a letter or figure
            elif c in OPENING and i < closing:
                depth += 1
            elif c in CLOSING:
                depth = max(0, depth - 1)
            elif depth == 0 and _separates(text, i, g):
                break
            elif c == "\n":
                break
            i += 1
        else:
            i = n
        if value := _trimmed(g._escape.sub(r"\1", text[start:i]) if escaped else text[start:i]):
            out.append(value)
        i = max(i, start + 1)
    return out


def _encloses(text: str) -> bool:
    """Whether the first bracket is closed by the last character."""
    depth, quote = 0, ""
    for k, c in enumerate(text):
        if quote:
            if c == quote and text[k - 1] != "\\":
                quote = ""
        elif c in '"':
            quote = c
        elif c in OPENING:
            depth += 1
        elif c in CLOSING:
            depth -= 1
            if depth == 0:
                return k == len(text) - 1
    return True


def _quoted(text: str, i: int) -> tuple[str, int]:
    """The quoted value that starts at i and the place after its closing quote; 0 if it is never closed."""
    close, out, i = QUOTES[text[i]], [], i + 1
    while i < len(text):
        c = text[i]
        if c == "\\" and i + 1 < len(text):
            out.append(text[i + 1])
            i += 2
        elif c == close:
            if text[i + 1 : i + 2] == close:
                out.append(c)
                i += 2
            else:
                return "".join(out), i + 1
        else:
            out.append(c)
            i += 1
    return "", 0


def _trimmed(value: str) -> str:
    value = value.strip()
    for a, b in QUOTES.items():
        if len(value) > 1 and value[0] == a and value[-1] == b:
            return value[1:-1].strip()
    value = value.strip('"“”[]').strip()
    return value


def unpack(df: DataFrame, id_col: str, fields: dict[str, Grammar], least: int = 2) -> DataFrame:
    """(id, field_name, pos, item): the values of fields that hold at least `least`.

    No shuffle; a row is read once however many fields it has. NULL and blank fields
    give no rows, values that repeat keep a row each, texts of any length are read whole, other columns
    don't matter. An empty table gives no rows.
    """
    names = list(fields)

    def read(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            rows: tuple[list, ...] = ([], [], [], [])
            for k, name in enumerate(names):
                g = fields[name]
                for i, text in zip(ids, b.column(k + 1).to_pylist()):
                    if not text or len(text) < 3:
                        continue
                    got = tokens(text, g)
                    if len(got) >= least:
                        rows[0].extend([i] * len(got))
                        rows[1].extend([name] * len(got))
                        rows[2].extend(range(len(got)))
                        rows[3].extend(got)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.string())], ["id", "field_name", "pos", "item"])

    return df.select(F.col(id_col).cast("long"), *[F.col(n).cast("string") for n in names]).mapInArrow(read, "id long, field_name string, pos long, item string")


def skill_grammar(concepts: DataFrame) -> Grammar:
    """Skills: the taxonomy's titles that hold a delimiter may stand unquoted; a slash separates only between spaces."""
    titles = [r[0] for r in concepts.where(F.col("title").rlike(r"[,;|/、，；・•]")).select("title").distinct().limit(MOST_WHOLE + 1).collect()]
    if len(titles) > MOST_WHOLE:
        raise ValueError("too many titles hold a delimiter to send to every task")
    return Grammar(delimiters=",;|、，；・•\n\t", spaced="/", whole=titles)


def code_grammar() -> Grammar:
    """Taxonomy codes hold no delimiter, so whitespace and slashes separate as well."""
    return Grammar(delimiters=",;|、，；・•/\n\t", whitespace=True)

"""Problem 3: quantities recorded in different units, brought to one.

A text is cut into figures and unit strings. Unit strings are segmented by dynamic
programming over tries of prefixes (scales), roots (currencies and periods) and
exponents (what puts a root below the line); where several decompositions fit, the cheapest wins,
and the field's dimension prior makes a root of a dimension the field hasn't cost more. Figures
are kept exact: the result is computed in fractions and rounded half up once.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALES = {"百": 100, "千": 1000, "万": 10**4, "億": 10**8, "k": 1000, "thousand": 1000, "million": 10**6, "mio": 10**6}
MONEY = {
    "JPY": ("円", "yen", "¥", "jpy"), "USD": ("usd", "us$", "$", "dollar", "dollars", "ドル"), "EUR": ("eur", "€", "euro", "euros", "ユーロ"),
    "GBP": ("gbp", "£", "pound", "pounds", "ポンド"), "CNY": ("cny", "rmb", "yuan", "元", "人民元"), "KRW": ("krw", "₩", "won", "원", "ウォン"), "VND": ("vnd", "₫", "dong", "ドン"),
    "BRL": ("brl", "r$", "reais"), "IDR": ("idr", "rp", "rupiah"), "THB": ("thb", "฿", "baht", "バーツ"), "PHP": ("php", "₱", "pesos"), "INR": ("inr", "₹", "rupees", "ルピー"), "MYR": ("myr", "rm", "ringgit"),
    "SGD": ("sgd", "s$"), "HKD": ("hkd", "hk$"), "TWD": ("twd", "nt$"), "AUD": ("aud", "a$"), "CAD": ("cad", "c$"), "NZD": ("nzd", "nz$"), "CHF": ("chf", "sfr"), "PLN": ("pln", "zł"), "SEK": ("sek",), "NOK": ("nok",), "DKK": ("dkk",), "MXN": ("mxn", "mx$"),
}
#: Words that name the period by themselves.
PAY = {
    "hour": ("時給", "時間給", "hourly", "時間当たり", "hour rate", "hour wage"),
    "day": ("日給", "日当", "日払い", "日払", "daily", "日額", "day rate", "daily rate", "per diem"),
    "week": ("週給", "週払い", "weekly", "週額", "week rate"),
    "month": ("月給", "月収", "月額", "月俸", "monthly", "month rate"),
    "year": ("年収", "年俸", "年額", "年給", "annually", "annual", "yearly", "p.a.", "p.a", "per annum"),
}
#: Roots that name a period only below the line.
TIME = {
    "hour": ("時", "時間", "hour", "hours", "h", "hr", "hrs"),
    "day": ("日", "day", "days", "d"),
    "week": ("週", "週間", "week", "weeks", "wk", "w"),
    "month": ("月", "ヶ月", "か月", "ケ月", "カ月", "箇月", "month", "months", "mo", "mth", "m"),
    "year": ("年", "year", "years", "yr", "yrs", "annum", "y"),
}
BELOW = ("/", "per", "a", "an", "毎", "each", "the", "by", "⁻¹", "^-1")
RANGE = ("-", "~", "〜", "–", "—", "−", "to", "から", "until", "bis", "‐", "ー")
#: Cost of a character that fits nothing, and of a root that the field's dimensions don't have.
UNKNOWN, FOREIGN = 4.0, 3.0
_FIGURE = re.compile(r"(?<![a-z])\d(?:[\d.,]*\d)?|(?<![\d#百千万億])[〇一二三四五六七八九十百千]+(?=[万億円])")
_KANJI = {c: i for i, c in enumerate("〇一二三四五六七八九")}
_TENS = {"十": 10, "百": 100, "千": 1000}


def _trie() -> dict:
    root: dict = {}

    def put(word, kind, value):
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node.setdefault("", []).append((kind, value))

    for kind, table in (("money", MONEY), ("pay", PAY), ("time", TIME)):
        for value, words in table.items():
            for w in words:
                put(w, kind, value)
    for w, v in SCALES.items():
        put(w, "scale", v)
    for w in BELOW:
        put(w, "below", None)
    for w in RANGE:
        put(w, "range", None)
    put("#", "figure", None)
    return root


_ROOT = _trie()
_DIMENSION = {"money": "money", "scale": "money", "pay": "time", "time": "time"}


def _arc(before: str, kind: str) -> float:
    """Cost of one part after another."""
    if kind == "time":
        return 0.2 if before == "below" else 1.0 if before in ("money", "scale", "figure") else 6.0
    if kind == "scale":
        return 0.2 if before in ("figure", "scale") else 5.0
    if kind == "range":
        return 0.5 if before in ("figure", "money", "scale") else 2.0
    return 0.5


@lru_cache(maxsize=50_000)
def segment(unit: str, dimensions: frozenset = frozenset({"money", "time"})) -> tuple[tuple[str, object], ...]:
    """The cheapest decomposition of a unit string in which figures are '#'. Letters of the Latin alphabet match as whole words."""
    n = len(unit)
    best: list[dict] = [{} for _ in range(n + 1)]
    best[0][""] = (0.0, None, None)
    for i in range(n):
        if not best[i]:
            continue
        steps = []
        if unit[i] in " \t　:,;()（）・。.+約制":
            steps.append((i + 1, None, None, 0.0))
        else:
            j = i
            if unit[i].isascii() and unit[i].isalpha():
                while j < n and unit[j].isascii() and unit[j].isalpha():
                    j += 1
            else:
                j = i + 1
            steps.append((j, "?", None, UNKNOWN))
        if unit[i] not in _ROOT and unicodedata.category(unit[i]) == "Sc":
            steps.append((i + 1, "money", unit[i], 0.0))  # a currency, if none that is known
        node, j = _ROOT, i
        if not (unit[i].isascii() and unit[i].isalpha() and i and unit[i - 1].isascii() and unit[i - 1].isalpha()):
            while j < n and unit[j] in node:
                node, j = node[unit[j]], j + 1
                inside = unit[j - 1].isascii() and unit[j - 1].isalpha() and j < n and unit[j].isascii() and unit[j].isalpha()
                if "" in node and not inside:
                    for kind, value in node[""]:
                        steps.append((j, kind, value, FOREIGN if _DIMENSION.get(kind, "") not in (dimensions | {""}) else 0.0))
        for j, kind, value, cost in steps:
            for last, (c, *_rest) in best[i].items():
                total = c + cost + (_arc(last, kind) if kind and kind != "?" else 0)
                state = last if kind is None else kind
                if state not in best[j] or total < best[j][state][0]:
                    best[j][state] = (total, (i, last), (kind, value))
    out, at = [], (n, min(best[n], key=lambda s: best[n][s][0]))
    while at:
        _, back, part = best[at[0]][at[1]]
        if part and part[0] and part[0] != "?":
            out.append(part)
        at = back
    return tuple(reversed(out))


def _plain(text: str) -> str:
    """Digits with a point for the decimal mark. Of a comma and a point the last is the mark; a mark that comes twice parts thousands; a
    single comma is the mark if other than three digits follow it, a single point always is."""
    point, comma = text.rfind("."), text.rfind(",")
    if point >= 0 and comma >= 0:
        mark = "." if point > comma else ","
        mark = "" if text.count(mark) > 1 else mark
    elif comma >= 0:
        mark = "," if text.count(",") == 1 and len(text) - comma != 4 else ""
    else:
        mark = "." if text.count(".") == 1 else ""
    whole, part = text.rsplit(mark, 1) if mark else (text, "")
    return re.sub(r"[.,]", "", whole) + (f".{part}" if part else "")


def _figure(text: str) -> Fraction:
    if text[0].isdigit() and text[0] not in _KANJI:
        return Fraction(Decimal(_plain(text)))
    total, digit = 0, None
    for c in text:
        if c in _KANJI:
            digit = (digit or 0) * 10 + _KANJI[c]
        else:
            total, digit = total + (1 if digit is None else digit) * _TENS[c], None
    return Fraction(total + (digit or 0))


@dataclass(frozen=True)
class Quantity:
    """Ends in `currency` (None: none named) a `period` (None: none named); scaled: whether a scale or currency was named."""

    ends: tuple[Fraction, ...]
    currency: str | None
    period: str | None
    scaled: bool


def parse(text: str | None) -> Quantity | None:
    """The quantity a text states, or None without a figure."""
    if not text:
        return None
    text = unicodedata.normalize("NFKC", text).lower()
    found = list(_FIGURE.finditer(text))
    if not found:
        return None
    # figures that go on with the one before, as in 3万5千: nothing but its scale stands between
    joined = [False, *(text[x.end() : y.start()].strip() in SCALES for x, y in zip(found, found[1:]))]
    parts = segment(_FIGURE.sub("#", text))
    figures = iter(zip(found, joined))
    ends: list[list] = [[]]  # of terms [figure, scale or None]
    currency = period = None
    aside = False  # whether the last figure is one of a remark, such as a number of payments, and not of the amount
    for kind, value in parts:
        if kind == "figure":
            f, goes_on = next(figures)
            aside = bool(ends[-1]) and (aside or not goes_on)
            if not aside:
                ends[-1].append([_figure(f[0]), None])
        elif kind == "scale" and ends[-1] and not aside:
            ends[-1][-1][1] = (ends[-1][-1][1] or 1) * value
        elif kind == "range" and ends[-1] and not aside:
            ends.append([])
        elif kind == "money":
            currency = currency or value
        elif kind in ("pay", "time"):
            period = period or value
    ends = [e for e in ends if e]
    scales = {e[-1][1] for e in ends if e[-1][1]}
    if len(ends) > 1 and len(scales) == 1 and any(e[-1][1] is None for e in ends):
        for e in ends:
            e[-1][1] = e[-1][1] or next(iter(scales))
    values = tuple(sum((f * (s or 1) for f, s in (e if len(e) > 1 and e[0][1] else e[:1])), Fraction(0)) for e in ends)
    return Quantity(values, currency, period, bool(scales or currency))


@lru_cache(maxsize=50_000)
def period_of(text: str | None) -> str | None:
    """The period a text without an amount names, such as a kind of job."""
    if not text:
        return None
    unit = re.sub(r"\d+", "0", unicodedata.normalize("NFKC", text).lower())
    before = ""
    for kind, value in segment(unit, frozenset({"time"})):
        if kind == "pay" or (kind == "time" and (before == "below" or unit.endswith(("pay", "rate", "salary", "wage")))):
            return value
        before = kind
    return None


def reference(df: DataFrame, most: int = 10_000) -> list:
    """The rows of a small list of reference, at most `most`."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("the list is too large to send to every task")
    return rows


def to_common_unit(df: DataFrame, id_col: str, lower: str, upper: str, kind: str, source: str, units: DataFrame, sources: DataFrame, default_source: str = "indeed") -> DataFrame:
    """(id, field_name, yen_per_year) of each amount that can be read and isn't yet written as the plain digits of it.

    units: kind, code, factor (periods in a year, yen for one unit of a currency); sources: source,
    period, scale of bare figures. No shuffle. NULL, blank and figureless amounts, and sources without an
    entry where no period is named, give no row. Half yen round up. Ties and repeated rows are rows of their own, an empty
    table gives none, other columns don't matter. An amount in a currency without a factor gives no row; figures of a remark behind the amount don't count.
    """
    factors = {(r["kind"], r["code"]): int(r["factor"]) for r in reference(units.select("kind", "code", "factor"))}
    default = {r["source"]: (r["period"], int(r["scale"])) for r in reference(sources.select("source", "period", "scale"))}

    def read(batches):
        @lru_cache(maxsize=100_000)
        def yearly(text: str, kind_text: str | None, where: str | None, end: int) -> int | None:
            q = parse(text)
            if q is None or not q.ends:
                return None
            value = max(q.ends) if end else min(q.ends)
            period = q.period or period_of(kind_text)
            if period is None:
                known = default.get(where if where is not None else default_source)
                if known is None:
                    return None
                period, scale = known
                if not q.scaled:
                    value *= scale
            money = factors.get(("currency", q.currency or "JPY"))
            times = factors.get(("period", period))
            if money is None or times is None:
                return None
            return int((value * money * times * 2 + 1) // 2)

        for b in batches:
            ids, low, high, kinds, where = (c.to_pylist() for c in b.columns)
            rows: tuple[list, ...] = ([], [], [])
            for i, a, z, k, s in zip(ids, low, high, kinds, where):
                for end, name, text in ((0, lower, a), (1, upper, z)):
                    if text:
                        got = yearly(text, k, s, end)
                        if got is not None and text != str(got):
                            for r, v in zip(rows, (i, name, got)):
                                r.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64())], ["id", "field_name", "yen_per_year"])

    return df.select(F.col(id_col).cast("long"), *[F.col(c).cast("string") for c in (lower, upper, kind, source)]).mapInArrow(read, "id long, field_name string, yen_per_year long")

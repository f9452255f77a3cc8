"""Problem 2: the language of texts and of the segments of mixed ones.

Script ranges narrow the candidates of each sentence or list item; within a script, per-word
(for unspaced scripts per-character) log scores of a naive Bayes model decide, and where a sentence holds words of
several scripts, a run of each tells against the languages of the others. A
Viterbi pass over a text's sentences sums the word scores of each, forbids a switch inside one and charges
SWITCH for one between two, so that a segment is a longest run of whole sentences in one language. Its confidence is the posterior
of its language under the same chain, by the forward-backward algorithm.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("ja", "en", "zh", "ko", "vi", "pt", "id", "de")
#: How much a switch between sentences costs (nats).
SWITCH = 5.0
#: What a character of a script, at most so many of a run, and a lower-case Latin word are worth against languages of other scripts (nats).
CHARACTER, LONGEST, WORD = 2.0, 4, 2.0
#: What the ad's language is worth for a title in the same script (nats).
HOME = 4.0
#: Scripts by language; a language that isn't named here is written in Latin letters.
SCRIPT = {"ja": "kana", "zh": "han", "ko": "hangul"}
_KANA = re.compile(r"[ぁ-ゖァ-ヺー々ゝゞ]")
_HAN = re.compile(r"[㐀-䶿一-鿿𠀀-𯿿]")
_HANGUL = re.compile(r"[가-힣ᄀ-ᇿ㄰-㆏]")
_LOWER = re.compile(r"(?<![^\W\d_])[a-zß-öø-ÿāăąćčďđēęěğīıłńňōőœřśşšťūůűźżžơưạ-ỹ]{2,}(?![^\W\d_])")
_RUNS = re.compile(r"(?P<kana>[ぁ-ゖァ-ヺー々ゝゞ]+)|(?P<han>[㐀-䶿一-鿿𠀀-𯿿]+)|(?P<hangul>[가-힣ᄀ-ᇿ㄰-㆏]+)")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_TWO_KANA, _TWO_HANGUL = (re.compile(f"{x.pattern}[^{x.pattern[1:]}*{x.pattern}") for x in (_KANA, _HANGUL))
#: Sentence and item ends: line breaks, full stops of unspaced scripts, stops before whitespace, a slash or bar between spaces.
_BREAKS = "\r\n\u2028\u2029\x0b\x0c"
# with what ends before the next begins; a stop only before whitespace, a slash or bar only between; it begins with one class of characters, which is searched for much faster than several
_MARKS = re.compile(rf"[{_BREAKS}。！？｡.!?…/|｜／](?:(?<=[{_BREAKS}])[{_BREAKS}]*|(?<=[。！？｡])|(?<=[.!?…])(?![{_BREAKS}])[\"”’»)]*\s+|(?<=\s[/|｜／])(?=\s))")
_SPACE, _BAR = re.compile(r"\s*"), re.compile(r"\s*[/|｜／]\s+")

#: What a company's name has.
_COMPANY = re.compile(r"\b(?:Co\.?,? ?Ltd|Inc|Corp|LLC|GmbH|K\.K)\b|株式会社|合同会社|有限会社|有限公司|주식회사|㈱", re.I)


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of sentences and list items."""
    return divided(text)[0]


def divided(text: str) -> tuple[list[tuple[int, int]], list[str]]:
    """Spans of sentences and list items, and what they hold without whitespace around it."""
    spans, held, at = [], [], 0
    for m in _MARKS.finditer(text):
        i, to = m.span()
        if i < at:
            continue
        c = text[i]
        if c in _BREAKS:
            end = i
            if i > at and text[i - 1].isspace() and (bar := _BAR.match(text, to)):
                to = bar.end()
        elif c in "。！？｡":
            if text[i + 1 : i + 2] in ("」", "』", "）", ")", "”", '"'):
                continue
            end = to
        elif c in ".!?…":
            end = i + 1
        else:
            end, to = at + len(text[at:i].rstrip()), _SPACE.match(text, i + 1).end()
            if end == i:
                continue
        if c := text[at:end].strip():
            spans.append((at, end))
            held.append(c)
        at = to
    if c := text[at:].strip():
        spans.append((at, len(text)))
        held.append(c)
    return spans, held


class Model:
    """Word scores of each language, fitted on labelled texts whose script fits the label."""

    def __init__(self, rows: list[tuple[str, str]], languages: tuple[str, ...] = LANGUAGES):
        words: dict[str, Counter] = defaultdict(Counter)
        chars: dict[str, Counter] = defaultdict(Counter)
        for lang, text in rows:
            if lang not in languages:
                continue
            for a, b in sentences(unicodedata.normalize("NFKC", text)):
                s = text_of = unicodedata.normalize("NFKC", text)[a:b]
                kana, han, hangul = len(_KANA.findall(s)), len(_HAN.findall(s)), len(_HANGUL.findall(s))
                if lang in ("ja", "zh"):
                    if (kana > 1) == (lang == "ja") and han:
                        chars[lang].update(_HAN.findall(s))
                elif lang not in SCRIPT and not (kana or han or hangul):
                    for w in _WORD.findall(text_of):
                        words[lang][w.lower()] += 1
        self._score(languages, words, chars, {x: sum(c.values()) for x, c in words.items()}, {x: sum(c.values()) for x, c in chars.items()})

    @classmethod
    def of_counts(cls, words: dict[str, Counter], chars: dict[str, Counter], word_totals: dict[str, float], char_totals: dict[str, float], languages: tuple[str, ...] = LANGUAGES) -> Model:
        """The model of words and characters counted elsewhere, by language; the totals may hold more than what is named."""
        self = cls.__new__(cls)
        self._score(languages, defaultdict(Counter, words), defaultdict(Counter, chars), word_totals, char_totals)
        return self

    def _score(self, languages, words, chars, word_totals, char_totals) -> None:
        grams: dict[str, Counter] = defaultdict(Counter)
        self.latin = [x for x in languages if x not in SCRIPT]
        # in an order that doesn't depend on that of the rows
        vocabulary = sorted({w for c in words.values() for w in c})
        seen = Counter(w for c in words.values() for w in c)
        self.words: dict[str, tuple[float, ...]] = {}
        self.often = {w: n for w in vocabulary if (n := sum(words[x][w] for x in self.latin)) < 1}
        # a word that is rarer than once counts as a share of one
        kinds = sum(min(1.0, sum(words[x][w] for x in self.latin)) for w in vocabulary)
        totals = {x: word_totals.get(x, 0) + 0.5 * kinds + 1 for x in self.latin}
        for w in vocabulary:
            raw = [math.log((words[x][w] + 0.5) / totals[x]) for x in self.latin]
            top = max(raw)
            # a word of one text tells less than one of many: names and figures' neighbours
            weight = min(1.0, sum(words[x][w] for x in self.latin) / 4)
            if seen[w] == len(self.latin) and top - min(raw) < 1:
                weight = 0
            self.words[w] = tuple(max(-8.0, (r - top) * weight) for r in raw)
            if weight and not w[0].isupper():
                for x, r in zip(self.latin, raw):
                    if words[x][w] > 2:
                        p = f"^{w}$"
                        grams[x].update(p[k : k + 3] for k in range(len(p) - 2))
        gram_totals = {x: sum(grams[x].values()) + 0.5 * 5000 for x in self.latin}
        self.grams = {g: tuple(math.log((grams[x][g] + 0.5) / gram_totals[x]) for x in self.latin) for g in {g for c in grams.values() for g in c}}
        self.no_gram = tuple(math.log(0.5 / gram_totals[x]) for x in self.latin)
        self._memo: dict[str, tuple[float, ...] | None] = {}
        total = {x: char_totals.get(x, 0) + 1 for x in ("ja", "zh")}
        self.chars = {c: max(-5.0, min(5.0, math.log((chars["ja"][c] + 0.1) / total["ja"]) - math.log((chars["zh"][c] + 0.1) / total["zh"]))) for c in set(chars["ja"]) | set(chars["zh"])}

    def word(self, w: str) -> tuple[float, ...] | None:
        """Scores by Latin-script language, 0 at best; None for what looks like a name or tells nothing."""
        low = w.lower()
        got = self.words.get(low)
        if got is None and len(low) > 2 and not w[:1].isupper():
            p = f"^{low}$"
            raw = [sum(x) for x in zip(*(self.grams.get(p[k : k + 3], self.no_gram) for k in range(len(p) - 2)))]
            top = max(raw)
            got = tuple(max(-3.0, (r - top) / 2) for r in raw)
        return got if got and min(got) < 0 else None

    def score(self, s: str, all_words: bool = False) -> dict[str, float] | None:
        """Log scores (0 at best) of the languages a sentence may be in; None if it has no words of a language."""
        latin = s.isascii() or max(s) < "ᄀ"
        if not latin:
            kana, hangul = _KANA.search(s), _HANGUL.search(s)
            if (kana or hangul or _HAN.search(s)) and ((hangul and (kana or _HAN.search(s))) or _LOWER.search(s)):
                return self._mixed(s, _HAN.findall(s))
            if kana and _TWO_KANA.search(s):
                return {"ja": 0.0}
            if hangul and _TWO_HANGUL.search(s):
                return {"ko": 0.0}
            han = _HAN.findall(s)
            if len(han) > 1 or (han and kana):
                d = sum(self.chars.get(c, 0.0) for c in han) + (3.0 if kana else 0.0)
                return {"ja": min(d, 0.0), "zh": min(-d, 0.0)}
        return self._latin([w for w in _WORD.findall(s) if latin or max(w) < "ᄀ"], all_words)

    def _mixed(self, s: str, han: list[str]) -> dict[str, float] | None:
        """Scores of a sentence with words of several scripts: each run counts against the languages of other scripts."""
        against = {"kana": 0.0, "han": 0.0, "hangul": 0.0}
        for m in _RUNS.finditer(s):
            against[m.lastgroup] += CHARACTER * min(LONGEST, m.end() - m.start())
        words = len(_LOWER.findall(s)) * WORD
        kana, other, hangul = against["kana"], against["han"], against["hangul"]
        d = sum(self.chars.get(c, 0.0) for c in han)
        out = {"ja": min(d, 0.0) - hangul - words, "zh": min(-d, 0.0) - kana - hangul - words, "ko": -kana - other - words}
        latin = self._latin([w for w in _WORD.findall(s) if max(w) < "ᄀ"], True)
        for x, v in (latin or {}).items():
            out[x] = v - kana - other - hangul
        top = max(out.values())
        return {x: v - top for x, v in out.items() if v - top > -30}

    def of_words(self, found: list[str]) -> dict[str, float] | None:
        """The score of a sentence in Latin letters, by its words."""
        return self._latin(found, False)

    def _latin(self, found: list[str], all_words: bool) -> dict[str, float] | None:
        """Scores by Latin-script words."""
        if not found or (len(found) < 2 and not all_words):
            return None  # one word is a name or a mark (TEL, No.), unless it is all there is
        memo, rows = self._memo, []
        for w in found:
            if all_words:
                w = w.lower()
            if w in memo:
                got = memo[w]
            else:
                if len(memo) > 200_000:
                    memo.clear()
                got = memo[w] = self.word(w)
            if got is not None:
                rows.append(got)
        if not rows:
            return None
        totals = list(map(sum, zip(*rows)))
        top = max(totals)
        return {x: t - top for x, t in zip(self.latin, totals)}


def segments(text: str, model: Model, switch: float = SWITCH) -> list[tuple[str, int, int, float]]:
    """(language, start, end, confidence) of a text's segments in order; [] for NULL, blank and wordless texts."""
    if not text or text.isspace():
        return []
    text = text if text.isascii() else unicodedata.normalize("NFKC", text)
    units = []
    for a, b in sentences(text):
        got = model.score(text[a:b])
        if got is not None:
            units.append((a, b, got))
    if not units:
        got = model.score(text, all_words=True)
        if got is None:
            return []
        units = [(0, len(text), got)]
    # Viterbi: a language that isn't among a sentence's candidates can't hold it
    best: dict[str, tuple[float, tuple]] = {x: (s, (x, None)) for x, s in units[0][2].items()}
    for _, _, got in units[1:]:
        top, path = max(best.values(), key=lambda v: v[0])
        step = {}
        for x, s in got.items():
            stay = best.get(x)
            if stay is not None and stay[0] >= top - switch:
                step[x] = (stay[0] + s, (x, stay[1]))
            else:
                step[x] = (top - switch + s, (x, path))
        best = step
    _, path = max(best.values(), key=lambda v: v[0])
    labels = []
    while path:
        labels.append(path[0])
        path = path[1]
    labels.reverse()
    out: list[list] = []
    for lang, (a, b, _), sure in zip(labels, units, _posteriors(labels, [u[2] for u in units], switch)):
        if out and out[-1][0] == lang:
            out[-1][2] = b
            out[-1][3].append((sure, b - a))
        else:
            out.append([lang, a, b, [(sure, b - a)]])
    return [(x, a, b, sum(p * n for p, n in c) / sum(n for _, n in c)) for x, a, b, c in out]


def _posteriors(labels: list[str], scores: list[dict[str, float]], switch: float) -> list[float]:
    """The probability of each label given all sentences, by the forward-backward algorithm."""
    if all(len(x) == 1 for x in scores):
        return [1.0] * len(labels)
    toll, out = math.exp(-switch), []

    def pass_over(order) -> list[dict[str, float]]:
        """What the sentences before (in this order) say of each one."""
        said, past = [], None
        for x in order:
            here = {k: (past.get(k, 0.0) * (1 - toll) + toll if past else 1.0) for k in x}
            said.append(here)
            past = {k: v * math.exp(x[k]) for k, v in here.items()}
            total = sum(past.values()) or 1.0
            past = {k: v / total for k, v in past.items()}
        return said

    before, after = pass_over(scores), pass_over(scores[::-1])[::-1]
    for lang, x, p, q in zip(labels, scores, before, after):
        weights = {k: p[k] * q[k] * math.exp(v) for k, v in x.items()}
        out.append(weights[lang] / (sum(weights.values()) or 1.0))
    return out


def title_language(title: str, employer: str | None, body: list[tuple[str, int, int, float]], model: Model) -> tuple[str, float] | None:
    """A title's language: its own words', or the ad's where it only names a company or has no words that tell."""
    text = unicodedata.normalize("NFKC", title)
    if employer and employer.strip():
        text = text.replace(unicodedata.normalize("NFKC", employer).strip(), " ")
    home = max(body, key=lambda s: s[2] - s[1])[0] if body else None
    if home and _COMPANY.search(title):
        return home, 0.5
    words = _WORD.findall(text)
    kana, han, hangul = len(_KANA.findall(text)), len(_HAN.findall(text)), len(_HANGUL.findall(text))
    if not words:
        return (home, 0.5) if home else None
    if kana or hangul or han:
        if han and not kana and not hangul:
            d = sum(model.chars.get(c, 0.0) for c in _HAN.findall(text)) + (2.0 if home == "ja" else -2.0 if home == "zh" else 0.0)
            return ("ja" if d >= 0 else "zh"), 1 / (1 + math.exp(-min(abs(d), 30)))
        return ("ko", 1.0) if hangul > kana else ("ja", 1.0)
    got = model.score(text, all_words=True)
    if got is None:
        return (home, 0.5) if home else None
    if home in got:
        got = {x: s + (HOME if x == home else 0.0) for x, s in got.items()}
    lang = max(got, key=got.get)
    return lang, 1 / sum(math.exp(s - got[lang]) for s in got.values())


def fit(rows: list, columns: dict[str, str], languages: tuple[str, ...] = LANGUAGES) -> Model:
    """The model of the labelled texts among sampled rows (label by text column). Wrong labels among them only blur the scores. Without a labelled
    row only scripts decide."""
    labelled = ((r[label].strip().lower(), r[text]) for text, label in columns.items() for r in rows if r[label] and r[text])
    return Model([x for x in labelled if x[0] in languages], languages)


def language_labels(df: DataFrame, id_col: str, body: str, body_label: str, title: str, title_label: str, employer: str, model: Model) -> DataFrame:
    """(id, field_name, seg, n_segments, lang, confidence, label_right, start, end) of each segment of each text with words.

    start and end are places in the NFKC form of the text. NULL and blank texts, and texts in which nothing belongs to a
    language, give no rows. A label is right if, trimmed and in lower case, it equals the text's one
    language; NULL never is. Rows are judged one by one, so repeats repeat; an empty table gives no rows; other columns
    don't matter. No shuffle; the model is bounded by its sample.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def read(batches):
        m = shared.value
        for b in batches:
            ids, bodies, body_labels, titles, title_labels, employers = (c.to_pylist() for c in b.columns)
            rows: tuple[list, ...] = tuple([] for _ in range(9))
            for i, text, label, head, head_label, who in zip(ids, bodies, body_labels, titles, title_labels, employers):
                found = segments(text, m) if text else []
                for k, (lang, a, z, p) in enumerate(found):
                    right = len(found) == 1 and label is not None and label.strip().lower() == lang
                    for r, v in zip(rows, (i, body, k, len(found), lang, p, right, a, z)):
                        r.append(v)
                if head and not head.isspace() and (got := title_language(head, who, found, m)):
                    right = head_label is not None and head_label.strip().lower() == got[0]
                    for r, v in zip(rows, (i, title, 0, 1, got[0], got[1], right, 0, len(head))):
                        r.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], ["id", "field_name", "seg", "n_segments", "lang", "confidence", "label_right", "start", "end"])

    schema = "id long, field_name string, seg long, n_segments long, lang string, confidence double, label_right boolean, start long, end long"
    return df.select(F.col(id_col).cast("long"), *[F.col(c).cast("string") for c in (body, body_label, title, title_label, employer)]).mapInArrow(read, schema)

"""Problem 1: broken prompt and response pairs.

A response is cut into clauses and a linear-chain conditional random field tags each as answer, refusal, echo
(of the prompt), foreign or unfinished. The clauses' tags are weighed by their length into a coverage
of the response, and the coverage gives the defect: mostly refusal, mostly echo, mostly foreign, or an unfinished clause. Only an empty
response is told without tags. A title is a response of one clause under the same field.

What the field sees of a clause are its likeness to the prompt, its language, how much its words are those of refusals rather than of
answers, and, at the response's end, how it ends and how much of the prompt is behind it. The field's weights are fitted on pairs made from all
rows: sound responses as they are, cut short, replaced by their prompt, by a prompt in another language, or by a refusal. All rows also
give how clauses end, which words there are and how long answers are.

A table is read twice for that. The first pass counts, task by task. The second finds the features of each pair, and of the one made from it; equal
sequences of features are counted together, so that the driver fits the field on a list that grows much slower than the table. Features of the
pairs as they are stay in the shared folder, where the fitted field tags them.
"""

from __future__ import annotations

import math
import random
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.langid import _HAN, _KANA, _RUNS, _WORD, LANGUAGES, SCRIPT, Model, divided
from adloom.llm.normal import bare
from adloom.session import cut

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)
#: What stands for an answer without being one.
NOTHING = {"", "none", "null", "nil", "na", "nooutput", "noanswer", "notranslation", "empty", "なし", "無し", "無", "tbd", "nan", "undefined", "unknown", "translation", "englishtranslation", "hereisthetranslation", "note", "answer", "output", "english", "result", "response", "title", "jobtitle"}
#: Refusals in general wording, from which the words of refusals are learned.
REFUSALS = (
    "I'm sorry, but I can't assist with that.", "I apologize, but I am unable to fulfill this request.", "Unfortunately, I cannot translate this text for you.", "As an AI language model, I must decline to answer this.",
    "I'm not able to provide a translation of this content.", "I won't be able to help you with this task.", "It is not possible for me to process this input.", "I am not permitted to work on this kind of material, as it goes against my guidelines.",
    "I do not feel comfortable translating this message.", "I would rather not complete this.", "Sorry, this is something that I can't do.", "My apologies, I refuse to continue with this.", "I cannot comply with the request you made.",
    "Please provide a different text.", "Could you please check the text you sent?", "Feel free to ask me another question.", "If you have any other request, let me know.", "The content may violate my policies.", "It may include private or personal information.",
    "申し訳ございませんが、この内容は翻訳できません。", "ご依頼にはお答えできかねます。", "その質問にはお答えいたしかねます。", "この文章の翻訳はお手伝いすることができません。", "別の文章をお送りください。", "ご要望には対応できません。",
    "抱歉，我无法翻译这段文字。", "很抱歉，我不能满足您的请求。", "请提供其他文本。", "죄송하지만 이 글은 번역할 수 없습니다.", "요청하신 내용은 도와드릴 수 없습니다.", "다른 글을 보내 주세요.",
    "Xin lỗi, tôi không thể dịch văn bản này.", "Tôi không thể thực hiện yêu cầu này.", "Desculpe, mas não posso traduzir este texto.", "Não consigo ajudar com este pedido.", "Maaf, saya tidak dapat menerjemahkan teks ini.", "Saya tidak bisa membantu permintaan ini.",
    "Es tut mir leid, aber ich kann diesen Text nicht übersetzen.", "Leider kann ich Ihnen bei dieser Anfrage nicht helfen.",
)
_LEAD = re.compile(r"^\s*(?:(?:sure|certainly|of course|okay|ok)[,!.]?\s*)?(?:[a-z][a-z ,'’-]{0,40})?\b(?:translation|translated|english|version|note|answer|output|title|job title)\b[a-z ,'’-]{0,30}[:：]\s*", re.I)
_NUMBER = re.compile(r"\d+")
_WORDS = re.compile(r"[^\W\d_]+(?:[’'][^\W\d_]+)*|\d+(?:[:.,]\d+)*")
_STOP, _DOTS = re.compile(r"[.!?。！？｡][\"'”’»」』）)\]]*\s*$"), re.compile(r"(?:…|\.\.\.|・・・)[\"'”’)」]*\s*$")
_LETTER = re.compile(r"[^\W_]")
_SPACED = re.compile(r"[^\W\d_]+(?:[’'][^\W\d_]+)*")
WIDTH = 5
#: Counts of a table of more rows are brought down to so many, so that a number they are compared with means as much in any table. A word or a pair of words that is
#: rarer than KEPT in so many tells nothing; without these a model is as large for any table.
ROWS, KEPT = 6_000, 0.25
#: Places of the hash that says what is made of a row, and rows among which an answer of another row is looked for.
_SPACE, _GROUP = 1 << 30, 256
#: Counts a task holds before it hands them on, characters it reads before it counts the clauses in them, and characters counted at once.
_HELD, _READ, _AT_ONCE = 400_000, 12_000_000, 3_000_000
#: Clauses and titles of which a process remembers what follows from them alone, and how long they may be.
_KNOWN, _LONGEST = 100_000, 500
#: Rows whose clauses are looked up together.
_TOGETHER = 1_000


class _Memo(dict):
    """What a function says of a clause or title, for when it comes again. It is sent to other processes empty."""

    def __init__(self, of):
        self.of = of

    def __missing__(self, text: str):
        got = self.of(text)
        if len(text) <= _LONGEST:
            if len(self) >= _KNOWN:
                self.clear()
            self[text] = got
        return got

    def __reduce__(self):
        return _Memo, (self.of,)


def nfkc(text: str | None) -> str:
    if not text:
        return ""
    return text if text.isascii() else unicodedata.normalize("NFKC", text.replace("…", "\u0001")).replace("\u0001", "…")


def clauses(text: str) -> list[str]:
    """Sentences and items that hold a letter or digit."""
    return [c for c in divided(text)[1] if c[0].isalnum() or _LETTER.search(c)]


def _parts(text: str) -> tuple[list[tuple[int, int]], list[str]]:
    """The clauses' spans and the clauses."""
    spans, found = divided(text)
    if not all(map(_LETTER.search, found)):
        spans = [x for x, c in zip(spans, found) if _LETTER.search(c)]
        found = list(filter(_LETTER.search, found))
    return spans, found


_TRAIL = " .!?。！？｡…\"'”’»」』）)]"


def _ending(clause: str) -> tuple[str, str]:
    """The last two words, with names and figures as classes; of unspaced scripts the last two characters."""
    c = clause.rstrip(_TRAIL)
    while c and c[-1].isspace():
        c = c.rstrip().rstrip(_TRAIL)
    if c and ord(c[-1]) > 0x2E7F:
        return c[-2:-1], c[-1:]
    w = _WORDS.findall(c[-80:])
    return (_class(w[-2]) if len(w) > 1 else "^", _class(w[-1]) if w else "^")


def _class(w: str) -> str:
    return "0" if w[0].isdigit() else "N" if w[0].isupper() else w.lower()


class Endings:
    """How likely a clause is complete that ends so: counts of clauses that were followed by another, against the same words inside clauses."""

    def __init__(self, end: dict, mid: dict, end1: dict, mid1: dict):
        self.end, self.mid, self.end1, self.mid1 = map(Counter, (end, mid, end1, mid1))

    def complete(self, clause: str) -> float:
        e = _ending(clause)
        n, m = self.end[e], self.mid[e]
        n1, m1 = self.end1[e[1]], self.mid1[e[1]]
        back = (n1 + 0.2) / (n1 + m1 + 1.0)
        return (n + 2 * back) / (n + m + 2)


_MARK = re.compile(r"[\W\d_]*(?:[^\W\d_]{1,4}\.?)?[\W\d_]*")


def _unmarked(parts: list[str]) -> list[str]:
    """Without the lines of figures and the short statements with figures at the end."""
    n = len(parts)
    while n and _marks[parts[n - 1]]:
        n -= 1
    return parts[:n]


def _marked(c: str) -> bool:
    if not _NUMBER.search(c):
        return False
    return bool(_MARK.fullmatch(c) or (_STOP.search(c) and sum(map(str.isalpha, c)) <= (8 if ord(c[-2:][0]) > 0x2E7F or ord(c[-1]) > 0x2E7F else 20)))


_marks = _Memo(_marked)


_TWO_HIRAGANA = re.compile(r"[ぁ-ゖ][^ぁ-ゖ]*[ぁ-ゖ]")


def _kind(text: str) -> str:
    """Script and, of Latin letters, whether marks are frequent: what a language's length depends on."""
    if text.isascii():
        return "plain"
    if _TWO_HIRAGANA.search(text):
        return "kana"
    if re.search(r"[가-힣]{2}", text):
        return "hangul"
    if len(re.findall(r"[一-鿿]", text)) * 3 > len(text):
        return "han"
    marks = len(text) - len(text.encode("ascii", "ignore"))
    return "marked" if marks * 12 > len(text) else "some" if marks * 100 > len(text) else "plain"


def _units(text: str) -> list[str]:
    """Words of spaced scripts, pairs of characters of unspaced ones."""
    out = []
    for w in _SPACED.findall(text.lower()):
        if w[0] > "\u2e7f":
            out += [w[k : k + 2] for k in range(len(w) - 1)] or [w]
        else:
            out.append(w.replace("’", "'"))
    return out


class Wording:
    """How much more a clause's words are those of refusals than of sound answers and prompts: log ratios by word, counted over all rows.
    The prior of a refusal's words is what they are elsewhere; a word that neither has tells nothing."""

    def __init__(self, refusals: tuple[str, ...], good: Counter, total: float, prior: float = 50.0):
        """total: of all words of good, and the rare ones it leaves out."""
        bad = Counter(w for t in refusals for w in set(_units(t)))
        nb, ng = sum(bad.values()) + prior, total + sum(min(1.0, n) for n in good.values()) + 10_000
        usual = {w: (good[w] + 1) / ng for w in good.keys() | bad.keys()}
        self.weight = {w: math.log((bad[w] + prior * p) / (nb * p)) for w, p in usual.items()}
        telling = [w for w in bad if self.weight[w] > 3]
        self._words = frozenset(w for w in telling if w[0] < "\u2e7f")
        self._pairs = re.compile("|".join(map(re.escape, sorted(set(telling) - self._words)))) if set(telling) - self._words else None
        self.scores = _Memo(self.score)

    def hints(self, text: str) -> bool:
        """Whether the text has a telling word at all; most have none, and their clauses needn't be scored."""
        if not self._words.isdisjoint(_SPACED.findall(text.lower().replace("’", "'"))):
            return True
        return bool(self._pairs and not text.isascii() and self._pairs.search(text))

    def tells(self, word: str) -> bool:
        """Whether a word in lower case is a telling one."""
        return word in self._words

    def score(self, clause: str) -> float:
        """Sum of the log ratios of the clause's words."""
        return sum(self.weight.get(w, 0.0) for w in _units(clause))


class Field:
    """The conditional random field: weights of named features by tag and of neighbouring tags."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.w = np.zeros((0, len(TAGS)))
        self.t = np.zeros((len(TAGS), len(TAGS)))
        self._memo: dict = {}

    def fit(self, counts: Counter, rounds: int = 80, rate: float = 0.15, decay: float = 2e-4) -> None:
        """Gradient ascent on the likelihood of all sequences at once (Adam). counts: of each (features, tags)."""
        self.index = {f: i for i, f in enumerate(sorted({f for seq, _ in counts for c in seq for f in c}))}
        # longest first, so that those that have a k-th clause come first
        items = sorted(counts.items(), key=lambda x: (-len(x[0][0]), str(x[0])))
        weight = np.array([n for _, n in items], float) / max(1, sum(counts.values()))
        lens = np.array([len(x[0]) for x, _ in items])
        longest, n = int(lens.max(initial=0)), len(items)
        live = [int((lens > k).sum()) for k in range(longest)]
        where, feature = [], []
        tags = np.zeros((longest, n), int)
        for i, ((seq, own), _) in enumerate(items):
            for k, c in enumerate(seq):
                tags[k, i] = own[k]
                for f in c:
                    where.append(k * n + i)
                    feature.append(self.index[f])
        where, feature = np.array(where, int), np.array(feature, int)
        m = len(TAGS)
        p = np.zeros(len(self.index) * m + m * m)
        first, second = np.zeros_like(p), np.zeros_like(p)
        for step in range(1, rounds + 1):
            w, t = p[: -m * m].reshape(-1, m), p[-m * m :].reshape(m, m)
            s = np.stack([np.bincount(where, w[feature, y], longest * n) for y in range(m)], 1).reshape(longest, n, m)
            a, b = s.copy(), np.zeros_like(s)
            for k in range(1, longest):
                v = a[k - 1, : live[k], :, None] + t
                top = v.max(1)
                a[k, : live[k]] = s[k, : live[k]] + top + np.log(np.exp(v - top[:, None]).sum(1))
            for k in range(longest - 2, -1, -1):
                v = t + (s[k + 1, : live[k + 1]] + b[k + 1, : live[k + 1]])[:, None, :]
                top = v.max(2)
                b[k, : live[k + 1]] = top + np.log(np.exp(v - top[:, :, None]).sum(2))
            end = a[0] + b[0]
            z = end.max(1) + np.log(np.exp(end - end.max(1)[:, None]).sum(1))
            gt, gs = np.zeros((m, m)), np.zeros_like(s)
            for k in range(longest):
                x = live[k]
                gs[k, :x] = -np.exp(a[k, :x] + b[k, :x] - z[:x, None])
                gs[k, np.arange(x), tags[k, :x]] += 1
                gs[k, :x] *= weight[:x, None]
                if k:
                    pair = np.exp(a[k - 1, :x, :, None] + t + (s[k, :x] + b[k, :x])[:, None, :] - z[:x, None, None])
                    gt -= (pair * weight[:x, None, None]).sum(0)
                    np.add.at(gt, (tags[k - 1, :x], tags[k, :x]), weight[:x])
            flat = gs.reshape(-1, m)
            gw = np.stack([np.bincount(feature, flat[where, y], len(self.index)) for y in range(m)], 1)
            g = np.concatenate([gw.ravel(), gt.ravel()]) - decay * p
            first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            p = p + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        self.w, self.t = p[: -m * m].reshape(-1, m), p[-m * m :].reshape(m, m)
        self._memo.clear()

    def tag(self, seq: list[tuple[str, ...]]) -> list[int]:
        """The best tags, by Viterbi. A feature the field wasn't fitted on has no weight."""
        key = tuple(seq)
        if (got := self._memo.get(key)) is not None:
            return got
        s = [self.w[[i for f in c if (i := self.index.get(f)) is not None]].sum(0) for c in seq]
        best, back = s[0], []
        for row in s[1:]:
            m = best[:, None] + self.t
            back.append(m.argmax(0))
            best = row + m.max(0)
        out = [int(best.argmax())]
        for step in reversed(back):
            out.append(int(step[out[-1]]))
        out.reverse()
        if len(self._memo) > 100_000:
            self._memo.clear()
        self._memo[key] = out
        return out


def _grams(text: str) -> set:
    s = bare(text)
    return {s[i : i + WIDTH] for i in range(len(s) - WIDTH + 1)} or {s}


def _bin(x: float, *bounds: float) -> int:
    return bisect_right(bounds, x)


def _without_lead(text: str) -> str:
    while (":" in text or "：" in text) and (m := _LEAD.match(text)) and m.end():
        text = text[m.end() :]
    return text


_TWO_KANA = re.compile(f"{_KANA.pattern}[^{_KANA.pattern[1:]}*{_KANA.pattern}")


def _points(text: str) -> np.ndarray:
    """The code points, as bytes if there are only those of ASCII."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


#: Of each character: nothing, a letter, a digit, a mark that may stand between letters, one that may between digits, or not looked up yet.
_NONE, _LETTERS, _DIGITS, _QUOTE, _POINT, _UNSEEN = range(6)
_sorts = np.full(0x110000, _UNSEEN, np.uint8)


def _sorts_of(codes: np.ndarray) -> np.ndarray:
    got = _sorts[codes]
    if len(new := codes[got == _UNSEEN]):
        for c in np.unique(new).tolist():
            x = chr(c)
            _sorts[c] = _DIGITS if x.isdecimal() else _LETTERS if x.isalnum() else _QUOTE if x in "’'" else _POINT if x in ":.," else _NONE
        got = _sorts[codes]
    return got


def _words_of(codes: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """What _WORDS finds in a text: the different words, and of each one found its number among them and its place."""
    sort = _sorts_of(codes)
    at = np.flatnonzero(sort[1:-1] >= _QUOTE) + 1
    mark = sort[at]
    want = np.where(mark == _QUOTE, _LETTERS, _DIGITS)
    inner = (sort[at - 1] == want) & (sort[at + 1] == want)
    sort[at[inner]] = want[inner]
    sort[sort >= _QUOTE] = _NONE
    begins = sort != _NONE
    held = begins.copy()
    begins[1:] &= sort[1:] != sort[:-1]
    starts = np.flatnonzero(begins)
    inside, places = codes[held], np.flatnonzero(begins[held])
    if codes.dtype == np.uint8:
        data, offsets = inside, np.append(places, len(inside))
    else:
        size = np.ones(len(inside), np.int8)
        for bound in (0x80, 0x800, 0x10000):
            size += inside >= bound
        data = inside.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        offsets = np.concatenate([[0], np.cumsum(np.add.reduceat(size, places, dtype=np.int32))]) if len(places) else np.zeros(1)
    offsets = offsets.astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False), starts


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[list[int], list[int]]:
    """The different keys and the sum of the numbers of each."""
    found = pa.array(keys).dictionary_encode()
    at = found.indices.to_numpy(zero_copy_only=False)
    return found.dictionary.to_pylist(), np.bincount(at, n, len(found.dictionary)).astype(np.int64).tolist()


class _Classes(dict):
    def __missing__(self, w: str) -> str:
        got = "^" if w == "^" else _class(w)
        if len(self) < 200_000:
            self[w] = got
        return got


class Tally:
    """What is counted of rows; those of several tasks add up. rows() are (kind, key, part, number):

    A and P: endings of answers and prompts by the last two words, part e at an end and m inside; A1 and P1: by the last. u: words and pairs of characters. t: words of titles,
    part w anywhere and l at the end. w and c: words and characters by language. r: the kind of a prompt and how long the answer is for it. U, W and C: totals of u, w and c."""

    def __init__(self):
        self.classes = _Classes()
        self._clear()

    def _clear(self) -> None:
        self.end, self.mid = (Counter(), Counter()), (Counter(), Counter())
        self.tokens, self.titles, self.last, self.ratio = Counter(), Counter(), Counter(), Counter()
        self.words, self.chars = {x: Counter() for x in LANGUAGES if x not in SCRIPT}, {x: Counter() for x in ("ja", "zh")}
        self._forget()

    def _forget(self) -> None:
        #: By side (0 answers, 1 prompts) and label: how often each clause came, and how often with another after it.
        self.found: dict[tuple[int, str | None], tuple[Counter, Counter]] = {}
        #: How often each title came, each answer to one, and each labelled text.
        self.heads, self.shorts, self.labels = Counter(), Counter(), Counter()
        self.waiting = 0

    def _take(self) -> None:
        """Count what is in the clauses: of each different one once, times how often it came."""
        # a text, how often it came and how often before another, its side (None: only its words count) and label, and whether its words are its label's alone
        some: list[tuple] = []
        for (lang, text), n in self.labels.items():
            text = unicodedata.normalize("NFKC", text)
            some += [(c, n, 0, None, lang, True) for c in divided(text)[1]]
        for titles in (self.heads, self.shorts):
            some += [(text, n, 0, None, None, False) for text, n in titles.items()]
        for text, n in self.shorts.items():
            w = [x.lower() for x in re.findall(r"[^\W\d_]{2,}", text)]
            for x in w:
                self.titles[x] += n
            if w:
                self.last[w[-1]] += n
        for (side, lang), (every, inner) in self.found.items():
            some += [(c, n, inner.get(c, 0), side, lang, False) for c, n in every.items()]
        self._forget()
        # characters of ASCII take less when they are alone
        for plain in (True, False):
            held, size = [], 0
            for x in some:
                if x[0].isascii() == plain:
                    held.append(x)
                    size += len(x[0])
                    if size > _AT_ONCE:
                        self._count(held)
                        held, size = [], 0
            self._count(held)

    def _count(self, some: list[tuple]) -> None:
        """Count what is in these clauses."""
        if not some:
            return
        texts, n, inner, sides, labels, alone = zip(*some)
        codes = _points("\n".join([*texts, ""]))
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
        n, inner, alone = np.array(n, np.int64), np.array(inner, np.int64), np.array(alone, bool)
        side = np.array([-1 if x is None else x for x in sides])
        top = np.maximum.reduceat(codes, starts)
        vocabulary, word, at = _words_of(codes)
        of = np.searchsorted(starts, at, "right") - 1
        many = n[of]
        for w, k in zip(vocabulary, np.bincount(word, many * ~alone[of], len(vocabulary)).astype(np.int64).tolist()):
            if k:
                self.tokens[w] += k
        self._told(texts, n, labels, top, vocabulary, word, of)
        # characters of unspaced scripts, words of others
        unspaced = (side >= 0) & ((codes[starts + np.maximum(lens, 1) - 1] > 0x2E7F) | (codes[starts] > 0x2E7F))
        spaced = ((side >= 0) & ~unspaced)[of]
        number: dict[str, int] = {"^": 0}
        classes, used = self.classes, np.zeros(len(vocabulary), bool)
        used[word[spaced]] = True
        named = np.array([number.setdefault(classes[w], len(number)) if x else 0 for w, x in zip(vocabulary, used.tolist())], np.int64)[word]
        names, count = list(number), len(number)
        first = np.ones(len(of), bool)
        first[1:] = of[1:] != of[:-1]
        last = np.ones(len(of), bool)
        last[:-1] = first[1:]
        before = np.zeros(len(of), np.int64)
        before[1:] = named[:-1]
        before[first] = 0
        pairs = before * count + named
        of_char = np.repeat(np.arange(len(texts)), lens + 1)
        for s in (0, 1):
            mid = self.mid[s]
            took = ~last & (side == s)[of] & spaced
            for x, k in zip(*_sums(pairs[took], many[took])):
                mid[names[x // count], names[x % count]] += k
            own = unspaced & (side == s)
            # without the last character and the line break
            took = own[of_char]
            took[starts[own] + lens[own] - 1] = took[starts[own] + lens[own]] = False
            left = np.flatnonzero(took[:-1] & took[1:])
            for x, k in zip(*_sums(codes[left].astype(np.int64) << 21 | codes[left + 1], n[of_char[left]])):
                mid[chr(x >> 21), chr(x & 0x1FFFFF)] += k
        # endings: by the last two words, if they are what _ending finds
        final = np.full(len(texts), -1)
        final[of[last]] = np.flatnonzero(last)
        wordless = final < 0
        early = np.where(first[final], final, final - 1)
        near = wordless | (at[early] >= starts + lens - 80) if len(at) else wordless
        easy = ~unspaced & (top <= 0x2E7F) & near & (inner > 0)
        for s in (0, 1):
            end = self.end[s]
            took = np.flatnonzero(easy & (side == s))
            key = np.where(wordless[took], 0, pairs[final[took]]) if len(at) else np.zeros(len(took), np.int64)
            for x, k in zip(*_sums(key, inner[took])):
                end[names[x // count], names[x % count]] += k
            for i in np.flatnonzero(~easy & (inner > 0) & (side == s)).tolist():
                end[_ending(texts[i])] += int(inner[i])

    def _told(self, texts: tuple[str, ...], n: np.ndarray, labels: tuple, top: np.ndarray, vocabulary: list[str], word: np.ndarray, of: np.ndarray) -> None:
        """Count words and characters by language."""
        which: dict[str | None, list[int]] = {}
        for i, lang in enumerate(labels):
            which.setdefault(lang, []).append(i)
        for lang, places in which.items():
            if lang in self.words:
                # below 0x1100 there is no script that runs are looked for in
                told = np.zeros(len(texts), bool)
                told[[i for i, high in zip(places, top[places].tolist()) if high < 0x1100 or not _RUNS.search(texts[i])]] = True
                took = told[of]
                found = self.words[lang]
                for w, k in zip(*_sums(word[took], n[of[took]])):
                    found[vocabulary[w]] += k
            elif lang in self.chars:
                some = [i for i, high in zip(places, top[places].tolist()) if high > 0x7F and bool(_TWO_KANA.search(texts[i])) == (lang == "ja")]
                if some:
                    codes = _points("".join([texts[i] for i in some]))
                    own = self.chars[lang]
                    for c, k in zip(*_sums(codes, np.repeat(n[some], [len(texts[i]) for i in some]))):
                        if _HAN.match(chr(c)):
                            own[chr(c)] += k

    def pair(self, q: str, a: str, lang: str | None = None) -> None:
        """A prompt and its sound answer; lang: the label of the prompt."""
        asked, got = clauses(q), clauses(a)
        for key, found in (((0, None), got), ((1, lang), asked)):
            if (held := self.found.get(key)) is None:
                held = self.found[key] = Counter(), Counter()
            held[0].update(found)
            held[1].update(found[:-1])
        self.ratio[_kind(q), round(min(1000.0, sum(map(len, got)) / max(1, sum(map(len, asked)))), 3)] += 1
        self._read(q, a)

    def _read(self, *texts: str) -> None:
        self.waiting += sum(map(len, texts))
        if self.waiting > _READ:
            self._take()

    def head(self, q: str, a: str) -> None:
        """A title and its answer."""
        self.heads[q] += 1
        self.shorts[a] += 1
        self._read(q, a)

    def label(self, lang: str, text: str) -> None:
        """A text with its language."""
        self.labels[lang, text] += 1
        self._read(text)

    def full(self) -> bool:
        return len(self.tokens) + sum(map(len, self.mid)) > _HELD

    def rows(self) -> list[tuple[str, str, str, int]]:
        """The counts, which then begin anew."""
        self._take()
        units, out, unspaced, many = Counter(), [], [], []
        for t, n in self.tokens.items():
            if not t[0].isdecimal():
                low = t.lower()
                if low[0] <= "\u2e7f":
                    units[low.replace("’", "'")] += n
                elif len(low) == 1:
                    units[low] += n
                else:
                    unspaced.append(low)
                    many.append(n)
        if unspaced:
            codes = _points("\n".join(unspaced)).astype(np.int64)
            left = np.flatnonzero((codes[:-1] != 10) & (codes[1:] != 10))
            n = np.repeat(many, np.fromiter(map(len, unspaced), np.int64, len(many)) + 1)
            for x, k in zip(*_sums(codes[left] << 21 | codes[left + 1], n[left])):
                units[chr(x >> 21) + chr(x & 0x1FFFFF)] += k
        for name, end, mid in zip("AP", self.end, self.mid):
            for part, found in (("e", end), ("m", mid)):
                one = Counter()
                for (a, b), n in found.items():
                    if b == "^":  # from one clause to the next
                        continue
                    out.append((name, f"{a}\x1f{b}", part, n))
                    one[b] += n
                out += [(f"{name}1", b, part, n) for b, n in one.items()]
        for x, found in self.words.items():
            real = Counter()
            for t, n in found.items():
                if "'" in t or "’" in t:
                    for w in _WORD.findall(t):
                        real[w.lower()] += n
                elif not t[0].isdecimal():
                    real[t.lower()] += n
            out += [("w", w, x, n) for w, n in real.items()]
            out.append(("W", "", x, sum(real.values())))
        for x, found in self.chars.items():
            out += [("c", c, x, n) for c, n in found.items()]
            out.append(("C", "", x, sum(found.values())))
        out += [("u", u, "", n) for u, n in units.items()]
        out.append(("U", "", "", sum(units.values())))
        out += [("t", w, part, n) for part, found in (("w", self.titles), ("l", self.last)) for w, n in found.items()]
        out += [("r", kind, str(x), n) for (kind, x), n in self.ratio.items()]
        self._clear()
        return out


class Counts:
    """The tallies of all rows together, brought down by a factor."""

    def __init__(self, rows: list, scale: float = 1.0):
        self.of: dict[str, dict] = {}
        for kind, key, part, n in rows:
            self.of.setdefault(kind, {}).setdefault(part, Counter())[key] += n * scale

    def endings(self, name: str) -> Endings:
        two, one = self.of.get(name, {}), self.of.get(f"{name}1", {})
        return Endings(*[{tuple(k.split("\x1f")): n for k, n in two.get(p, {}).items()} for p in "em"], *[one.get(p, {}) for p in "em"])

    def total(self, name: str, part: str = "") -> float:
        return self.of.get(name, {}).get(part, {}).get("", 0.0)

    def model(self) -> Model:
        words, chars = self.of.get("w", {}), self.of.get("c", {})
        return Model.of_counts(words, chars, {x: self.total("W", x) for x in words}, {x: self.total("C", x) for x in chars})

    def ratios(self) -> dict[str, float]:
        """The median length of an answer by the kind of its prompt."""
        by: dict[str, list] = {}
        for x, found in self.of.get("r", {}).items():
            for kind, n in found.items():
                by.setdefault(kind, []).append((float(x), n))
        out = {}
        for kind, found in by.items():
            found.sort()
            so_far = np.cumsum([n for _, n in found])
            half = so_far[-1] / 2
            low, high = int(np.searchsorted(so_far, half * (1 - 1e-12))), int(np.searchsorted(so_far, half * (1 + 1e-12), side="right"))
            out[kind] = (found[low][0] + found[min(high, len(found) - 1)][0]) / 2
        return out


class Judge:
    """Says what is wrong with a pair. Everything in it comes from the (prompt, answer) of texts and titles it is made of."""

    def __init__(self, pairs: list[tuple[str, str]], titles: list[tuple[str, str]], model: Model):
        """From pairs in the driver; Judge.counted makes one of a table's counts."""
        sound = [(nfkc(q), nfkc(a)) for q, a in pairs]
        heads = [(nfkc(q), nfkc(a)) for q, a in titles]
        tally = Tally()
        for q, a in sound:
            tally.pair(q, a)
        for q, a in heads:
            tally.head(q, a)
        self._learn(Counts(tally.rows()), model)
        data = Counter()
        for i, (q, a) in enumerate(sound):
            data.update(self.Pair(self, q, a).made(i, lambda i=i: sound[(i + 77) % len(sound)][0]))
        for i, (q, a) in enumerate(heads):
            data.update(self._made_title(i, q, a, lambda i=i: heads[(i + 77) % len(heads)][0]))
        self.fit(data)

    @classmethod
    def counted(cls, counts: Counts) -> Judge:
        """A judge whose field isn't fitted yet."""
        self = cls.__new__(cls)
        self._learn(counts, counts.model())
        return self

    def _learn(self, counts: Counts, model: Model) -> None:
        self.model = model
        self.answers, self.prompts = counts.endings("A"), counts.endings("P")
        usual, total = Counter(counts.of.get("u", {}).get("", {})), counts.total("U")
        # words of languages that are rare among the pairs tell nothing either
        for w in model.words:
            often = 20 * min(1.0, model.often.get(w, 1.0))
            usual[w] += often
            total += often
        # refusals are made of one half and judged by the words of the other, so the field learns how well words it hasn't seen tell them
        self.wording = Wording(REFUSALS, usual, total)
        halves = REFUSALS[0::2], REFUSALS[1::2]
        self.unseen = [(own, Wording(other, usual, total)) for own, other in (halves, halves[::-1])]
        titles = counts.of.get("t", {})
        self.words, self.last = titles.get("w", Counter()), titles.get("l", Counter())
        self.longer: dict[str, float] = {}
        for w, n in self.words.items():
            for k in range(2, len(w)):
                self.longer[w[:k]] = max(self.longer.get(w[:k], 0), n)
        # a rare word that begins a much more frequent one comes from titles that were cut, as long as they are many
        for w in [w for w, n in self.words.items() if n < 3 and self.longer.get(w, 0) >= 12 * n]:
            self.words.pop(w)
            self.last.pop(w, None)
        self.ratio = counts.ratios()
        self.field = Field()
        self._clauses, self._heads, self._tails = _Memo(self._clause), _Memo(self._head), _Memo(self._tail)
        self._said = _Memo(self._says)
        self._ends, self._stops, self._kinds = _Memo(self._full), _Memo(self._stopped), _Memo(self._word)
        self._en = self.model.latin.index("en")

    def fit(self, data: Counter) -> None:
        """data: how often there is each (features, tags)."""
        self.unseen = []
        self.field.fit(data)
        # the rows have defects of their own: what the field calls unsound of the pairs taken as they are is left out
        self.field.fit(Counter({(seq, tags): n for (seq, tags), n in data.items() if any(tags) or not any(self.field.tag(seq))}))

    class Pair:
        """A prompt and a response, both NFKC, with what is found of them once."""

        def __init__(self, judge: Judge, q: str, a: str):
            self.judge, self.q, self.a, self.grams = judge, q, a, None
            self.body = _without_lead(a)
            self.asked, (self.spans, self.got) = clauses(q), _parts(self.body)

        @cached_property
        def english(self) -> bool:
            return self.judge._is_english(self.asked)

        def features(self, got: list[str], body: str) -> list[tuple[str, ...]]:
            return self.judge._features(self.q, self.asked, got, body, self.english, None, self)

        def made(self, i: int, other=None, plain: list | None = None) -> list:
            """The pair with known tags that row i gives: as it is, cut short, both cut at one place, an echo, a foreign text, a refusal. other: gives the prompt of another
            row; without it no foreign text is made. plain: the features of the pair as it is, if they are known."""
            j, q, asked, got, body = self.judge, self.q, self.asked, self.got, self.body
            if not got or not asked or not j._is_english(got):
                return []
            english, kind = self.english, i % 10
            if kind in (4, 5, 6) and len(got) > 1:
                rng, spans = random.Random(i), self.spans
                at = rng.randrange(max(1, len(body) // 8), len(body))
                if kind == 4:
                    # after a whole clause it is only cut short if much is missing
                    ends = [y for _, y in spans if y < 0.8 * len(body)]
                    if not ends:
                        return []
                    at = rng.choice(ends)
                if kind == 6:
                    x = rng.choice(spans)
                    at = rng.randrange(x[0] + 1, x[1])
                cut_off = body[:at].rstrip() + ("…" if rng.random() < 0.15 else "")
                kept = clauses(cut_off)
                if not kept or len(_unmarked(kept)) == len(_unmarked(got)) and len(cut_off) > 0.97 * len(body):
                    return []
                return [_example(self.features(kept, cut_off), [ANSWER] * (len(kept) - 1) + [UNFINISHED])]
            if kind == 7 and len(asked) == len(got) > 1:
                rng = random.Random(i)
                k, f = rng.randrange(1, len(asked)), rng.uniform(0.15, 0.9)
                ends = "…" if rng.random() < 0.5 else ""
                kept = [*got[:k], got[k][: max(2, int(f * len(got[k])))].rstrip() + ends]
                ask = [*asked[:k], asked[k][: max(2, int(f * len(asked[k])))].rstrip() + ends]
                return [_example(j._features("\n".join(ask), ask, kept, "\n".join(kept), english), [ANSWER] * len(kept))]
            if kind == 8 and not english:
                if i % 20 < 10:
                    return [_example(self.features(asked, q), [ECHO] * len(asked))]
                theirs = clauses(text := other()) if other else []
                if theirs and not j._is_english(theirs):
                    # as if it had nothing in common with the prompt, which it might by chance
                    return [_example(j._features(q, asked, theirs, text, True), [FOREIGN] * len(theirs))]
                return []
            if kind == 9:
                rng, (own, wording) = random.Random(i), j.unseen[i // 10 % 2]
                said = rng.sample(own, rng.randrange(1, 4))
                return [_example(j._features(q, asked, said, "\n".join(said), english, wording, self), [REFUSAL] * len(said))]
            return [_example(plain or self.features(got, body), [ANSWER] * len(got))]

    def _made_title(self, i: int, q: str, a: str, other=None, plain: tuple[str, ...] | None = None) -> list:
        """The same of a title."""
        body = _without_lead(a)
        if not bare(body) or self._foreign_title(body):
            return []
        kind = i % 10
        if kind in (5, 6):
            w = re.search(r"([^\W\d_]{5,})\W*$", body)
            if w and self.words.get(w[1].lower(), 0) > 2:
                return [_example([self._title_features(q, body[: w.start() + random.Random(i).randrange(2, len(w[1]) - 1)])], [UNFINISHED])]
        elif kind == 7:
            if self._foreign_title(q):
                return [_example([self._title_features(q, q)], [ECHO])]
        elif kind == 8:
            if other and self._foreign_title(text := other()) and not _near(bare(text), _grams(q), 0.3):
                return [_example([self._title_features(q, text)], [FOREIGN])]
        elif kind == 9:
            own, wording = self.unseen[i // 10 % 2]
            return [_example([self._title_features(q, random.Random(i).choice(own), wording)], [REFUSAL])]
        else:
            return [_example([plain or self._title_features(q, body)], [ANSWER])]
        return []

    def _is_english(self, parts: list[str]) -> bool:
        n = en = 0
        if sum(not c.isascii() and _WIDE.search(c) is not None for c in parts) * 2 > len(parts):
            return False
        for c in parts:
            own = self._clauses[c][0]
            if own is not None:
                n += len(c)
                en += len(c) * own
        return n > 0 and en * 2 > n

    def _clause(self, clause: str) -> tuple[bool | None, bool, tuple[str, ...]]:
        """Whether a clause is English (None: nothing tells), whether it has a word that tells refusals, and the features it has in any pair."""
        if clause.isascii() and clause.count("'") < 2:
            words = _WORD.findall(clause)
            kinds = set(map(self._kinds.__getitem__, words))
            hints = _TELLING in kinds or _BOTH in kinds
            # if no word is likelier in another language, English has the highest score there is
            if _OTHER not in kinds and _BOTH not in kinds:
                return True if len(words) > 1 and (_ENGLISH in kinds or _TELLING in kinds and self.model.score(clause)) else None, hints, ("any",)
            known = self.model.of_words(words)
        else:
            known, hints = self.model.score(clause), self.wording.hints(clause)
        far = 0 if known is None else _bin(-known.get("en", -20.0), 1, 4)
        return None if known is None else known.get("en", -9.0) > -1, hints, ("any", f"foreign{far}") if far else ("any",)

    def know(self, found) -> None:
        """Find what _clause says of clauses in Latin letters, of all at once."""
        known = self._clauses
        some = [c for c in set(found) if c not in known and len(c) <= _LONGEST and c.count("'") + c.count("’") < 2 and (c.isascii() or not _FAR.search(c))]
        if not some:
            return
        vocabulary, word, at = _words_of(_points("\n".join([*some, ""])))
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1)[:-1]])
        real = np.array([not w[0].isdecimal() for w in vocabulary], bool)[word] if vocabulary else np.zeros(0, bool)
        of, word = (np.searchsorted(starts, at, "right") - 1)[real], word[real]
        said, telling = zip(*[(None, False) if w[0].isdecimal() else self._said[w] for w in vocabulary]) if vocabulary else ((), ())
        none = (0.0,) * len(self.model.latin)
        score = np.array([x or none for x in said]).reshape(-1, len(none))[word]
        n, m = np.bincount(of, minlength=len(some)), len(some)
        scored = (np.bincount(of, np.array([x is not None for x in said], bool)[word], m) > 0) & (n > 1)
        hints = np.bincount(of, np.array(telling, bool)[word], m) > 0
        totals = np.stack([np.bincount(of, x, m) for x in score.T], 1)
        behind = totals.max(1) - totals[:, self._en]
        far = np.where(scored, np.searchsorted((1, 4), behind, "right"), 0)
        if len(known) + m > _KNOWN:
            known.clear()
        kinds = [("any",), ("any", "foreign1"), ("any", "foreign2")]
        for c, x, y, h, k in zip(some, scored.tolist(), (behind < 1).tolist(), hints.tolist(), far.tolist()):
            known[c] = y if x else None, h, kinds[k]

    def _says(self, word: str) -> tuple[tuple[float, ...] | None, bool]:
        """A word's scores by language, and whether it tells refusals."""
        return self.model.word(word), self.wording.tells(word.lower().replace("’", "'"))

    def _word(self, word: str) -> int:
        """What a word tells: nothing, English, another language, or a refusal as well."""
        got = self.model.word(word)
        other = bool(got) and got[self._en] < 0
        if self.wording.tells(word.lower()):
            return _BOTH if other else _TELLING
        return _OTHER if other else _ENGLISH if got else _SILENT

    def _features(self, q: str, asked: list[str], got: list[str], body: str, english: bool, wording: Wording | None = None, pair: Pair | None = None) -> list[tuple[str, ...]]:
        """The features of each clause of a response to a prompt. pair: what is known of them."""
        grams = None
        if not english and (not body.isascii() or q.isascii() or len(q.encode()) < 1.6 * len(q)):
            grams = pair.grams if pair and pair.grams else _grams(q)
            if pair:
                pair.grams = grams
        known = [self._clauses[c] for c in got]
        # a word lies in one clause, so the response has a telling one if a clause has
        hints = wording.hints(body) if wording else any([x[1] for x in known])
        if not grams and not hints:
            out = [x[2] for x in known]
        else:
            wording, out = wording or self.wording, []
            whole, like = _likeness(got, body, grams) if grams else (False, [0] * len(got))
            size = sum(map(len, got)) / max(1.0, self.ratio.get(_kind(q), 1.0) * sum(map(len, asked))) if hints else 0.0
            for clause, (_, _, own), share in zip(got, known, like):
                x = ["any"]
                if whole:
                    x.append("whole")
                if share:
                    x.append(f"like{share}")
                x += own[1:]
                if hints and (much := _bin(wording.scores[clause], 1, 5, 10)):
                    x.append(f"refusing{much}")
                    x.append(f"refusing{much} short{_bin(size, 0.3, 0.6)}")
                out.append(tuple(x))
        out[-1] = out[-1] + self._end(q, asked, got)
        return out

    def _full(self, clause: str) -> str:
        """How a last clause ends."""
        return "stop" if _STOP.search(clause) else f"p{_bin(self.answers.complete(clause), 0.1, 0.25, 0.5, 0.9)}"

    def _stopped(self, clause: str) -> bool:
        """Whether a prompt's last clause stops without an end where none is usual."""
        return not _STOP.search(clause) and self.prompts.complete(clause) < 0.15

    def _end(self, prompt: str, asked: list[str], got: list[str]) -> tuple[str, ...]:
        """How a response ends, against its prompt. Marks at the end (numbers, dates) are set aside: either side may have them alone."""
        asked, kept = _unmarked(asked), _unmarked(got)
        if not kept or not asked:
            return ("last marks",)
        lack, a, q = len(asked) - len(kept), kept[-1], asked[-1]
        ratio = self.ratio.get(_kind(prompt), 1.0)
        whole = sum(map(len, kept)) / max(1.0, ratio * sum(map(len, asked)))
        dots_a, dots_q = bool(_DOTS.search(got[-1])), bool(_DOTS.search(prompt.rstrip()))
        full = self._ends[a]
        if full != "stop" and len(kept) < len(got):
            full = "marks"
        if dots_a:
            return (f"dots {dots_q} {min(max(lack, -1), 2)}", "dots")
        # the prompt itself is cut
        cut = dots_q or self._stops[q]
        lack = min(max(lack, -1), 3)
        last = len(a) / max(1.0, ratio * len(q))
        size, own = _bin(whole, 0.5, 0.7, 0.85, 0.95), _bin(last, 0.5, 0.6, 0.7, 0.8, 0.9)
        out = [f"last {full}", f"last {full} lack{lack}", f"lack{lack} size{size}", f"last {full} lack{lack} size{size}", f"size{size}"]
        if lack == 0:
            out += [f"last {full} own{own}", f"last {full} own{own} size{size}"]
        if cut and lack <= 1:
            out += ["both cut", f"both cut {full}"]
        return tuple(out)

    def _title_features(self, q: str, text: str, wording: Wording | None = None) -> tuple[str, ...]:
        """The features of a title, a response of one clause."""
        (x, foreign, latin, much), (y, theirs, _, _) = self._heads[text], self._heads[q]
        out = ["any", "title"]
        if y and theirs:
            if x == y:
                out += ["title same", "like2"]
            elif len(x) > 7 and len(x) * 2 > len(y) and not (x.isascii() and len(y.encode("ascii", "ignore")) < WIDTH) and _near(x, _grams(q)):
                out += ["title like", "like2"]
        if not latin or foreign:
            out += ["title foreign", "foreign2"]
        if wording:
            much = _refusing(text, wording)
        if much:
            out += [f"title refusing{much}", f"refusing{much}"]
        if _DOTS.search(text):
            out.append(f"title dots {bool(_DOTS.search(q))}")
        elif not (y and x == y):
            out += self._tails[text]
        return tuple(out)

    def _head(self, text: str) -> tuple[str, bool, bool, int]:
        """A title's letters, whether it isn't English, whether its letters are Latin, and how much it is a refusal."""
        x = bare(text)
        if text.isascii() and text.count("'") < 2 and max(map(self._kinds.__getitem__, _WORD.findall(text.lower())), default=_SILENT) <= _ENGLISH:
            return x, False, x != "", 0
        latin = sum(c.isascii() or "À" <= c <= "ỹ" for c in x) * 2 > len(x)
        return x, self._other(text, x), latin, _refusing(text, self.wording)

    def _tail(self, text: str) -> tuple[str, ...]:
        """How a title's last word begins longer ones."""
        if m := re.search(r"([^\W\d_]{2,})\s*$", text):
            w = m[1].lower()
            longer, own, last = self.longer.get(w, 0), self.words.get(w, 0), self.last.get(w, 0)
            if longer >= 3:
                # a usual last word that lacks one letter is a slip; a word may stand inside titles only
                slip = any(self.last.get(w + c, 0) * 4 > longer for c in "abcdefghijklmnopqrstuvwxyz")
                inner = own >= 20 and last * 50 <= own
                begins = f"title begins{_bin(longer / (own + 0.1), 1, 3, 8, 30)} slip{slip} inner{inner}"
                return begins, f"{begins} last{_bin(last, 1, 3)}"
        return ()

    def _defect(self, parts: list[str], features: list[tuple[str, ...]]) -> str | None:
        return self.covered([len(c) for c in parts], features)

    def covered(self, lens: list[int], features) -> str | None:
        """What the tags' coverage says."""
        tags = self.field.tag(features)
        if not any(tags):
            return None
        cover = np.zeros(len(TAGS))
        for n, t in zip(lens, tags):
            cover[t] += n
        total = cover.sum()
        if cover[REFUSAL] * 2 > total - cover[UNFINISHED]:
            return "refusal"
        if cover[ECHO] * 2 > total:
            return "copy"
        if (cover[FOREIGN] + cover[ECHO]) * 2 > total:
            return "other_language"
        return "truncated" if cover[UNFINISHED] else None

    def text(self, prompt: str, answer: str) -> str | None:
        """The defect of a long answer, or None."""
        x = self.Pair(self, nfkc(prompt), nfkc(answer))
        return "empty" if _empty(x) else self._defect(x.got, x.features(x.got, x.body))

    def title(self, prompt: str, answer: str) -> str | None:
        """The defect of a short answer, or None."""
        body = _without_lead(nfkc(answer))
        if bare(body) in NOTHING:
            return "empty"
        return self._defect([body], [self._title_features(nfkc(prompt), body)])

    def _foreign_title(self, text: str) -> bool:
        return self._heads[text][1]

    def _other(self, text: str, x: str) -> bool:
        """Whether a title, x without marks, is in another language."""
        if not x:
            return False
        if sum(ord(c) > 0x2E7F for c in x) * 2 > len(x):
            return True
        got = self.model.score(text, all_words=True)
        return got is not None and got.get("en", -20.0) < -5


#: What a word tells.
_SILENT, _ENGLISH, _OTHER, _TELLING, _BOTH = range(5)
#: A character of an unspaced script, or of others behind it.
_WIDE = re.compile("[^\x00-\u1100]")
#: A character beyond Latin letters, or that has two in lower case.
_FAR = re.compile("[^\x00-\u012f\u0131-\u10ff]")


def _refusing(title: str, wording: Wording) -> int:
    return _bin(wording.scores[title], 1, 5, 10) if len(title) > 12 and wording.hints(title) else 0


def _near(s: str, grams: set, share: float = 0.7) -> bool:
    own = {s[i : i + WIDTH] for i in range(len(s) - WIDTH + 1)} or {s}
    return len(own & grams) >= share * len(own)


def _likeness(got: list[str], body: str, grams: set) -> tuple[bool, list[int]]:
    """Whether a response is like the prompt whose grams these are, and how much each of its clauses is."""
    s = bare(body)
    own = {s[i : i + WIDTH] for i in range(len(s) - WIDTH + 1)} or {s}
    common = own & grams
    if not common and len(next(iter(grams))) == WIDTH:
        return False, [0] * len(got)
    like = []
    for clause in got:
        s = bare(clause)
        # a clause's grams are among the response's, if it is long enough to have one
        if len(s) >= WIDTH and len(common) == len(own):
            like.append(2)
        elif len(s) >= WIDTH and len(common) <= _FEW and not any([g in s for g in common]):
            like.append(0)
        else:
            mine = {s[i : i + WIDTH] for i in range(len(s) - WIDTH + 1)} or {s}
            like.append(_bin(len(mine & common if len(s) >= WIDTH else mine & grams) / len(mine), 0.35, 0.6))
    return len(common) >= 0.7 * len(own), like


#: So many grams are looked for one by one in a clause.
_FEW = 30


def _empty(x: Judge.Pair) -> bool:
    return not x.got or len(x.body) < 80 and bare(x.body) in NOTHING


def _example(features: list[tuple[str, ...]], tags: list[int]) -> tuple:
    return tuple(features), tuple(tags)


def fit_judge(rows: list, text: tuple[str, str], title: tuple[str, str], model: Model) -> Judge:
    """A judge of rows in the driver, whose pairs are (prompt, answer) columns. All their pairs with two non-blank sides are used, whole."""
    pairs, titles = ([(r[q], r[a]) for r in rows if not _blank(r[q]) and not _blank(r[a])] for q, a in (text, title))
    return Judge(pairs, titles, model)


def _blank(text: str | None) -> bool:
    return text is None or not text.strip()


def broken_pairs(df: DataFrame, id_col: str, texts: tuple[str, str], titles: tuple[str, str], judge: Judge) -> DataFrame:
    """(id, field_name, defect) of each defective pair; texts and titles are (prompt, answer) columns, field_name the answer's.

    A NULL or blank prompt makes no pair and a NULL answer is pending. defect is the first that applies of empty, refusal, copy,
    other_language, truncated. Texts are judged whole. Repeated rows are judged each, an empty table gives no rows, other columns
    don't matter. No shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(judge)

    def read(batches):
        j = shared.value
        for b in batches:
            ids, q, a, tq, ta = (c.to_pylist() for c in b.columns)
            rows: tuple[list, ...] = ([], [], [])
            for i, prompt, answer, head, short in zip(ids, q, a, tq, ta):
                found = []
                if answer is not None and not _blank(prompt):
                    found.append((texts[1], "empty" if _blank(answer) else j.text(prompt, answer)))
                if short is not None and not _blank(head):
                    found.append((titles[1], "empty" if _blank(short) else j.title(head, short)))
                for name, defect in found:
                    if defect:
                        for r, v in zip(rows, (i, name, defect)):
                            r.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())], ["id", "field_name", "defect"])

    cols = [texts[0], texts[1], titles[0], titles[1]]
    return df.select(F.col(id_col).cast("long"), *[F.col(c).cast("string") for c in cols]).mapInArrow(read, "id long, field_name string, defect string")


def _place(id_col: str) -> Column:
    """What is made of a row follows from its id alone."""
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(_SPACE).cast("long"))


def _counts_of(df: DataFrame, texts: tuple[str, str], titles: tuple[str, str], labels: tuple[str, str], n: int) -> Counts:
    """The tallies of all rows; labels: the language columns of the prompts."""

    def read(batches):
        t = Tally()
        for b in batches:
            for q, a, hq, ha, lang, head_lang in zip(*(c.to_pylist() for c in b.columns)):
                lang, head_lang = ((x or "").strip().lower() for x in (lang, head_lang))
                lang, head_lang = (x if x in LANGUAGES else None for x in (lang, head_lang))
                paired = not _blank(q) and not _blank(a)
                if paired:
                    plain = "…" not in q  # else sentences end at other places
                    t.pair(nfkc(q), nfkc(a), lang if plain else None)
                if lang and q and not (paired and plain):
                    t.label(lang, q)
                if not _blank(hq) and not _blank(ha):
                    t.head(nfkc(hq), nfkc(ha))
                if head_lang and hq:
                    t.label(head_lang, hq)
            if t.full():
                yield _batch(t.rows())
        yield _batch(t.rows())

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows) if rows else [()] * 4, (pa.string(), pa.string(), pa.string(), pa.int64()))], ["kind", "key", "part", "n"])

    scale = min(1.0, ROWS / max(1, n))
    found = df.select(*[F.col(c).cast("string") for c in (*texts, *titles, *labels)]).mapInArrow(read, "kind string, key string, part string, n long")
    # all parts of a key are in one place: what is kept depends on their sum
    parts = found.repartition("kind", "key").groupBy("kind", "key", "part").agg(F.sum("n").alias("n")).groupBy("kind", "key").agg(F.sum("n").alias("all"), F.collect_list(F.struct("part", "n")).alias("parts"))
    kept = parts.where(F.col("kind").isin("r", "U", "W", "C") | (F.col("all") * scale >= KEPT)).select("kind", "key", F.explode("parts").alias("p")).select("kind", "key", "p.part", "p.n")
    return Counts(sorted(tuple(r) for r in kept.collect()), scale)


_FEATURES = "id long, field_name string, defect string, lens array<int>, seq string, tags string, n long"


def _packed(features) -> str:
    return "\x1e".join("\x1f".join(c) for c in features)


def _unpacked(text: str) -> tuple:
    return tuple(tuple(c.split("\x1f")) for c in text.split("\x1e"))


def _feature_batch(rows: list, data: Counter) -> pa.RecordBatch:
    rows = rows + [(None, None, None, None, _packed(seq), ",".join(map(str, tags)), n) for (seq, tags), n in data.items()]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows) if rows else [()] * 7, kinds)], ["id", "field_name", "defect", "lens", "seq", "tags", "n"])


def _features_of(df: DataFrame, id_col: str, texts: tuple[str, str], titles: tuple[str, str], judge, every: bool) -> DataFrame:
    """The features of all pairs as they are (if every), or their defect where none are needed, and without id how often there is each pair that is made of them."""

    def ahead(j, rows):
        """Rows with their pairs, whose clauses are looked up together."""
        for lo in range(0, len(rows), _TOGETHER):
            some = rows[lo : lo + _TOGETHER]
            pairs = [None if _blank(q) or _blank(a) else j.Pair(j, nfkc(q), nfkc(a)) for _, _, q, a, _, _ in some]
            j.know(c for x in pairs if x for c in (*x.asked, *x.got))
            yield from zip(some, pairs)

    def read(batches):
        j, data = judge.value, Counter()
        for b in batches:
            rows, made = [], []
            for (k, i, q, a, hq, ha), x in ahead(j, list(zip(*(c.to_pylist() for c in b.columns)))):
                if a is not None and not _blank(q):
                    if x is None:
                        rows.append((k, texts[1], "empty", None, None, None, None))
                    else:
                        plain = None
                        if _empty(x):
                            rows.append((k, texts[1], "empty", None, None, None, None))
                        elif every:
                            plain = x.features(x.got, x.body)
                            rows.append((k, texts[1], None, [len(c) for c in x.got], _packed(plain), None, None))
                        made += x.made(i, None, plain)
                if ha is not None and not _blank(hq):
                    head, short = nfkc(hq), nfkc(ha)
                    body, plain = _without_lead(short), None
                    if _blank(ha) or bare(body) in NOTHING:
                        rows.append((k, titles[1], "empty", None, None, None, None))
                    elif every:
                        plain = j._title_features(head, body)
                        rows.append((k, titles[1], None, [len(body)], _packed([plain]), None, None))
                    if not _blank(ha):
                        made += j._made_title(i // 1000, head, short, None, plain)
            data.update(made)
            if every:
                yield _feature_batch(rows, Counter())
            if len(data) > _HELD // 10:
                yield _feature_batch([], data)
                data = Counter()
        yield _feature_batch([], data)

    return df.select(F.col(id_col).cast("long"), _place(id_col), *[F.col(c).cast("string") for c in (*texts, *titles)]).mapInArrow(read, _FEATURES)


def _foreign_of(df: DataFrame, id_col: str, texts: tuple[str, str], titles: tuple[str, str], judge, n: int) -> DataFrame:
    """Answers that are the prompt of another row: rows are put together by their hash, and each takes that of the next."""

    def group(t):
        j, data = judge.value, Counter()
        rows = sorted(zip(*(c.to_pylist() for c in t.columns)), key=lambda r: (r[1], str(r)))
        for at, first in ((2, True), (4, False)):
            own = [(r[1], nfkc(r[at]), nfkc(r[at + 1])) for r in rows if not _blank(r[at]) and not _blank(r[at + 1])]
            for k, (i, q, a) in enumerate(own):
                other = lambda k=k, own=own: own[(k + 1) % len(own)][1]
                data.update(j.Pair(j, q, a).made(i, other) if first else j._made_title(i // 1000, q, a, other))
        got = _feature_batch([], data)
        return pa.Table.from_batches([got.select(["seq", "tags", "n"])])

    i = F.col("_i")
    text, title = (i % 10 == 8) & (F.floor(i / 10) % 2 == 1), F.floor(i / 1000) % 10 == 8
    some = df.select(F.col(id_col).cast("long").alias("_id"), _place(id_col).alias("_i"), *[F.col(c).cast("string").alias(f"_{k}") for k, c in enumerate((*texts, *titles))]).where(text | title)
    some = some.select(*[F.when(text if c in ("_0", "_1") else title, F.col(c)).alias(c) if c[1:].isdigit() else F.col(c) for c in some.columns])
    groups = max(1, n * 145 // 1000 // _GROUP)
    return some.withColumn("_g", F.floor(i / F.lit(_SPACE / groups))).groupBy("_g").applyInArrow(lambda t: group(t.drop(["_g"])), "seq string, tags string, n long")


def table_judge(df: DataFrame, id_col: str, texts: tuple[str, str], titles: tuple[str, str], labels: tuple[str, str], every: bool = False) -> tuple[Judge, DataFrame]:
    """The judge of all rows, and the features of their pairs, if every; these are a table to be freed."""
    n, context = df.count(), df.sparkSession.sparkContext
    judge = Judge.counted(_counts_of(df, texts, titles, labels, n))
    shared = context.broadcast(judge)
    found = cut(_features_of(df, id_col, texts, titles, shared, every))
    made = found.where("tags is not null").select("seq", "tags", "n").unionByName(_foreign_of(df, id_col, texts, titles, shared, n))
    data = sorted(tuple(r) for r in made.groupBy("seq", "tags").agg(F.sum("n")).collect())
    judge.fit(Counter({(_unpacked(seq), tuple(map(int, tags.split(",")))): k for seq, tags, k in data}))
    return judge, found


def tagged_pairs(found: DataFrame, judge: Judge) -> DataFrame:
    """What broken_pairs gives, of features that table_judge found."""
    shared = found.sparkSession.sparkContext.broadcast(judge)

    def read(batches):
        j, memo = shared.value, {}
        for b in batches:
            rows: tuple[list, ...] = ([], [], [])
            for k, name, defect, lens, seq in zip(*(c.to_pylist() for c in b.columns)):
                if defect is None:
                    if (features := memo.get(seq)) is None:
                        if len(memo) > 100_000:
                            memo.clear()
                        features = memo[seq] = _unpacked(seq)
                    defect = j.covered(lens, features)
                if defect:
                    for r, v in zip(rows, (k, name, defect)):
                        r.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())], ["id", "field_name", "defect"])

    return found.where("field_name is not null").select("id", "field_name", "defect", "lens", "seq").mapInArrow(read, "id long, field_name string, defect string")

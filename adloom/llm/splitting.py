"""Problem 10: cutting oversized texts at natural boundaries, with overlap.

A text above the limit is cut by recursive bisection: at the strongest boundary (paragraph, line,
sentence, word) whose token count lies near the middle, then each half that still exceeds
the limit minus the overlap. Afterwards each piece but the first is begun about `overlap` tokens
earlier. Token counts are those of bpe.py's pieces; where a cut could change
the encoding (inside a piece, or after whitespace) the piece is encoded by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.bpe import DEFAULT_TOKENIZER, Encoder, encoder, portions

PARAGRAPH, LINE, SENTENCE, WORD, INSIDE = 4, 3, 2, 1, 0
FULL_STOPS, STOPS, CLOSERS = "。！？．｡", ".!?…", "」』）)\"'”’]】"
#: How far from the middle, as a share of the tokens, a stronger boundary is still preferred.
REACH = 0.25


def strengths(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Strength of the boundary before each piece; codes hold one text or several, and only whitespace runs are looked back over."""
    white = np.isin(codes, np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], codes.dtype))
    lines = np.cumsum((codes == 10) | ((codes == 13) & (np.append(codes[1:], 0) != 10)) | (codes == 0x2029) | (codes == 0x2028))
    solid = np.maximum.accumulate(np.where(white, -1, np.arange(len(codes))))
    at = starts[starts > 0]
    back = solid[at - 1]
    breaks = lines[at - 1] - np.where(back >= 0, lines[np.maximum(back, 0)], 0)
    end = codes[np.maximum(back, 0)]
    before = codes[np.maximum(back - 1, 0)]
    full, stop, close = ([ord(c) for c in x] for x in (FULL_STOPS, STOPS, CLOSERS))
    closed = np.isin(end, close)
    gap = (back < at - 1) | (codes[at] == 32)
    sentence = (np.isin(end, full) & ~np.isin(codes[at], close)) | (closed & np.isin(before, full)) | (gap & (np.isin(end, stop) | (closed & np.isin(before, stop))))
    out = np.full(len(starts), WORD)
    out[starts > 0] = np.where(breaks > 1, PARAGRAPH, np.where(breaks == 1, LINE, np.where(sentence, SENTENCE, WORD)))
    # whitespace before the next text belongs to what is before it
    out[white[starts] & (np.append(white[1:], False)[starts]) & (out >= LINE)] = WORD
    return out


def cuts(total: np.ndarray, strength: np.ndarray, limit: int, overlap: int) -> list[int]:
    """Indices of the boundaries at which to cut. total: tokens before each boundary, the first 0 and the last the whole; no two
    neighbours lie limit - overlap tokens apart."""
    room, out, todo = limit - overlap, [], [(0, len(total) - 1)]
    while todo:
        lo, hi = todo.pop()
        first = int(total[lo])
        size = int(total[hi]) - first
        if size <= room or hi - lo < 2:
            continue
        middle, reach = first + size / 2, size * REACH
        a, b = total.searchsorted((middle - reach, middle + reach))
        a, b = max(int(a), lo + 1), min(int(b), hi)
        if a >= b:
            near = int(total.searchsorted(middle))
            a = max(lo + 1, min(near - 1, hi - 1))
            b = max(a + 1, min(hi, near + 1))
        s = strength[a:b]
        top = np.nonzero(s == s.max())[0]
        best = a + int(top[np.abs(total[a:b][top] - middle).argmin()])
        out.append(best)
        todo += [(lo, best), (best, hi)]
    return sorted(out)


def boundaries(e: Encoder, codes: np.ndarray, owner: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray, strength: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, code point, tokens of the text before, strength) of the places where texts that lie end to end in codes may be cut: before each piece, and inside
    pieces of more than `most` tokens wherever a token ends with a character."""
    counts = e.count[index]
    before = np.cumsum(counts) - counts
    fresh = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
    before -= np.repeat(before[fresh], np.diff(np.append(np.flatnonzero(fresh), len(owner))))
    big = np.flatnonzero(counts > most)
    if not len(big):
        return owner, starts, before, strength
    c, n = counts[big], sizes[big]
    token = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
    ends = np.cumsum(e.v.length[e.flat[np.repeat(e.begin[index[big]], c) + token]])
    where = np.repeat(starts[big] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    x = codes[where]
    bytes_ = np.cumsum(1 + (x > 0x7F).astype(np.int64) + (x > 0x7FF) + (x > 0xFFFF))
    at = np.searchsorted(bytes_, ends)
    hit = np.flatnonzero((bytes_[at] == ends) & (token + 1 < np.repeat(c, c)))
    piece = np.repeat(big, c)[hit]
    place = np.append(starts, where[at[hit]] + 1)
    order = np.argsort(place, kind="stable")
    return np.append(owner, owner[piece])[order], place[order], np.append(before, before[piece] + token[hit] + 1)[order], np.append(strength, np.full(len(hit), INSIDE))[order]


def split_text(e: Encoder, text: str, place: np.ndarray, before: np.ndarray, strength: np.ndarray, total: int, limit: int, overlap: int, exact: bool = True) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of the pieces of a text above the limit, from its boundaries; tokens are -1 where only encoding the piece by itself tells, unless exact."""
    p, t, s = np.append(place, len(text)), np.append(before, total), np.append(strength, PARAGRAPH)
    at = [0, *cuts(t, s, limit, overlap), len(p) - 1]
    out = []
    for a, b in zip(at, at[1:]):
        o = a
        if a:
            o = int(t[:a].searchsorted(t[a] - overlap))
            # a cut at a sentence or line is worth a few tokens less of overlap
            near = np.nonzero((s[o:a] >= SENTENCE) & (t[o:a] <= t[a] - overlap * 3 // 4))[0]
            o += int(near[0]) if len(near) else 0
        while True:
            end = int(p[b])
            sure = s[o] > INSIDE and s[b] > INSIDE and not (text[end - 1].isspace() and text[end - 2 : end - 1].isspace())
            if not sure and not exact:
                n = -1
                break
            n = int(t[b] - t[o]) if sure else int(e.sizes([text[p[o] : p[b]]])[0])
            if n <= limit or o >= a:
                break
            o += 1
        if n > limit:  # encoded by itself it is longer than as a part, which only a cut inside a word can cause
            m = a + (b - a) // 2
            if a < m < b:
                for x, y in ((o, m), (m, b)):
                    out.append((int(p[x]), int(p[y]), int(e.sizes([text[p[x] : p[y]]])[0])))
                continue
        out.append((int(p[o]), int(p[b]), n))
    return out


def split_long(df: DataFrame, id_col: str, text_col: str, limit: int = 512, overlap: int = 64, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, piece, start, end, n_tokens, text) of each text above the limit; start and end are code points.

    Pieces are numbered from 0, have at most `limit` tokens encoded by themselves, and cover the text without a gap; from
    the second on they start with about `overlap` tokens of the one before. Only a character that has more
    tokens than the limit could exceed it. NULL, empty and short texts give no rows; texts of any length are read
    whole; repeated rows are split each, a NULL id is kept, other columns don't matter. No shuffle.
    """

    def read(batches):
        e = encoder(tokenizer)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in portions(texts):
                part = texts[lo:hi]
                owner, starts, length, index = e.pieces(part)
                codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), "<u4")
                total = np.bincount(owner, e.count[index], len(part)).astype(np.int64)
                strength = strengths(codes, starts)
                long = total[owner] > limit  # pieces of texts that are cut
                own, place, before, power = boundaries(e, codes, owner[long], starts[long], length[long], index[long], strength[long], overlap // 2)
                bounds = np.searchsorted(own, np.arange(len(part) + 1))
                begins = np.cumsum(list(map(len, part))) - list(map(len, part))
                rows: tuple[list, ...] = ([], [], [], [], [], [])
                cut: list = []
                for k in np.nonzero(total > limit)[0]:
                    x, y = bounds[k], bounds[k + 1]
                    cut.append((k, split_text(e, part[k], place[x:y] - begins[k], before[x:y], power[x:y], int(total[k]), limit, overlap, exact=False)))
                open_ = [(m, n) for m, (_, got) in enumerate(cut) for n, piece in enumerate(got) if piece[2] < 0]
                sizes = e.sizes([part[cut[m][0]][cut[m][1][n][0] : cut[m][1][n][1]] for m, n in open_])
                again = set()
                for (m, n), size in zip(open_, sizes.tolist()):
                    cut[m][1][n] = (*cut[m][1][n][:2], size)
                    if size > limit:
                        again.add(m)
                for m, (k, got) in enumerate(cut):
                    if m in again:
                        x, y = bounds[k], bounds[k + 1]
                        got = split_text(e, part[k], place[x:y] - begins[k], before[x:y], power[x:y], int(total[k]), limit, overlap)
                    for n, (start, end, size) in enumerate(got):
                        for r, v in zip(rows, (ids[lo + k], n, start, end, size, part[k][start:end])):
                            r.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.string() if i == 5 else pa.int64()) for i, r in enumerate(rows)], ["id", "piece", "start", "end", "n_tokens", "text"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text <> ''")
    return rows.mapInArrow(read, "id long, piece long, start long, end long, n_tokens long, text string")

"""Problem 8: byte-level BPE of whole texts by prefix dynamic programming.

For each prefix of a piece the table holds the last token of the prefix's encoding. That token
is unique: of the tokens that end the prefix, it is the one that may follow the last token of what
is left before it, where two tokens may stand together if encoding their bytes gives
just these two. Appending a byte adds one entry and changes none; an edit leaves every entry before it.

Pieces (the pattern's matches) are found on arrays of code points and each different piece is encoded once while it stays in a bounded
memory: it is looked up by a 64-bit hash and then compared, code point by code point. Pieces that are new in a batch go
through the table together, position by position. A long piece goes through it in windows, together too: as an entry depends on no more than
the entries of one token's length before it, a window that agrees with the one before over that length goes on as the whole piece would; one that doesn't is made again.
"""

from __future__ import annotations

import base64
import unicodedata
from functools import lru_cache

import numpy as np

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Largest tokenizer file that is sent to every task.
MOST_FILE = 64 << 20
#: Different pieces, and their ids, that a worker remembers before it starts anew; code points worked on at once.
REMEMBER, REMEMBER_IDS, BATCH = 600_000, 12_000_000, 1_500_000
#: Pieces of more bytes than this are encoded in windows; bytes of windows worked on at once.
LONG, WINDOWS = 1500, 400_000
_NONE = np.int64(1) << 40


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        data = f.read(MOST_FILE + 1)
    if len(data) > MOST_FILE:
        raise ValueError("the tokenizer file is too large to send to every task")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Vocabulary:
    """Tokens as a trie, each one's last merge, and which two may stand together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.bytes_of = [b""] * size
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.longest = int(self.length.max())
        self.left = np.arange(size)
        self.right = np.arange(size)
        keys, ids = [], []
        nodes: dict[tuple[int, int], int] = {}
        token_at = [-1]
        for b, i in sorted(ranks.items(), key=lambda x: x[1]):
            node = 0
            for c in b:
                node = nodes.setdefault((node, c), len(token_at))
                if node == len(token_at):
                    token_at.append(-1)
            token_at[node] = i
            if len(b) > 1:
                self.left[i], self.right[i] = l, r = self._last_merge(b, i)
                keys.append(l * size + r)
                ids.append(i)
        self.size = size
        self.child = np.full((len(token_at), 256), -1, np.int32)
        for (node, c), to in nodes.items():
            self.child[node, c] = to
        self.token_at = np.array(token_at, np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ids = np.array(keys, np.int64)[order], np.array(ids, np.int64)[order]
        self._seen = np.full(1 << 20, -1, np.int64)
        self._ok = np.zeros(1 << 20, bool)
        self._pairs: dict[int, bool] = {}

    def _last_merge(self, b: bytes, i: int) -> tuple[int, int]:
        parts = [b[k : k + 1] for k in range(len(b))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda k: self.ranks.get(parts[k] + parts[k + 1], size_max))
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that a and b merge to, or _NONE."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ids[at], _NONE)

    def _judge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges along the seam of a and b would leave both whole: undo their merges from
        the latest, and look whether an earlier one joins across."""
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), _NONE)
        while len(live):
            bad = self.merged(a, b) < limit
            ok[live[bad]] = False
            # the later merge is undone first; a single byte can't be, then the other one is
            la, rb = self.right[a], self.left[b]
            undo_a = ((a > b) & (la != a)) | ((a <= b) & (rb == b))
            stuck = (la == a) & (rb == b)
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, la, a), np.where(undo_a, b, rb)
            go = ~bad & ~stuck
            live, a, b, limit = live[go], a[go], b[go], limit[go]
        return ok

    def together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        out = self._ok[slot]
        miss = np.nonzero(self._seen[slot] != key)[0]
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            ok = self._judge(new // self.size, new % self.size)
            out[miss] = ok[back]
            self._seen[slot[miss]], self._ok[slot[miss]] = key[miss], ok[back]
        return out

    def _endings(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(token, start, end, end within its piece) of every token that lies inside a piece, in the order of the last."""
        starts = np.cumsum(lens) - lens
        total = int(lens.sum())
        begin, room = np.repeat(starts, lens), np.repeat(starts + lens, lens)
        node, at = np.zeros(total, np.int64), np.arange(total)
        token, where, end = [], [], []
        for d in range(self.longest):
            node = self.child[node, data[at + d]].astype(np.int64)
            alive = node >= 0
            node, at = node[alive], at[alive]
            t = self.token_at[node]
            hit = t >= 0
            token.append(t[hit])
            where.append(at[hit])
            end.append(at[hit] + d + 1)
            inside = at + d + 1 < room[at]
            node, at = node[inside], at[inside]
            if not len(at):
                break
        token, where, end = map(np.concatenate, (token, where, end))
        step = end - begin[where]
        order = np.argsort(step, kind="stable")
        return token[order], where[order], end[order], step[order]

    def table(self, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Of pieces that lie one after another in data (bytes): for each byte the last token of the prefix that ends with it."""
        token, where, end, step = self._endings(data, lens)
        starts = np.cumsum(lens) - lens
        bounds = np.searchsorted(step, np.arange(1, int(lens.max(initial=0)) + 2))
        first = where == np.repeat(starts, lens)[where]
        last = np.full(int(lens.sum()), -1, np.int64)
        for k in range(len(bounds) - 1):
            lo, hi = bounds[k], bounds[k + 1]
            t, w, f = token[lo:hi], where[lo:hi], first[lo:hi]
            good = f.copy()
            rest = np.nonzero(~f)[0]
            if len(rest):
                good[rest] = self.together(last[w[rest] - 1], t[rest])
            last[end[lo:hi][good] - 1] = t[good]
        return last

    def encode_many(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that lie one after another in data (bytes), flat, and each piece's number of ids."""
        last, starts = self.table(data, lens), np.cumsum(lens) - lens
        # back from the ends
        counts = np.zeros(len(lens), np.int64)
        live, place = np.nonzero(lens)[0], (starts + lens)[lens > 0]
        ids, owners = [], []
        while len(live):
            t = last[place - 1]
            ids.append(t)
            owners.append(live)
            counts[live] += 1
            place = place - self.length[t]
            go = place > starts[live]
            live, place = live[go], place[go]
        if not ids:
            return np.zeros(0, np.int64), counts
        rank = np.concatenate([np.full(len(o), k) for k, o in enumerate(owners)])
        ids, owners = np.concatenate(ids), np.concatenate(owners)
        flat = np.empty(len(ids), np.int64)
        flat[np.cumsum(counts)[owners] - 1 - rank] = ids
        return flat, counts

    def encode_long(self, data: np.ndarray) -> np.ndarray:
        """Ids of one long piece: windows with an overlap go through the table together and are joined where they agree."""
        n, reach = len(data), self.longest
        size, over = 2 * reach, 2 * reach
        last = np.empty(n, np.int64)
        done = 0
        for first in range(0, n, WINDOWS // 2):
            begins = np.arange(first, min(n, first + WINDOWS // 2), size)
            lows, highs = np.maximum(begins - over, 0), np.minimum(begins + size, min(n, first + WINDOWS // 2))
            lens = highs - lows
            where = np.repeat(lows - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
            tables, at = self.table(data[where], lens), np.cumsum(lens) - lens
            for begin, low, high, k in zip(begins.tolist(), lows.tolist(), highs.tolist(), at.tolist()):
                own = tables[k : k + high - low]
                if low == 0 or np.array_equal(last[begin - reach : begin], own[begin - low - reach : begin - low]):
                    last[done:high] = own[done - low :]
                else:
                    self._go_on(data, last, begin, high, own[begin - low :])
                done = high
        out, lengths, back, place = [], self.length.tolist(), last.tolist(), n
        while place:
            out.append(back[place - 1])
            place -= lengths[out[-1]]
        return np.array(out[::-1], np.int64)

    def _go_on(self, data: np.ndarray, last: np.ndarray, begin: int, end: int, guess: np.ndarray) -> None:
        """Entries begin to end after those before; from where they have agreed with the guess for a token's length, the guess stands."""
        low = max(0, begin - self.longest)
        token, where, ends, _ = self._endings(data[low:end], np.array([end - low]))
        keep = ends + low > begin
        token, where, ends = token[keep].tolist(), (where[keep] + low).tolist(), (ends[keep] + low).tolist()
        agreed, done = 0, begin
        for t, w, e in zip(token, where, ends):
            if e <= done:
                continue
            if w == 0 or self._fit(int(last[w - 1]), t):
                last[e - 1], done = t, e
                agreed = agreed + 1 if guess[e - 1 - begin] == t else 0
                if agreed >= self.longest:
                    last[e:end] = guess[e - begin :]
                    return

    def _fit(self, a: int, b: int) -> bool:
        key = a * self.size + b
        got = self._pairs.get(key)
        if got is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            got = self._pairs[key] = bool(self.together(np.array([a]), np.array([b]))[0])
        return got


size_max = 1 << 60


class PrefixTable:
    """The table of one piece, kept so that bytes can be appended, or changed near the end, without encoding the rest again."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, bytearray(), []
        self.append(data)

    def _fits(self, a: int, b: int) -> bool:
        return bool(self.v.together(np.array([a]), np.array([b]))[0])

    def append(self, data: bytes) -> None:
        v = self.v
        for c in data:
            self.data.append(c)
            n = len(self.data)
            for d in range(min(v.longest, n), 0, -1):
                t = v.ranks.get(bytes(self.data[n - d :]))
                if t is not None and (d == n or self._fits(self.last[n - d - 1], t)):
                    self.last.append(t)
                    break

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Change bytes start to end; entries before start stand, those after it are made again."""
        tail = bytes(self.data[end:])
        del self.data[start:], self.last[start:]
        self.append(data + tail)

    def ids(self, end: int | None = None) -> list[int]:
        """Of the prefix of `end` bytes; of all without it."""
        out, n = [], len(self.data) if end is None else end
        while n:
            out.append(self.last[n - 1])
            n -= len(self.v.bytes_of[out[-1]])
        return out[::-1]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 space, 4 other whitespace, of each code point."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c in "LN":
            out[i] = 1 if c == "L" else 2
    for i in (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        out[i] = 4
    out[32] = 3
    return out


def piece_starts(codes: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin. codes: texts one after another; fresh: the first code point of each text."""
    n = len(codes)
    kind = _classes()[codes]
    white = kind >= 3
    after_fresh = np.append(fresh[1:], True)  # the text ends here
    prev, prev_space = np.roll(kind, 1), np.roll(kind == 3, 1) & ~fresh
    prev_white = np.roll(white, 1) & ~fresh
    word = ~white & ((kind != prev) | fresh) & ~prev_space
    # a run of whitespace begins; its last character stands by itself if text follows
    next_white = np.append(white[1:], False) & ~after_fresh
    run = white & ~prev_white
    final = white & ~next_white & ~after_fresh
    starts = word | run | final | fresh
    # contractions
    for i in np.nonzero((codes == 39) & starts & (kind == 0) & ~after_fresh)[0]:
        tail = "".join(map(chr, codes[i + 1 : i + 3]))
        k = 2 if tail in ("re", "ve", "ll") and not after_fresh[i + 1] else 1 if tail[:1] in ("s", "t", "m", "d") else 0
        if k and not fresh[i + 1]:
            starts[i + 1] = False
            if i + 1 + k < n:
                starts[i + 1 + k] = True
    return starts


class Encoder:
    """Ids of many texts; remembers pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.v = Vocabulary(ranks)
        rng = np.random.default_rng(8)
        self._value = rng.integers(1, 2**63, (2, 4096), np.int64).astype(np.uint64)
        self._reset()

    def _reset(self):
        self.known: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.begin: np.ndarray = np.zeros(1 << 12, np.int64)
        self.count: np.ndarray = np.zeros(1 << 12, np.int64)
        # the pieces' own code points, to compare with
        self.written: np.ndarray = np.zeros(1 << 16, np.uint32)
        self.place: np.ndarray = np.zeros(1 << 12, np.int64)
        self.letters: np.ndarray = np.zeros(1 << 12, np.int64)
        self.n = self.used = self.wrote = 0

    def _hashes(self, codes: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each piece that mixes two position-weighted sums of its code points and its length."""
        c = codes.astype(np.int64)
        place = np.arange(len(codes)) - np.repeat(starts, lens)
        out = lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(2):
            x = self._value[k][c & 4095] ^ (self._value[k][(c >> 9) & 4095] << np.uint64(1))
            x = x * (self._value[1 - k][place & 4095] | np.uint64(1)) + (place >> 12).astype(np.uint64)
            x ^= x >> np.uint64(31)
            s = np.add.reduceat(x, starts)
            out = (out ^ (s ^ (s >> np.uint64(29)))) * np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))

    def _learn(self, codes: np.ndarray, starts: np.ndarray, lens: np.ndarray, hashes: np.ndarray | None) -> np.ndarray:
        """The indices of new pieces; they are found again by their hashes, if given."""
        index = np.zeros(len(starts), np.int64)
        where = np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
        c = codes[where]
        width = 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)
        size = np.add.reduceat(width, np.cumsum(lens) - lens)
        data = c.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        ends = np.cumsum(size)
        long = np.nonzero(size > LONG)[0]
        pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        short = np.nonzero(size <= LONG)[0]
        if len(short):
            mask = np.repeat(size <= LONG, size)
            flat, counts = self.v.encode_many(np.frombuffer(data, np.uint8)[mask], size[short])
            pieces.append((short, flat, counts))
        for i in long:
            got = self.v.encode_long(np.frombuffer(data, np.uint8)[ends[i] - size[i] : ends[i]])
            pieces.append((np.array([i]), got, np.array([len(got)])))
        begins = np.cumsum(lens) - lens
        if self.wrote + len(c) > len(self.written):
            self.written = np.concatenate([self.written, np.zeros(max(len(c), len(self.written)), np.uint32)])
        self.written[self.wrote : self.wrote + len(c)] = c
        for at, flat, counts in pieces:
            need = self.used + len(flat)
            if need > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(max(need, len(self.flat)), np.int32)])
            if self.n + len(at) > len(self.begin):
                more = np.zeros(max(len(at), len(self.begin)), np.int64)
                self.begin, self.count, self.place, self.letters = (np.concatenate([x, more]) for x in (self.begin, self.count, self.place, self.letters))
            self.flat[self.used : need] = flat
            self.begin[self.n : self.n + len(at)] = self.used + np.cumsum(counts) - counts
            self.count[self.n : self.n + len(at)] = counts
            self.place[self.n : self.n + len(at)], self.letters[self.n : self.n + len(at)] = self.wrote + begins[at], lens[at]
            index[at] = np.arange(self.n, self.n + len(at))
            self.n += len(at)
            self.used = need
        self.wrote += len(c)
        if hashes is not None:
            self.known.update(zip(hashes.tolist(), index.tolist()))
        return index

    def pieces(self, texts: list[str]):
        """(owner, start, length, index) of all pieces of non-empty texts: code points within the texts laid end to end;
        count[index] and flat[begin[index]:] are their ids."""
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        fresh = np.zeros(len(codes), bool)
        begin = np.cumsum(lens) - lens
        fresh[begin[lens > 0]] = True
        starts = np.nonzero(piece_starts(codes, fresh))[0]
        size = np.diff(np.append(starts, len(codes)))
        if self.n > REMEMBER or self.used > REMEMBER_IDS or self.wrote > 4 * REMEMBER_IDS:
            self._reset()
        unique, at, back = np.unique(self._hashes(codes, starts, size), return_index=True, return_inverse=True)
        index = np.fromiter((self.known.get(h, -1) for h in unique.tolist()), np.int64, len(unique))
        new = index < 0
        if new.any():
            index[new] = self._learn(codes, starts[at[new]], size[at[new]], unique[new])
        index = index[back]
        # a piece whose hash another one has is encoded by itself
        there = np.minimum(np.repeat(self.place[index], size) + np.arange(len(codes)) - np.repeat(starts, size), len(self.written) - 1)
        other = np.unique(np.repeat(np.arange(len(starts)), size)[self.written[there] != codes]) if len(codes) else starts
        if len(other) or (self.letters[index] != size).any():
            other = np.union1d(other, np.nonzero(self.letters[index] != size)[0])
            index[other] = self._learn(codes, starts[other], size[other], None)
        owner = np.repeat(np.arange(len(texts)), lens)[starts] if len(codes) else starts
        return owner, starts, size, index

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, flat (int32), and each text's number of ids."""
        if not any(texts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        owner, _, _, index = self.pieces(texts)
        counts = self.count[index]
        where = np.repeat(self.begin[index] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        return self.flat[where], np.bincount(owner, counts, len(texts)).astype(np.int64)

    def sizes(self, texts: list[str]) -> np.ndarray:
        if not any(texts):
            return np.zeros(len(texts), np.int64)
        owner, _, _, index = self.pieces(texts)
        return np.bincount(owner, self.count[index], len(texts)).astype(np.int64)


def portions(texts: list[str], most: int = BATCH):
    """Slices of about `most` code points; a longer text is one by itself."""
    lo = size = 0
    for hi, t in enumerate(texts):
        if size and size + len(t) > most:
            yield lo, hi
            lo, size = hi, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


@lru_cache(maxsize=2)
def encoder(path: str = DEFAULT_TOKENIZER) -> Encoder:
    """The process's encoder of a tokenizer file."""
    return Encoder(load_ranks(path))

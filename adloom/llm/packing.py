"""Problem 9: filling containers of fixed capacity, balanced by cost.

Items above the capacity are divided into full containers and a rest. All other items of a block are
taken in descending order and each goes to the sequence of lowest cost (linear plus quadratic in
the lengths of its items, as attention is) that has room, out of the least possible number of sequences. Where none has room for an item, one of the emptiest
gets it by giving another sequence an item in exchange for a slightly smaller one, so that what is left over in several comes together in one.
Only what can't be helped so opens further sequences. Blocks are cut by a hash, so all work is within blocks of bounded size.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.bpe import DEFAULT_TOKENIZER, encoder, portions
from adloom.session import cut

#: Items of a block, and the cost of a sequence: LINEAR * tokens + sum of QUADRATIC * tokens ** 2 of its items.
BLOCK, LINEAR, QUADRATIC = 20_000, 1.0, 1 / 1024


#: Emptiest sequences that an exchange is looked for in first, and how many times as many then, until it is in all.
TRIED, MORE = 256, 16


class _Sequences:
    """Sequences with room and cost; finds that of least cost among those with at least so much room, by a segment tree over rooms."""

    def __init__(self, capacity: int, opened: int):
        self.base = 1 << capacity.bit_length()
        self.top = [math.inf] * (2 * self.base)
        self.heaps: dict[int, list] = {}
        self.room = np.full(opened, capacity, np.int64)
        self.cost = [0.0] * opened
        self.heaps[capacity] = [(0.0, k) for k in range(opened)]
        self._lift(capacity)

    def _lift(self, room: int) -> None:
        h = self.heaps.get(room)
        while h and (self.cost[h[0][1]] != h[0][0] or self.room[h[0][1]] != room):  # it has changed since
            heapq.heappop(h)
        i, value = self.base + room, h[0][0] if h else math.inf
        while i and self.top[i] != value:
            self.top[i] = value
            i //= 2
            if i:
                value = min(self.top[2 * i], self.top[2 * i + 1])

    def change(self, k: int, room: int, cost: float) -> None:
        before, self.room[k], self.cost[k] = int(self.room[k]), room, cost
        heapq.heappush(self.heaps.setdefault(room, []), (cost, k))
        self._lift(before)
        self._lift(room)

    def add(self, k: int, size: int) -> None:
        self.change(k, int(self.room[k]) - size, self.cost[k] + _cost(size))

    def cheapest(self, least: int) -> int | None:
        lo, hi, best, at = self.base + least, 2 * self.base - 1, math.inf, 0
        while lo <= hi:
            if lo & 1:
                if self.top[lo] < best:
                    best, at = self.top[lo], lo
                lo += 1
            if not hi & 1:
                if self.top[hi] < best:
                    best, at = self.top[hi], hi
                hi -= 1
            lo //= 2
            hi //= 2
        if at == 0:
            return None
        while at < self.base:
            at = 2 * at if self.top[2 * at] == best else 2 * at + 1
        return self.heaps[at - self.base][0][1]


def _cost(size: int) -> float:
    return LINEAR * size + QUADRATIC * size * size


def cost_of(sizes: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The cost of each sequence."""
    return np.bincount(where, LINEAR * sizes + QUADRATIC * sizes.astype(np.float64) ** 2)


def _exchange(q: _Sequences, sizes: np.ndarray, place: np.ndarray, s: int) -> int | None:
    """A sequence that has room for s after one of its items was exchanged for a smaller one of another sequence, or None. sizes are in descending order; place is -1 for what isn't placed."""
    low, tried, n = -sizes, TRIED, len(sizes)
    rooms = np.where(place >= 0, q.room[place], -1)
    while True:
        cut = int(np.partition(q.room, len(q.room) - tried)[len(q.room) - tried]) if tried < len(q.room) else 0
        mine = np.flatnonzero(rooms >= cut)
        # the first item that is smaller by what is lacking, and some after it, if the room where it is takes the difference
        at = np.searchsorted(low, low[mine] + s - rooms[mine])
        for step in (0, 1, 3, 8, 20, 50, 120):
            j = np.minimum(at + step, n - 1)
            gain = sizes[mine] - sizes[j]
            ok = np.flatnonzero((gain >= s - rooms[mine]) & (gain <= rooms[j]) & (place[j] != place[mine]))
            if len(ok):
                best = ok[(gain[ok] - (s - rooms[mine[ok]])).argmin()]
                i, j = int(mine[best]), int(j[best])
                k, other, gain = int(place[i]), int(place[j]), int(sizes[i] - sizes[j])
                place[i], place[j] = other, k
                moved = _cost(int(sizes[i])) - _cost(int(sizes[j]))
                q.change(k, int(q.room[k]) + gain, q.cost[k] - moved)
                q.change(other, int(q.room[other]) - gain, q.cost[other] + moved)
                return k
        if cut == 0:
            return None
        tried *= MORE


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item of 1 to capacity tokens. Ties go by position. No items give an empty array."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    order = np.argsort(-sizes, kind="stable")
    down = sizes[order].astype(np.int64)
    place, left, opened = np.full(len(down), -1, np.int64), np.arange(len(down)), 0
    while len(left):
        # what is left over from the sequences before goes into the least number of further ones, by the same rule
        q = _Sequences(capacity, -(-int(down[left].sum()) // capacity))
        own = np.full(len(down), -1, np.int64)
        for i in left.tolist():
            s = int(down[i])
            k = q.cheapest(s)
            if k is None:
                k = _exchange(q, down[:i], own[:i], s)
            if k is not None:
                own[i] = k
                q.add(k, s)
        put = own >= 0
        place[put] = own[put] + opened
        opened += len(q.room)
        left = left[~put[left]]
    # a sequence that got nothing doesn't count
    place = np.unique(place, return_inverse=True)[1]
    out = np.empty(len(sizes), np.int64)
    out[order] = place
    return out


def sized(df: DataFrame, id_col: str, text_col: str, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, n, h): tokens and a hash of each text that isn't NULL or empty."""

    def measure(batches):
        e = encoder(tokenizer)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in portions(texts):
                hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in texts[lo:hi]], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(e.sizes(texts[lo:hi])), pa.array(hashes)], ["id", "n", "h"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text <> ''")
    return rows.mapInArrow(measure, "id long, n long, h long")


def fill_containers(df: DataFrame, id_col: str, text_col: str, capacity: int = 2048, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, part, token_start, n_tokens, container, position): each text's parts and where they went.

    part and token_start are 0 unless the text is above the capacity; such a text has a part for each full
    container and one for its rest. container is a string unique in the result and the same wherever the rows lie, position counts within it.
    NULL and empty texts have no parts; blank ones count like others. Rows that repeat, ids
    too, are items of their own; a NULL id is kept. An empty table gives no rows, other columns don't matter.
    """
    # rows of one id and text can't be told apart: they are counted before the shuffle and numbered
    same = cut(sized(df, id_col, text_col, tokenizer).groupBy("id", "n", "h").agg(F.count("*").alias("copies")))
    zero = F.lit(0).cast("long")
    rows = same.select("id", "n", "h", F.explode(F.sequence(zero, F.col("copies") - 1)).alias("copy"))
    parts = rows.select("*", F.explode(F.sequence(zero, F.greatest(zero, F.ceil(F.col("n") / capacity) - 1))).alias("part"))
    items = parts.select("id", "part", (F.col("part") * capacity).alias("token_start"), F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("part") * capacity).alias("n_tokens"), "h", "copy")
    name = F.concat_ws("_", F.concat(F.lit("w"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), F.hex("h"), F.col("copy").cast("string"), F.col("part").cast("string"))
    whole = items.where(F.col("n_tokens") == capacity).select("*", name.alias("container"), zero.alias("position"))
    rest = items.where(F.col("n_tokens") < capacity)
    blocks = max(1, -(-rest.count() // BLOCK))

    def fill(key, t):
        block = key[0].as_py()
        t = t.sort_by([("n_tokens", "descending"), ("id", "ascending"), ("part", "ascending"), ("h", "ascending"), ("copy", "ascending")])
        where = pack(t.column("n_tokens").to_numpy(), capacity)
        order = np.argsort(where, kind="stable")
        first = np.r_[True, np.diff(where[order]) != 0]
        run = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        position = np.empty(len(order), np.int64)
        position[order] = run
        return pa.table([*(t.column(c) for c in ("id", "part", "token_start", "n_tokens")), pa.array([f"b{block}_{k}" for k in where.tolist()]), pa.array(position)], names=["id", "part", "token_start", "n_tokens", "container", "position"])

    kind = "id long, part long, token_start long, n_tokens long, container string, position long"
    packed = rest.withColumn("block", F.pmod(F.xxhash64("id", "h", "copy", "part"), F.lit(blocks).cast("long"))).groupBy("block").applyInArrow(fill, kind)
    return packed.unionByName(whole.select("id", "part", "token_start", "n_tokens", "container", "position"))

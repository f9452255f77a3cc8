"""Problem 5: near-duplicates with small edits, by a MinHash LSH forest.

A signature is read as TREES tries. Every trie is sorted as a whole, across all tasks, so that texts with the longest
common prefixes lie side by side. Matching starts from those: neighbours that share LONG times the final prefix are verified and
grouped. Then the matched prefix is shortened to the length at which the tries together reach the target recall at the threshold
(`prefix_length`), and there every two texts of a bucket that aren't in one group yet are screened with 128 bits of further minima and
verified exactly on the texts. Both steps are the same at every size and for every bucket, however crowded: nothing is capped.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.copies import copy_groups
from adloom.llm.normal import bare
from adloom.operators.components import components
from adloom.session import cut, free

#: Tries, screening bits and least chance that a pair at the threshold meets in a trie.
TREES, BITS, TARGET = 20, 128, 0.93
#: Matching starts from prefixes this many times as long as the final ones.
LONG = 2
#: Texts of a bucket that one task compares with as many others at once, and pairs it holds at once.
BLOCK, PAIRS = 1024, 1 << 20
#: Least share of equal bits of a candidate: a pair at 0.6 expects 0.8 with a deviation of 0.035.
SCREEN = 0.69
_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_ROUNDS = np.random.default_rng(20240607).integers(1, 2**63, 64, np.int64).astype(np.uint64) | np.uint64(1)


def recall_at(similarity: float, length: int, trees: int = TREES) -> float:
    """The chance that two texts share a prefix of `length` minima in at least one trie."""
    return 1 - (1 - similarity**length) ** trees


def prefix_length(threshold: float, target: float = TARGET, trees: int = TREES) -> int:
    """The longest prefix that still reaches the target recall at the threshold: shortened from 64 until it does, 1 at least."""
    length = 64
    while length > 1 and recall_at(threshold, length, trees) < target:
        length -= 1
    return length


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    return x


def shingle_hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` characters of normalized texts, and the index of each one's text.
    A text shorter than width is one run."""
    pad = [t if len(t) >= width else t + "\x00" * (width - len(t)) for t in texts]
    codes = np.frombuffer("".join(pad).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, pad), np.int64, len(pad))
    owner = np.repeat(np.arange(len(pad)), lens)
    ends = np.cumsum(lens)
    n = len(codes) - width + 1
    h = np.zeros(max(n, 0), np.uint64)
    for i in range(width):
        h = h + (codes[i : i + n] + np.uint64(i + 1)) * _P[i % 5] * np.uint64(2 * (i // 5) + 1)
    keep = np.arange(max(n, 0)) + width <= ends[owner[: max(n, 0)]]
    return _mix(h[keep]), owner[: max(n, 0)][keep]


def _binned(h: np.ndarray, owner: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """One minimum for each bin of one permutation; empty bins take that of another bin drawn by a fixed sequence."""
    bin_of = ((h >> np.uint64(40)) * np.uint64(bins)) >> np.uint64(24)
    value = (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
    flat = np.full(rows * bins, 1 << 40, np.int64)
    np.minimum.at(flat, owner * bins + bin_of.astype(np.int64), value)
    sig = flat.reshape(rows, bins)
    rng = np.random.default_rng(bins)
    full = sig < 1 << 40
    out = sig.copy()
    empty = ~full
    while empty.any() and rows:
        donor = rng.integers(0, bins, bins)
        r, c = np.nonzero(empty)
        ok = full[r, donor[c]]
        out[r[ok], c[ok]] = sig[r[ok], donor[c[ok]]]
        empty[r[ok], c[ok]] = False
    return out


def signatures(texts: list[str], width: int, values: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts, values) minima, of 16 bits each, and two words of screening bits of normalized, non-empty texts."""
    h, owner = shingle_hashes(texts, width)
    sig = _binned(h, owner, len(texts), values)
    bits = _binned(_mix(h * _ROUNDS[0]), owner, len(texts), BITS)
    bits = (_mix(bits.astype(np.uint64) * _ROUNDS[1]) >> np.uint64(17)) & np.uint64(1)
    words = np.zeros((len(texts), 2), np.uint64)
    for i in range(BITS):
        words[:, i // 64] |= bits[:, i] << np.uint64(i % 64)
    return (_mix(sig.astype(np.uint64) * _ROUNDS[2]) >> np.uint64(20)).astype(np.uint16), words.view(np.int64)


def prefixes(sig: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts, TREES) hashes of each trie's first `length` minima, and of the LONG * length minima that follow each other from there:
    what comes after a trie's own minima are the next one's."""
    values = TREES * length
    key, rest = np.empty((len(sig), TREES), np.int64), np.empty((len(sig), TREES), np.int64)
    for t in range(TREES):
        x = np.full(len(sig), t + 1000 * length, np.uint64)
        for i in range(LONG * length):
            x = _mix(x * _ROUNDS[i % 64] + sig[:, (t * length + i) % values].astype(np.uint64) + np.uint64(1))
            if i == length - 1:
                key[:, t] = x.view(np.int64)
        rest[:, t] = x.view(np.int64)
    return key, rest


def similarity(a: str, b: str, width: int) -> float:
    x, y = (({s[i : i + width] for i in range(len(s) - width + 1)} or {s}) for s in (a, b))
    common = len(x & y)
    return common / (len(x) + len(y) - common)


def _signed(docs: DataFrame, width: int, values: int) -> DataFrame:
    """(id, text_hash, sig, b0, b1); rows without a letter or digit aren't there."""

    def sign(batches):
        for b in batches:
            texts = [bare(x) for x in b.column(1).to_pylist()]
            at = [i for i, t in enumerate(texts) if t]
            ids = b.column(0).take(pa.array(at, pa.int64()))
            for k in range(0, len(at), 512):
                part = [texts[i] for i in at[k : k + 512]]
                sig, words = signatures(part, width, values)
                yield pa.RecordBatch.from_arrays([ids.slice(k, 512), pa.array([xxhash.xxh3_128_digest(t) for t in part], pa.binary()), pa.array([r.tobytes() for r in sig], pa.binary()), pa.array(words[:, 0].copy()), pa.array(words[:, 1].copy())], ["id", "text_hash", "sig", "b0", "b1"])

    return docs.mapInArrow(sign, "id long, text_hash binary, sig binary, b0 long, b1 long")


def _filed(signed: DataFrame, length: int) -> DataFrame:
    """(key, rest, id): a row for each trie. rest tells longer prefixes apart, in 32 bits, so that they lie together when sorted."""

    def keys(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, TREES * length)
            key, rest = prefixes(sig, length)
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(sig)), TREES)))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array((rest.ravel() >> np.int64(32)).astype(np.int32)), ids], ["key", "rest", "id"])

    return signed.select("id", "sig").mapInArrow(keys, "key long, rest int, id long")


def _runs(batches, by: int):
    """Batches of a sorted partition as (columns, begins): whole runs of the first `by` columns at a time, and where each begins. A run is held until its end is seen."""

    def changes(cols):
        return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols[:by]], axis=0)])

    held = None
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        if not len(cols[0]):
            continue
        last = int(changes(cols)[-1])
        held = [c[last:] for c in cols]
        if last:
            done = [c[:last] for c in cols]
            yield done, changes(done)
    if held is not None:
        yield held, np.zeros(1, np.int64)


def _crowds(filed: DataFrame) -> DataFrame:
    """(key, id, before): the rows of buckets with more than one text; before is the neighbour that shares the longer prefix, if one does.

    The tries are sorted across tasks by ranges of all columns, so a crowded bucket is spread over as many tasks as it fills. A row at the end of a
    task is kept, as its bucket may go on in the next; it only lacks that neighbour.
    """

    def look(batches):
        past = None  # the row before, not yet told of
        first = True
        for b in batches:
            key, rest, ids = (c.to_numpy() for c in b.columns)
            if not len(key):
                continue
            if past is not None:
                key, rest, ids = (np.concatenate([[p], c]) for p, c in zip(past[:3], (key, rest, ids)))
            like = key[1:] == key[:-1]
            near = like & (rest[1:] == rest[:-1])
            prev_like = np.r_[first if past is None else past[3], like]
            before = np.r_[-1 if past is None else past[4], np.where(near, ids[:-1], -1)]
            has = np.r_[False if past is None else past[5], near]
            keep = prev_like[:-1] | like
            yield pa.RecordBatch.from_arrays([pa.array(key[:-1][keep]), pa.array(ids[:-1][keep]), pa.array(before[:-1][keep], mask=~has[:-1][keep])], ["key", "id", "before"])
            past, first = (key[-1], rest[-1], ids[-1], bool(prev_like[-1]), int(before[-1]), bool(has[-1])), False
        if past is not None:
            yield pa.RecordBatch.from_arrays([pa.array([past[0]], pa.int64()), pa.array([past[2]], pa.int64()), pa.array([past[4]], pa.int64(), mask=np.array([not past[5]]))], ["key", "id", "before"])

    return filed.repartitionByRange("key", "rest", "id").sortWithinPartitions("key", "rest", "id").mapInArrow(look, "key long, id long, before long")


def _across(crowds: DataFrame, groups: DataFrame, bits: DataFrame, screen: float) -> DataFrame:
    """Candidates (a, b): all pairs of a bucket that aren't in one group, screened.

    A bucket's largest group needs no pairs within itself, so only the rest meets it and itself: a bucket that lies in one group costs nothing, and one that
    mostly does costs what lies outside. Members are dealt into blocks by a hash and each two blocks are a group of their own, so no task gets a whole bucket.
    """
    least = BITS - int((1 - screen) * BITS)
    state = bits.join(groups.hint("merge"), "id", "left").select("id", F.coalesce("component", "id").alias("component"), "b0", "b1")
    x = rows = cut(crowds.select("key", "id").join(state.hint("merge"), "id"))
    sizes = x.groupBy("key", "component").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n"), F.sum("n").alias("all")).where("n < all")
    blocks = sizes.select("key", "main", F.ceil((F.col("all") - F.col("n")) / BLOCK).cast("int").alias("kr"), F.ceil(F.col("n") / BLOCK).cast("int").alias("km"))
    x = x.join(blocks.hint("merge"), "key")
    is_main = F.col("component") == F.col("main")
    x = x.withColumn("own", F.when(is_main, F.col("kr") + F.pmod(F.xxhash64("id"), "km")).otherwise(F.pmod(F.xxhash64("id"), "kr")).cast("int"))
    x = x.withColumn("other", F.explode(F.when(is_main, F.sequence(F.lit(0), F.col("kr") - 1)).otherwise(F.sequence(F.lit(0), F.col("kr") + F.col("km") - 1))))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    x = x.select("key", low.alias("low"), high.alias("high"), (F.col("own") == low).alias("left"), "id", "component", "b0", "b1")
    x = x.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", F.col("left").desc(), "id")

    def screened(batches):
        for (_, low, high, left, ids, component, b0, b1), begins in _runs(batches, 3):
            n, same = len(ids), low == high
            ends = np.append(begins[1:], n)
            size = ends - begins
            run = np.repeat(np.arange(len(begins)), size)
            lefts = np.add.reduceat(left.astype(np.int64), begins)
            # the rows a row meets: those after it in a block with itself, the other block's if it is of the left one
            start = np.where(same, np.arange(n) + 1, np.where(left, (begins + lefts)[run], ends[run]))
            count = ends[run] - start
            words = np.stack([b0, b1], 1).view(np.uint64)  # counting bits of signed numbers would count those of their absolute values
            at = 0
            while at < n:
                upto = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), PAIRS)) + at)
                c = count[at:upto]
                x = np.repeat(np.arange(at, upto), c)
                y = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c) + np.repeat(start[at:upto], c)
                ok = component[x] != component[y]
                x, y = x[ok], y[ok]
                ok = BITS - np.bitwise_count(words[x] ^ words[y]).sum(1, dtype=np.int64) >= least
                x, y = ids[x[ok]], ids[y[ok]]
                if len(x):
                    both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])
                at = upto

    found = cut(x.mapInArrow(screened, "a long, b long").distinct())
    free(rows)
    return found


def similar_groups(df: DataFrame, id_col: str, text_col: str, width: int = 5, threshold: float = 0.6, target: float = TARGET, screen: float = SCREEN, also: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(id, component) of every row that is linked to another, and (id_col, text_col, *also) of those rows and some more: rows whose sets of character
    runs have a Jaccard similarity of at least `threshold`, and what is connected through them.

    Texts are compared without case, width, whitespace and punctuation; rows without a letter or digit,
    NULL included, and NULL ids are no cases; a text shorter than width is one run. Exact copies are links and are
    folded before the search, so however many there are they cost one row. An id that several rows have stands for all their texts. Empty input
    gives no rows; other columns are ignored.
    """
    length = prefix_length(threshold, target)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    signed = cut(_signed(docs, width, TREES * length))
    firsts = signed.groupBy("text_hash").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    exact = cut(signed.select("id", "text_hash").join(firsts.hint("merge"), "text_hash").where("id <> a").select("a", F.col("id").alias("b"), "text_hash").distinct())
    reps = cut(signed.join(exact.select(F.col("b").alias("id"), "text_hash").hint("merge"), ["id", "text_hash"], "left_anti").select("id", "sig", "b0", "b1"))
    free(signed)
    crowds = cut(_crowds(_filed(reps, length)))

    def verify(batches):
        for b in batches:
            x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
            ok = [similarity(bare(p), bare(q), width) >= threshold for p, q in zip(x, y)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def of(ids: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias(id_col), text_col, *also)
        return cut(rows.join(ids.withColumnRenamed("id", id_col).hint("merge"), id_col, "left_semi"))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()

    def checked(pairs: DataFrame, rows: DataFrame) -> DataFrame:
        # plain inner joins, so AQE splits a text that is in very many pairs
        texts = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        return (
            pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")).hint("merge"), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")).hint("merge"), "b")
            .select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")
        )

    # the longest prefixes: neighbours in the sorted tries
    pairs = cut(crowds.where("before is not null").select(F.least("id", "before").alias("a"), F.greatest("id", "before").alias("b")).where("a < b").distinct())
    known = ends(pairs.unionAll(exact.select("a", "b"))).distinct()
    members = of(known)
    links = checked(pairs, members)
    groups = cut(components(links).select(F.col("node").alias("id"), "component"))
    # shortened to the target recall: what isn't in one group yet
    more = _across(crowds, groups, reps.select("id", "b0", "b1"), screen)
    members = members.unionAll(of(ends(more).join(known.hint("merge"), "id", "left_anti")))
    # an id with another text beside the copied one links what both are in
    twice = exact.select("a", "b").join(reps.select(F.col("id").alias("b")).hint("merge"), "b", "left_semi").select("a", "b")
    joined = components(checked(more, members).unionAll(groups.select(F.col("component").alias("a"), F.col("id").alias("b")).where("a <> b")).unionAll(twice))
    joined = cut(joined.select(F.col("node").alias("id"), "component"))
    # copies go where their first text is
    copies = exact.join(joined.withColumnRenamed("id", "a").hint("merge"), "a", "left").select("a", "b", F.coalesce("component", "a").alias("component"))
    alone = copies.where("component = a").select(F.col("a").alias("id"), "component")
    everyone = joined.unionAll(copies.select(F.col("b").alias("id"), "component")).unionAll(alone).distinct()
    free(reps, pairs, groups, crowds, more)
    return everyone, members


def version_groups(df: DataFrame, id_col: str, text_col: str, swap: tuple[str, ...], needed: tuple[str, ...]) -> DataFrame:
    """(first_id, version_id): similar_groups without those made up only of copies in the sense of copies.py."""
    groups, members = similar_groups(df, id_col, text_col, also=tuple(c for c in swap if c != text_col))
    groups = cut(groups)
    copies = copy_groups(members, id_col, swap, text_col, needed)
    kinds = groups.join(copies.select(F.col("copy_id").alias("id"), "first_id"), "id", "left").withColumn("kind", F.coalesce("first_id", "id"))
    mixed = kinds.groupBy("component").agg(F.min("kind").alias("lo"), F.max("kind").alias("hi")).where("lo <> hi").select("component")
    return groups.join(mixed, "component", "left_semi").where("id <> component").select(F.col("component").alias("first_id"), F.col("id").alias("version_id"))

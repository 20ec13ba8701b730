"""Near-duplicate texts by SimHash fingerprints that differ in few bits, found by Golay-code keys.

The binary Golay code divides all words of 23 bits among 4096 codewords at distance three or less.
The codewords near a word are its own one and, if that is three bits away, the five at distance
four. Two words that differ in two bits or fewer have one in common; two that differ in one bit: the
own codeword of one is near the other.

A fingerprint of 64 bits is three segments of 22, 21 and 21 bits. With four errors at most, either a
segment has none, and then another has two or fewer; or two segments have one each. So a pair meets
under (one segment as it is, near codewords of another), or under (near codewords of two segments
on one side, own codewords on the other). What meets is verified by counting bits.

The second kind of key has 24 bits. It is needed only where all segments have errors, which are then one, one and
one or two; so such a pair has a near codeword of the third segment in common as well, and a key that is met too often
is divided by these, to 36 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinset.llm.common import as_bytes, hold, keep, sorted_runs
from skeinset.llm.components import components

SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0b101011100011  # of the Golay code
RUN_LIMIT = 20_000
SMALL_RUN = 64
_PROBE, _OWN, _BOTH = 0, 1, 2
_PAIRS = tuple(combinations(range(len(SEGMENTS)), 2))  # tags of keys, before those with a whole segment
_TAG_BIT = 34
_REFINED = 1 << 58  # tells divided runs from others


def fingerprint_of(text: bytes, words: int) -> int:
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        grams = [joined]
    else:
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = np.concatenate([[0], ends[:-words]]).tolist()
        grams = [joined[a:b] for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]
    hashed = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashed), 1 << 14):
        bits = np.unpackbits(hashed[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashed), bitorder="little").view("<i8")[0])


def fingerprint(text: str | Column, words: int = 4) -> Column:
    """The fingerprint of each text as a bigint; no words give zero."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        hold("simhash", int)
        return pa.array([fingerprint_of(t, words) for t in as_bytes(texts)], pa.int64())

    return simhash(text)


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error to the own codeword, errors to the codewords near, and how many those are."""
    bit = np.empty(23, dtype=np.int64)
    power = 1
    for i in range(23):
        bit[i] = power
        power <<= 1
        if power >> 11:
            power ^= GENERATOR
    own = np.zeros(2048, dtype=np.int64)
    for weight in (1, 2, 3):
        for places in combinations(range(23), weight):
            own[np.bitwise_xor.reduce(bit[list(places)])] = sum(1 << p for p in places)
    near, count = np.zeros((2048, 6), dtype=np.int64), np.empty(2048, dtype=np.int64)
    for s in range(2048):
        errors = {int(own[s]), *((1 << i) ^ int(own[s ^ bit[i]]) for i in range(23))}
        count[s] = len(errors)
        near[s, : len(errors)] = sorted(errors)
    return own, near, count


def syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for i in range(22, 10, -1):
        rest ^= np.where(rest >> i & 1, GENERATOR << (i - 11), 0)
    return rest


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the own codeword; indices of all near ones, six a row; which of the six are set."""
    own, near, count = golay()
    s = syndromes(words)
    return (words ^ own[s]) >> 11, (words[:, None] ^ near[s]) >> 11, np.arange(6) < count[s][:, None]


def segment(prints: np.ndarray, i: int) -> np.ndarray:
    at, n = SEGMENTS[i]
    return (prints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the rows they belong to. Low bits of a key: probe, own, or both at once."""
    segments = [segment(prints, i) for i in range(len(SEGMENTS))]
    coded = [near_codewords(s) for s in segments]
    rows, keys, tag = [], [], 0

    def add(at: np.ndarray, left: np.ndarray, right: np.ndarray, role: int) -> None:
        rows.append(at)
        keys.append(((np.int64(tag) << _TAG_BIT | left << 12 | right) << 2) | role)

    everyone = np.arange(len(prints))
    for i, j in _PAIRS:
        add(everyone, coded[i][0], coded[j][0], _OWN)
        at, a, b = np.nonzero(coded[i][2][:, :, None] & coded[j][2][:, None, :])
        add(at, coded[i][1][at, a], coded[j][1][at, b], _PROBE)
        tag += 1
    for i in range(len(SEGMENTS)):
        for j in range(len(SEGMENTS)):
            if i != j:
                at, b = np.nonzero(coded[j][2])
                add(at, segments[i][at], coded[j][1][at, b], _BOTH)
                tag += 1
    return np.concatenate(keys), np.concatenate(rows)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for i in range(0, len(prints), 2048):
            part = prints[i : i + 2048]
            keys, at = keys_of(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[at].view(np.int64))], names=["key", "fp"])


def _divided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys on two segments, under each near codeword of the third; see the head of the module."""
    for batch in batches:
        for i in range(0, batch.num_rows, 8192):
            part = batch.slice(i, 8192)
            old, prints = part.column("key").to_numpy(), part.column("fp").to_numpy().view(np.uint64)
            run = old >> 2
            for tag, pair in enumerate(_PAIRS):
                mine = np.flatnonzero(run >> _TAG_BIT == tag)
                (third,) = set(range(len(SEGMENTS))) - set(pair)
                _, near, used = near_codewords(segment(prints[mine], third))
                at, a = np.nonzero(used)
                keys = (_REFINED | run[mine[at]] << 12 | near[at, a]) << 2 | old[mine[at]] & 3
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[mine[at]].view(np.int64))], names=["key", "fp"])


def forest(left: np.ndarray, right: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that join what is connected by pairs of ``left`` and ``right``, fewer than there are members."""
    rest, links = [left, right], []
    while len(rest[0]) and len(rest[1]):
        front = [(0, rest[0][0])]
        rest[0] = rest[0][1:]
        while front:
            side, x = front.pop()
            other = rest[1 - side]
            hit = np.bitwise_count(other ^ x) <= bits
            links += [(x, y) for y in other[hit] if x != y]
            front += [(1 - side, y) for y in other[hit]]
            rest[1 - side] = other[~hit]
    return links


def links_in_runs(keys: np.ndarray, prints: np.ndarray, bits: int) -> np.ndarray:
    """Verified links among rows sorted by key: all pairs of small runs, a forest of each larger one."""
    start = np.flatnonzero(np.diff(keys >> 2, prepend=-1))
    end = np.append(start[1:], len(keys))
    role = keys & 3
    probes = np.add.reduceat(role == _PROBE, start)
    both = role[start] == _BOTH
    own_at = np.where(both, start, start + probes)
    probe_end = np.where(both, end, own_at)
    left, right = probe_end - start, end - own_at
    pairs = left * right
    pairs[both & (left == 1)] = 0
    found = []
    small = np.flatnonzero((pairs > 0) & (pairs <= SMALL_RUN))
    for some in np.array_split(small, 1 + len(small) // (1 << 14)):
        n = pairs[some]
        run = np.repeat(some, n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x = prints[start[run] + at // right[run]]
        y = prints[own_at[run] + at % right[run]]
        hit = (x != y) & (np.bitwise_count(x ^ y) <= bits)
        found.append(np.stack([x[hit], y[hit]], axis=1))
    for r in np.flatnonzero(pairs > SMALL_RUN):
        links = forest(prints[start[r] : probe_end[r]], prints[own_at[r] : end[r]], bits)
        if links:
            found.append(np.array(links, dtype=np.uint64))
    pairs = np.concatenate(found) if found else np.empty((0, 2), dtype=np.uint64)
    return np.unique(np.sort(pairs, axis=1), axis=0)


def _as_batch(links: np.ndarray, key: np.ndarray | None = None) -> pa.RecordBatch:
    flat = [pa.array(links[:, i].view(np.int64)) for i in (0, 1)]
    hot = pa.nulls(len(links), pa.int64()) if key is None else pa.array(key)
    return pa.RecordBatch.from_arrays([*flat, hot], names=["a", "b", "key"])


def _link_runs(bits: int, limit: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, rows in sorted_runs(batches, 2, limit):
            keys, prints = rows.column("key").to_numpy(), rows.column("fp").to_numpy().view(np.uint64)
            if whole:
                yield _as_batch(links_in_runs(keys, prints, bits))
            else:
                yield _as_batch(np.stack([prints, prints], axis=1), keys)

    return link


def _link_tiles(bits: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in sorted_runs(batches, 0, 1 << 62):
            tile, prints = rows.column("tile").to_numpy(), rows.column("fp").to_numpy().view(np.uint64)
            role = rows.column("role").to_numpy()
            for t in np.unique(tile):
                mine, theirs = prints[(tile == t) & (role != _OWN)], prints[(tile == t) & (role != _PROBE)]
                yield _as_batch(np.array(forest(mine, theirs, bits), dtype=np.uint64).reshape(-1, 2))

    return link


def links(prints: DataFrame, bits: int = MAX_BITS, run_limit: int = RUN_LIMIT) -> DataFrame:
    """Links ``a, b`` between fingerprints (bigint column ``fp``, all different) of ``bits`` or fewer
    differing bits: enough to connect all that any such links connect.

    A key of more than ``run_limit`` fingerprints isn't handled by the task that meets it. If it is one of
    two codewords, it is divided by those of the third segment. The rows of keys that can't be divided, or are
    still met too often, are dealt out again as tiles, one block of it against another.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be 0 to {MAX_BITS}")

    def meet(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
        met = keyed.repartition(F.shiftright("key", 2)).sortWithinPartitions("key")
        found = keep(met.mapInArrow(_link_runs(bits, run_limit), "a bigint, b bigint, key bigint"), "near")
        return found.filter("key is null").select("a", "b"), found.filter("key is not null").selectExpr("key", "a as fp")

    near, hot = meet(prints.select("fp").mapInArrow(_keyed, "key bigint, fp bigint"))
    if hot.isEmpty():
        return near
    on_two = F.shiftright("key", 2 + _TAG_BIT) < len(_PAIRS)
    more, still = meet(hot.filter(on_two).mapInArrow(_divided, "key bigint, fp bigint"))
    near, hot = near.union(more), hot.filter(~on_two).union(still)
    if hot.isEmpty():
        return near
    hot = hot.selectExpr("shiftright(key, 2) as run", "key & 3 as role", "fp")
    sizes = hot.groupBy("run").agg(F.ceil(F.count("*") / F.lit(run_limit)).alias("blocks"))
    placed = hot.join(sizes, "run").withColumn("at", F.expr("pmod(xxhash64(fp), blocks)"))
    # a probe visits every block of own rows; of rows that are both, lower blocks visit higher ones
    spread = (
        placed.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .selectExpr(
            "fp",
            f"case when role = {_PROBE} then array(struct(at as i, other as j, {_PROBE} as role))"
            f" when role = {_OWN} then array(struct(other as i, at as j, {_OWN} as role))"
            f" when at = other then array(struct(at as i, at as j, {_BOTH} as role))"
            f" when at < other then array(struct(at as i, other as j, {_PROBE} as role))"
            f" else array(struct(other as i, at as j, {_OWN} as role)) end as place",
            "run",
        )
        .selectExpr("xxhash64(run, place[0].i, place[0].j) as tile", "fp", "cast(place[0].role as bigint) as role")
    )
    tiles = spread.repartition("tile").sortWithinPartitions("tile")
    return near.union(tiles.mapInArrow(_link_tiles(bits), "a bigint, b bigint, key bigint").select("a", "b"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = MAX_BITS
) -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row of ``docs``; other columns are not used.

    ``component_id`` is the smallest id among all texts that can be reached by links, the own one
    included. Equal texts, and all texts without words (null ones too), share a fingerprint and so a
    component. A null id takes part but is no component's id unless no other is there.
    """
    prints = keep(docs.select(F.col(id_col), fingerprint(text_col, words).alias("fp")), "prints")
    known = _groups(prints, id_col, bits).select("fp", "component_id")
    return prints.join(known, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _groups(prints: DataFrame, id_col: str, bits: int) -> DataFrame:
    """``fp, root, component_id`` for every fingerprint of ``prints``."""
    first = keep(prints.groupBy("fp").agg(F.min(id_col).alias("first")), "first")
    roots = components(links(first, bits))
    linked = first.join(roots, first.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return linked.join(least, "root").select("fp", "root", "component_id")


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` that are the first of their component: that with the smallest id, a null id last.

    Rows are told apart by their place and not by their ids, which may be missing or repeat: of rows with equal
    ids in one component one stays, and rows with equal ids in two components both do. All texts without words,
    null ones too, are one component. No rows give none.
    """
    marked = keep(docs.withColumns({"__at": F.monotonically_increasing_id(), "__fp": fingerprint(text_col, words)}), "marked")
    prints = marked.select("__at", F.col(id_col).alias("__id"), F.col("__fp").alias("fp"))
    order = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__at").alias("at"))
    lowest = prints.groupBy("fp").agg(F.min(order).alias("lowest"))
    groups = _groups(prints, "__id", bits)
    stay = lowest.join(groups, "fp").groupBy("root").agg(F.min("lowest").alias("lowest"))
    return marked.join(stay.select(F.col("lowest.at").alias("__at")), "__at", "left_semi").select(*docs.columns)

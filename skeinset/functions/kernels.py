"""Numpy helpers that run inside tasks.

They are sent with the tasks that use them, so executors need not have this package installed.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STRIP_CELLS = 50_000
QUERY_STRIP = 128
ROW_STRIP = 8192
PACK_NUMBERS = 1 << 20
GROUP_NUMBERS = 1 << 19


def distances(x: np.ndarray, y: np.ndarray, p: float = 2) -> np.ndarray:
    """Distances of order ``p``, summed coordinate by coordinate as the column form does."""
    total = np.zeros((len(x), len(y)))
    gap = np.empty_like(total)
    for a, b in zip(np.ascontiguousarray(x.T)[:, :, None], np.ascontiguousarray(y.T)):
        np.subtract(a, b, out=gap)
        if p == 2:
            np.multiply(gap, gap, out=gap)
        else:
            np.power(np.abs(gap, out=gap), p, out=gap)
        total += gap
    return np.sqrt(total, out=total) if p == 2 else np.power(total, 1.0 / p, out=total)


def row_distances(x: np.ndarray, y: np.ndarray, p: float = 2) -> np.ndarray:
    """The distance of each row of ``x`` to the same row of ``y``, summed as ``distances`` does."""
    total = np.zeros(len(x))
    for a, b in zip(x.T, y.T):
        gap = a - b
        total += gap * gap if p == 2 else np.abs(gap) ** p
    return np.sqrt(total) if p == 2 else total ** (1.0 / p)


def strips(x: np.ndarray, width: int) -> Iterator[slice]:
    """Row ranges of ``x`` whose distance table to ``width`` rows fits the processor cache."""
    step = max(1, STRIP_CELLS // max(width, 1))
    for start in range(0, len(x), step):
        yield slice(start, start + step)


def values(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    """The list in one cell of an Arrow batch."""
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def first_per_query(rows: pa.Table, k: np.ndarray, one_per_distance: bool) -> pa.Table:
    """The first ``k[q]`` rows of each ``q`` in the order of all columns, which begin with ``q, dist``."""
    keys = [(c, "ascending") for c in rows.column_names]
    rows = rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_start"))
    if one_per_distance and rows.num_rows:
        q, dist = (rows.column(c).to_numpy() for c in ("q", "dist"))
        rows = rows.filter(pa.array(np.append(True, (np.diff(q) != 0) | (np.diff(dist) != 0))))
    q = rows.column("q").to_numpy()
    return rows.filter(pa.array(np.arange(len(q)) - np.searchsorted(q, q) < k[q]))


def nearest_rows(numbers: list[np.ndarray], words: list[pa.Array], k: np.ndarray, one_per_distance: bool):
    """A function on Arrow batches that gives the ``k[q]`` nearest rows of a task to each query ``q``.

    ``numbers`` and ``words`` hold a column of the queries each. Batches have the same columns first,
    then what is carried along, in whose order rows of equal distance are taken. A task keeps ``k``
    rows per query, and of the rows it meets only looks at those within the ``k``-th distance so far. Of a
    strip of rows, least and greatest values and the words that occur show which queries it is too far from.
    """
    kinds = [w.unique() for w in words]
    asked = [pc.index_in(w, value_set=kind).to_numpy() for w, kind in zip(words, kinds)]

    def least(x: list[np.ndarray], codes: list[np.ndarray], some: slice) -> np.ndarray:
        """No row of a strip is nearer to a query than this, up to rounding."""
        total = np.zeros(len(k[some]))
        for a, b in zip(x, numbers):
            gap = np.maximum(np.maximum(a.min() - b[some], b[some] - a.max()), 0.0)
            total += gap * gap
        for a, b in zip(codes, asked):
            total += ~np.isin(b[some], a)
        return total * (1 - 1e-9)

    def gaps(x: list[np.ndarray], codes: list[np.ndarray], some: np.ndarray) -> np.ndarray:
        total = np.zeros((len((x + codes)[0]), len(k[some])))
        for a, b in zip(x, numbers):
            gap = b[some] - a[:, None]
            total += gap * gap
        for a, b in zip(codes, asked):
            total += a[:, None] != b[some]
        return total

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, pa.Table] = {}
        bound = np.full(len(k), np.inf)
        for batch in batches:
            for start in range(0, batch.num_rows, ROW_STRIP):
                part = batch.slice(start, ROW_STRIP)
                columns = part.columns
                x = [c.to_numpy(zero_copy_only=False) for c in columns[: len(numbers)]]
                if any(np.isnan(c).any() for c in x):
                    raise ValueError("a numeric value is missing")
                named = columns[len(numbers) : len(numbers) + len(kinds)]
                codes = [pc.fill_null(pc.index_in(c, value_set=s), -1).to_numpy() for c, s in zip(named, kinds)]
                carried = pa.Table.from_batches([part]).select(range(len(numbers) + len(kinds), len(columns)))
                for at in range(0, len(k), QUERY_STRIP):
                    some = slice(at, at + QUERY_STRIP)
                    some = at + np.flatnonzero(least(x, codes, some) <= bound[some])
                    if not len(some):
                        continue
                    d, most = gaps(x, codes, some), k[some].max()
                    if not one_per_distance and len(d) >= most and np.isinf(bound[some]).any():
                        bound[some] = np.minimum(bound[some], np.partition(d, most - 1, axis=0)[most - 1])
                    row, q = np.nonzero(d <= bound[some])
                    if not len(row):
                        continue
                    close = carried.take(pa.array(row))
                    found = pa.table([pa.array(some[q]), pa.array(d[row, q]), *close.columns], ["q", "dist", *close.column_names])
                    kept = pa.concat_tables([held[at], found]) if at in held else found
                    kept = held[at] = first_per_query(kept, k, one_per_distance).combine_chunks()
                    strip = slice(at, at + QUERY_STRIP)
                    n = np.bincount(kept.column("q").to_numpy() - at, minlength=len(k[strip]))
                    full = n >= k[strip]
                    bound[strip][full] = kept.column("dist").to_numpy()[(np.cumsum(n) - 1)[full]]
        for kept in held.values():
            yield from kept.to_batches()

    return search


def boxed(x: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Rows of ``x`` in runs of at most ``most``, halved across their widest coordinate until they are that few."""

    def cut(at: np.ndarray) -> Iterator[np.ndarray]:
        runs = -(-len(at) // most)
        if runs <= 1:
            yield at
            return
        part, middle = x[at], most * (runs // 2)
        order = np.argpartition(part[:, int((part.max(axis=0) - part.min(axis=0)).argmax())], middle)
        yield from cut(at[order[:middle]])
        yield from cut(at[order[middle:]])

    return cut(np.arange(len(x)))


def packed_centroids(rows: int, pivots: np.ndarray, p: float):
    """A function on Arrow batches ``cid, c`` that makes rows of at most ``rows`` centroids near each other.

    Of successive centroids, ``PACK_NUMBERS`` numbers or one block are held and cut into blocks by their coordinates.
    """
    most = rows * max(1, PACK_NUMBERS // max(rows * pivots.shape[1], 1))

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        cids = table.column(0).to_numpy()
        x = table.column(1).combine_chunks().flatten().to_numpy().reshape(len(cids), -1)
        for some in boxed(x, rows):
            some = some[np.argsort(cids[some])]  # the first of equal distances is then that of the lowest number
            away = distances(x[some], pivots, p)
            columns = [cids[some], x[some].ravel(), away.min(axis=0), away.max(axis=0)]
            yield pa.RecordBatch.from_pydict({n: [c] for n, c in zip(("cids", "flat", "low", "high"), columns)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - size)
                batch = batch.slice(part.num_rows)
                held.append(part)
                size += part.num_rows
                if size == most:
                    yield from packed(held)
                    held, size = [], 0
        if held:
            yield from packed(held)

    return run


def least_distances(x: np.ndarray, away: np.ndarray | None, box: tuple[np.ndarray, ...], p: float) -> np.ndarray:
    """No centroid of ``box`` is nearer to a row than this.

    A box has the bounds of its centroids' coordinates and of their distances to the pivots; ``away`` are the
    rows' distances to those, if they are to count. Of order 2 the gaps to a box round as ``distances`` does, never
    above it.
    """
    low, high, ring_low, ring_high = box
    total = np.zeros(len(x))
    for a, least, most in zip(x.T, low, high):
        gap = np.maximum(np.maximum(least - a, a - most), 0.0)
        total += gap * gap if p == 2 else gap**p
    bound = np.sqrt(total, out=total) if p == 2 else total ** (1.0 / p) * (1 - 1e-9)
    if away is not None:
        ring = np.maximum(ring_low - away, away - ring_high) - 1e-11 * (away + ring_high)
        bound = np.maximum(bound, ring.max(axis=1))
    return bound


class Found:
    """The nearest centroid of each row of ``x`` so far, and the distances to it and to the next one.

    The triangle inequality on pivots is for vectors of more coordinates than there are pivots; orders below 1 have none.
    """

    def __init__(self, x: np.ndarray, pivots: np.ndarray, p: float, second: bool):
        self.x, self.away, self.p = x, distances(x, pivots, p), p
        self.pivoted = p >= 1 and x.shape[1] > len(pivots)
        self.cid = np.full(len(x), -1, dtype="int64")
        self.near, self.after = np.full(len(x), np.inf), np.full(len(x), np.inf)
        self.limit = self.after if second else self.near  # what is farther changes nothing

    def least(self, rows: np.ndarray, boxes: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
        """The least distances of ``rows`` to each of some boxes."""
        x = np.asfortranarray(self.x[rows])
        away = self.away[rows] if self.pivoted else None
        return [least_distances(x, away, box, self.p) for box in boxes]

    def look(self, rows: np.ndarray, blocks: list[tuple]) -> None:
        """Take blocks ``cids, table, low, high`` into account for ``rows``, for each row the nearest block first."""
        least = self.least(rows, [(table.min(axis=0), table.max(axis=0), low, high) for _, table, low, high in blocks])
        home = np.argmin(least, axis=0)
        for first_of_all in (True, False):
            for b, (cids, table, *_) in enumerate(blocks):
                some = rows[((home == b) == first_of_all) & ~(least[b] > self.limit[rows])]
                for s in strips(some, len(table)):
                    self._compare(some[s], cids, table)

    def _compare(self, at: np.ndarray, cids: np.ndarray, table: np.ndarray) -> None:
        d = distances(self.x[at], table, self.p)
        every, best = np.arange(len(d)), d.argmin(axis=1)
        first = d[every, best]
        d[every, best] = np.inf
        next_one = d.min(axis=1)
        near, after = self.near[at], self.after[at]
        wins = (first < near) | ((first == near) & (cids[best] < self.cid[at]))
        self.after[at] = np.where(wins, np.minimum(near, next_one), np.minimum(after, first))
        self.near[at[wins]], self.cid[at[wins]] = first[wins], cids[best[wins]]

    def array(self) -> pa.Array:
        after = pa.array(self.after, mask=~np.isfinite(self.after))
        return pa.StructArray.from_arrays([pa.array(self.cid), pa.array(self.near), after], names=["cid", "dist", "second"])


def nearest_in_blocks(blocks: list, pivots: np.ndarray, p: float, second: bool):
    """A function on vectors and ``cid, dist, second`` so far that takes some blocks of centroids into account.

    A block is looked at by the points that may have a centroid in it as near as the ones they know.
    """

    def nearest(vectors: pa.Array, known: pa.Array) -> pa.Array:
        found = Found(_rows(vectors, pivots.shape[1]), pivots, p, second)
        old = known.flatten()  # its fields, null where nothing is known
        found.cid[:] = pc.fill_null(old[0], -1).to_numpy()
        found.near[:], found.after[:] = (pc.fill_null(f, np.inf).to_numpy() for f in old[1:])
        values = [tuple(np.asarray(part) for part in sent.value) for sent in blocks]
        found.look(np.arange(len(found.x)), values)
        return found.array()

    return nearest


def box_tree(boxes: list[tuple[np.ndarray, ...]], some: np.ndarray | None = None) -> tuple:
    """``(box, number)`` of one box, or ``(box around them, (left, right))`` of halves across the widest coordinate."""
    some = np.arange(len(boxes)) if some is None else some
    if len(some) == 1:
        return boxes[some[0]], int(some[0])
    low, high, ring_low, ring_high = (np.array([boxes[i][k] for i in some]) for k in range(4))
    whole = low.min(axis=0), high.max(axis=0), ring_low.min(axis=0), ring_high.max(axis=0)
    middle = low + high
    order = some[np.argsort(middle[:, int((middle.max(axis=0) - middle.min(axis=0)).argmax())], kind="stable")]
    half = len(some) // 2
    return whole, (box_tree(boxes, order[:half]), box_tree(boxes, order[half:]))


def nearest_in_slices(slices: list, boxes: list[tuple[np.ndarray, ...]], pivots: np.ndarray, p: float, second: bool):
    """A function on batches of vectors that finds ``cid, dist, second`` among all blocks of all slices.

    A slice is a broadcast of some blocks and has a box. A task holds a group of points and one slice at a
    time. Each point first goes down the tree of boxes to the slice it is nearest to, and then to every other slice
    that is no farther than the centroids it knows.
    """
    tree = box_tree(boxes)

    def blocks_of(number: int) -> list[tuple]:
        # of several slices none stays in the worker's memory, as ``value`` would
        sent = slices[number]
        return sent.value if len(slices) == 1 else sent.load_from_path(sent._path)

    def nearest_one(found: Found, home: np.ndarray, node: tuple, rows: np.ndarray) -> None:
        _, below = node
        if not len(rows):
            return
        if isinstance(below, int):
            home[rows] = below
            found.look(rows, blocks_of(below))
            return
        left, right = found.least(rows, [box for box, _ in below])
        nearer = left <= right
        nearest_one(found, home, below[0], rows[nearer])
        nearest_one(found, home, below[1], rows[~nearer])

    def others(found: Found, home: np.ndarray, node: tuple, rows: np.ndarray) -> None:
        box, below = node
        if isinstance(below, int):
            rows = rows[home[rows] != below]
        rows = rows[~(found.least(rows, [box])[0] > found.limit[rows])]
        if not len(rows):
            return
        if isinstance(below, int):
            found.look(rows, blocks_of(below))
            return
        for child in below:
            others(found, home, child, rows)

    def grouped(held: list[np.ndarray]) -> pa.Array:
        found = Found(np.concatenate(held), pivots, p, second)
        every, home = np.arange(len(found.x)), np.full(len(found.x), -1)
        nearest_one(found, home, tree, every)
        others(found, home, tree, every)
        return found.array()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, numbers = [], 0
        for vectors in batches:
            held.append(_rows(vectors, pivots.shape[1]))
            numbers += held[-1].size
            if numbers >= GROUP_NUMBERS:
                yield grouped(held)
                held, numbers = [], 0
        if held:
            yield grouped(held)

    return run


class _Sums:
    """Sums of vectors by the place of their centroid, and what finding the centroids took."""

    def __init__(self, cids: np.ndarray, size: int):
        self.cids, self.sums, self.n = cids, np.zeros((len(cids), size)), np.zeros(len(cids), dtype="int64")
        self.compared = self.distances = 0

    def add(self, x: np.ndarray, owner: np.ndarray, work: np.ndarray) -> None:
        self.compared += int((work > 1).sum())
        self.distances += int(work.sum(dtype="int64"))
        if len(x):
            order = np.argsort(owner, kind="stable")
            at, first, n = np.unique(owner[order], return_index=True, return_counts=True)
            self.sums[at] += np.add.reduceat(x[order], first, axis=0)
            self.n[at] += n

    def batches(self) -> Iterator[pa.RecordBatch]:
        """``cid, n, sums``: a row per centroid with points, and one of no centroid with the work in place of sums."""
        rows = [(int(self.cids[i]), int(self.n[i]), self.sums[i]) for i in np.flatnonzero(self.n)]
        for cid, n, sums in [*rows, (None, 0, [float(self.compared), float(self.distances)])]:
            columns = [pa.array([cid], pa.int64()), pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["cid", "n", "sums"])


def _rows(vectors: pa.Array, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def summed_owners(cids: np.ndarray, size: int):
    """A function on Arrow batches ``v, cid, upper, lower, work`` that sums vectors by their ``cid``; see ``_Sums``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Sums(cids, size)
        for batch in batches:
            owner = np.searchsorted(cids, batch.column("cid").to_numpy())
            total.add(_rows(batch.column("v"), size), owner, batch.column("work").to_numpy())
        yield from total.batches()

    return run


def bounded_owners(now: tuple[np.ndarray, np.ndarray], moves: tuple[np.ndarray, ...], p: float, sums: bool):
    """A function on Arrow batches ``v, cid, upper, lower, work`` that finds the nearest of the centroids ``now``.

    ``cid, upper, lower`` hold for the centroids as they were; ``moves`` tells what has become of each: its
    number, its place now, the way it has gone, the longest way of the others, and for each centroid now
    the distance to the nearest other one. Only points whose bounds meet have their own distance taken, and
    all distances if they meet still. The result is the same columns, or with ``sums`` the sums by centroid.
    Bounds are widened by more than rounding can be off, so that equal distances are always compared.
    """
    (cids, table), (old, place, moved, others, least) = now, moves
    more, less = 1 + 1e-10, 1 - 1e-10

    def settle(x: np.ndarray, cid: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        was = np.searchsorted(old, cid)
        owner, work = place[was], np.zeros(len(x), dtype="int32")
        high = (upper + moved[was]) * more
        low = lower * less - others[was] * more
        known = np.isfinite(high)
        low[known] = np.maximum(low[known], least[owner[known]] * less - high[known])
        near = np.flatnonzero(known & ~(high < low))
        if len(near):
            own = row_distances(x[near], table[owner[near]], p)
            work[near] = 1
            high[near] = own * more
            low[near] = np.maximum(low[near], least[owner[near]] * less - high[near])
        open_ = np.flatnonzero(~(high < low))
        for s in strips(open_, len(table)):
            at = open_[s]
            d = distances(x[at], table, p)
            every, best = np.arange(len(d)), d.argmin(axis=1)
            owner[at], high[at] = best, d[every, best] * more
            d[every, best] = np.inf
            low[at] = d.min(axis=1) * less
            work[at] += len(table)
        return owner, high, low, work

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Sums(cids, table.shape[1])
        for batch in batches:
            x = _rows(batch.column("v"), table.shape[1])
            owner, high, low, work = settle(x, *(batch.column(c).to_numpy() for c in ("cid", "upper", "lower")))
            if sums:
                total.add(x, owner, work)
            else:
                found = [pa.array(a) for a in (cids[owner], high, low, work)]
                yield pa.RecordBatch.from_arrays([batch.column("v"), *found], names=["v", "cid", "upper", "lower", "work"])
        if sums:
            yield from total.batches()

    return run


def race_times(text: str, n: int) -> Iterator[tuple[int, float]]:
    """Places 1 to ``n`` of a value's points and their rising times, from hashes of ``text`` and the place."""
    time = 0.0
    for j in range(1, n + 1):
        draw = int(hashlib.md5(f"{text}:{j}".encode()).hexdigest()[:13], 16)
        time += -math.log((draw + 1.0) / (1 << 52)) / (n - j + 1)
        yield j, time

"""Word sequences that occur more than once, found level by level at doubled lengths.

Of any run of ``window`` words, the sequence of a quarter of its length with the lowest hash is its
anchor; runs with equal words have equal anchors. Only anchors are looked at on the first level, and
only those whose words occur more than once anywhere go on. What stands around them is compared at
twice that length, and what is still not alone, at twice again: the windows themselves.

Texts are named by a digest of 128 bits, so copies are one text that is known to be repeated. A first
level key of more than ``run_limit`` places is not gathered in one task: its windows are counted as
rows, which Spark sums up before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinset.llm.common import as_bytes, hold, keep, release, salted_join, sorted_runs, utf8

WINDOW = 35
RUN_LIMIT = 20_000
CACHED_WORDS = 150_000
_PLACE_BITS = 28
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def levels(window: int) -> tuple[int, int, int]:
    """Lengths of the three levels, each at most twice the one before."""
    half = -(-window // 2)
    return -(-half // 2), half, window


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Sequence:
    """Hashes of all word sequences of a text, any length."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        self.n = n
        size = 1 << max(12, n.bit_length())
        h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(h * _powers(_BASE, size)[:n], out=self.sums[1:])
        self.back = _powers(pow(_BASE, -1, 1 << 64), size)

    def of(self, length: int) -> np.ndarray:
        """Hash of the sequence of ``length`` words at each place."""
        h = (self.sums[length:] - self.sums[: self.n + 1 - length]) * self.back[: self.n + 1 - length]
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        return h


def anchors(grams: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the lowest hash among ``starts`` neighbours, and the first and last window of each."""
    if len(grams) > 1 << _PLACE_BITS:
        raise ValueError(f"a text of more than {1 << _PLACE_BITS} word sequences")
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= starts:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < starts:
        gap = starts - width
        least = np.minimum(least[:-gap], least[gap:])
    place = (least & mask).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return place[first], first, np.append(first[1:], len(place)) - 1


def _anchor_rows(window: int):
    short, _, _ = levels(window)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("substrings", _HASHES.clear)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                keys, digests, places = [], [], []
                for digest, text in zip(part.column(0).to_pylist(), as_bytes(part.column(1))):
                    words = text.split()
                    if len(words) < window:
                        continue
                    grams = Sequence(words).of(short)
                    at, _, _ = anchors(grams, window - short + 1)
                    keys.append(grams[at].view(np.int64))
                    digests += [digest] * len(at)
                    places.append(at.astype(np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys)), pa.array(digests, pa.binary()), pa.array(np.concatenate(places))],
                        names=["key", "digest", "place"],
                    )

    return rows


_CANDIDATE = "key bigint, digest binary, first int, left bigint, right bigint, windows binary, hot boolean"


def _candidate_rows(window: int):
    """What stands around surviving anchors: hashes at twice the length on either side, and all windows."""
    short, half, _ = levels(window)
    fields = ["key", "digest", "first", "left", "right", "windows", "hot"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("substrings", _HASHES.clear)
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                out: list[list] = [[] for _ in fields]
                for digest, text, found in zip(
                    part.column(0).to_pylist(), as_bytes(part.column(1)), part.column(2).to_pylist()
                ):
                    seq = Sequence(text.split())
                    grams, halves, whole = seq.of(short), seq.of(half), seq.of(window)
                    at, first, last = anchors(grams, window - short + 1)
                    hot = {f["place"]: f["hot"] for f in found}
                    for p, a, b in zip(at.tolist(), first.tolist(), last.tolist()):
                        if p not in hot:
                            continue
                        right = halves[p] if p < len(halves) else 0
                        left = halves[p + short - half] if p + short >= half else 0
                        row = (grams[p], digest, a, left, right, whole[a : b + 1].tobytes(), hot[p])
                        for column, value in zip(out, row):
                            column.append(value)
                if not out[0]:
                    continue
                signed = [pa.array(np.array(out[k], dtype=np.uint64).view(np.int64)) for k in (0, 3, 4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        signed[0],
                        pa.array(out[1], pa.binary()),
                        pa.array(out[2], pa.int32()),
                        *signed[1:],
                        pa.array(out[5], pa.binary()),
                        pa.array(out[6], pa.bool_()),
                    ],
                    names=fields,
                )

    return rows


def _twice(values: np.ndarray) -> np.ndarray:
    """Whether each value occurs more than once."""
    _, back, count = np.unique(values, return_inverse=True, return_counts=True)
    return count[back] > 1


def _spans(digests: list[bytes], first: np.ndarray, counts: np.ndarray, hit: np.ndarray, window: int) -> pa.RecordBatch:
    """Runs of hit windows as spans of words; ``hit`` has ``counts`` windows of each row in turn."""
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(hit)) - np.repeat(np.cumsum(counts) - counts, counts)
    row, at = row[hit], at[hit]
    new = np.append(True, (np.diff(row) != 0) | (np.diff(at) != 1)) if len(row) else np.empty(0, dtype=bool)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row)) - 1 if len(row) else begin
    start = (first[row[begin]] + at[begin]).astype(np.int32)
    stop = (first[row[end]] + at[end] + window).astype(np.int32)
    names = pa.array(digests, pa.binary()).take(pa.array(row[begin]))
    return pa.RecordBatch.from_arrays([names, pa.array(start), pa.array(stop)], names=["digest", "start", "stop"])


def _repeated_windows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, run in sorted_runs(batches, 0, 1 << 62):
            left, right = (run.column(c).to_numpy() for c in ("left", "right"))
            alive = (_twice(left) & (left != 0)) | (_twice(right) & (right != 0))
            run = run.filter(pa.array(alive))
            if not run.num_rows:
                continue
            blobs = run.column("windows").to_pylist()
            counts = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
            hit = _twice(np.frombuffer(b"".join(blobs), dtype=np.uint64))
            yield _spans(run.column("digest").to_pylist(), run.column("first").to_numpy(), counts, hit, window)

    return rows


def _one_row_per_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 2000):
            part = batch.slice(i, 2000)
            blobs = part.column(2).to_pylist()
            counts = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = (part.column(1).to_numpy()[row] + at).astype(np.int32)
            hashes = np.frombuffer(b"".join(blobs), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), part.column(0).take(pa.array(row)), pa.array(start)], names=["hash", "digest", "start"]
            )


def _digest(text_col: str):
    return F.unhex(F.md5(utf8(text_col)))


def _copies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(_digest(text_col).alias("digest"), F.col(id_col).alias("id")).groupBy("digest").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies")
    )


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, run_limit: int = RUN_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """``digest, spans`` (word spans, end not included, overlapping or not) of texts that share windows
    with another text or inside themselves, and the texts concerned: ``digest, text``.

    Copies of a text are not compared with each other here.
    """
    if window < 4:
        raise ValueError("a window has at least four words")
    named = docs.select(_digest(text_col).alias("digest"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = named.select("digest", "text").mapInArrow(_anchor_rows(window), "key bigint, digest binary, place int")
    rows = keep(rows, "anchors")
    # a table of its own, so that the join below shuffles both sides and may split a frequent key
    again = keep(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "again")
    survivors = (
        rows.join(again, "key")
        .groupBy("digest")
        .agg(F.collect_set(F.struct("place", (F.col("n") > run_limit).alias("hot"))).alias("found"))
    )
    chosen = survivors.join(_copies(docs, id_col, text_col), "digest").select("digest", "found", "first_id")
    picked = named.join(chosen, (named.digest == chosen.digest) & named.id.eqNullSafe(chosen.first_id))
    texts = keep(picked.select(named.digest, "text", "found"), "candidates")
    release(rows)
    around = keep(texts.mapInArrow(_candidate_rows(window), _CANDIDATE), "windows")
    met = around.filter("not hot").repartition("key").sortWithinPartitions("key")
    spans = met.mapInArrow(_repeated_windows(window), "digest binary, start int, stop int")
    hot = around.filter("hot")
    if not hot.isEmpty():
        single = hot.select("digest", "first", "windows").mapInArrow(
            _one_row_per_window, "hash bigint, digest binary, start int"
        )
        again = keep(single.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "again")
        spans = spans.union(
            salted_join(single, again, "hash", "digest").select("digest", "start", (F.col("start") + window).cast("int").alias("stop"))
        )
    merged = spans.groupBy("digest").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return merged, texts.select("digest", "text").dropDuplicates(["digest"])


def cut(text: bytes, spans: list[dict]) -> tuple[int, list[bytes]]:
    """The number of words of a text, and the words outside all spans."""
    words = text.split()
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for s in spans:
        gone[s["start"]] += 1
        gone[s["stop"]] -= 1
    left = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
    return len(words), [words[i] for i in left]


def _without(text: Column, spans: Column, whole: bool = False) -> Column:
    """``n_words, n_removed, kept_sha256, kept_text`` (null unless ``whole``) of texts and their spans."""

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept_sha256: string, kept_text: string>")
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for text, found in zip(as_bytes(texts), spans.to_pylist()):
            n, left = cut(text, found or [])
            kept = b" ".join(left)
            rows.append((n, n - len(left), hashlib.sha256(kept).hexdigest(), kept.decode() if whole else None))
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["n_words", "n_removed", "kept_sha256", "kept_text"]
        )

    # A filter on the result would else be moved before it, with a second run of the function of its own.
    return without.asNondeterministic()(text, spans)


_NOTHING = hashlib.sha256(b"").hexdigest()


def repeats_removed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, run_limit: int = RUN_LIMIT
) -> DataFrame:
    """``id_col, n_words, n_removed, kept_sha256`` for every row of ``docs``.

    A word goes if a run of ``window`` words that covers it starts anywhere else as well, in the same
    text or another; copies of a text, repeated rows among them, remove each other. ``kept_sha256`` is
    that of the words left, joined by blanks. Null and empty texts have no words, and texts shorter
    than a window lose none. Other columns are not used; ids may be null or repeat.
    """
    none = F.lit(None).cast("array<struct<start: int, stop: int>>")
    each = docs.select(F.col(id_col), _digest(text_col).alias("digest"), _without(F.col(text_col), none).alias("w"))
    plain = each.select(id_col, "digest", "w.n_words", F.col("w.kept_sha256").alias("whole"))
    spans, texts = repeated_spans(docs, id_col, text_col, window, run_limit)
    changed = texts.join(spans, "digest").select("digest", _without(F.col("text"), F.col("spans")).alias("w"))
    result = changed.select("digest", F.col("w.n_removed").alias("removed"), F.col("w.kept_sha256").alias("left"))
    copies = _copies(docs, id_col, text_col).filter("copies > 1").select("digest", F.lit(True).alias("copied"))
    known = copies.join(result, "digest", "full")
    copied = F.col("copied").isNotNull() & (F.col("n_words") >= window)
    return plain.join(known, "digest", "left").select(
        id_col,
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copied, F.lit(_NOTHING)).otherwise(F.coalesce("left", "whole")).alias("kept_sha256"),
    )


def with_repeats_removed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, run_limit: int = RUN_LIMIT
) -> DataFrame:
    """``docs`` with its texts cut as in ``repeats_removed``, and ``__n_words, __n_removed``.

    A text that loses nothing stays as it is; of another the words left are joined by blanks.
    """
    spans, texts = repeated_spans(docs, id_col, text_col, window, run_limit)
    copies = _copies(docs, id_col, text_col).filter("copies > 1").select("digest", F.lit(True).alias("__copied"))
    known = copies.join(spans, "digest", "full").withColumnsRenamed({"digest": "__digest", "spans": "__spans"})
    joined = docs.withColumn("__digest", _digest(text_col)).join(known, "__digest", "left")
    found = joined.withColumn("__w", _without(F.col(text_col), F.col("__spans"), whole=True))
    copied = F.col("__copied").isNotNull() & (F.col("__w.n_words") >= window)
    removed = F.when(copied, F.col("__w.n_words")).otherwise(F.col("__w.n_removed"))
    text = F.when(copied, F.lit("")).when(F.col("__w.n_removed") > 0, F.col("__w.kept_text")).otherwise(F.col(text_col))
    return found.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.col("__w.n_words").alias("__n_words"),
        removed.alias("__n_removed"),
    )

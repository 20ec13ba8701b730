"""Passages of benchmark items in texts, by Wu-Manber search over words.

A table over hashes of blocks of two words says how far the search may jump; blocks that share a place there
take the shorter jump. At a block that ends patterns, the bucket of its hash lists them in the order of their
own hashes, and the words are compared. Patterns of one length are searched together; all long items give
patterns of one length. Everything is held in arrays: some 35 bytes a word of the items.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinset.llm.common import as_bytes, keep, release

WINDOW = 10
SLICE_BYTES = 32_000_000  # of items; some 250 MB when built
MOST_JUMPS = 1 << 27

_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of characters beyond ASCII."""
    return text.translate(_TABLE).split()


class Patterns:
    """Patterns of one length: jumps by block, and buckets of patterns by the block that ends them."""

    def __init__(self, length: int, items: list[tuple[int, bytes]]):
        """``items``: their numbers, and their words joined by a space."""
        m = self.length = length
        block = self.block = min(2, m)
        counts = [text.count(b" ") + 1 for _, text in items]
        self.items = [number for number, _ in items]
        self.firsts = [0, *accumulate(counts)][:-1]  # an item's first word
        size = 1 << max(10, (16 * sum(counts)).bit_length())
        self.mask = min(size, MOST_JUMPS) - 1
        jumps = np.full(self.mask + 1, m - block + 1, dtype=np.uint8 if m < 255 else np.int64)
        suffix, whole, starts, places = array("Q"), array("Q"), array("q"), array("q", [0])
        for first, (_, text) in zip(self.firsts, items):
            words = text.split(b" ")
            for word in words:
                places.append(places[-1] + len(word) + 1)
            for end in range(block, len(words) + 1):
                key = xxhash.xxh64_intdigest(b" ".join(words[end - block : end]))
                at, far = key & self.mask, max(m - end, 0)
                if far < jumps[at]:
                    jumps[at] = far
                if end >= m:
                    suffix.append(key)
                    whole.append(xxhash.xxh64_intdigest(b" ".join(words[end - m : end])))
                    starts.append(first + end - m)
        suffix, whole, starts = (np.frombuffer(v, dtype=v.typecode) for v in (suffix, whole, starts))
        order = np.lexsort((whole, suffix))
        self.suffix, self.whole, self.starts = suffix[order], whole[order], starts[order]
        self.jumps = jumps.tobytes() if jumps.itemsize == 1 else jumps
        self.text = b" ".join(text for _, text in items)
        self.places = np.array(places)

    def bucket(self, key: int, words: list[bytes]) -> set[int]:
        """Items that hold these words, whose last ones have the hash ``key``."""
        a, b = np.searchsorted(self.suffix, np.uint64(key), "left"), np.searchsorted(self.suffix, np.uint64(key), "right")
        if a == b:
            return set()
        text = b" ".join(words)
        mine, found = np.uint64(xxhash.xxh64_intdigest(text)), set()
        for i in range(a + np.searchsorted(self.whole[a:b], mine, "left"), a + np.searchsorted(self.whole[a:b], mine, "right")):
            start = int(self.starts[i])
            if self.text[self.places[start] : self.places[start + self.length] - 1] == text:
                found.add(self.items[bisect_right(self.firsts, start) - 1])
        return found

    def search(self, words: list[bytes]):
        """Places and items of all patterns found."""
        m, block, jumps, mask, n = self.length, self.block, self.jumps, self.mask, len(words)
        digest, at = xxhash.xxh64_intdigest, m
        while at <= n:
            key = digest(words[at - 2] + b" " + words[at - 1] if block == 2 else words[at - 1])
            jump = jumps[key & mask]
            if jump:
                at += jump
                continue
            items = self.bucket(key, words[at - m : at])
            if items:
                yield at - m, items
            at += 1


class Searcher:
    """All windows of some items, ready to be sent to tasks."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        by_length: dict[int, set[tuple[int, bytes]]] = {}
        for name, text in items:
            words = words_of(text)
            if words:
                by_length.setdefault(min(window, len(words)), set()).add((place[name], b" ".join(words)))
        self.sets = [Patterns(m, sorted(found)) for m, found in sorted(by_length.items())]

    def hits(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, spans of hit words (united, end not included), items."""
        words = words_of(text)
        spans, items = [], set()
        for patterns in self.sets:
            for at, found in patterns.search(words):
                spans.append((at, at + patterns.length))
                items |= found
        return len(words), united(spans), items


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_KIND = "n_words: bigint, n_hit: bigint, spans: array<struct<start: bigint, end: bigint>>, item_ids: array<string>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("spans", pa.list_(_SPAN)),
        ("item_ids", pa.list_(pa.string())),
        ("contaminated", pa.bool_()),
    ]
)


def _finder(sent):
    @F.arrow_udf(f"struct<{_KIND}, contaminated: boolean>")
    def find(texts: pa.Array, before: pa.Array) -> pa.Array:
        searcher, rows = sent.value, []
        for text, known in zip(as_bytes(texts), before.to_pylist()):
            n, spans, items = searcher.hits(text)
            names = {searcher.names[i] for i in items}
            if known:
                spans = united(spans + [(s["start"], s["end"]) for s in known["spans"]])
                names.update(known["item_ids"])
            rows.append(
                {
                    "n_words": n,
                    "n_hit": sum(b - a for a, b in spans),
                    "spans": [{"start": a, "end": b} for a, b in spans],
                    "item_ids": sorted(names),
                    "contaminated": bool(spans),
                }
            )
        return pa.array(rows, _RESULT)

    return find


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    found: str = "found",
    window: int = WINDOW,
    item_col: str = "item_id",
    item_text: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` with a column ``found``: a struct of ``n_words, n_hit, spans, item_ids, contaminated``.

    An item's windows are its runs of ``window`` words, or all its words if they are fewer. ``spans``
    are the united word spans inside occurrences, ``item_ids`` the items that have any, sorted as
    strings; an item without an id counts as the empty string, repeated items as one. Null and empty
    texts have no words; items without words are never found. All columns of ``docs`` are kept; one
    that is named as ``found`` is replaced.

    A benchmark of at most ``slice_bytes`` of text is sent to tasks at once; of a longer one each
    slice is sent in turn, and texts are searched once for each. What is found so far is then written with the
    rows, and a slice is given up before the next is built.
    """
    named = F.coalesce(F.col(item_col).cast("string"), F.lit(""))
    items = benchmark.select(named.alias("name"), F.col(item_text).alias("t")).filter("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).head()[0] or 0
    n = 1 + int(total) // slice_bytes
    context = docs.sparkSession.sparkContext
    before = F.lit(None).cast(f"struct<{_KIND}, contaminated: boolean>")
    out = docs.withColumn("__found", before)
    for i in range(n):
        mine = items.filter(F.pmod(F.xxhash64("t"), F.lit(n)) == i).collect()
        sent = context.broadcast(Searcher([(r["name"], r["t"].encode()) for r in mine], window))
        searched = out.withColumn("__found", _finder(sent)(F.col(text_col), F.col("__found")))
        if i + 1 < n:
            searched = keep(searched, "searched")
            sent.destroy()
            if i:
                release(out)
        out = searched
    return out.withColumn(found, F.col("__found")).drop("__found")

"""Sequences of bounded length from whole documents, by vector best-fit.

A bin has three residual capacities: tokens, documents and attention cost (the sum of squared piece
lengths). Pieces go from long to short into the open bin that meets every constraint and scores best:
by the weighted dot-product of demand and residual, both as parts of the capacity, or by the smallest
weighted norm of what would be left. Where none fits, a bin is opened.

Only a piece's length matters for its place, so the packing is worked out on the number of pieces of
each length: a table of at most ``tokens`` rows whatever the number of documents. Bins in the same
state are one entry, and an entry takes as many equal pieces at once as it would take one by one.
The outcome says, for ranges of ranks among the pieces of a length, which bins take them and where;
each piece finds its range by its rank, and no piece moves but for that rank.
"""

from __future__ import annotations

import re
import struct
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skeinset.llm.common import as_bytes, hold
from skeinset.llm.tokens import tokenizer

RANK_ROWS = 200_000
CACHED_TOKENS = 400_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and how the residuals weigh. The limits must let any single piece in."""

    tokens: int = 4096
    documents: int = 4096
    attention: float = 4096.0**2
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    score: str = "norm"

    def __post_init__(self):
        if self.score not in ("norm", "dot"):
            raise ValueError("score is 'norm' or 'dot'")
        if self.tokens < 1 or self.documents < 1 or self.attention < self.tokens**2:
            raise ValueError("a single piece must fit")


@dataclass
class Placements:
    """Ranges of ranks by length: ``key`` is where a range starts, the rest tells where its pieces go."""

    key: np.ndarray
    first_bin: np.ndarray
    per_bin: np.ndarray
    offset: np.ndarray
    n_bins: int

    @staticmethod
    def keyed(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return (length.astype(np.int64) << 44) | rank.astype(np.int64)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of each piece."""
        key = self.keyed(length, rank)
        at = np.searchsorted(self.key, key, "right") - 1
        inside = key - self.key[at]
        return self.first_bin[at] + inside // self.per_bin[at], self.offset[at] + inside % self.per_bin[at] * length


def best_fit(lengths: list[tuple[int, int]], capacity: Capacity) -> Placements:
    """Vector best-fit decreasing over ``(length, number of pieces)``."""
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=float)
    weights = np.array(capacity.weights)
    first, count, left = np.empty(64, dtype=np.int64), np.zeros(64, dtype=np.int64), np.zeros((64, 3))
    entries, bins = 0, 0
    out: list[tuple[int, int, int, int]] = []

    def scores(rest: np.ndarray, demand: np.ndarray) -> np.ndarray:
        if capacity.score == "dot":
            return (weights * rest / limits * demand / limits).sum(axis=-1)
        return -(weights * ((rest - demand) / limits) ** 2).sum(axis=-1)

    for length, todo in sorted(lengths, reverse=True):
        demand = np.array([length, 1, float(length) ** 2])
        rank = 0
        while todo:
            fits = (count[:entries] > 0) & (left[:entries] >= demand).all(axis=1)
            if fits.any():
                at = np.flatnonzero(fits)
                e = int(at[np.argmax(scores(left[at], demand))])
                n, start, rest = int(count[e]), int(first[e]), left[e].copy()
            else:
                e, n, start, rest = -1, todo, bins, limits.copy()
            # pieces that one bin takes in a row: as long as it stays the best choice
            others = scores(left[:entries][fits], demand).max() if fits.any() else -np.inf
            times, after = 1, rest - demand
            while times < todo and (after >= demand).all() and (e < 0 or scores(after, demand) >= others):
                times, after = times + 1, after - demand
            used = min(n, todo // times)
            offset = capacity.tokens - int(rest[0])
            out.append((Placements.keyed(np.int64(length), np.int64(rank)), start, times, offset))
            todo -= used * times
            rank += used * times
            if e < 0:
                bins += used
            elif used == n:
                count[e] = 0
            else:
                first[e], count[e] = start + used, n - used
            if entries == len(count):
                kept = np.flatnonzero(count[:entries])
                entries = len(kept)
                grown = max(64, 2 * entries)
                first, count, left = first[kept], count[kept], left[kept]
                first = np.append(first, np.zeros(grown, dtype=np.int64))
                count = np.append(count, np.zeros(grown, dtype=np.int64))
                left = np.append(left, np.zeros((grown, 3)), axis=0)
            first[entries], count[entries], left[entries] = start, used, after
            entries += 1
    out.sort()
    table = np.array(out, dtype=np.int64).reshape(-1, 4)
    return Placements(*table.T.copy(), n_bins=bins)


def pack(pieces: DataFrame, keys: list[str], length_col: str = "length", capacity: Capacity = Capacity()) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; columns of these names are replaced.

    ``keys`` are columns that spread and order pieces of equal length; rows equal in all of them take
    their places in any order. Offsets inside a sequence have no gaps. Lengths are 1 to the capacity;
    null or other lengths are an error.
    """
    base = pieces.drop("sequence_id", "offset")
    sizes = base.groupBy(F.col(length_col).cast("bigint").alias("n")).count().collect()
    if any(r["n"] is None or not 1 <= r["n"] <= capacity.tokens for r in sizes):
        raise ValueError("a piece's length must be 1 to the capacity")
    plan = best_fit([(r["n"], r["count"]) for r in sizes], capacity)
    sent = base.sparkSession.sparkContext.broadcast(plan)

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def placed(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = sent.value.place(length.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(c) for c in found], names=["sequence_id", "offset"])

    counts = base.sparkSession.createDataFrame(
        pa.table({"__n": pa.array([r["n"] for r in sizes], pa.int64()), "__of": pa.array([r["count"] for r in sizes], pa.int64())})
    )
    slot = F.expr(f"pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), cast(ceil(__of / {RANK_ROWS}) as bigint))")
    dealt = (
        base.withColumn("__n", F.col(length_col).cast("bigint"))
        .join(F.broadcast(counts), "__n")
        .withColumn("__slot", slot)
        .drop("__of")
    )
    before = Window.partitionBy("__n").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("__n", "__slot")
        .count()
        .select("__n", "__slot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    )
    within = Window.partitionBy("__n", "__slot").orderBy(*keys)
    ranked = dealt.join(offsets, ["__n", "__slot"]).withColumn("__rank", F.col("__before") + F.row_number().over(within) - 1)
    return ranked.withColumn("__at", placed(F.col("__n"), F.col("__rank"))).select(
        *[F.col(c) for c in base.columns], F.col("__at.sequence_id").alias("sequence_id"), F.col("__at.offset").alias("offset")
    )


# Texts of these characters only: canonical composition leaves them alone and lower case is one to one.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_TOKENS = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\\sa-zß-öø-ÿ0-9]+")


def byte_letters() -> list[str]:
    """The letter a byte-level vocabulary has for each byte: itself where that is visible, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _TokenIds(dict):
    """Ids of what the pre-tokenizer of a lower-case vocabulary with word ends gives, by the library's model."""

    def __init__(self, model):
        self.model, self.letters = model, byte_letters()

    def __missing__(self, token: str) -> bytes:
        if len(self) > CACHED_TOKENS:
            self.clear()
        found = self.model.tokenize("".join(map(self.letters.__getitem__, token.encode())))
        value = self[token] = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        return value


class _TextIds:
    """Token ids of texts as bytes, for tokenizers that drop white space and never join over it.

    Most texts are split here as the pre-tokenizer does it, and equal parts are encoded once. Others are
    encoded by the library, word by word.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.parts = _TokenIds(self.tokenizer.model)
        tried = ["It's  a\nStraße,", "ÀÉÎÖÜÿ", "a1b22 don'tx'll x''re", "--a.b!! 'd", "Ñandú's <a|b>", "ÿ0ß'd9 "]
        # whether splitting gives what the library gives, tried on all kinds of words
        self.splits = all(self._split(t) == self._whole(t) for t in tried)

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, _TOKENS.findall(text.lower())))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def of(self, raw: bytes) -> bytes:
        text = raw.decode()
        if self.splits and "<|" not in text and _PLAIN.fullmatch(text):
            return self._split(text)
        return b"".join(self._whole(w.decode()) for w in raw.split())


@lru_cache(maxsize=1)
def _text_ids(path: str) -> _TextIds:
    return _TextIds(path)


def ids_of(text: bytes, path: str) -> bytes:
    """Ids of a text as little-endian 32-bit numbers."""
    return _text_ids(path).of(text)


def _forget() -> None:
    _text_ids.cache_clear()
    tokenizer.cache_clear()


def token_ids(text: str | Column, path: str, end: int | None = None) -> Column:
    """Ids of each text as an array, with the id ``end`` added; null counts as empty.

    ``path`` names a tokenizer file that drops white space and never joins over it; equal parts of
    texts are then encoded once.
    """
    close = b"" if end is None else np.array([end], dtype="<u4").tobytes()

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        hold("packing", _forget)
        found = [np.frombuffer(ids_of(t, path) + close, dtype="<i4") for t in as_bytes(texts)]
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        flat = np.concatenate(found) if found else np.empty(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return ids(text)


def cut_pieces(text: str | Column, path: str, end: int, tokens: int) -> Column:
    """Array of ``start, length, ids_crc32``: the pieces of at most ``tokens`` ids of each text.

    Ids are those of ``token_ids``. Only what is longer than ``tokens`` is cut. The checksum is over
    the piece's ids as unsigned little-endian 32-bit numbers.
    """
    close = np.array([end], dtype="<u4").tobytes()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    @F.arrow_udf("array<struct<start: bigint, length: bigint, ids_crc32: bigint>>")
    def cut(texts: pa.Array) -> pa.Array:
        hold("packing", _forget)
        rows = []
        for text in as_bytes(texts):
            ids = ids_of(text, path) + close
            parts = range(0, len(ids), 4 * tokens)
            found = [ids[i : i + 4 * tokens] for i in parts]
            rows.append(
                [{"start": i // 4, "length": len(p) // 4, "ids_crc32": zlib.crc32(p)} for i, p in zip(parts, found)]
            )
        return pa.array(rows, kind)

    return cut(text)


def document_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = 1, tokens: int = 4096
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32``: one row per piece of each document, empty ones too."""
    found = docs.select(F.col(id_col), cut_pieces(text_col, path, end, tokens).alias("__cut"))
    # Every text has a piece. The outer form keeps Spark from a filter on their number, which would cut all texts twice.
    return found.select(id_col, F.posexplode_outer("__cut").alias("piece", "__p")).select(id_col, "piece", "__p.*")

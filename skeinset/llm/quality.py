"""Text quality by the votes of the nearest labelled texts in a latent space.

Texts become counts of hashed features: words, shapes of words (case, digits, marks), shapes of
neighbouring words, and whether a word repeats the one before. Weighted by rarity and scaled, they are
projected on the leading singular directions of a bounded sample of labelled texts. The vectors of
that sample are sent to all tasks; each text is compared with all of them in blocks, and the most
similar ones vote with their similarity.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinset.llm.common import as_bytes

CACHED_WORDS = 150_000
_SHAPE = bytes(
    0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x30 if 0x30 <= c <= 0x39 else c
    for c in range(256)
)


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled texts used, and with ``features`` of each, driver and broadcast."""

    features: int = 4096
    dimensions: int = 64
    sample: int = 4000
    neighbours: int = 25
    power: float = 4.0
    prior_weight: float = 0.05
    block: int = 2048
    seed: int = 7


def shape(word: bytes) -> bytes:
    """Kinds of characters of a word, equal neighbours as one."""
    kinds = word.translate(_SHAPE)
    out = bytearray()
    for c in kinds:
        if not out or out[-1] != c:
            out.append(c)
    return bytes(out[:8])


class _Known(dict):
    """Feature numbers of a word and of its shape, by word."""

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > CACHED_WORDS:
            self.clear()
        half = self.size // 2
        kind = shape(word)
        value = self[word] = (
            xxhash.xxh64_intdigest(word.lower(), 1) % half,
            half + xxhash.xxh64_intdigest(kind, 2) % (half // 4),
        )
        return value


@lru_cache(maxsize=2)
def _known(size: int) -> _Known:
    return _Known(size)


def counts(text: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often they occur, damped by the logarithm."""
    words = text.split()
    if not words:
        return np.empty(0, dtype=np.int64), np.empty(0)
    found = np.array(list(map(_known(size).__getitem__, words)), dtype=np.int64)
    half, eighth = size // 2, size // 8
    word, kind = found[:, 0], found[:, 1]
    pair = half + eighth + (kind[:-1] * 31 + kind[1:]) % eighth
    same = half + 2 * eighth + (word[1:] == word[:-1]).astype(np.int64)
    tally = np.bincount(np.concatenate([word, kind, pair, same]), minlength=size)
    at = np.flatnonzero(tally)
    return at, np.where(at < half, np.log1p(tally[at]), tally[at] / np.sqrt(len(words)))


@dataclass
class Model:
    settings: Settings
    rarity: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    @staticmethod
    def fit(found: list[tuple[np.ndarray, np.ndarray]], labels: list[int], settings: Settings) -> Model:
        """A model from the features of texts, as ``counts`` gives them."""
        n, size = len(found), settings.features
        table = np.zeros((n, size), dtype=np.float32)
        for row, (at, value) in zip(table, found):
            row[at] = value
        rarity = np.log((1 + n) / (1 + (table > 0).sum(axis=0))).astype(np.float32) + 0.1
        table *= rarity
        table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
        rng = np.random.default_rng(settings.seed)
        wide = min(settings.dimensions + 16, size)
        basis = rng.standard_normal((size, wide)).astype(np.float32)
        for _ in range(4):
            basis, _ = np.linalg.qr(table.T @ (table @ basis))
        small = basis.T @ (table.T @ (table @ basis))
        values, directions = np.linalg.eigh(small)
        lead = np.argsort(values)[::-1][: settings.dimensions]
        projection = (basis @ directions[:, lead]).astype(np.float32)
        vectors = _unit(table @ projection)
        y = np.array(labels, dtype=np.float32)
        return Model(settings, rarity, projection, vectors, y, float(y.mean()) if n else 0.5)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        s = self.settings
        for i in range(0, len(texts), s.block):
            part = texts[i : i + s.block]
            made = np.zeros((len(part), s.dimensions), dtype=np.float32)
            for row, text in zip(made, part):
                at, value = counts(text, s.features)
                value = value * self.rarity[at]
                row[: self.projection.shape[1]] = value @ self.projection[at] / max(float(np.linalg.norm(value)), 1e-9)
            near = _unit(made[:, : self.projection.shape[1]]) @ self.vectors.T
            k = min(s.neighbours, near.shape[1])
            top = np.argpartition(near, -k, axis=1)[:, -k:] if k < near.shape[1] else np.tile(np.arange(k), (len(part), 1))
            weight = np.clip(np.take_along_axis(near, top, axis=1), 0, 1).astype(float) ** s.power
            votes = (weight * self.labels[top]).sum(axis=1) + s.prior_weight * self.prior
            out[i : i + s.block] = votes / (weight.sum(axis=1) + s.prior_weight)
        return np.clip(out, 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings = Settings()
) -> Model:
    """A model from the documents that rows of ``labels`` (with ``id_col``) name, with labels of 0 or 1.

    Of more than ``settings.sample`` such rows, those with the lowest hash of the id are used, whatever the
    length of their texts: tasks make features of these, and only features come to the driver. Null ids, labels
    and texts are left out. The chosen labels, of bounded number, are broadcast, so texts are not shuffled.
    """

    @F.arrow_udf("binary")
    def counted(texts: pa.Array) -> pa.Array:
        found = [counts(t, settings.features) for t in as_bytes(texts)]
        return pa.array([at.astype("<i4").tobytes() + value.astype("<f4").tobytes() for at, value in found], pa.binary())

    named = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    order = F.xxhash64(id_col)
    sample = named.orderBy(order, id_col, label_col).limit(settings.sample).select(id_col, F.col(label_col).alias("label"))
    texts = docs.select(id_col, F.col(text_col).alias("text")).filter("text is not null")
    rows = texts.join(F.broadcast(sample), id_col).select(id_col, "label", F.xxhash64("text").alias("tie"), counted("text").alias("found"))
    got = rows.orderBy(order, id_col, "label", "tie").limit(settings.sample).collect()
    halves = [(r["found"], len(r["found"]) // 2) for r in got]
    found = [(np.frombuffer(f, "<i4", n // 4), np.frombuffer(f, "<f4", n // 4, n)) for f, n in halves]
    return Model.fit(found, [r["label"] for r in got], settings)


def quality_score(docs: DataFrame, model: Model, text_col: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with ``score``, 0 to 1, higher where label 1 is likelier; a column of that name is replaced.

    Only the text counts. Null, empty and unlike texts get the share of label 1 among the sample.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(sent.value.scores(as_bytes(texts)))

    return docs.withColumn(score, scored(text_col))

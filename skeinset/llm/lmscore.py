"""Log-probabilities of texts by an n-gram model whose counts are held in a log-frequency Bloom filter.

A count ``c`` is kept as its level, the whole part of log2 ``c``: the filter holds the n-gram together with each
number from 0 to its level, and is asked with 0, 1, 2, ... until an answer is no. The level then stands for the
mean count of all n-grams of that level, so that counts are right on average. An n-gram is never missed; one in
about a hundred answers is a wrong yes, which adds a level.

Probabilities are interpolated: ``p(w | h) = (c(h w) + pull * p(w | shorter h)) / (c(h) + pull)``, down to the
word alone with 0.1 added to each count.

The filter grows with the corpus, so it is made in shards, by tasks, each as large as its n-grams need: a task that
reads texts sends a shard's n-grams of a batch in one row, and the counts are added up where the shard is made. It goes
to the workers in slices of ``slice_bytes`` at most, each a broadcast of its own. A task reads texts once, keeps
the n-grams of a group of them, and asks one slice after the other; it holds one at a time.

Exact counts of words (for ``base_score``) stay in a table. The most frequent words, of bounded number and
length, are broadcast; only others are joined, salted, from each text's list of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from skeinset.llm.common import as_bytes, hold, keep, salted_join

END = "\n"  # no word has white space
GROUP_BYTES = 12 << 20  # of texts whose n-grams are looked up together
PART_BYTES = 2 << 20  # of texts that are split into tokens at once
STRIP = 1 << 17  # n-grams that are hashed at once
ASKED = 1 << 19  # n-grams whose levels are looked up together
SENT = 1 << 18  # n-grams that are sent to shards at once
ADDED = 1 << 22  # n-grams of a shard that are added up at once
LEVELS = 63
_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """``pull`` weighs the shorter history, in tokens; ``bits`` and ``probes`` are per entry of the filter."""

    order: int = 2
    pull: float = 100.0
    bits: int = 10
    probes: int = 5
    shard_bytes: int = 2 << 20  # of training text to a shard of the filter
    slice_bytes: int = 32 << 20  # of the filter in one broadcast
    hot_words: int = 100_000
    hot_length: int = 64


class Tokens(NamedTuple):
    """``ids`` of all texts, each its words and an end; ``ends`` are the places after them; ``words`` by id."""

    ids: np.ndarray
    ends: np.ndarray
    words: pa.Array

    @staticmethod
    def of(texts: pa.Array) -> Tokens:
        lower = pa.array([t.lower() for t in as_bytes(texts)], pa.large_binary())  # A-Z, being bytes; and no slice of an array
        parts = pc.ascii_split_whitespace(lower.cast(pa.large_string()))
        coded = parts.flatten().dictionary_encode()
        words, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        real = ids != pc.index(words, "").as_py()
        text = np.repeat(np.arange(len(texts)), parts.value_lengths().to_numpy())
        ends = np.cumsum(np.bincount(text[real], minlength=len(texts)) + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, len(words), dtype=np.int64)
        inside = np.ones(len(out), dtype=bool)
        inside[ends - 1] = False
        out[inside] = ids[real]
        return Tokens(out, ends, pa.concat_arrays([words, pa.array([END], words.type)]))

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_ODD = 0x2545F4914F6CDD1D


def hashed_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: sums of its bytes' numbers times powers of an odd one, all words at once."""
    binary = pa.concat_arrays([words.cast(pa.large_binary())])
    ends = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    raw = np.frombuffer(binary.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    power = np.cumprod(np.concatenate([[_U(1)], np.full(len(raw), _ODD, dtype=_U)]))
    back = np.cumprod(np.concatenate([[_U(1)], np.full(len(raw), pow(_ODD, -1, 1 << 64), dtype=_U)]))
    sums = np.concatenate([[_U(0)], np.cumsum(_BYTE[raw] * power[:-1])])
    a, b = ends[:-1] - ends[0], ends[1:] - ends[0]
    return mixed((sums[b] - sums[a]) * back[a] + (b - a).astype(_U))


_START = hashed_words(pa.array(["\n\n"]))


def longer_grams(tokens: Tokens, one: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 2 to ``order``: which tokens have such an n-gram, and its key. A text's first n-gram begins with its start."""
    place = np.arange(len(tokens.ids)) - np.repeat(tokens.starts, np.diff(tokens.ends, prepend=0))
    own = one[tokens.ids]
    last = own
    for n in range(2, order + 1):
        before = np.concatenate([_START, last[:-1]])
        before[place == 0] = _START[0]
        last = mixed(before * _U(0x9E3779B97F4A7C15) + own + _U(n))
        yield place >= n - 2, last


def by_shard(keys: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards of n-grams, in order, and the places of their n-grams."""
    shard = (keys % _U(n_shards)).astype(np.min_scalar_type(n_shards))
    order = np.argsort(shard, kind="stable")
    return shard[order], order.astype(np.min_scalar_type(-len(keys) - 1))


def _entries(keys: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes of n-grams with a number begin, and how far each goes, of 2^32."""
    h = mixed(keys + (np.atleast_1d(level).astype(_U) + _U(1)) * _U(0xD1B54A32D192ED03))
    return (h >> _U(32)).astype(np.uint32), h.astype(np.uint32) | np.uint32(1)


def _bits_at(begin: np.ndarray, step: np.ndarray, size: np.ndarray | int, probe: int) -> np.ndarray:
    return ((begin + np.uint32(probe) * step).astype(_U) * np.asarray(size).astype(_U, copy=False)) >> _U(32)


def filter_of(keys: np.ndarray, counts: np.ndarray, bits: int, probes: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The filter of n-grams and counts; how many n-grams each level has, and the sum of their counts."""
    level = np.frexp(counts.astype(float))[1] - 1
    n = level + 1
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    flags = np.zeros(-(-int(n.sum()) * bits // 8) * 8, dtype=bool)
    if len(flags) >> 32:
        raise ValueError("too many n-grams for one shard")
    entries = _entries(np.repeat(keys, n), number)
    for probe in range(probes):
        flags[_bits_at(*entries, len(flags), probe)] = True
    held = np.bincount(level, minlength=LEVELS), np.bincount(level, weights=counts, minlength=LEVELS)
    return np.packbits(flags, bitorder="little").tobytes(), *held


@dataclass
class Slice:
    """Consecutive shards: their first number, places of their first bytes, and the bytes."""

    first: int
    starts: np.ndarray
    data: np.ndarray

    def levels(self, keys: np.ndarray, shard: np.ndarray, probes: int) -> np.ndarray:
        """The level of each n-gram, -1 if it isn't held. All are of this slice's shards."""
        at = shard.astype(np.int64) - self.first
        out = np.full(len(keys), -1, dtype=np.int8)
        left = np.flatnonzero(self.starts[at + 1] > self.starts[at])
        for level in range(LEVELS):
            if not len(left):
                break
            left = np.concatenate([self._held(keys, at, left[i : i + STRIP], level, probes) for i in range(0, len(left), STRIP)])
            out[left] = level
        return out

    def _held(self, keys: np.ndarray, at: np.ndarray, left: np.ndarray, level: int, probes: int) -> np.ndarray:
        """Those places of ``left`` whose n-gram the filter holds with a level."""
        begin, step = _entries(keys[left], level)
        start = self.starts[at[left]]
        size = ((self.starts[at[left] + 1] - start) * 8).view(_U)
        for probe in range(probes):
            bit = _bits_at(begin, step, size, probe).view(np.int64)
            yes = np.flatnonzero(((self.data[start + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1).view(bool))
            left, begin, step, start, size = left[yes], begin[yes], step[yes], start[yes], size[yes]
        return left


@dataclass
class Model:
    """``words``: the table ``word, n``; ``shards``: the table ``shard, bits`` of the filter; ``means``: the count
    that stands for no level, level 0, 1, ...; ``tokens`` and ``distinct``: of the training texts."""

    settings: Settings
    words: DataFrame
    shards: DataFrame
    n_shards: int
    means: np.ndarray
    tokens: int
    distinct: int

    @property
    def denominator(self) -> float:
        return self.tokens + 0.1 * (self.distinct + 1)

    def slices(self) -> Iterator[Slice]:
        """Slices of ``slice_bytes`` at most, or of one shard, made on the driver one at a time.

        Shards come in order, a partition of them at a time, so that no slice is there as rows and as bytes at once.
        """
        first, ends, data = 0, [0], bytearray()
        for r in self.shards.orderBy("shard").toLocalIterator():
            shard, bits = r["shard"], r["bits"]
            if data and len(data) + len(bits) > self.settings.slice_bytes:
                yield Slice(first, np.array(ends, dtype=np.int64), np.frombuffer(data, np.uint8))
                first, ends, data = first + len(ends) - 1, [0], bytearray()
            ends += [len(data)] * (shard - first - len(ends) + 1)  # shards without n-grams before it
            data += bits
            ends.append(len(data))
        ends += [len(data)] * (self.n_shards - first - len(ends) + 1)
        yield Slice(first, np.array(ends, dtype=np.int64), np.frombuffer(data, np.uint8))


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = Tokens.of(batch.column(0))
        n = np.bincount(tokens.ids, minlength=len(tokens.words))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([tokens.words.take(pa.array(some)).cast(pa.string()), pa.array(n[some])], names=["word", "n"])


def _grams_of(order: int, n_shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = Tokens.of(batch.column(0))
            if not len(tokens.ids):
                continue
            one = hashed_words(tokens.words)
            n = np.bincount(tokens.ids, minlength=len(one))
            found = [(np.append(one[n > 0], _START), np.append(n[n > 0], len(tokens.ends)))]
            found += [np.unique(keys[has], return_counts=True) for has, keys in longer_grams(tokens, one, order)]
            del tokens, one, n
            for keys, counts in found:
                shard, places = by_shard(keys, n_shards)
                for i in range(0, len(keys), SENT):
                    some, at = shard[i : i + SENT], places[i : i + SENT]
                    cuts = np.flatnonzero(np.append(True, some[1:] != some[:-1]))
                    ends = np.append(cuts, len(some)).astype(np.int32) * np.int32(8)
                    sent = [_packed(keys[at], ends), _packed(counts[at].astype(np.int64), ends)]
                    yield pa.RecordBatch.from_arrays([pa.array(some[cuts].astype(np.int32)), *sent], names=["shard", "keys", "counts"])

    return run


def _packed(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of the numbers, cut at ``ends``."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(numbers)])


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, and the sum of its counts."""
    order = np.argsort(keys)
    keys = keys[order]
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[cuts], np.add.reduceat(counts[order], cuts)


def _shards_of(bits: int, probes: int):
    def added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return counted(*(np.concatenate(c) for c in zip(*held)))

    def made(shard: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        data, items, totals = filter_of(*added(held), bits, probes)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([data], pa.binary()), pa.array([items]), pa.array([totals])],
            names=["shard", "bits", "items", "totals"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(shard)]):
                if held and now != shard[a]:
                    yield made(now, held)
                    held = []
                if not held:
                    now, size, most = int(shard[a]), 0, ADDED
                sent = (b"".join(batch.column(c).slice(a, b - a).to_pylist()) for c in ("keys", "counts"))
                held.append(tuple(np.frombuffer(s, kind) for s, kind in zip(sent, (_U, np.int64))))
                size += len(held[-1][0])
                if size > most:  # frequent n-grams come with every batch of texts
                    held = [added(held)]
                    size = len(held[0][0])
                    most = ADDED + 2 * size
        if held:
            yield made(now, held)

    return run


def train(docs: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> Model:
    """Counts of words and n-grams of all texts of ``docs``. A null text is an empty one: its end counts."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_shards = 1 + size // settings.shard_bytes
    words = texts.mapInArrow(_words_of, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = keep(words, "words")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    dealt = texts.mapInArrow(_grams_of(settings.order, n_shards), "shard int, keys binary, counts binary").repartition("shard")
    made = dealt.sortWithinPartitions("shard").mapInArrow(
        _shards_of(settings.bits, settings.probes), "shard int, bits binary, items array<bigint>, totals array<double>"
    )
    shards = keep(made, "shards")
    zipped = F.posexplode(F.arrays_zip("items", "totals")).alias("level", "z")
    sums = shards.select(zipped).groupBy("level").agg(F.sum("z.items").alias("n"), F.sum("z.totals").alias("total"))
    means = np.zeros(LEVELS + 1)
    for r in sums.filter("n > 0").collect():
        means[r["level"] + 1] = r["total"] / r["n"]
    for level in np.flatnonzero(means[1:] == 0):  # only met by wrong answers
        means[level + 1] = 1.5 * 2.0 ** int(level)
    return Model(settings, words, shards.select("shard", "bits"), n_shards, means, tokens, distinct)


class _Part(NamedTuple):
    """Texts of a group in small: columns for their rows, tokens, and each n-gram once."""

    columns: list[pa.Array]
    ids: np.ndarray
    starts: np.ndarray
    keys: list[np.ndarray]  # of words and the start, then of longer n-grams
    backs: list[np.ndarray]  # which of those a token has
    masks: list[np.ndarray]


class _Scorer:
    """Sums over the tokens of each text, as a task needs them."""

    def __init__(self, model: Model, slices: Sequence, hot):
        self.settings, self.means, self.n_shards = model.settings, model.means, model.n_shards
        self.denominator, self.slices, self.hot = model.denominator, slices, hot

    def part(self, ids: list[pa.Array], texts: pa.Array) -> _Part:
        """With the columns ``n_tokens, known, base, others``: the last two parts of counts not sent here, by word and times."""
        tokens = Tokens.of(texts)
        n, starts = np.diff(tokens.ends, prepend=0), tokens.starts
        hot, counted = self.hot.value
        found = pc.index_in(tokens.words.cast(pa.string()), value_set=hot)
        sent = found.is_valid().to_numpy(zero_copy_only=False)
        count = np.where(sent, np.append(counted, 0)[found.fill_null(-1).to_numpy()], 0)
        own = np.where(sent, np.log10((count + 0.1) / self.denominator), 0.0)
        known = np.add.reduceat((sent & (count > 0))[tokens.ids].astype(np.int64), starts)
        base = np.add.reduceat(own[tokens.ids], starts)
        rest = np.flatnonzero(~sent[tokens.ids])
        text = np.repeat(np.arange(len(texts)), n)[rest]
        pair, times = np.unique(text * len(tokens.words) + tokens.ids[rest], return_counts=True)
        at, word = pair // len(tokens.words), pair % len(tokens.words)
        others = pa.StructArray.from_arrays([tokens.words.take(pa.array(word)).cast(pa.string()), pa.array(times)], names=["word", "times"])
        offsets = pa.array(np.searchsorted(at, np.arange(len(texts) + 1)).astype(np.int32))
        columns = [*ids, pa.array(n), pa.array(known), pa.array(base), pa.ListArray.from_arrays(offsets, others)]
        one = hashed_words(tokens.words)
        keys, backs, masks = [np.append(one, _START)], [], []
        for has, gram in longer_grams(tokens, one, self.settings.order):
            some, back = np.unique(gram[has], return_inverse=True)
            keys.append(some)
            backs.append(back.astype(np.int32))
            masks.append(has)
        return _Part(columns, tokens.ids.astype(np.int32), starts, keys, backs, masks)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        shard, order = by_shard(keys, self.n_shards)  # a shard's bytes are then met together
        level = np.full(len(keys), -1, dtype=np.int8)
        for sent, first, last in self.slices:
            a, b = np.searchsorted(shard, np.array([first, last], dtype=shard.dtype))
            # of several slices none stays in the worker's memory, as ``value`` would
            part = sent.value if len(self.slices) == 1 else sent.load_from_path(sent._path)
            for i in range(a, b, ASKED):
                some = order[i : min(i + ASKED, b)]
                level[some] = part.levels(keys[some], shard[i : i + len(some)], self.settings.probes)
        return level

    def log_sums(self, part: _Part, found: list[np.ndarray]) -> np.ndarray:
        """log10 of the model's probability of each text; ``found`` are the counts of ``part.keys``."""
        shorter = found[0][part.ids]
        p = (shorter + 0.1) / self.denominator
        first = np.zeros(len(p), dtype=bool)
        first[part.starts] = True
        pull = self.settings.pull
        for has, back, counts in zip(part.masks, part.backs, found[1:]):
            history = np.concatenate([[0.0], shorter[:-1]])
            history[first] = found[0][-1]
            own = np.zeros(len(p))
            own[has] = counts[back]
            p = np.where(has, (np.minimum(own, history) + pull * p) / (history + pull), p)
            shorter = own
        return np.add.reduceat(np.log10(p), part.starts)

    def columns(self, parts: list[_Part]) -> Iterator[list[pa.Array]]:
        """The columns of each part of a group, whose n-grams are looked up together and not kept in the parts."""
        sizes = [[len(k) for k in p.keys] for p in parts]
        keys = np.concatenate([k for p in parts for k in p.keys])
        for part in parts:
            part.keys.clear()
        level = np.split(self.levels(keys), np.cumsum([n for s in sizes for n in s])[:-1])
        del keys
        found = (self.means[v + 1] for v in level)
        for part, own in zip(parts, sizes):
            yield [*part.columns, pa.array(self.log_sums(part, [next(found) for _ in own]))]


def _small(texts: pa.Array) -> Iterator[slice]:
    """Runs of texts of about ``PART_BYTES``, or of one longer text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + PART_BYTES, "right"))
        yield slice(start, max(end, start + 1))
        start = max(end, start + 1)


_OTHERS = ArrayType(StructType([StructField("word", StringType()), StructField("times", LongType())]))
_SUMS = [
    StructField("n_tokens", LongType()), StructField("__known", LongType()), StructField("__base", DoubleType()),
    StructField("__others", _OTHERS), StructField("score", DoubleType()),
]


def score(docs: DataFrame, model: Model, id_cols: Sequence[str], text_col: str = "text") -> DataFrame:
    """``id_cols, n_tokens, n_known, base_score, score`` for each row of ``docs``.

    Tokens are the words, A-Z lower-cased, and an end. ``n_known`` counts those of the training texts,
    ``base_score`` adds up log10((c + 0.1) / (N + 0.1 (V + 1))) of each token's exact count, ``score`` the model's
    log10 probabilities. A null text is an empty one, a single end. Ids may be null and repeat; no column of
    ``docs`` but these and the text is looked at. No rows give none; a model of no texts knows no token.
    """
    spark, settings = docs.sparkSession, model.settings
    sent = []
    for part in model.slices():
        sent.append((spark.sparkContext.broadcast(part), part.first, part.first + len(part.starts) - 1))
        del part  # before the next one is made
    short = model.words.filter(F.octet_length("word") <= settings.hot_length)
    frequent = short.orderBy(F.desc("n"), "word").limit(settings.hot_words).toArrow()  # not as rows, which take several times that
    hot = spark.sparkContext.broadcast((frequent["word"].combine_chunks().cast(pa.string()), frequent["n"].to_numpy()))
    scorer = _Scorer(model, sent, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("lm", int)
        pa.default_memory_pool().release_unused()  # the worker may have served other stages
        parts, size = [], 0
        for batch in batches:
            for some in _small(batch.column(batch.num_columns - 1)):
                *ids, texts = (c[some] for c in batch.columns)
                parts.append(scorer.part(ids, texts))
                size += texts.nbytes
                if size >= GROUP_BYTES:
                    yield from (pa.RecordBatch.from_arrays(c, names=schema.names) for c in scorer.columns(parts))
                    parts, size = [], 0
        if parts:
            yield from (pa.RecordBatch.from_arrays(c, names=schema.names) for c in scorer.columns(parts))

    names = {c: f"__id{i}" for i, c in enumerate(id_cols)}
    rows = docs.select(
        F.monotonically_increasing_id().alias("__row"), *[F.col(c).alias(n) for c, n in names.items()], F.col(text_col).cast("string").alias("__text")
    )
    schema = StructType([*rows.schema.fields[:-1], *_SUMS])
    summed = keep(rows.mapInArrow(run, schema), "sums")
    for part in [s for s, *_ in sent] + [hot]:
        part.destroy()
    others = summed.select("__row", F.explode("__others").alias("o")).select("__row", "o.word", "o.times")
    term = F.log10((F.col("n") + 0.1) / F.lit(model.denominator))
    met = salted_join(others, model.words, "word", "__row").groupBy("__row").agg(
        F.sum("times").alias("met"), F.sum(F.col("times") * term).alias("met_base")
    )
    unmet = F.aggregate("__others.times", F.lit(0).cast("bigint"), lambda a, b: a + b) - F.coalesce("met", F.lit(0))
    least = float(np.log10(0.1 / model.denominator))
    return summed.join(met, "__row", "left").select(
        *[F.col(n).alias(c) for c, n in names.items()],
        "n_tokens",
        (F.col("__known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        (F.col("__base") + F.coalesce("met_base", F.lit(0.0)) + unmet * F.lit(least)).alias("base_score"),
        "score",
    )

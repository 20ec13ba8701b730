"""Language-model scores against a plain model, and the filter against exact counts."""

import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skeinset.llm import lmscore
from skeinset.llm.lmscore import Settings

EXACT = dict(bits=60, probes=24)  # no wrong answers among a few thousand n-grams


def tokens_of(text):
    return [*(w.decode() for w in (text or "").encode().lower().split()), "\n"]


class Plain:
    def __init__(self, texts, order, pull):
        self.order, self.pull, self.start = order, pull, ("<start>",)
        self.words, self.grams = Counter(), Counter()
        for t in texts:
            tokens = tokens_of(t)
            self.words.update(tokens)
            line = [*self.start, *tokens]
            for n in range(1, order + 1):
                self.grams.update(tuple(line[i : i + n]) for i in range(len(line) - n + 1))
        levels = {}
        for c in self.grams.values():
            levels.setdefault(c.bit_length(), []).append(c)
        self.mean = {k: sum(v) / len(v) for k, v in levels.items()}
        self.all, self.below = sum(self.words.values()), sum(self.words.values()) + 0.1 * (len(self.words) + 1)

    def count(self, gram):
        c = self.grams[gram]
        return self.mean[c.bit_length()] if c else 0.0

    def base(self, text):
        return sum(math.log10((self.words[w] + 0.1) / self.below) for w in tokens_of(text))

    def score(self, text):
        line, total = [*self.start, *tokens_of(text)], 0.0
        for i in range(1, len(line)):
            p = (self.count((line[i],)) + 0.1) / self.below
            for n in range(2, self.order + 1):
                if i - n + 1 >= 0:
                    history = self.count(tuple(line[i - n + 1 : i]))
                    p = (min(self.count(tuple(line[i - n + 1 : i + 1])), history) + self.pull * p) / (history + self.pull)
            total += math.log10(p)
        return total


def test_tokens_of_slices():
    texts = pa.array(["", None, " Été  À\xa0b ", "a\x85b \x1c", "日本\v語", "END end"] * 3)
    for a in range(len(texts)):
        found = lmscore.Tokens.of(texts[a : a + 5])
        words = found.words.to_pylist()
        got = [[words[i] for i in found.ids[s:e]] for s, e in zip(found.starts, found.ends)]
        assert got == [tokens_of(t) for t in texts[a : a + 5].to_pylist()]


def test_hashes_of_words():
    words = pa.array([f"w{i}" for i in range(50_000)] + ["", "a", "b", "ab", "ba", "aa", "a" * 999, "é", "日本"])
    found = lmscore.hashed_words(words)
    assert len(set(found.tolist())) == len(words)
    assert np.array_equal(lmscore.hashed_words(words[100:200]), found[100:200]) and len(lmscore.hashed_words(words[:0])) == 0


def test_parts_of_a_group(monkeypatch, spark, docs):
    model = lmscore.train(docs)
    whole = lmscore.score(docs, model, ["doc_id", "text"]).collect()
    scorer = lmscore._Scorer(model, [(SimpleNamespace(value=s), s.first, s.first + len(s.starts) - 1) for s in model.slices()], SimpleNamespace(value=(pa.array([], pa.string()), np.zeros(0, dtype=np.int64))))
    texts = pa.array([r.text for r in whole])
    monkeypatch.setattr(lmscore, "PART_BYTES", 300)
    parts = [scorer.part([], texts[some]) for some in lmscore._small(texts)]
    assert len(parts) > 20
    got = np.concatenate([c[-1].to_numpy() for c in scorer.columns(parts)])
    assert np.allclose(got, [r.score for r in whole])


@pytest.fixture(scope="module")
def docs(spark, odd_docs):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("The the tHE calm river Straße é É x\x1cy stone".split(" ")) for _ in range(rng.randint(0, 80))) for _ in range(80)]
    texts += ["w" * 300, "w" * 300 + " calm", " \n\t ", "\x0blead and trail\r\n"]
    rows = [(100 + i, t, "x") for i, t in enumerate(texts)]
    return odd_docs.select("doc_id", "text", "found").union(spark.createDataFrame(rows, "a long, b string, c string"))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_a_plain_model(spark, docs, order):
    settings = Settings(order=order, pull=5.0, hot_words=5, shard_bytes=20_000, slice_bytes=40_000, **EXACT)
    training = docs.filter("doc_id % 3 <> 0")
    model = lmscore.train(training, settings=settings)
    want = Plain([r.text for r in training.collect()], order, 5.0)
    assert (model.tokens, model.distinct) == (want.all, len(want.words)) and model.n_shards > 3 and len(list(model.slices())) > 1
    got = lmscore.score(docs, model, ["doc_id", "text"]).collect()
    assert len(got) == docs.count()
    for r in got:
        tokens = tokens_of(r.text)
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(w in want.words for w in tokens))
        assert math.isclose(r.base_score, want.base(r.text), rel_tol=1e-9)
        assert math.isclose(r.score, want.score(r.text), rel_tol=1e-9)


def test_ways_to_the_same_scores(spark, docs):
    found = []
    for settings in (Settings(), Settings(hot_words=0), Settings(hot_length=0, slice_bytes=1, shard_bytes=50_000)):
        model = lmscore.train(docs, settings=settings)
        rows = lmscore.score(docs.repartition(3), model, ["doc_id", "text"]).collect()
        found.append(sorted((str(r.doc_id), str(r.text), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows))
    assert found[0] == found[1] == found[2]


def test_filter_and_words_are_not_collected_as_rows(spark, monkeypatch):
    taken, kind = [], type(spark.range(1))
    full = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: taken.append(df.columns) or full(df))
    docs = spark.range(300).selectExpr("id as doc_id", "concat('w', id, ' w', id % 7) as text")
    model = lmscore.train(docs, settings=Settings(shard_bytes=100, slice_bytes=500))
    slices = list(model.slices())
    assert lmscore.score(docs, model, ["doc_id"]).count() == 300
    assert taken and not any({"bits", "word"} & set(columns) for columns in taken)
    held = {r["shard"]: bytes(r["bits"]) for r in full(model.shards)}
    got = [s.data[a:b].tobytes() for s in slices for a, b in zip(s.starts, s.starts[1:])]
    assert got == [held.get(i, b"") for i in range(model.n_shards)] and len(slices) > 2
    assert [s.first for s in slices] == [0, *np.cumsum([len(s.starts) - 1 for s in slices])[:-1]]
    assert all(len(s.data) <= 500 or len(s.starts) == 2 for s in slices)


def test_filter_misses_nothing_and_seldom_errs():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    counts = np.minimum(rng.zipf(1.5, 20_000), 1 << 40)
    data, items, totals = lmscore.filter_of(keys, counts, 10, 5)
    assert items.sum() == 20_000 and totals.sum() == counts.sum()
    part = lmscore.Slice(4, np.array([0, 0, len(data)]), np.frombuffer(data, np.uint8))
    level = part.levels(keys, np.full(len(keys), 5), 5)
    true = np.array([int(c).bit_length() - 1 for c in counts])
    assert (level >= true).all() and (level > true).mean() < 0.02
    others = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert (part.levels(others, np.full(len(others), 5), 5) >= 0).mean() < 0.02
    assert (part.levels(others, np.full(len(others), 4), 5) == -1).all()  # an empty shard


def test_filter_hashes_an_ngram_once_a_level(monkeypatch):
    rng = np.random.default_rng(2)
    keys, counts = rng.integers(0, 1 << 63, 5000).astype(np.uint64), rng.integers(1, 9, 5000)
    hashed, mixed = [], lmscore.mixed
    monkeypatch.setattr(lmscore, "mixed", lambda x: hashed.append(len(x)) or mixed(x))
    entries = int(sum(int(c).bit_length() for c in counts))
    data, _, _ = lmscore.filter_of(keys, counts, **EXACT)
    assert sum(hashed) == entries
    hashed.clear()
    level = lmscore.Slice(0, np.array([0, len(data)]), np.frombuffer(data, np.uint8)).levels(keys, np.zeros(5000, int), EXACT["probes"])
    assert level.tolist() == [int(c).bit_length() - 1 for c in counts] and sum(hashed) == entries + 5000


@pytest.mark.parametrize("order", [1, 2, 3])
def test_tasks_send_a_row_a_shard(monkeypatch, order):
    texts = [["the calm river", "", "the calm the calm", None, " ".join(f"w{i % 700}" for i in range(3000))], ["", None], ["The river w1 w2"] * 3]
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.string())], names=["text"]) for t in texts]
    want = Counter()
    for b in batches:
        tokens = lmscore.Tokens.of(b.column(0))
        one = lmscore.hashed_words(tokens.words)
        want.update([*one[tokens.ids].tolist(), *lmscore._START.tolist() * len(b)])
        for has, keys in lmscore.longer_grams(tokens, one, order):
            want.update(keys[has].tolist())
    for sent in (1 << 22, 100):
        monkeypatch.setattr(lmscore, "SENT", sent)
        rows = pa.Table.from_batches(list(lmscore._grams_of(order, 7)(iter(batches))))
        assert sent == 100 or rows.num_rows <= len(batches) * order * 7
        rows = rows.sort_by("shard")
        made = [r for b in lmscore._shards_of(**EXACT)(iter(rows.to_batches(max_chunksize=5))) for r in b.to_pylist()]
        assert [r["shard"] for r in made] == sorted({k % 7 for k in want})
        data = {r["shard"]: r["bits"] for r in made}
        starts = np.cumsum([0, *(len(data.get(i, b"")) for i in range(7))])
        part = lmscore.Slice(0, starts, np.frombuffer(b"".join(data.get(i, b"") for i in range(7)), np.uint8))
        keys = np.array(list(want), dtype=np.uint64)
        got = part.levels(keys, (keys % np.uint64(7)).astype(np.int64), EXACT["probes"])
        assert got.tolist() == [c.bit_length() - 1 for c in want.values()]
        assert sum(sum(r["totals"]) for r in made) == want.total() and sum(sum(r["items"]) for r in made) == len(want)


def test_better_than_words_alone(spark):
    rng = random.Random(6)
    follows = {w: rng.sample(range(200), 3) for w in range(200)}

    def text():
        w, out = rng.randrange(200), []
        for _ in range(100):
            out.append(f"w{w}")
            w = rng.choice(follows[w])
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")
    model = lmscore.train(docs.filter("doc_id >= 100"))
    rows = lmscore.score(docs.filter("doc_id < 100"), model, ["doc_id"]).collect()
    assert all(r.score > r.base_score for r in rows)


def test_nothing_to_learn_or_score(spark, docs, no_docs):
    model = lmscore.train(no_docs)
    rows = lmscore.score(docs, model, ["doc_id"]).collect()
    assert len(rows) == docs.count() and all(r.n_known == 0 and math.isfinite(r.score) for r in rows)
    assert lmscore.score(no_docs, lmscore.train(docs), ["doc_id"]).count() == 0
    assert docs.select(F.count("*")).head()[0] == len(rows)

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from skeinset.functions import kernels
from skeinset.operators import knn
from skeinset.operators.knn import knn_classify

TRAIN = "id bigint, age double, income double, status string, gender string, children double, model string"
ASK = "query_id int, age double, income double, status string, gender string, children double"
RANGES = ((18.0, 77.0), (5000.0, 67789.0), (0.0, 5.0))


def people(n, seed=1):
    rng = random.Random(seed)
    return [
        (i, float(rng.randint(18, 30)), float(rng.choice([5000, 20000, 60000])), rng.choice("MS"), rng.choice("FM"),
         float(rng.randint(0, 2)), rng.choice(["van", "car", "bike"]))
        for i in range(n)
    ]


def scaled(r):
    return tuple((x - lo) / (hi - lo) for x, (lo, hi) in zip((r[0], r[1], r[4]), RANGES)), (r[2], r[3])


@pytest.mark.parametrize("one", [False, True])
@pytest.mark.parametrize("per_pass", [1024, 2])
def test_equals_brute_force(spark, one, per_pass):
    rows, asked = people(400), [(q, *r[1:6]) for q, r in enumerate(people(5, seed=2))]
    found = knn_classify(
        spark.createDataFrame(rows, TRAIN),
        spark.createDataFrame(asked, ASK),
        9,
        one_per_distance=one,
        queries_per_pass=per_pass,
    )
    train = [(r[0], *scaled(r[1:]), r[6]) for r in rows]
    got, labels = {}, {r["query_id"]: r["label"] for r in found.labels.collect()}
    for r in found.neighbours.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["dist"], r["id"], r["label"]))
    for q in asked:
        want = brute.neighbours(train, scaled(q[1:]), 9, one)
        assert got[q[0]] == want
        assert labels[q[0]] == brute.vote(want)


def small(spark, rows):
    return spark.createDataFrame(rows, "id bigint, x double, word string, model string")


def ask(spark):
    return spark.createDataFrame([(0, 0.0, "a")], "query_id int, x double, word string")


def test_equal_distances_take_the_lowest_ids(spark):
    train = small(spark, [(3, 1.0, "a", "A"), (1, 1.0, "a", "B"), (2, 1.0, "a", "C")])
    options = dict(numeric={"x": (0, 1)}, nominal=["word"])
    two = knn_classify(train, ask(spark), 2, **options).neighbours
    assert sorted(r["id"] for r in two.collect()) == [1, 2]
    one = knn_classify(train, ask(spark), 2, one_per_distance=True, **options).neighbours
    assert [r["id"] for r in one.collect()] == [1]


def test_vote_tie_goes_to_the_lowest_label(spark):
    train = small(spark, [(1, 1.0, "a", "B"), (2, 2.0, "a", "A")])
    assert knn_classify(train, ask(spark), 2, {"x": (0, 1)}, ["word"]).labels.head()["label"] == "A"


def test_fewer_rows_than_neighbours(spark):
    train = small(spark, [(1, 1.0, "b", "B")])
    assert knn_classify(train, ask(spark), 5, {"x": (0, 1)}, ["word"]).neighbours.count() == 1


def test_neighbours_to_ask_for_by_query(spark):
    rows = people(300)
    asked = [(q, q + 1, *r[1:6]) for q, r in enumerate(people(5, seed=2))]
    df = spark.createDataFrame(asked, ASK.replace("query_id int", "query_id int, k int"))
    found = knn_classify(spark.createDataFrame(rows, TRAIN).repartition(4), df, "k").neighbours
    train = [(r[0], *scaled(r[1:]), r[6]) for r in rows]
    for q in asked:
        got = [(r["dist"], r["id"], r["label"]) for r in found.filter(found.query_id == q[0]).orderBy("rank").collect()]
        assert got == brute.neighbours(train, scaled(q[2:]), q[1], False)


def test_one_scan_for_any_number_of_queries(spark):
    df = spark.createDataFrame([(q, float(q), "a") for q in range(2000)], "query_id int, x double, word string")
    found = knn_classify(small(spark, [(1, 1.0, None, "B"), (2, 1.0, "a", "A")]), df, 1, {"x": (0, 1)}, ["word"]).neighbours
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan
    assert found.count() == 2000 and found.filter("id = 2").count() == 2000


def test_passes_hold_a_part_of_the_queries_whatever_their_ids(spark, monkeypatch):
    sizes, full = [], knn._nearest
    monkeypatch.setattr(knn, "_nearest", lambda rows, asked, *rest: sizes.append(asked.num_rows) or full(rows, asked, *rest))
    df = spark.createDataFrame([(None if q % 2 else 7, float(q), "a") for q in range(50)], "query_id int, x double, word string")
    train = small(spark, [(i, float(i), "a", "AB"[i % 2]) for i in range(60)])
    found = knn_classify(train, df.repartition(4), 1, {"x": (0, 1)}, ["word"], queries_per_pass=8).neighbours
    assert sorted(r["id"] for r in found.collect()) == list(range(50))
    assert len(sizes) == 7 and max(sizes) <= 8


def test_far_strips_of_rows_are_passed_over(monkeypatch):
    monkeypatch.setattr(kernels, "ROW_STRIP", 10)
    kept, full = [], kernels.first_per_query
    monkeypatch.setattr(kernels, "first_per_query", lambda rows, *rest: kept.append(rows.num_rows) or full(rows, *rest))
    asked = [np.array([5.0, 41.0])], [pa.array(["a", None])]
    search = kernels.nearest_rows(*asked, np.array([2, 3]), False)
    rows = pa.record_batch([pa.array(np.arange(1000.0)), pa.array(["a", "b"] * 500), pa.array(range(1000))], names=["x", "w", "id"])
    got = pa.Table.from_batches(list(search(iter([rows])))).sort_by([("q", "ascending"), ("dist", "ascending"), ("id", "ascending")])
    want = []
    for q, (x, w, k) in enumerate([(5.0, "a", 2), (41.0, None, 3)]):
        near = sorted(((v - x) ** 2 + (("a", "b")[v % 2] != w), v) for v in range(1000))[:k]
        want += [(q, d, v) for d, v in near]
    assert [tuple(r.values()) for r in got.to_pylist()] == want
    assert len(kept) < 8  # of a hundred strips


def test_nulls_are_equal_words(spark):
    df = spark.createDataFrame([(0, 1.0, None)], "query_id int, x double, word string")
    train = small(spark, [(1, 1.0, "a", "B"), (2, 1.0, None, "A")])
    found = knn_classify(train, df, 2, {"x": (0, 1)}, ["word"]).neighbours
    assert [(r["id"], r["dist"]) for r in found.orderBy("rank").collect()] == [(2, 0.0), (1, 1.0)]


def test_no_queries_and_no_rows(spark):
    options = dict(numeric={"x": (0, 1)}, nominal=["word"])
    assert knn_classify(small(spark, [(1, 1.0, "a", "B")]), ask(spark).filter("false"), 1, **options).neighbours.count() == 0
    assert knn_classify(small(spark, []), ask(spark), 1, **options).labels.count() == 0


def test_many_copies_of_one_distance(spark):
    train = small(spark, [(i, 1.0, "a", "AB"[i % 2]) for i in range(3000)])
    found = knn_classify(train.repartition(16), ask(spark), 4, {"x": (0, 1)}, ["word"]).neighbours
    assert sorted(r["id"] for r in found.collect()) == [0, 1, 2, 3]


def test_missing_number_is_an_error(spark):
    with pytest.raises(PySparkException):
        knn_classify(small(spark, [(1, None, "b", "B")]), ask(spark), 1, {"x": (0, 1)}, ["word"]).neighbours.collect()

import hashlib
import math
import random
from collections import Counter
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skeinset.functions import kernels, vectors
from skeinset.functions.kernels import race_times
from skeinset.operators import nearest, tiles
from skeinset.operators.nearest import Centroids, assign, local_table, with_nearest
from skeinset.operators.ranks import number_rows
from skeinset.operators.silhouette import silhouette
from skeinset.plans.agglomerate import _Blocks, agglomerate, closest_pair
from skeinset.plans import kmeans as km
from skeinset.plans.draws import candidates
from skeinset.plans.kmeans import kmeans, kmeans_step, lloyd, random_seeds


def cloud(n, size=4, seed=1, top=9):
    rng = random.Random(seed)
    return [[float(rng.randint(0, top)) for _ in range(size)] for _ in range(n)]


def points_of(spark, rows):
    return spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(rows)], "id bigint, f array<double>")


def seeds_of(spark, rows):
    return local_table(spark, [(i, list(map(float, c))) for i, c in enumerate(rows)], nearest.CENTROID_SCHEMA)


@pytest.fixture(params=["inline", "batched", "blocks"])
def way(request, monkeypatch):
    """Each of the three ways to assign points."""
    if request.param != "inline":
        monkeypatch.setattr(nearest, "INLINE_DOUBLES", 0)
    if request.param == "blocks":
        monkeypatch.setattr(nearest, "LOCAL_DOUBLES", 0)
    return request.param


def test_assign_equals_brute_force(spark, way):
    rows, centres = cloud(150), dict(enumerate(cloud(5, seed=2)))
    got = {r["id"]: (r["cid"], r["dist"]) for r in assign(points_of(spark, rows), seeds_of(spark, centres.values()), "f").collect()}
    assert got == {i: brute.nearest(p, centres) for i, p in enumerate(rows)}


def test_assign_takes_columns_and_keeps_them(spark, way):
    df = spark.createDataFrame([(1, 2.0, 3), (2, 8.0, 3)], "k int, a double, b int")
    out = assign(df, seeds_of(spark, [(0, 3), (9, 3)]), ["a", "b"])
    assert out.columns == ["k", "a", "b", "cid", "dist"]
    assert sorted(map(tuple, out.collect())) == [(1, 2.0, 3, 0, 2.0), (2, 8.0, 3, 1, 1.0)]


def test_distance_tie_goes_to_the_lowest_cid(spark, way):
    out = assign(points_of(spark, [(0, 0, 0, 0)]), seeds_of(spark, [(1, 0, 0, 0), (-1, 0, 0, 0)]), "f").head()
    assert (out["cid"], out["dist"]) == (0, 1.0)


def test_numbers_with_gaps_are_kept(spark, way):
    centres = local_table(spark, [(3, [0.0]), (9, [10.0])], nearest.CENTROID_SCHEMA)
    out = assign(points_of(spark, [(1,), (8,)]), centres, "f").orderBy("id").collect()
    assert [r["cid"] for r in out] == [3, 9]


def test_a_missing_coordinate_is_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(PySparkException):
        assign(df, seeds_of(spark, [(0, 0)]), ["a", "b"]).collect()


@pytest.mark.parametrize("p,per_pass", [(2, 1), (2, 8), (1, 2), (0.5, 3)])
def test_many_blocks_of_centroids(spark, monkeypatch, p, per_pass):
    monkeypatch.setattr(nearest, "BLOCKS_PER_PASS", per_pass)
    rows, centres = cloud(300, 2, top=40), list(enumerate(cloud(90, 2, seed=3, top=40)))
    centres += [(100 + i, c) for i, c in centres[:9]]  # equal ones, of higher number
    random.Random(1).shuffle(centres)
    table = local_table(spark, centres, nearest.CENTROID_SCHEMA)
    out = with_nearest(points_of(spark, rows), Centroids.of(table, 32), "f", second=True, p=p).collect()
    assert len(out) == len(rows)

    def dist(a, b):
        return brute.dist(a, b) if p == 2 else sum(abs(x - y) ** p for x, y in zip(a, b)) ** (1 / p)

    for r in out:
        found = sorted((dist(rows[r["id"]], c), i) for i, c in centres)
        assert (r["dist"], r["second"]) == pytest.approx((found[0][0], found[1][0])) and (p != 2 or r["cid"] == found[0][1])


def test_points_of_many_slices_of_centroids_are_not_written(spark, monkeypatch):
    written, full = [], nearest.cut_lineage
    monkeypatch.setattr(nearest, "cut_lineage", lambda df: written.append(df.columns) or full(df))
    monkeypatch.setattr(nearest, "BLOCKS_PER_PASS", 2)
    monkeypatch.setattr(kernels, "GROUP_NUMBERS", 64)
    rows = cloud(200, 2, top=40) + [(1e6 + i, i % 40) for i in range(40)]  # far from all centroids, too
    centres = list(enumerate(cloud(150, 2, seed=3, top=40)))
    table = local_table(spark, [(i, list(map(float, c))) for i, c in centres], nearest.CENTROID_SCHEMA)
    out = with_nearest(points_of(spark, rows), Centroids.of(table, 32), "f", second=True).collect()
    assert written == [["cids", "flat", "low", "high"]] and sorted(r["id"] for r in out) == list(range(len(rows)))
    for r in out:
        found = sorted((brute.dist(rows[r["id"]], c), i) for i, c in centres)
        assert (r["cid"], r["dist"], r["second"]) == (found[0][1], found[0][0], found[1][0])


@pytest.mark.parametrize("size,second", [(2, True), (2, False), (7, True)])
def test_slices_of_far_centroids_are_not_read(monkeypatch, size, second):
    monkeypatch.setattr(kernels, "GROUP_NUMBERS", 150)
    x, centres = (np.array(cloud(n, size, seed=n, top=30), dtype=float) for n in (100, 600))
    pivots, read = centres[:4], []
    blocks = [(at, centres[at], *(m(kernels.distances(centres[at], pivots), axis=0) for m in (np.min, np.max))) for at in map(np.sort, kernels.boxed(centres, 10))]

    class Sent:
        def __init__(self, blocks):
            self.blocks, self._path = blocks, None

        def load_from_path(self, path):
            read.append(self)
            return self.blocks

    slices = [Sent(blocks[i : i + 2]) for i in range(0, len(blocks), 2)]
    tables = [np.concatenate([t for _, t, *_ in s.blocks]) for s in slices]
    away = [kernels.distances(t, pivots) for t in tables]
    boxes = [(t.min(axis=0), t.max(axis=0), a.min(axis=0), a.max(axis=0)) for t, a in zip(tables, away)]
    search = kernels.nearest_in_slices(slices, boxes, pivots, 2, second)
    near = x if size > 2 else x[np.argsort(x[:, 0])] * [0.1, 1.0]  # a strip at the edge
    got = [r for a in search(pa.array(near[i : i + 7].tolist()) for i in range(0, 100, 7)) for r in a.to_pylist()]
    d = kernels.distances(near, centres)
    assert [r["cid"] for r in got] == d.argmin(axis=1).tolist() and [r["dist"] for r in got] == d.min(axis=1).tolist()
    if second:
        assert [r["second"] for r in got] == np.sort(d, axis=1)[:, 1].tolist()
    assert size > 2 or len(set(map(id, read))) < len(slices) / 2


def test_points_of_many_centroids_are_not_shuffled(spark):
    table = spark.range(200).selectExpr("id as cid", "array(cast(id as double)) as c")
    points = spark.range(1000).selectExpr("id", "array(id / 7) as f")
    near = with_nearest(points, Centroids.of(table, 32), "f")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert all(abs(r["dist"] - abs(r["f"][0] - r["cid"])) < 1e-9 and r["cid"] == round(r["f"][0]) for r in near.collect() if r["id"] < 1000)


def test_far_blocks_are_skipped(monkeypatch):
    compared, full = [], kernels.distances
    monkeypatch.setattr(kernels, "distances", lambda x, y, p=2: compared.append(len(x) * len(y)) or full(x, y, p))
    blocks = [SimpleNamespace(value=(list(range(i, i + 10)), np.arange(i, i + 10.0)[:, None], [float(i)], [i + 9.0])) for i in range(0, 100, 10)]
    known = pa.array([None, None], pa.struct([("cid", pa.int64()), ("dist", pa.float64()), ("second", pa.float64())]))
    got = kernels.nearest_in_blocks(blocks, np.zeros((1, 1)), 2, False)(pa.array([[3.2], [3.9]]), known).to_pylist()
    assert [g["cid"] for g in got] == [3, 4]
    assert sum(compared) == 2 + 20  # the pivot, and one block of ten


def test_step_drops_or_keeps_empty_clusters(spark):
    df, seeds = points_of(spark, [(0, 0, 0, 0), (2, 0, 0, 0)]), seeds_of(spark, [(0, 0, 0, 0), (100, 0, 0, 0)])
    assert [tuple(r) for r in kmeans_step(df, seeds, "f").collect()] == [(0, [1, 0, 0, 0], 2)]
    kept = kmeans_step(df, seeds, "f", empty="keep").orderBy("cid").collect()
    assert [tuple(r) for r in kept] == [(0, [1, 0, 0, 0], 2), (1, [100, 0, 0, 0], 0)]


def test_equal_seeds_leave_one(spark):
    out = kmeans_step(points_of(spark, cloud(20)), seeds_of(spark, [(0, 0, 0, 0)] * 2), "f").collect()
    assert [r["cid"] for r in out] == [0]


def test_rounds_equal_repeated_steps(spark):
    rows = cloud(200, top=50)
    centres = dict(enumerate(cloud(4, seed=5, top=50)))
    fit = kmeans(points_of(spark, rows), seeds_of(spark, centres.values()), "f", max_iter=3, stop=None)
    for _ in range(3):
        centres = brute.step(rows, centres)
    assert {r["cid"]: r["c"] for r in fit.centroids.collect()} == centres
    assert fit.n_iter == 3 and not fit.converged
    assert fit.assignments.count() == len(rows)
    assert fit.history.groupBy("iteration").count().count() == 3
    assert {r["state"] for r in fit.report.collect()} == {"Convergence not reached"}


def test_table_of_centroids_gives_the_same_run(spark):
    rows = cloud(60, 2, top=50)
    df, seeds = points_of(spark, rows), seeds_of(spark, cloud(4, 2, seed=5, top=50))
    options = dict(max_iter=2, threshold=0.5)
    small, large = (kmeans(df, seeds, "f", local_doubles=n, **options) for n in (None, 0))
    for part in ("centroids", "history"):
        a, b = ({tuple(map(str, r)) for r in getattr(x, part).collect()} for x in (small, large))
        assert a == b
    assert (small.n_iter, small.converged) == (large.n_iter, large.converged)


@pytest.mark.parametrize("local", [None, 0])
def test_a_run_goes_on_after_the_last_committed_round(spark, tmp_path, local, monkeypatch):
    rows = cloud(300, 2, top=50)
    df, seeds = points_of(spark, rows), seeds_of(spark, cloud(6, 2, seed=5, top=50))
    options = dict(stop="aligned", threshold=0.01, local_doubles=local)
    whole = kmeans(df, seeds, "f", max_iter=6, **options)
    path, write = str(tmp_path / "rounds"), km._Rounds.write

    def killed(self, iteration, last):
        if iteration == 2:
            raise KeyboardInterrupt
        write(self, iteration, last)

    with monkeypatch.context() as m:
        m.setattr(km._Rounds, "write", killed)
        with pytest.raises(KeyboardInterrupt):
            kmeans(df, seeds, "f", max_iter=6, rounds_to=path, **options)
    assert sorted(p.name for p in (tmp_path / "rounds").iterdir()) == ["_rules", "iteration=0", "iteration=1"]
    written = []
    with monkeypatch.context() as m:
        m.setattr(km._Rounds, "write", lambda self, i, last: written.append(i) or write(self, i, last))
        again = kmeans(df, seeds, "f", max_iter=6, rounds_to=path, **options)
    assert written == list(range(2, whole.n_iter)) or written == list(range(2, whole.n_iter + 1))
    assert (again.n_iter, again.converged) == (whole.n_iter, whole.converged)
    for part in ("centroids", "history"):
        a, b = (sorted(map(str, getattr(x, part).collect())) for x in (whole, again))
        assert a == b
    with pytest.raises(ValueError, match="another run"):
        kmeans(df, seeds, "f", max_iter=6, rounds_to=path, **{**options, "threshold": 1.0})


@pytest.mark.parametrize(
    "stop,empty,p,cost", [("aligned", "drop", 2, 2.0), ("nearest", "keep", 2, 0.0), (None, "drop", 1, 1e9), ("aligned", "drop", 3, 2.0)]
)
def test_rounds_with_bounds_are_the_same(spark, stop, empty, p, cost, monkeypatch):
    """Whether points are written once, now and then or in each round; whole numbers, so that distances tie."""
    monkeypatch.setattr("skeinset.plans.bounds.WRITE_COST", cost)
    rows = cloud(700, 3, top=7) + cloud(300, 3, seed=4, top=90)
    seeds = [rows[i] for i in (0, 5, 5, 9, 710, 720, 800)] + [[1e6] * 3]
    points = points_of(spark, rows).repartition(5)
    rules = dict(max_iter=12, threshold=0.001, stop=stop, empty=empty, p=p)
    plain, fit = (kmeans(points, seeds_of(spark, seeds), "f", **rules, bounds=b) for b in (False, True))
    assert fit.n_iter == plain.n_iter and fit.converged == plain.converged and plain.work is None
    key = ["iteration", "cid"]
    for a, b in zip(plain.history.orderBy(key).collect(), fit.history.orderBy(key).collect(), strict=True):
        assert (a.iteration, a.cid, a.n) == (b.iteration, b.cid, b.n)
        assert np.allclose([*a.c, *a.prev, a.shift], [*b.c, *b.prev, b.shift], rtol=1e-12, atol=1e-9)
    work = fit.work.orderBy("iteration").collect()
    assert len(work) == fit.n_iter and {r.points for r in work} == {1000}
    assert work[0].compared == 1000 and work[0].distances == 1000 * len(seeds)


def test_work_of_rounds_with_bounds_falls(spark):
    rng = np.random.default_rng(3)
    centres = rng.uniform(0, 100, (30, 2))
    rows = (centres[rng.integers(0, 30, 6000)] + rng.normal(0, 1.5, (6000, 2))).tolist()
    fit = lloyd(points_of(spark, rows), "f", "id", 30, max_iter=15, bounds=True)
    work = [r.distances for r in fit.work.orderBy("iteration").collect()]
    assert work[0] == 30 * 6000 and work[-1] < work[0] / 20 and sum(work) < len(work) * work[0] / 4
    assert fit.work.agg(F.min("points")).head()[0] == 6000


def test_bounds_need_a_triangle_inequality_and_points(spark):
    with pytest.raises(ValueError, match="below 1"):
        kmeans(points_of(spark, [(1,)]), seeds_of(spark, [(1,)]), "f", p=0.5, bounds=True)
    with pytest.raises(ValueError, match="no points"):
        kmeans(points_of(spark, []), seeds_of(spark, [(1,)]), "f", bounds=True)
    one = kmeans(points_of(spark, [(1,), (4,)]), seeds_of(spark, [(1,)]), "f", stop=None, max_iter=3, bounds=True)
    assert [(r.compared, r.distances) for r in one.work.orderBy("iteration").collect()] == [(0, 2), (0, 0), (0, 0)]


def test_threshold_is_inclusive(spark):
    df, seeds = points_of(spark, [(2000,), (2000,)]), seeds_of(spark, [(0,)])
    assert kmeans(df, seeds, "f", max_iter=1, threshold=2000.0).converged
    assert not kmeans(df, seeds, "f", max_iter=1, threshold=1999.0).converged


@pytest.mark.parametrize("stop", ["nearest", "aligned"])
def test_shifts_follow_the_stop_rule(spark, stop):
    old = [1.0, 10.0, 10.5]
    df, seeds = points_of(spark, [(3,), (5,), (3.5,), (4.5,), (6,)]), seeds_of(spark, [(v,) for v in old])
    history = kmeans(df, seeds, "f", max_iter=1, threshold=3.0, stop=stop).history.collect()
    assert {h["cid"]: h["c"] for h in history} == {0: [4.0], 1: [6.0]}
    for h in history:
        own = abs(h["c"][0] - old[h["cid"]])
        assert h["shift"] == (own if stop == "aligned" else min(abs(h["c"][0] - o) for o in old))
        assert h["prev"] == [old[h["cid"]]]


def test_nearest_rule_looks_at_all_old_centroids(spark):
    # With distances of order 1 a mean may leave its cell, so the nearest old centroid is another.
    rows, old = [(0, 0), (0, 6), (10, 0), (1, 1)], [(3, 3), (9, 5)]
    for stop in ("nearest", "aligned"):
        fit = kmeans(points_of(spark, rows), seeds_of(spark, old), "f", max_iter=1, stop=stop, p=1)
        for h in fit.history.collect():
            gaps = [sum(abs(x - y) for x, y in zip(h["c"], o)) for o in old]
            assert h["shift"] == pytest.approx(min(gaps) if stop == "nearest" else gaps[h["cid"]])


def test_other_orders_of_distance(spark, way):
    rows, centres = cloud(60, 3), dict(enumerate(cloud(4, 3, seed=2)))
    out = assign(points_of(spark, rows), seeds_of(spark, centres.values()), "f", p=1).collect()
    assert len(out) == len(rows)
    for r in out:
        sums = {i: sum(abs(x - y) for x, y in zip(rows[r["id"]], c)) for i, c in centres.items()}
        assert (r["dist"], r["cid"]) == min((d, i) for i, d in sums.items())


def test_lloyd_ends_at_a_fixed_point(spark):
    rows = cloud(80, 2, top=60)
    fit = lloyd(points_of(spark, rows), "f", "id", k=3, seed=2)
    centres = {r["cid"]: r["c"] for r in fit.centroids.collect()}
    assert fit.converged and fit.n_iter <= 30
    for cid, c in brute.step(rows, centres).items():
        assert c == pytest.approx(centres[cid], abs=1e-3)


def test_number_rows(spark):
    df = spark.range(500).selectExpr("id * 37 % 500 as v").repartition(7)
    out = number_rows(df, ["v"], "rank")
    assert out.columns == ["v", "rank"]
    assert sorted(map(tuple, out.collect())) == [(i, i) for i in range(500)]


def test_many_random_seeds(spark, monkeypatch):
    df = points_of(spark, cloud(60, 2))
    few = sorted(map(tuple, random_seeds(df, 20, "id", "f", 3).collect()))
    monkeypatch.setattr(nearest, "LOCAL_DOUBLES", 0)
    assert sorted(map(tuple, random_seeds(df, 20, "id", "f", 3).collect())) == few


def test_sum_of_squares_never_rises(spark):
    rows = cloud(300, 2, top=100)
    fit = kmeans(points_of(spark, rows), seeds_of(spark, cloud(5, 2, seed=8, top=100)), "f", max_iter=5, stop=None)
    losses = []
    for i in range(5):
        centres = {r["cid"]: r["c"] for r in fit.history.filter(F.col("iteration") == i).collect()}
        losses.append(sum(brute.nearest(p, centres)[1] ** 2 for p in rows))
    assert losses == sorted(losses, reverse=True)


def test_seeds_and_lloyd_without_ids(spark):
    df = spark.createDataFrame([([float(i % 3), 1.0],) for i in range(30)], "f array<double>")
    drawn = [tuple(r) for r in random_seeds(df, 30, None, "f", 3).orderBy("cid").collect()]
    assert drawn == [(i, [float(i // 10), 1.0]) for i in range(30)]
    some = sorted(map(tuple, random_seeds(df, 4, None, "f", 3).collect()))
    assert some == sorted(map(tuple, random_seeds(df.repartition(5), 4, None, "f", 3).collect()))
    assert lloyd(df, "f", k=2).centroids.count() <= 2


def raced(rows, k, seed):
    """The race run for every point, by hand."""
    times = []
    for value, n in Counter(rows).items():
        time = 0.0
        for j in range(1, n + 1):
            text = f"{seed}:{','.join(map(str, value))}:{j}"
            time -= math.log((int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 1) / 2**52) / (n - j + 1)
            times.append((time, value, j))
    return [list(v) for v, _ in sorted((v, j) for _, v, j in sorted(times)[:k])]


@pytest.mark.parametrize("k", [1, 7, 40, 400])
def test_race_equals_all_points_run(spark, monkeypatch, k):
    rng = random.Random(5)
    rows = [(float(rng.randrange(30)), rng.choice([0.5, 0.0, 0.25])) for _ in range(300)] + [(3.0, 0.5)] * 150
    df = spark.createDataFrame([(list(r),) for r in rows], "f array<double>").repartition(5)
    few = sorted(map(tuple, random_seeds(df, k, None, "f", 3).collect()))
    assert few == list(enumerate(raced(rows, k, 3)))
    assert few == sorted(map(tuple, random_seeds(df.repartition(3), k, None, "f", 3).collect()))
    monkeypatch.setattr(nearest, "LOCAL_DOUBLES", 0)
    assert few == sorted(map(tuple, random_seeds(df, k, None, "f", 3).collect()))


def test_race_counts_few_values(spark):
    hot = spark.range(60_000).selectExpr("array(if(id % 3 = 0, -1.0D, cast(id as double))) as f")
    even = spark.range(200_000).selectExpr("array(cast(id % 20000 as double)) as f")
    for df in (hot, even):
        found = candidates(df, 5, "f", 1)
        assert 5 <= found.count() < 200
    # zeros of either sign are one value; a hot one is drawn, its points one after the other
    zeros = spark.range(90).selectExpr("array(if(id % 2 = 0, 0.0D, -0.0D)) as f")
    assert [(r["c"], r["n"]) for r in candidates(zeros, 5, "f", 1).collect()] == [([0.0], 90)]
    with pytest.raises(ValueError):
        random_seeds(zeros, 91, None, "f")
    with pytest.raises(ValueError):
        random_seeds(zeros.filter("false"), 1, None, "f")


def test_race_is_a_uniform_draw():
    counts, tries = {"a": 6, "b": 2, "c": 1, "d": 1}, 4000
    first, both = Counter(), 0
    for seed in range(tries):
        times = sorted((t, v) for v, n in counts.items() for _, t in race_times(f"{seed}:{v}", n))
        first[times[0][1]] += 1
        both += times[0][1] == times[1][1] == "a"
    assert all(abs(first[v] / tries - n / 10) < 0.03 for v, n in counts.items())
    assert abs(both / tries - 6 / 10 * 5 / 9) < 0.03


def test_means_of_wide_vectors(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x, seeds = rng.normal(size=(200, 40)), rng.normal(size=(3, 40))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "f array<double>").repartition(4)
    centres = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(seeds)], "cid bigint, c array<double>")
    near = np.linalg.norm(x[:, None] - seeds, axis=2).argmin(axis=1)
    for r in kmeans_step(df, centres, "f").collect():
        mine = x[near == r["cid"]]
        assert r["n"] == len(mine) and np.allclose(r["c"], mine.mean(axis=0))


def test_random_seeds(spark):
    df = points_of(spark, cloud(100))
    a = [tuple(r) for r in random_seeds(df, 5, "id", "f", 3).orderBy("cid").collect()]
    assert a == [tuple(r) for r in random_seeds(df.repartition(5), 5, "id", "f", 3).orderBy("cid").collect()]
    assert a != [tuple(r) for r in random_seeds(df, 5, "id", "f", 4).orderBy("cid").collect()]
    with pytest.raises(ValueError):
        random_seeds(df, 101, "id", "f")


@pytest.mark.parametrize("method", ["simple", "pairwise"])
def test_silhouette_equals_brute_force(spark, method, monkeypatch):
    monkeypatch.setattr("skeinset.operators.tiles.BLOCK_DOUBLES", 64)
    rows = cloud(220, 2, top=12)
    centres = dict(enumerate(cloud(3, 2, seed=4, top=12)))
    df, table = points_of(spark, rows), seeds_of(spark, centres.values())
    want = getattr(brute, method)(rows, centres)
    got = {r["id"]: (r["cid"], r["s"]) for r in silhouette(df, table, "f", method).collect()}
    assert len(got) == len(rows)
    for i, (cid, s) in enumerate(want):
        assert got[i][0] == cid and got[i][1] == pytest.approx(s, abs=1e-12)
    by_cluster = silhouette(df, table, "f", method, "cluster").collect()
    for r in by_cluster:
        mine = [s for cid, s in want if cid == r["cid"]]
        assert r["n"] == len(mine) and r["s"] == pytest.approx(sum(mine) / len(mine))
    whole = silhouette(df, table, "f", method, "all").head()
    assert whole["s"] == pytest.approx(sum(s for _, s in want) / len(want)) and whole["n"] == len(rows)


@pytest.mark.parametrize("square", [1, 3, 16])
def test_squares_of_tiles(spark, square, monkeypatch):
    """Each tile once, whatever the runs are; blocks are sent per run and tasks follow the squares."""
    monkeypatch.setattr("skeinset.operators.tiles.SQUARE", square)
    monkeypatch.setattr("skeinset.operators.tiles.BLOCK_DOUBLES", 32)
    rows = [(g, i, [float(i % 97), float(i * i % 89)], 1.0 + i % 3) for g, n in ((3, 900), (5, 40), (8, 1)) for i in range(n)]
    table = spark.createDataFrame(rows, "g bigint, id bigint, v array<double>, n double")
    blocks = tiles.pack(table, "g", "v", "id", ["id", "n"], tiles.block_rows(2))
    squares = tiles.own_tiles(blocks, "g", ["n"])
    listed = blocks.collect()
    ids = {(r["g"], r["blk"]): r["id"] for r in listed}
    got = {(r["g"], ids[r["g"], r["blk"]][r["pos"]]): r["total"] for r in tiles.weighted_distance_sums(squares, 2).collect()}
    for g in (3, 5, 8):
        x, n = (np.array([r[k] for r in rows if r[0] == g]) for k in (2, 3))
        assert np.allclose([got.pop((g, i)) for i in range(len(x))], kernels.distances(x, x) @ n)
    assert not got
    run = min(square, 7)  # 57 + 3 + 1 blocks, 4 squares for each of 8 partitions
    runs = {r["g"]: -(-r["n_blk"] // run) for r in listed}
    assert squares.count() == sum(runs[r["g"]] for r in listed)
    assert squares.rdd.getNumPartitions() == max(8, sum(r * (r + 1) // 2 for r in runs.values()) // tiles.SQUARES_PER_TASK)
    pair = tiles.closest_pair(tiles.own_tiles(tiles.pack(table.filter("g = 3").withColumnRenamed("id", "cid"), "g", "v", "cid", ["cid"], 16), "g", ["cid"]), 2)
    x = np.array([r[2] for r in rows if r[0] == 3])
    d = kernels.distances(x, x)
    d[np.tril_indices(900)] = np.inf
    assert tuple(pair.head()) == (d.min(), *np.unravel_index(d.argmin(), d.shape))


@pytest.mark.parametrize(
    "points, centres, want",
    [
        ([(0,)], [(0,), (5,)], [1.0]),
        ([(0,), (2,)], [(1,)], [-1.0, -1.0]),
        ([(1,), (1,)], [(1,)], [0.0, 0.0]),
        ([(0,), (0,), (2,)], [(1,), (50,)], [48 / 50, 48 / 50, 46 / 48]),
    ],
)
def test_silhouette_by_hand(spark, points, centres, want):
    got = silhouette(points_of(spark, points), seeds_of(spark, centres), "f", "pairwise").orderBy("id").collect()
    assert [r["s"] for r in got] == pytest.approx(want)


def test_equal_centroids_are_no_other_cluster(spark):
    df = points_of(spark, [(0,), (2,)])
    got = silhouette(df, seeds_of(spark, [(1,), (1,)]), "f", "pairwise").collect()
    assert [r["s"] for r in got] == [-1.0, -1.0]


@pytest.mark.parametrize("local", [1_000_000, 0])
def test_midpoint_and_mean(spark, local):
    done = agglomerate(points_of(spark, [(0,), (1,), (10,), (10,)][:3]), "f", local_doubles=local)
    merges = [tuple(r) for r in done.merges.orderBy("round").collect()]
    assert merges == [(0, 3, 0, 1, 1.0, [0.5]), (1, 2, 2, 3, 9.5, [5.25])]
    assert [tuple(r) for r in done.last_midpoints.collect()] == [(4, [5.25])]
    assert [r["c"][0] for r in done.centroids.collect()] == pytest.approx([11 / 3])


def test_agglomerate_ties_go_to_the_first_pair(spark):
    first = agglomerate(points_of(spark, [(2,), (1,), (0,)]), "f", max_rounds=1).merges.head()
    assert (first["i"], first["j"]) == (0, 1)


def test_agglomerate_equals_brute_force(spark):
    rows = cloud(40, 2, seed=6, top=30)
    merges, last, means = brute.agglomerate(rows, target=18)
    done = agglomerate(points_of(spark, rows), "f", target_k=18)
    got = [(r["i"], r["j"], r["distance"], r["merged"]) for r in done.merges.orderBy("round").collect()]
    assert got == merges
    assert {r["cid"]: r["c"] for r in done.last_midpoints.collect()} == last
    assert {r["cid"]: r["c"] for r in done.centroids.collect()} == means
    counts = [r["n_before"] for r in done.merges.orderBy("round").collect()]
    assert counts == sorted(set(counts), reverse=True)


@pytest.mark.parametrize("n,size,top,rebase", [(99, 2, 11, 64), (60, 1, 1000, 3), (120, 2, 10**6, 64), (70, 3, 5, 10)])
def test_whole_runs_equal_brute_force(spark, n, size, top, rebase, monkeypatch):
    monkeypatch.setattr("skeinset.plans.agglomerate.REBASE", rebase)
    monkeypatch.setattr("skeinset.plans.agglomerate.BLOCK_POINTS", 20)
    rows = cloud(n, size, seed=n, top=top)
    rows += rows[: n // 3] * 2
    merges, last, means = brute.agglomerate(rows)
    done = agglomerate(points_of(spark, rows), "f")
    got = done.merges.orderBy("round").collect()
    assert [(r["i"], r["j"]) for r in got] == [m[:2] for m in merges]
    assert [r["distance"] for r in got] == pytest.approx([m[2] for m in merges])
    assert {r["cid"]: pytest.approx(r["c"]) for r in done.last_midpoints.collect()} == last
    assert {r["cid"]: r["n"] for r in done.centroids.collect()} == {max(last): len(rows)}
    assert [r["c"] for r in done.centroids.collect()] == [pytest.approx(c) for c in means.values()]


@pytest.mark.parametrize("target,rounds", [(1, 0), (1, 7), (9, None), (9, 12), (60, None)])
def test_runs_that_end_early(spark, target, rounds):
    rows = cloud(50, 2, seed=3, top=40)
    merges, _, _ = brute.agglomerate(rows, target=target)
    done = agglomerate(points_of(spark, rows), "f", target_k=target, max_rounds=rounds)
    assert [(r["i"], r["j"]) for r in done.merges.orderBy("round").collect()] == [m[:2] for m in merges][:rounds]
    if rounds is None:
        assert done.centroids.count() >= min(target, done.last_midpoints.count()) - 1


def test_few_jobs_and_few_comparisons(spark, monkeypatch):
    calls, full = [], _Blocks.first_surprise
    monkeypatch.setattr(_Blocks, "first_surprise", lambda self, steps: calls.append(len(steps)) or full(self, steps))
    done = agglomerate(points_of(spark, [(i * i,) for i in range(200)]), "f", target_k=120)
    assert done.n_rounds == 80 and len(calls) <= 40


@pytest.mark.parametrize("local", [1_000_000, 0])
def test_closest_pair(spark, local, monkeypatch):
    monkeypatch.setattr("skeinset.operators.tiles.BLOCK_DOUBLES", 64)
    rows = [list(p) for p in sorted({tuple(p) for p in cloud(150, 2, seed=9, top=60)})]
    want = min((brute.dist(rows[i], rows[j]), i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)))
    assert tuple(closest_pair(seeds_of(spark, rows), local).head()) == want
    assert closest_pair(seeds_of(spark, rows[:1]), local).count() == 0


def test_vector_functions(spark):
    df = spark.range(1).select(
        F.array(F.lit(0.0), F.lit(3.0)).alias("a"), F.array(F.lit(4.0), F.lit(0.0)).alias("b"), F.lit("1, 2.5").alias("t")
    )
    row = df.select(
        vectors.euclidean("a", "b"),
        vectors.minkowski("a", "b", 1),
        vectors.minkowski("a", "b"),
        vectors.midpoint("a", "b"),
        vectors.parse_vector("t"),
        vectors.format_vector("a"),
        vectors.silhouette_score(F.lit(0.0), F.lit(0.0)),
        vectors.silhouette_score(F.lit(1.0), F.lit(4.0)),
        vectors.min_max(F.lit(47.5), 18, 77),
        vectors.nominal_distance(F.lit("x"), F.lit("X")),
        vectors.nominal_distance(F.lit("x"), F.lit("x")),
    ).head()
    assert list(row) == [5.0, 7.0, 5.0, [2.0, 1.5], [1.0, 2.5], "0.0,3.0", 0.0, 0.75, 0.5, 1.0, 0.0]


@pytest.mark.parametrize("local", [1_000_000, 0])
def test_nothing_to_merge(spark, local):
    done = agglomerate(points_of(spark, [(3, 4), (3, 4)]), "f", local_doubles=local)
    assert done.n_rounds == 0 and done.merges.count() == 0
    assert [tuple(r) for r in done.centroids.collect()] == [(0, [3.0, 4.0], 2)]


def test_no_points(spark):
    none = points_of(spark, [(1, 1)]).filter("id < 0")
    with pytest.raises(ValueError):
        agglomerate(none, "f")
    with pytest.raises(ValueError):
        kmeans(none, seeds_of(spark, [(0, 0)]), "f")


def test_names_in_use_are_refused(spark):
    with pytest.raises(ValueError):
        assign(points_of(spark, [(1, 1)]).withColumnRenamed("id", "cid"), seeds_of(spark, [(0, 0)]), "f")


def test_cached_points_give_the_same(spark):
    df, seeds = points_of(spark, cloud(50, 2)), seeds_of(spark, cloud(3, 2, seed=5))
    a, b = (kmeans(df, seeds, "f", max_iter=2, stop=None, cache=c).centroids for c in (False, True))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize(
    "bad", [[1.0, 2.0, 3.0], [1.0], [float("nan"), 1.0], [1.0, None], None], ids=["long", "short", "nan", "null", "no vector"]
)
def test_bad_points_are_the_same_error_however_many_centroids(spark, way, bad):
    points = spark.createDataFrame([(0, [1.0, 1.0]), (1, bad)], "id long, v array<double>")
    seeds = spark.createDataFrame([(0, [0.0, 0.0]), (1, [9.0, 9.0])], "cid long, c array<double>")
    with pytest.raises(Exception, match="lacks a coordinate or has too many"):
        nearest.assign(points, seeds, "v").collect()


@pytest.mark.parametrize("bad", [[1.0], [1.0, None], [1.0, float("nan")], None])
def test_bad_centroids_are_an_error(spark, way, bad):
    points = spark.createDataFrame([(0, [1.0, 1.0])], "id long, v array<double>")
    seeds = spark.createDataFrame([(0, [0.0, 0.0]), (1, bad)], "cid long, c array<double>")
    with pytest.raises(ValueError, match="none missing"):
        nearest.assign(points, seeds, "v")


def test_too_few_or_no_points_are_an_error(spark, way):
    points = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "id long, v array<double>")
    seeds = spark.createDataFrame([(0, [0.0, 0.0]), (1, [9.0, 9.0])], "cid long, c array<double>")
    with pytest.raises(ValueError, match="9 seeds asked of 5 points"):
        random_seeds(points, 9, "id", "v")
    with pytest.raises(ValueError, match="no points given"):
        kmeans(points.filter("id > 9"), seeds, "v")

"""

Each query reads the given parquet tables whole. Pages are played by ``customer``, the activity
log by ``events`` or ``orders``, follows by edges made of ``lineitem`` and ``orders``, points by
``lineitem`` measures or ``embeddings``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from skeinset.functions import vectors as V  # noqa: E402
from skeinset.operators import knn as knn_ops  # noqa: E402
from skeinset.operators import nearest, silhouette, social  # noqa: E402
from skeinset.plans import agglomerate as hc  # noqa: E402
from skeinset.plans import kmeans as km  # noqa: E402
from skeinset.sources import folders, schemas, sinks, text  # noqa: E402

try:
    from skeinset.llm import queries as llm_queries  # noqa: E402
except ImportError:
    llm_queries = None

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SEEDS = [
    (10.0, 5000.0, 0.02, 0.01),
    (20.0, 20000.0, 0.04, 0.02),
    (25.0, 40000.0, 0.05, 0.04),
    (35.0, 60000.0, 0.06, 0.05),
    (45.0, 90000.0, 0.08, 0.07),
]
FAR_SEED = (10.0, 900000.0, 0.02, 0.01)
INACTIVE_SINCE = "2024-01-28 00:00:00"
VECTOR_SEEDS = 10
VECTOR_SEED = 7
PRICE_CUTS = ["l_quantity", "l_discount", "l_tax"]
RACE_SEEDS = 200


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seeds(spark: SparkSession, rows=SEEDS) -> DataFrame:
    return nearest.local_table(spark, [(i, list(r)) for i, r in enumerate(rows)], nearest.CENTROID_SCHEMA)


def _flat(centroids: DataFrame, *others: str, digits: int = 4) -> DataFrame:
    coords = [F.round(F.col("c")[i], digits).alias(f"c{i}") for i in range(4)]
    return centroids.select("cid", *coords, *others)


def _vector_seeds(embeddings: DataFrame) -> DataFrame:
    return km.random_seeds(embeddings, VECTOR_SEEDS, "vec_id", "embedding", VECTOR_SEED)


# --- table queries ---------------------------------------------------------------------------


def count_per_category(spark, sf):
    return social.count_by(_read(spark, sf, "customer"), "c_mktsegment", "c_custkey", n="access_count")


def top10_most_accessed(spark, sf):
    pages = _read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return social.top_by_count(
        _read(spark, sf, "orders"), "o_custkey", pages, "c_custkey", pages.columns, 10, "o_orderkey"
    )


def top10_most_active(spark, sf):
    pages = _read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return social.top_by_count(
        _read(spark, sf, "events"), "user_id", pages, "c_custkey", pages.columns, 10, "event_id"
    )


def filter_category(spark, sf):
    return social.filter_equals(_read(spark, sf, "customer"), "c_mktsegment", "BUILDING")


def follower_counts(spark, sf):
    return social.count_with_details(
        _read(spark, sf, "orders"), "o_custkey", _read(spark, sf, "customer"), "c_custkey", "o_orderkey"
    )


def total_and_distinct(spark, sf):
    return social.total_and_distinct(_read(spark, sf, "lineitem"), "l_suppkey", "l_partkey", "l_orderkey")


def above_average(spark, sf):
    return social.above_average(
        _read(spark, sf, "orders"),
        "o_custkey",
        _read(spark, sf, "customer"),
        "c_custkey",
        ["c_name", "c_acctbal"],
        "o_orderkey",
    )


def inactive_entities(spark, sf):
    cutoff = F.lit(datetime.fromisoformat(INACTIVE_SINCE)).cast("timestamp_ntz")
    return social.inactive(
        _read(spark, sf, "customer"),
        "c_custkey",
        _read(spark, sf, "events"),
        "user_id",
        "ts",
        cutoff,
        ["c_custkey", "c_name"],
    )


def one_way_same_region(spark, sf):
    lines = _read(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    edges = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("src"), (F.col("l_suppkey") * 15).alias("dst")
    )
    return social.one_way_same_group(
        edges.filter("src <> dst"),
        "src",
        "dst",
        _read(spark, sf, "customer"),
        "c_custkey",
        "c_nationkey",
        ["c_custkey", "c_name"],
    )


def one_way_hubs(spark, sf):
    """As ``one_way_same_region``; a third of the edges leaves one customer, a third meets another."""
    lines = _read(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    turn = F.col("l_orderkey") % 3
    edges = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.when(turn == 0, 1).otherwise(F.col("o_custkey")).alias("src"),
        F.when(turn == 1, 2).otherwise(F.col("l_suppkey") * 15).alias("dst"),
    )
    customers = _read(spark, sf, "customer")
    columns = ["c_custkey", "c_name"]
    return social.one_way_same_group(edges.filter("src <> dst"), "src", "dst", customers, "c_custkey", "c_nationkey", columns, hubs=True)


# --- k-means ---------------------------------------------------------------------------------


def kmeans_one_step(spark, sf):
    return _flat(km.kmeans_step(_read(spark, sf, "lineitem"), _seeds(spark), MEASURES), "n")


def kmeans_manhattan(spark, sf):
    return _flat(km.kmeans_step(_read(spark, sf, "lineitem"), _seeds(spark), MEASURES, p=1), "n")


def kmeans_lloyd(spark, sf):
    fit = km.lloyd(_read(spark, sf, "embeddings"), "embedding", "vec_id", VECTOR_SEEDS, seed=VECTOR_SEED)
    return _flat(fit.centroids, "n", "converged", F.lit(fit.n_iter).alias("n_iter"), digits=5)


def kmeans_keep_empty(spark, sf):
    seeds = _seeds(spark, [*SEEDS, FAR_SEED])
    return _flat(km.kmeans_step(_read(spark, sf, "lineitem"), seeds, MEASURES, empty="keep"), "n")


def _fit(spark, sf, **options):
    return km.kmeans(_read(spark, sf, "lineitem"), _seeds(spark), MEASURES, **options)


def kmeans_fixed_rounds(spark, sf):
    return _flat(_fit(spark, sf, max_iter=5, stop=None).centroids, "n")


def kmeans_converged(spark, sf):
    return _flat(_fit(spark, sf).centroids, "n", "converged")


def kmeans_history(spark, sf):
    shift = F.round("shift", 3).alias("shift")
    return _flat(_fit(spark, sf).history, "iteration", "n", shift, digits=3)


def kmeans_aligned(spark, sf):
    fit = _fit(spark, sf, max_iter=30, threshold=0.0001, stop="aligned")
    return _flat(fit.centroids, "n", "converged", F.lit(fit.n_iter).alias("n_iter"))


def kmeans_bounded(spark, sf):
    """Rounds over points that carry bounds of their distances."""
    return _flat(_fit(spark, sf, max_iter=12, stop=None, bounds=True).centroids, "n")


def kmeans_centroids(spark, sf):
    return _flat(_fit(spark, sf, threshold=10.0).report, "state")


def kmeans_assignments(spark, sf):
    embeddings = _read(spark, sf, "embeddings")
    fit = km.kmeans(embeddings, _vector_seeds(embeddings), "embedding", threshold=0.0001)
    return fit.assignments.select("vec_id", "cid", F.round("dist", 5).alias("dist"))


def kmeans_assign_lines(spark, sf):
    near = nearest.assign(_read(spark, sf, "lineitem"), _seeds(spark), MEASURES)
    return near.select("l_orderkey", "l_linenumber", *MEASURES, "cid", F.round("dist", 4).alias("dist"))


def nearest_of_many(spark, sf):
    """More centroids than are sent at once, here beyond 1,000 numbers."""
    parts = _read(spark, sf, "part").select(F.col("p_partkey").alias("cid"), V.as_vector(["p_retailprice", "p_size"]).alias("c"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", price.alias("price"), "l_quantity")
    near = nearest.with_nearest(lines, nearest.Centroids.of(parts, 1000), ["price", "l_quantity"], second=True)
    return near.select("l_orderkey", "l_linenumber", "cid", F.round("dist", 6).alias("dist"), F.round("second", 6).alias("second"))


def random_init(spark, sf):
    seeds = _vector_seeds(_read(spark, sf, "embeddings"))
    return seeds.select("cid", F.col("c")[0].alias("c0"), F.col("c")[63].alias("c63"))


def random_init_without_ids(spark, sf):
    seeds = km.random_seeds(_read(spark, sf, "lineitem"), VECTOR_SEEDS, None, MEASURES, VECTOR_SEED, draw="copies")
    return seeds.select("cid", *[F.col("c")[i].alias(f"c{i}") for i in range(4)])


def random_init_by_race(spark, sf):
    seeds = km.random_seeds(_read(spark, sf, "lineitem"), RACE_SEEDS, None, PRICE_CUTS, VECTOR_SEED)
    return seeds.select("cid", *[F.col("c")[i].alias(f"c{i}") for i in range(3)])


# --- silhouettes -----------------------------------------------------------------------------


def silhouette_simple(spark, sf):
    embeddings = _read(spark, sf, "embeddings")
    scored = silhouette.silhouette(embeddings, _vector_seeds(embeddings), "embedding")
    return scored.select("vec_id", "cid", F.round("s", 6).alias("s"))


def silhouette_simple_clusters(spark, sf):
    scored = silhouette.silhouette(_read(spark, sf, "lineitem"), _seeds(spark), MEASURES, by="cluster")
    return scored.select("cid", F.round("s", 6).alias("s"), "n")


def silhouette_pairwise(spark, sf):
    embeddings = _read(spark, sf, "embeddings")
    scored = silhouette.silhouette(
        embeddings, _vector_seeds(embeddings), "embedding", "pairwise", "cluster"
    )
    return scored.select("cid", F.round("s", 6).alias("s"), "n")


def silhouette_pairwise_points(spark, sf):
    suppliers = _read(spark, sf, "supplier")
    centres = _supplier_centres(spark)
    scored = silhouette.silhouette(suppliers, centres, ["s_acctbal", "s_nationkey"], "pairwise", "point")
    return scored.select("s_suppkey", "cid", F.round("s", 6).alias("s"))


def kmeans_silhouette(spark, sf):
    centres = _fit(spark, sf).centroids
    scored = silhouette.silhouette(_read(spark, sf, "lineitem"), centres, MEASURES, by="cluster")
    return scored.select("cid", F.round("s", 6).alias("s"), "n")


def kmeans_silhouette_pairwise(spark, sf):
    embeddings = _read(spark, sf, "embeddings")
    fit = km.kmeans(embeddings, _vector_seeds(embeddings), "embedding", threshold=0.0001)
    scored = silhouette.silhouette(embeddings, fit.centroids, "embedding", "pairwise", "cluster")
    return scored.select("cid", F.round("s", 6).alias("s"), "n")


SUPPLIER_CENTRES = [(1000.0, 12.0), (5000.0, 12.0), (9000.0, 12.0)]


def _supplier_centres(spark):
    return _seeds(spark, SUPPLIER_CENTRES)


# --- agglomerative clustering ----------------------------------------------------------------


def agglomerate_merges(spark, sf):
    merges = hc.agglomerate(_read(spark, sf, "part"), ["p_size"]).merges
    return merges.select(
        "round",
        "n_before",
        "i",
        "j",
        F.round("distance", 6).alias("distance"),
        F.round(F.col("merged")[0], 6).alias("merged"),
    )


def agglomerate_centroids(spark, sf):
    done = hc.agglomerate(_read(spark, sf, "customer"), ["c_nationkey"])
    last = done.last_midpoints.select("cid", F.round(F.col("c")[0], 6).alias("last_midpoint"))
    return done.centroids.select("cid", F.round(F.col("c")[0], 6).alias("mean"), "n").join(last, "cid")


def agglomerate_rounds(spark, sf):
    balance = F.col("c_acctbal")
    nations = _read(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.min(balance).alias("low"), F.max(balance).alias("high"), F.count(F.lit(1)).alias("n")
    )
    merges = hc.agglomerate(nations, ["low", "high", "n"]).merges
    return merges.select("round", "n_before", "i", "j", F.round("distance", 6).alias("distance"))


def _hundredths(column):
    return F.round(F.col(column) * 100).cast("double").alias(column)


def agglomerate_discount_tax(spark, sf):
    done = hc.agglomerate(_read(spark, sf, "lineitem").select(*map(_hundredths, MEASURES[2:])), MEASURES[2:])
    merged = [F.round(F.col("merged")[i], 6).alias(f"m{i}") for i in range(2)]
    return done.merges.select("round", "n_before", "i", "j", F.round("distance", 6).alias("distance"), *merged)


def agglomerate_lineitem(spark, sf):
    status = F.ascii("l_linestatus").cast("double").alias("status")
    points = _read(spark, sf, "lineitem").select(F.col("l_quantity").cast("double"), _hundredths("l_discount"), status)
    done = hc.agglomerate(points, ["l_quantity", "l_discount", "status"])
    return done.merges.select("round", "n_before", "i", "j", F.round("distance", 6).alias("distance"))


def closest_pair(spark, sf):
    suppliers = _read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("cid"), V.as_vector(["s_acctbal", "s_nationkey"]).alias("c")
    )
    pair = hc.closest_pair(suppliers)
    return pair.select(F.round("distance", 6).alias("distance"), "i", "j")


# --- nearest neighbours ----------------------------------------------------------------------


def _nation_profiles(spark, sf):
    top = _read(spark, sf, "supplier").groupBy("s_nationkey").agg(F.max("s_acctbal").alias("c_acctbal"))
    return top.select(F.col("s_nationkey").alias("query_id"), "c_acctbal", F.col("s_nationkey").alias("c_nationkey"))


def _knn_customers(spark, sf):
    return knn_ops.knn_classify(
        _read(spark, sf, "customer"),
        _nation_profiles(spark, sf),
        7,
        {"c_acctbal": (-1000.0, 10000.0)},
        ["c_nationkey"],
        "c_mktsegment",
        ["c_custkey"],
    )


def knn_classify(spark, sf):
    return _knn_customers(spark, sf).labels


def knn_neighbours(spark, sf):
    found = _knn_customers(spark, sf).neighbours
    return found.select("query_id", "rank", F.round("dist", 9).alias("dist"), "c_custkey", "label")


def knn_one_per_distance(spark, sf):
    lines = _read(spark, sf, "lineitem")
    queries = lines.groupBy("l_returnflag").agg(
        F.max("l_discount").alias("l_discount"), F.min("l_quantity").alias("l_quantity")
    )
    found = knn_ops.knn_classify(
        lines,
        queries.withColumn("query_id", F.col("l_returnflag")),
        25,
        {"l_quantity": (1.0, 50.0), "l_discount": (0.0, 0.1)},
        ["l_returnflag"],
        "l_linestatus",
        ["l_orderkey", "l_linenumber"],
        one_per_distance=True,
    ).neighbours
    return found.select(
        "query_id", "rank", F.round("dist", 9).alias("dist"), "l_orderkey", "l_linenumber", "label"
    )


def knn_parsed_queries(spark, sf):
    n = F.col("n_nationkey")
    asked = _read(spark, sf, "nation").select(
        n, n % 7 + 1, n + 20, n * 400, F.when(n % 2 == 0, "BUILDING").otherwise("MACHINERY"), n % 3, n % 6
    )
    key = F.col("c_custkey")
    train = _read(spark, sf, "customer").select(
        "c_custkey",
        (key % 60 + 18).alias("age"),
        F.col("c_acctbal").alias("income"),
        F.col("c_mktsegment").alias("status"),
        (F.col("c_nationkey") % 3).cast("string").alias("gender"),
        (key % 6).alias("children"),
        F.concat(F.lit("m"), F.col("c_nationkey").cast("string")).alias("model"),
    )
    named = [F.col(c).alias(a) for c, a in zip(asked.columns, "abcdefg")]
    queries_ = text.parse_delimited(sinks.to_lines(asked.select(*named)), (("query_id", "int"), *schemas.QUERY))
    found = knn_ops.knn_classify(train, queries_, "k", id_cols=["c_custkey"]).neighbours
    return found.select("query_id", "rank", F.round("dist", 9).alias("dist"), "c_custkey", "label")


# --- text formats ----------------------------------------------------------------------------


def _page_rows(spark, sf):
    return _read(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), "c_acctbal", "c_mktsegment"
    )


def text_pages(spark, sf):
    return text.parse_delimited(sinks.to_lines(_page_rows(spark, sf)), schemas.PAGES)


def text_points(spark, sf):
    lines = sinks.to_lines(_read(spark, sf, "lineitem").select(*MEASURES))
    spaced = lines.select(F.explode(F.array(F.concat(F.lit("  "), "value"), F.lit("  "))).alias("value"))
    parsed = text.parse_points(spaced)
    return parsed.select(*[F.col("features")[i].alias(f"f{i}") for i in range(4)])


def text_follows(spark, sf):
    rows = _read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_custkey") + 1, F.col("o_totalprice"), "o_orderpriority", "o_orderstatus"
    )
    return text.parse_delimited(sinks.to_lines(rows), schemas.FOLLOWS)


def text_activity(spark, sf):
    number = F.when(F.col("value") > 10, F.col("event_id"))
    rows = _read(spark, sf, "events").select("event_id", "user_id", number, "event_type")
    return text.parse_delimited(sinks.to_lines(rows), schemas.ACTIVITY)


# --- sinks, written and read back ------------------------------------------------------------


def sink_delimited(spark, sf):
    path = folders.scratch_folder(spark, "sink") + "/pages"
    sinks.write_delimited(_read(spark, sf, "nation"), path)
    sinks.write_delimited(_page_rows(spark, sf), path, overwrite=True)
    return text.read_pages(spark, path)


def _supplier_points(spark, sf):
    return _read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("cid"), V.as_vector(["s_acctbal", "s_nationkey"]).alias("c")
    )


def sink_keyed(spark, sf):
    path = folders.scratch_folder(spark, "sink") + "/points"
    sinks.write_keyed(_supplier_points(spark, sf), path, "cid", "c")
    read = text.read_centroids(spark, path)
    return read.select(F.col("cid").alias("s_suppkey"), F.col("c")[0].alias("s_acctbal"), F.col("c")[1].alias("s_nationkey"))


def sink_centroids(spark, sf):
    path = folders.scratch_folder(spark, "sink") + "/centroids"
    points = _supplier_points(spark, sf)
    sinks.write_centroids(points, path, with_id=True)
    sinks.write_centroids(points, path)
    ranked = text.read_centroids(spark, path)
    return ranked.select("cid", F.col("c")[0].alias("s_acctbal"), F.col("c")[1].alias("s_nationkey"))


def kmeans_resumed(spark, sf):
    """The rounds of a run that ended after two and was taken up again."""
    path = folders.scratch_folder(spark, "rounds")
    _fit(spark, sf, max_iter=2, rounds_to=path)
    shift = F.round("shift", 3).alias("shift")
    return _flat(_fit(spark, sf, rounds_to=path).history, "iteration", "n", shift, digits=3)


# --- scalar functions ------------------------------------------------------------------------


def vector_functions(spark, sf):
    origin = F.array_repeat(F.lit(0.1), 64)
    vector = V.as_vector("embedding")
    return _read(spark, sf, "embeddings").select(
        "vec_id",
        F.round(V.euclidean(vector, origin), 6).alias("euclidean"),
        F.round(V.minkowski(vector, origin, 1), 6).alias("manhattan"),
        F.round(V.minkowski(vector, origin, 3), 6).alias("cubic"),
        F.round(V.midpoint(vector, origin)[5], 6).alias("middle"),
        (V.parse_vector(V.format_vector(vector)) == vector).alias("round_trip"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """K-means to convergence over all line items."""
    return kmeans_converged(spark, "/root/testdata/sf0.001")


_QUERIES = [
    count_per_category,
    top10_most_accessed,
    top10_most_active,
    filter_category,
    follower_counts,
    total_and_distinct,
    above_average,
    inactive_entities,
    one_way_same_region,
    one_way_hubs,
    kmeans_one_step,
    kmeans_manhattan,
    kmeans_lloyd,
    kmeans_keep_empty,
    kmeans_fixed_rounds,
    kmeans_converged,
    kmeans_history,
    kmeans_aligned,
    kmeans_bounded,
    kmeans_centroids,
    kmeans_assignments,
    kmeans_assign_lines,
    nearest_of_many,
    random_init,
    random_init_without_ids,
    random_init_by_race,
    silhouette_simple,
    silhouette_simple_clusters,
    silhouette_pairwise,
    silhouette_pairwise_points,
    kmeans_silhouette,
    kmeans_silhouette_pairwise,
    agglomerate_merges,
    agglomerate_centroids,
    agglomerate_rounds,
    agglomerate_discount_tax,
    agglomerate_lineitem,
    closest_pair,
    knn_classify,
    knn_neighbours,
    knn_one_per_distance,
    knn_parsed_queries,
    text_pages,
    text_points,
    text_follows,
    text_activity,
    sink_delimited,
    sink_keyed,
    sink_centroids,
    kmeans_resumed,
    vector_functions,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {q.__name__: q for q in _QUERIES}
    return found | llm_queries.queries() if llm_queries else found


# --- SQL for comparison ----------------------------------------------------------------------

_EDGES = """edges AS (
    SELECT DISTINCT o_custkey AS src, l_suppkey * 15 AS dst
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey <> l_suppkey * 15)"""


def _rows_sql(rows) -> str:
    return ", ".join(f"({i}::BIGINT, [{', '.join(f'{v!r}::DOUBLE' for v in r)}])" for i, r in enumerate(rows))


def _dist(a: str, b: str, size: int, p: int = 2) -> str:
    if p == 1:
        return " + ".join(f"abs({a}[{i}]-{b}[{i}])" for i in range(1, size + 1))
    terms = " + ".join(f"({a}[{i}]-{b}[{i}])*({a}[{i}]-{b}[{i}])" for i in range(1, size + 1))
    return f"sqrt({terms})"


def _mean(size: int, weight: str = "") -> str:
    if weight:
        return ", ".join(f"sum(v[{i}]*{weight})/sum({weight})" for i in range(1, size + 1))
    return ", ".join(f"sum(v[{i}])/count(*)" for i in range(1, size + 1))


def _nearest_sql(points: str, centres: str, size: int, p: int = 2) -> str:
    """Points with ``cid`` and ``dist``; ``centres`` has cid, c."""
    return f"""SELECT p.*, near.cid AS cid, near.d AS dist FROM (
        SELECT p.*, list_min(list_transform(s.cs, lambda x: {{'d': {_dist('p.v', 'x.c', size, p)}, 'cid': x.cid}})) AS near
        FROM {points} p, (SELECT list({{'cid': cid, 'c': c}}) AS cs FROM {centres}) s) p"""


def _kmeans_sql(points: str, seeds: str, size: int, rounds: int, stop: str | None, threshold: float) -> str:
    """CTEs ``pts``, ``k``: one row per round and centroid: it, cid, c, prev, shift, n, done."""
    shift = {
        "nearest": f"(SELECT min({_dist('m.c', 'o.c', size)}) FROM cur o)",
        "aligned": _dist("m.c", "m.prev", size),
        None: _dist("m.c", "m.prev", size),
    }[stop]
    done = "false" if stop is None else f"max(shift) OVER () <= {threshold!r}"
    return f"""pts AS MATERIALIZED ({points}),
    k AS (
      SELECT 0 AS it, cid, c, c AS prev, 0.0::DOUBLE AS shift, 0::BIGINT AS n, false AS done FROM ({seeds}) s
      UNION ALL
      SELECT * FROM (
        WITH cur AS (SELECT * FROM k WHERE NOT done AND it < {rounds}),
        near AS ({_nearest_sql('pts', 'cur', size)}),
        m AS (SELECT cur.it + 1 AS it, g.cid, g.c, cur.c AS prev, g.n FROM cur JOIN (
            SELECT cid, [{_mean(size)}] AS c, count(*) AS n FROM near GROUP BY cid) g ON g.cid = cur.cid),
        sh AS (SELECT m.*, {shift} AS shift FROM m)
        SELECT it, cid, c, prev, shift, n, {done} AS done FROM sh))"""


_LINE_POINTS = f"SELECT [{', '.join(MEASURES)}] AS v FROM lineitem"
_EMB_POINTS = "SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings"
_EMB_SEEDS = f"""SELECT (row_number() OVER (ORDER BY vec_id) - 1)::BIGINT AS cid, embedding::DOUBLE[] AS c FROM (
    SELECT * FROM embeddings ORDER BY md5('{VECTOR_SEED}:' || vec_id), vec_id LIMIT {VECTOR_SEEDS})"""


def _line_fit(tail: str, rounds=5, stop="nearest", threshold=2000.0) -> str:
    seeds = f"SELECT * FROM (VALUES {_rows_sql(SEEDS)}) t(cid, c)"
    ctes = _kmeans_sql(_LINE_POINTS, seeds, 4, rounds, stop, threshold)
    return f"WITH RECURSIVE {ctes} {tail}"


def _flat_sql(*others: str, digits: int = 4) -> str:
    return ", ".join(["cid", *[f"round(c[{i + 1}], {digits}) AS c{i}" for i in range(4)], *others])


_PAGES = """SELECT c_custkey::INT AS id, c_name AS "userNickname",
            CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS "userJob", trunc(c_acctbal)::INT AS "userRegionCode",
            c_mktsegment AS "userHobby" FROM customer"""
_LAST = "WHERE it = (SELECT max(it) FROM k)"


def _agglomerate_sql(points: str, size: int, target: int, rounds: int | None, tail: str) -> str:
    """``st``: one row per round and cluster: round, cid, c, and the merge that led to it."""
    more = "" if rounds is None else f" AND round < {rounds}"
    mid = ", ".join(f"(max(c[{i}]) FILTER (cid = b.i) + max(c[{i}]) FILTER (cid = b.j)) / 2" for i in range(1, size + 1))
    return f"""WITH RECURSIVE pts AS MATERIALIZED (SELECT v, count(*)::DOUBLE AS w FROM ({points}) GROUP BY v),
    st AS (
      SELECT 0 AS round, (row_number() OVER (ORDER BY v) - 1)::BIGINT AS cid, v AS c, 0::BIGINT AS n_before,
             NULL::BIGINT AS i, NULL::BIGINT AS j, NULL::DOUBLE AS d FROM pts
      UNION ALL
      SELECT * FROM (
        WITH cur AS (SELECT * FROM st WHERE (SELECT count(*) FROM st) > {target}{more}),
        near AS ({_nearest_sql('pts', 'cur', size)}),
        means AS (SELECT cid, [{_mean(size, 'w')}] AS c FROM near GROUP BY cid),
        best AS (SELECT min({{'d': {_dist('a.c', 'b.c', size)}, 'i': a.cid, 'j': b.cid}}) AS b, (SELECT count(*) FROM means) AS m
                 FROM means a JOIN means b ON a.cid < b.cid HAVING (SELECT count(*) FROM means) > {target}),
        nxt AS (SELECT max(round) + 1 AS round, max(cid) + 1 AS fresh FROM cur)
        SELECT nxt.round, cid, c, m, b.i, b.j, b.d FROM means, best, nxt WHERE cid <> b.i AND cid <> b.j
        UNION ALL
        SELECT max(nxt.round), max(nxt.fresh), [{mid}], max(m), b.i, b.j, b.d FROM means, best, nxt GROUP BY b))
    {tail}"""


def _knn_sql(train: str, queries_: str, k: int, dist: str, ids: str, one: bool, tail: str) -> str:
    first = f"QUALIFY row_number() OVER (PARTITION BY query_id, dist ORDER BY {ids}, label) = 1" if one else ""
    return f"""WITH t AS ({train}), q AS ({queries_}),
    pairs AS (SELECT q.query_id, {dist} AS dist, {ids}, label FROM t, q),
    kept AS (SELECT * FROM pairs {first}),
    near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, {ids}, label)::INT AS rank FROM kept
             QUALIFY rank <= {k})
    {tail}"""


def _knn_customers_sql(tail: str) -> str:
    return _knn_sql(
        "SELECT (c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE AS a, c_nationkey, c_mktsegment AS label, c_custkey FROM customer",
        "SELECT s_nationkey AS query_id, (max(s_acctbal) + 1000.0::DOUBLE) / 11000.0::DOUBLE AS a, s_nationkey AS c_nationkey FROM supplier GROUP BY 1, 3",
        7,
        "(q.a - t.a) * (q.a - t.a) + CASE WHEN q.c_nationkey = t.c_nationkey THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END",
        "c_custkey",
        False,
        tail,
    )


def _pairwise_sql(points: str, centres: str, size: int, tail: str) -> str:
    """``scored``: one row per point: id, cid, s."""
    score = "CASE WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END"
    return f"""WITH pts AS MATERIALIZED ({points}), cen AS MATERIALIZED ({centres}),
    near AS MATERIALIZED ({_nearest_sql('pts', 'cen', size)}),
    own AS (SELECT p.id, coalesce(avg({_dist('p.v', 'q.v', size)}), 0) AS a
            FROM near p LEFT JOIN near q ON p.cid = q.cid AND p.v <> q.v GROUP BY p.id),
    other AS (SELECT p.id, p.cid, coalesce(min({_dist('p.v', 'c.c', size)}), 0) AS b
              FROM near p LEFT JOIN cen c ON p.cid <> c.cid GROUP BY p.id, p.cid),
    scored AS (SELECT id, cid, {score} AS s FROM own JOIN other USING (id))
    {tail}"""


def _simple_sql(points: str, centres: str, size: int, tail: str) -> str:
    return f"""WITH pts AS MATERIALIZED ({points}), cen AS MATERIALIZED ({centres}),
    ds AS (SELECT p.*, list_sort(list_transform(s.cs, lambda x: {{'d': {_dist('p.v', 'x.c', size)}, 'cid': x.cid}})) AS ds
           FROM pts p, (SELECT list({{'cid': cid, 'c': c}}) AS cs FROM cen) s),
    ab AS (SELECT ds.*, ds[1].cid AS cid, ds[1].d AS a, ds[2].d AS b FROM ds),
    scored AS (SELECT ab.*, CASE WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)
    {tail}"""


def oracle_sql() -> dict[str, str]:
    return _sql() | llm_queries.oracle_sql() if llm_queries else _sql()


def _sql() -> dict[str, str]:
    line_seeds = f"SELECT * FROM (VALUES {_rows_sql(SEEDS)}) t(cid, c)"
    far_seeds = f"SELECT * FROM (VALUES {_rows_sql([*SEEDS, FAR_SEED])}) t(cid, c)"
    history = _line_fit(
        f"SELECT {_flat_sql('(it - 1)::INT AS iteration', 'n', 'round(shift, 3) AS shift', digits=3)} FROM k WHERE it > 0"
    )
    supplier_points = "SELECT s_suppkey AS id, [s_acctbal, s_nationkey::DOUBLE] AS v FROM supplier"
    supplier_centres = f"SELECT * FROM (VALUES {_rows_sql(SUPPLIER_CENTRES)}) t(cid, c)"
    emb_ids = "SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings"
    step = f"""SELECT {_flat_sql('n')} FROM (SELECT cid, [{_mean(4)}] AS c, count(*) AS n FROM (
        {_nearest_sql(f'({_LINE_POINTS})', f'({line_seeds})', 4)}) GROUP BY cid)"""
    keep = f"""SELECT {_flat_sql('n')} FROM (SELECT s.cid, coalesce(g.c, s.c) AS c, coalesce(g.n, 0) AS n
        FROM ({far_seeds}) s LEFT JOIN (SELECT cid, [{_mean(4)}] AS c, count(*) AS n FROM (
        {_nearest_sql(f'({_LINE_POINTS})', f'({far_seeds})', 4)}) GROUP BY cid) g ON g.cid = s.cid)"""
    manhattan = f"""SELECT {_flat_sql('n')} FROM (SELECT cid, [{_mean(4)}] AS c, count(*) AS n FROM (
        {_nearest_sql(f'({_LINE_POINTS})', f'({line_seeds})', 4, 1)}) GROUP BY cid)"""
    lloyd = _kmeans_sql(_EMB_POINTS, _EMB_SEEDS, 64, 30, "aligned", 0.0001)
    emb_fit = _kmeans_sql(_EMB_POINTS, _EMB_SEEDS, 64, 5, "nearest", 0.0001)
    return {
        "count_per_category": "SELECT c_mktsegment, count(c_custkey) AS access_count FROM customer GROUP BY 1",
        "top10_most_accessed": """SELECT c_custkey, c_name, c_acctbal FROM (
            SELECT o_custkey, count(o_orderkey) AS n FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey
            ORDER BY n DESC, c_custkey LIMIT 10""",
        "top10_most_active": """SELECT c_custkey, c_name, c_acctbal FROM (
            SELECT user_id, count(event_id) AS n FROM events GROUP BY 1) JOIN customer ON user_id = c_custkey
            ORDER BY n DESC, c_custkey LIMIT 10""",
        "filter_category": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
        "follower_counts": """SELECT owner, n, customer.* FROM (
            SELECT o_custkey AS owner, count(o_orderkey) AS n FROM orders GROUP BY 1) JOIN customer ON owner = c_custkey""",
        "total_and_distinct": """SELECT l_suppkey, count(l_orderkey) AS n, count(DISTINCT l_partkey) AS n_distinct
            FROM lineitem GROUP BY 1""",
        "above_average": """WITH g AS (SELECT o_custkey AS owner, count(o_orderkey) AS n FROM orders GROUP BY 1)
            SELECT owner, c_name, c_acctbal, n FROM g JOIN customer ON owner = c_custkey
            WHERE n > (SELECT avg(n) FROM g)""",
        "inactive_entities": f"""SELECT c_custkey, c_name FROM customer LEFT JOIN (
            SELECT user_id, max(ts) AS last FROM events GROUP BY 1) ON user_id = c_custkey
            WHERE last IS NULL OR last <= TIMESTAMP '{INACTIVE_SINCE}'""",
        "one_way_same_region": f"""WITH {_EDGES}
            SELECT DISTINCT a.c_custkey, a.c_name FROM edges e
            JOIN customer a ON a.c_custkey = e.src JOIN customer b ON b.c_custkey = e.dst
            LEFT JOIN edges r ON r.src = e.dst AND r.dst = e.src
            WHERE r.src IS NULL AND a.c_nationkey = b.c_nationkey""",
        "one_way_hubs": """WITH raw AS (
            SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS src,
            CASE WHEN l_orderkey % 3 = 1 THEN 2 ELSE l_suppkey * 15 END AS dst
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
            edges AS (SELECT DISTINCT src, dst FROM raw WHERE src <> dst)
            SELECT DISTINCT a.c_custkey, a.c_name FROM edges e
            JOIN customer a ON a.c_custkey = e.src JOIN customer b ON b.c_custkey = e.dst
            LEFT JOIN edges r ON r.src = e.dst AND r.dst = e.src
            WHERE r.src IS NULL AND a.c_nationkey = b.c_nationkey""",
        "kmeans_one_step": step,
        "kmeans_manhattan": manhattan,
        "kmeans_lloyd": f"WITH RECURSIVE {lloyd} SELECT "
        + _flat_sql("n", "done AS converged", "it::INT AS n_iter", digits=5)
        + f" FROM k {_LAST}",
        "kmeans_keep_empty": keep,
        "kmeans_fixed_rounds": _line_fit(f"SELECT {_flat_sql('n')} FROM k {_LAST}", stop=None),
        "kmeans_converged": _line_fit(f"SELECT {_flat_sql('n', 'done AS converged')} FROM k {_LAST}"),
        "kmeans_history": history,
        "kmeans_resumed": history,
        "kmeans_aligned": _line_fit(
            f"SELECT {_flat_sql('n', 'done AS converged', 'it::INT AS n_iter')} FROM k {_LAST}", 30, "aligned", 0.0001
        ),
        "kmeans_bounded": _line_fit(f"SELECT {_flat_sql('n')} FROM k {_LAST}", 12, None),
        "kmeans_centroids": _line_fit(
            "SELECT " + _flat_sql("CASE WHEN done THEN 'Convergence reached' ELSE 'Convergence not reached' END AS state")
            + f" FROM k {_LAST}", 5, "nearest", 10.0
        ),
        "kmeans_assignments": f"""WITH RECURSIVE {emb_fit}, last AS (SELECT * FROM k {_LAST})
            SELECT vec_id, cid, round(dist, 5) AS dist FROM ({_nearest_sql('pts', 'last', 64)})""",
        "kmeans_assign_lines": f"""SELECT * EXCLUDE (v, near) REPLACE (round(dist, 4) AS dist) FROM ({_nearest_sql(
            f"(SELECT l_orderkey, l_linenumber, {', '.join(MEASURES)}, [{', '.join(MEASURES)}] AS v FROM lineitem)",
            f'({line_seeds})', 4)})""",
        "nearest_of_many": f"""SELECT l_orderkey, l_linenumber, b[1].i AS cid, round(b[1].d, 6) AS dist, round(b[2].d, 6) AS second FROM (
            SELECT l_orderkey, l_linenumber, r, min({{'d': {_dist('v', 'c', 2)}, 'i': p_partkey}}, 2) AS b
            FROM (SELECT l_orderkey, l_linenumber, row_number() OVER () AS r, [l_extendedprice / l_quantity, l_quantity] AS v FROM lineitem),
                 (SELECT p_partkey, [p_retailprice, p_size::DOUBLE] AS c FROM part) GROUP BY ALL)""",
        "random_init": f"SELECT cid, c[1] AS c0, c[64] AS c63 FROM ({_EMB_SEEDS})",
        "random_init_by_race": f"""WITH t AS (
                SELECT v, count(*) AS n FROM (SELECT [{', '.join(PRICE_CUTS)}] AS v FROM lineitem) GROUP BY v),
            p AS (SELECT v, n, unnest(range(1, least(n, {RACE_SEEDS}) + 1)) AS j FROM t),
            u AS (SELECT v, n, j, (('0x' || left(md5('{VECTOR_SEED}:' || array_to_string(v, ',') || ':' || j), 13))::BIGINT::DOUBLE + 1)
                / 4503599627370496::DOUBLE AS u FROM p),
            e AS (SELECT v, j, sum(-ln(u) / (n - j + 1)) OVER (PARTITION BY v ORDER BY j) AS a FROM u),
            drawn AS (SELECT v, j FROM e ORDER BY a, v, j LIMIT {RACE_SEEDS})
            SELECT row_number() OVER (ORDER BY v, j) - 1 AS cid, {', '.join(f'v[{i + 1}] AS c{i}' for i in range(3))} FROM drawn""",
        "random_init_without_ids": f"""WITH t AS (SELECT v, row_number() OVER (PARTITION BY v) AS i FROM ({_LINE_POINTS})),
            drawn AS (SELECT * FROM t ORDER BY md5('{VECTOR_SEED}:' || array_to_string(v, ',') || ':' || i) LIMIT {VECTOR_SEEDS})
            SELECT (row_number() OVER (ORDER BY v, i) - 1)::BIGINT AS cid, v[1] AS c0, v[2] AS c1, v[3] AS c2, v[4] AS c3 FROM drawn""",
        "silhouette_simple": _simple_sql(
            emb_ids, _EMB_SEEDS, 64, "SELECT id AS vec_id, cid, round(s, 6) AS s FROM scored"
        ),
        "silhouette_simple_clusters": _simple_sql(
            _LINE_POINTS, line_seeds, 4, "SELECT cid, round(avg(s), 6) AS s, count(*) AS n FROM scored GROUP BY cid"
        ),
        "silhouette_pairwise": _pairwise_sql(
            emb_ids, _EMB_SEEDS, 64, "SELECT cid, round(avg(s), 6) AS s, count(*) AS n FROM scored GROUP BY cid"
        ),
        "silhouette_pairwise_points": _pairwise_sql(
            supplier_points, supplier_centres, 2, "SELECT id AS s_suppkey, cid, round(s, 6) AS s FROM scored"
        ),
        "kmeans_silhouette": _simple_sql(
            _LINE_POINTS,
            _line_fit(f"SELECT cid, c FROM k {_LAST}"),
            4,
            "SELECT cid, round(avg(s), 6) AS s, count(*) AS n FROM scored GROUP BY cid",
        ),
        "kmeans_silhouette_pairwise": _pairwise_sql(
            emb_ids,
            f"WITH RECURSIVE {emb_fit} SELECT cid, c FROM k {_LAST}",
            64,
            "SELECT cid, round(avg(s), 6) AS s, count(*) AS n FROM scored GROUP BY cid",
        ),
        "agglomerate_merges": _agglomerate_sql(
            "SELECT [p_size::DOUBLE] AS v FROM part",
            1,
            1,
            None,
            """SELECT (round - 1)::INT AS round, n_before, i, j, round(d, 6) AS distance,
               round(max_by(c[1], cid), 6) AS merged FROM st WHERE round > 0 GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY st.round, n_before, i, j, d"),
        ),
        "agglomerate_centroids": _agglomerate_sql(
            "SELECT [c_nationkey::DOUBLE] AS v FROM customer",
            1,
            1,
            None,
            f""", last AS (SELECT * FROM st WHERE round = (SELECT max(round) FROM st)),
            final AS ({_nearest_sql('pts', 'last', 1)})
            SELECT final.cid, round(sum(v[1] * w) / sum(w), 6) AS mean, sum(w)::BIGINT AS n,
                   round(any_value(last.c[1]), 6) AS last_midpoint
            FROM final JOIN last ON final.cid = last.cid GROUP BY final.cid""",
        ),
        "agglomerate_rounds": _agglomerate_sql(
            """SELECT [min(c_acctbal), max(c_acctbal), count(*)::DOUBLE] AS v FROM customer GROUP BY c_nationkey""",
            3,
            1,
            None,
            """SELECT DISTINCT (round - 1)::INT AS round, n_before, i, j, round(d, 6) AS distance
               FROM st WHERE round > 0""",
        ),
        "agglomerate_discount_tax": _agglomerate_sql(
            "SELECT [round(l_discount * 100)::DOUBLE, round(l_tax * 100)::DOUBLE] AS v FROM lineitem",
            2,
            1,
            None,
            """SELECT (round - 1)::INT AS round, n_before, i, j, round(d, 6) AS distance,
               round(max_by(c[1], cid), 6) AS m0, round(max_by(c[2], cid), 6) AS m1
               FROM st WHERE round > 0 GROUP BY st.round, n_before, i, j, d""",
        ),
        "closest_pair": f"""SELECT round(p.d, 6) AS distance, p.i AS i, p.j AS j FROM (
            SELECT min({{'d': {_dist('a.v', 'b.v', 2)}, 'i': a.id, 'j': b.id}}) AS p
            FROM ({supplier_points}) a JOIN ({supplier_points}) b ON a.id < b.id)""",
        "knn_classify": _knn_customers_sql(
            """, votes AS (SELECT query_id, label, count(*) AS n FROM near GROUP BY 1, 2)
            SELECT query_id, label FROM votes
            QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) = 1"""
        ),
        "knn_neighbours": _knn_customers_sql(
            "SELECT query_id, rank, round(dist, 9) AS dist, c_custkey, label FROM near"
        ),
        "knn_one_per_distance": _knn_sql(
            """SELECT (l_quantity - 1.0::DOUBLE) / 49.0::DOUBLE AS a, (l_discount - 0.0::DOUBLE) / 0.1::DOUBLE AS b,
               l_returnflag, l_linestatus AS label, l_orderkey, l_linenumber FROM lineitem""",
            """SELECT l_returnflag AS query_id, (min(l_quantity) - 1.0::DOUBLE) / 49.0::DOUBLE AS a,
               (max(l_discount) - 0.0::DOUBLE) / 0.1::DOUBLE AS b, l_returnflag FROM lineitem GROUP BY 1, 4""",
            25,
            """(q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b)
               + CASE WHEN q.l_returnflag = t.l_returnflag THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END""",
            "l_orderkey, l_linenumber",
            True,
            "SELECT query_id, rank, round(dist, 9) AS dist, l_orderkey, l_linenumber, label FROM near",
        ),
        "knn_parsed_queries": """WITH t AS (
              SELECT c_custkey, (c_custkey % 60 + 18 - 18.0::DOUBLE) / 59.0::DOUBLE AS a,
                     (c_acctbal - 5000.0::DOUBLE) / 62789.0::DOUBLE AS b, (c_custkey % 6)::DOUBLE / 5.0::DOUBLE AS c,
                     c_mktsegment AS status, c_nationkey % 3 AS gender, 'm' || c_nationkey AS label FROM customer),
            q AS (
              SELECT n_nationkey AS query_id, n_nationkey % 7 + 1 AS k, (n_nationkey + 20 - 18.0::DOUBLE) / 59.0::DOUBLE AS a,
                     (n_nationkey * 400 - 5000.0::DOUBLE) / 62789.0::DOUBLE AS b, (n_nationkey % 6)::DOUBLE / 5.0::DOUBLE AS c,
                     CASE WHEN n_nationkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END AS status, n_nationkey % 3 AS gender
              FROM nation),
            pairs AS (
              SELECT query_id, k, c_custkey, label, (q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b) + (q.c - t.c) * (q.c - t.c)
                + CASE WHEN q.status = t.status THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END
                + CASE WHEN q.gender = t.gender THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS dist FROM t, q),
            near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, c_custkey)::INT AS rank FROM pairs)
            SELECT query_id::INT AS query_id, rank, round(dist, 9) AS dist, c_custkey, label FROM near WHERE rank <= k""",
        "text_pages": _PAGES,
        "sink_delimited": _PAGES,
        "sink_keyed": "SELECT s_suppkey, s_acctbal, s_nationkey::DOUBLE AS s_nationkey FROM supplier",
        "sink_centroids": """SELECT (row_number() OVER (ORDER BY s_suppkey) - 1)::BIGINT AS cid, s_acctbal,
            s_nationkey::DOUBLE AS s_nationkey FROM supplier""",
        "text_follows": """SELECT o_orderkey::INT AS "colRel", o_custkey::INT AS id1, (o_custkey + 1)::INT AS id2,
            trunc(o_totalprice)::INT AS date, o_orderpriority AS "desc" FROM orders""",
        "text_activity": """SELECT event_id::INT AS "logId", user_id::INT AS "byWho",
            CASE WHEN value > 10 THEN event_id::INT END AS "whatPage", event_type AS "actionType",
            NULL::INT AS time FROM events""",
        "text_points": "SELECT l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3 FROM lineitem",
        "vector_functions": """SELECT vec_id,
            round(sqrt(list_sum([(x - 0.1::DOUBLE) * (x - 0.1::DOUBLE) for x in v])), 6) AS euclidean,
            round(list_sum([abs(x - 0.1::DOUBLE) for x in v]), 6) AS manhattan,
            round(pow(list_sum([pow(abs(x - 0.1::DOUBLE), 3) for x in v]), 1.0::DOUBLE / 3), 6) AS cubic,
            round((v[6] + 0.1::DOUBLE) / 2, 6) AS middle,
            true AS round_trip
            FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)""",
    }

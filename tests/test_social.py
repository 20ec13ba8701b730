import pytest
from pyspark.sql import functions as F

from skeinset.operators import hubs, social


@pytest.fixture
def pages(spark):
    rows = [
        (1, "ann", "cook", 1, "Hockey"),
        (2, "bob", "cook", 1, "hockey"),
        (3, "cid", "smith", 2, "Hockey"),
        (4, "dan", "smith", 2, None),
    ]
    return spark.createDataFrame(rows, "id int, nick string, job string, region int, hobby string")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def facts(spark, rows):
    return spark.createDataFrame(rows, "log int, who int, page int, time int")


def test_count_by_skips_null_first_field_and_keeps_null_key(spark, pages):
    assert got(social.count_by(pages, "hobby", "id")) == [("Hockey", 2), ("hockey", 1), (None, 1)]
    log = facts(spark, [(None, 1, 1, 1), (2, 1, 1, 1), (None, 2, 2, 1)])
    assert got(social.count_by(log, "page", "log")) == [(1, 1), (2, 0)]


def test_filter_is_case_sensitive(pages):
    assert [r["id"] for r in social.filter_equals(pages, "hobby", "Hockey").orderBy("id").collect()] == [1, 3]


def test_top_by_count_breaks_ties_by_id_and_drops_unknown(spark, pages):
    log = facts(spark, [(i, 9, p, 1) for i, p in enumerate([2, 2, 3, 3, 1, 77, 77, 77, None, None, None])])
    top = social.top_by_count(log, "page", pages, "id", ["id", "nick", "job"], 2, "log")
    assert [tuple(r) for r in top.collect()] == [(2, "bob", "cook"), (3, "cid", "smith")]


def test_top_by_count_with_repeated_ids(spark):
    dim = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "id int, nick string")
    log = facts(spark, [(1, 9, 1, 1), (2, 9, 1, 1), (3, 9, 2, 1)])
    assert got(social.top_by_count(log, "page", dim, "id", ["id", "nick"], 2, "log")) == [(1, "x"), (1, "y")]
    assert social.top_by_count(log, "page", dim, "id", ["id", "nick"], 3, "log").count() == 3


def test_count_with_details_is_inner(spark, pages):
    log = facts(spark, [(1, 9, 2, 1), (2, 9, 2, 1), (3, 9, None, 1)])
    assert got(social.count_with_details(log, "page", pages, "id", "log")) == [(2, 2, 2, "bob", "cook", 1, "hockey")]


def test_total_and_distinct(spark):
    log = facts(spark, [(1, 1, 5, 0), (2, 1, 5, 0), (3, 1, 6, 0), (4, 2, None, 0), (None, 2, 7, 0)])
    assert got(social.total_and_distinct(log, "who", "page", "log")) == [(1, 3, 2), (2, 1, 1)]


def test_above_average_is_strict(spark, pages):
    equal = facts(spark, [(i, 9, p, 1) for i, p in enumerate([1, 2, 3])])
    assert social.above_average(equal, "page", pages, "id", ["nick"], "log").count() == 0
    more = facts(spark, [(i, 9, p, 1) for i, p in enumerate([1, 1, 2])])
    assert got(social.above_average(more, "page", pages, "id", ["nick"], "log")) == [(1, "ann", 2)]


def test_mean_counts_the_null_group(spark, pages):
    log = facts(spark, [(i, 9, p, 1) for i, p in enumerate([1, 1, None, None, None, None])])
    assert social.above_average(log, "page", pages, "id", ["nick"], "log").count() == 0


def test_inactive_cutoff_is_inclusive(spark, pages):
    log = facts(spark, [(1, 1, 9, 997840), (2, 2, 9, 997841), (3, 2, 9, 5), (4, 3, 9, None)])
    out = social.inactive(pages, "id", log, "who", "time", 1000000 - 24 * 90, ["id", "nick"])
    assert got(out) == [(1, "ann"), (3, "cid"), (4, "dan")]


def test_inactive_pushes_the_bound_into_the_scan(spark, pages, tmp_path):
    facts(spark, [(1, 1, 9, 5)]).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = social.inactive(pages, "id", log, "who", "time", 3, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(time,3)" in plan
    assert "ReadSchema: struct<who:int,time:int>" in plan


def edge_frame(spark, rows):
    return spark.createDataFrame(rows, "a int, b int")


@pytest.mark.parametrize("spread", [False, True])
def test_one_way_links(spark, pages, spread):
    def run(rows):
        out = social.one_way_same_group(edge_frame(spark, rows), "a", "b", pages, "id", "region", ["id", "nick"], spread)
        return got(out)

    assert run([(1, 2), (2, 1)]) == []
    assert run([(1, 3)]) == []
    assert run([(1, 2), (1, 2), (3, 4), (None, 2), (2, None), (9, 1)]) == [(1, "ann"), (3, "cid")]


@pytest.mark.parametrize("spread", [False, True])
def test_one_way_links_with_repeated_node_ids(spark, spread):
    nodes = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 2)], "id int, nick string, region int")
    out = social.one_way_same_group(edge_frame(spark, [(1, 2)]), "a", "b", nodes, "id", "region", ["id", "nick"], spread)
    assert got(out) == [(1, "y")]


@pytest.fixture
def no_help(spark):
    """Neither adaptive execution nor broadcasts by size."""
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {c: spark.conf.get(c) for c in plain}
    for c, value in plain.items():
        spark.conf.set(c, value)
    yield
    for c, value in before.items():
        spark.conf.set(c, value)


def test_links_of_a_hub_are_spread(spark, no_help):
    ids = F.col("id")
    edges = spark.range(60_000).select(F.when(ids % 3 == 0, -1).otherwise(ids % 5003).alias("src"), ids.alias("dst"))
    nodes = spark.range(-1, 60_000).select(ids.alias("src"), (ids % 7).alias("g"))
    hot = hubs.frequent_values(edges, "src")
    assert [r["__hot"] for r in hot.collect()] == [-1]

    def tasks(joined):
        return sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())

    spread, plain = hubs.join_spread(edges, nodes, "src", ["dst"]), edges.join(nodes, "src")
    assert sorted(spread.columns) == sorted(plain.columns) and spread.exceptAll(plain.select(spread.columns)).isEmpty()
    sizes = tasks(spread)
    assert sum(sizes) == 60_000 and len(sizes) == 8 and sizes[-1] < 3 * sizes[4]
    assert tasks(plain)[-1] > 20_000


def test_frequent_values_of_little(spark):
    rows = [("a", 1)] * 50 + [("b", 2)] * 50 + [(None, 3)] * 500
    table = spark.createDataFrame(rows, "k string, v int")
    assert {r["__hot"]: r["__copies"] for r in hubs.frequent_values(table, "k", 8).collect()} == {"a": 16, "b": 16}
    assert hubs.frequent_values(table.limit(0), "k").count() == 0
    twice = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k string, w string")
    assert hubs.join_spread(table, twice, "k", ["v"]).count() == 100
    assert hubs.join_spread(table.limit(0), twice, "k", ["v"]).count() == 0


def test_hot_key_and_partitioning_do_not_change_results(spark, pages):
    rows = [(i, i % 5, 1 if i % 3 else i % 4 + 1, i) for i in range(3000)]
    log = facts(spark, rows)
    expected = {}
    for _, _, page, _ in rows:
        expected[page] = expected.get(page, 0) + 1
    for parts in (1, 7, 64):
        assert dict(got(social.count_by(log.repartition(parts), "page", "log"))) == expected


def test_mean_shares_the_grouped_rows(spark, pages, tmp_path):
    facts(spark, [(i, 9, i % 3 + 1, 1) for i in range(100)]).write.parquet(str(tmp_path / "log"))
    out = social.above_average(spark.read.parquet(str(tmp_path / "log")), "page", pages, "id", ["nick"], "log")
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()

"""The registered queries on the small tables, with SQL where there is some, and the pipeline by brute force."""

import os

import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from skeinset.llm import queries, sql
from skeinset.llm.common import keep
from skeinset.llm.rules import quality_rules
from tests.llm.test_operators import plain_fingerprint, plain_removed, plain_roots

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    df = queries.queries()[name](spark, SF)
    cursor = con.execute(sql.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(tuple(r[n] for n in names) for r in df.collect())
    assert got == sorted(cursor.fetchall())


STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    return rows.union(rows.limit(20))


@pytest.fixture(scope="module")
def ruled(spark, docs):
    return keep(STAGES["quality rules"](spark, docs, SF), "ruled")


def texts_of(df):
    return sorted((r.text for r in df.collect()), key=str)


def test_quality_stage_keeps_what_the_rules_keep(docs, ruled):
    want = docs.select("text", quality_rules("text").alias("r")).filter("r.kept")
    assert texts_of(ruled) == texts_of(want) and 0 < ruled.count() < docs.count()


def test_near_duplicates_stage_keeps_one_of_each_group(spark, ruled):
    rows = ruled.collect()
    roots = plain_roots(sorted({plain_fingerprint(r.text) for r in rows}))
    first = {}
    for r in rows:
        root = roots[plain_fingerprint(r.text)]
        first[root] = min(first.get(root, r.doc_id), r.doc_id)
    one = STAGES["near-duplicates"](spark, ruled, SF)
    assert sorted(r.doc_id for r in one.collect()) == sorted(first.values()) and len(first) < len(rows)


def test_near_duplicates_stage_with_missing_and_repeated_ids(spark, ruled):
    a, b = ("one two three four five six seven " * 3, "quite another text it is and has nothing in common with that")
    rows = [(None, a), (None, b), (7, a), (7, "a third text of its own that no other row has at all"), (7, a), (None, None), (None, "")]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], ruled.select("doc_id", "text", "lang", "source", "n_chars").schema)
    got = STAGES["near-duplicates"](spark, table, SF).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == sorted([(7, a), (7, rows[3][1])])
    assert sorted((r.text or "") for r in got if r.doc_id is None) == ["", b]


def test_substrings_stage_removes_repeats(spark, ruled):
    left = STAGES["substrings"](spark, ruled, SF)
    rows = ruled.collect()
    removed = plain_removed([r.text for r in rows], 35)
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r, (n, gone, _) in zip(rows, removed) if gone < n or not n)


def test_decontamination_stage_drops_what_the_query_finds(spark, docs):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 80").head().text
    leaked = docs.limit(1).withColumns({"text": F.lit("Before it " + item + " after"), "doc_id": F.lit(-5).cast("bigint")})
    left = STAGES["decontamination"](spark, docs.union(leaked), SF)
    ids = {r.doc_id for r in left.select("doc_id").collect()}
    found = queries.queries()["op8_decontaminate"](spark, SF).filter("not contaminated").select("doc_id").collect()
    assert ids == {r.doc_id for r in found} and -5 not in ids


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_takes_odd_and_empty_tables(spark, docs, odd_docs, no_docs, name):
    assert STAGES[name](spark, no_docs.select(docs.columns), SF).count() == 0
    out = STAGES[name](spark, odd_docs.select(docs.columns), SF)
    out.collect()
    if name != "packing":
        assert out.columns == docs.columns


def test_run_applies_every_stage(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, SF), "step")
    assert sorted((r.doc_id, r.piece, r.length) for r in rows) == sorted((r.doc_id, r.piece, r.length) for r in docs.collect())

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skeinset.sources import folders, sinks, synthetic, text


def lines(tmp_path, *rows):
    path = tmp_path / "in.txt"
    path.write_text("\n".join(rows) + "\n")
    return str(path)


def test_fields_without_quoting(spark, tmp_path):
    path = lines(tmp_path, '1,"A,B",x,3,Hockey', "2,N,J,4", "3,N,J,5,Sewing,more", "x,,J,3.7,Hockey", "")
    rows = [tuple(r) for r in text.read_pages(spark, path).collect()]
    assert rows == [
        (1, '"A', 'B"', None, "3"),
        (2, "N", "J", 4, None),
        (3, "N", "J", 5, "Sewing"),
        (None, None, "J", 3, "Hockey"),
        (None, None, None, None, None),
    ]


def test_points_skip_blank_lines_and_reject_text(spark, tmp_path):
    path = lines(tmp_path, "1,2,3,4", "", "  5, 6,7,8 ")
    assert [r["features"] for r in text.read_points(spark, path).collect()] == [[1, 2, 3, 4], [5, 6, 7, 8]]
    with pytest.raises(PySparkException):
        text.read_points(spark, lines(tmp_path, "1,a")).collect()


def test_tables_round_trip(spark, tmp_path):
    for name, df, read in (
        ("pages", synthetic.pages(spark, 200), text.read_pages),
        ("follows", synthetic.follows(spark, 200, 50), text.read_follows),
        ("activity", synthetic.activity(spark, 200, 50), text.read_activity),
    ):
        sinks.write_delimited(df, str(tmp_path / name))
        back = read(spark, str(tmp_path / name))
        assert back.columns == df.columns
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_writers_refuse_and_overwrite(spark, tmp_path):
    df, path = synthetic.pages(spark, 5), str(tmp_path / "out")
    sinks.write_delimited(df, path)
    with pytest.raises(PySparkException):
        sinks.write_delimited(df, path)
    sinks.write_delimited(df.limit(2), path, overwrite=True)
    assert text.read_pages(spark, path).count() == 2


@pytest.mark.parametrize("with_id", [False, True])
def test_centroids_round_trip(spark, tmp_path, with_id):
    df = spark.createDataFrame([(2, [5.0, 1.5]), (0, [1.0, 2.0]), (1, [3.0, 4.0])], "cid bigint, c array<double>")
    sinks.write_centroids(df, str(tmp_path / "c"), with_id)
    back = text.read_centroids(spark, str(tmp_path / "c"))
    assert [tuple(r) for r in back.collect()] == [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 1.5])]
    assert len([f for f in (tmp_path / "c").iterdir() if f.name.startswith("part")]) == 1


def test_centroids_of_several_files_come_in_the_order_of_names(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "part-00001").write_text("\n".join(f"{i},0" for i in range(1, 51)) + "\n")
    (folder / "part-00000").write_text("0,0\n\n")
    back = text.read_centroids(spark, str(folder)).orderBy("cid").collect()
    assert [(r["cid"], r["c"][0]) for r in back] == [(i, float(i)) for i in range(51)]


def test_lines_keep_their_order_over_many_splits(spark, tmp_path):
    folder = tmp_path / "split"
    folder.mkdir()
    for name, n in (("b", 700), ("a", 40), ("c", 0), ("d", 900)):
        (folder / name).write_text("".join(f"{name},{i}\n" + "\n" * (i % 3) for i in range(n)))
    sizes = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
        back = text._in_order(spark, str(folder)).collect()
    finally:
        for c, size in sizes.items():
            spark.conf.set(c, size)
    want = [f"{name},{i}" for name, n in (("a", 40), ("b", 700), ("d", 900)) for i in range(n)]
    assert [r["value"] for r in sorted(back, key=lambda r: r["at"])] == want
    assert sorted(r["at"] for r in back) == list(range(len(want)))


def test_queries_have_numbers_in_file_order(spark, tmp_path):
    path = lines(tmp_path, "3,20,5000,S,F,1", "", "1,30,6000,M,M,0")
    rows = text.read_queries(spark, path).orderBy("query_id").collect()
    assert [(r["query_id"], r["k"], r["age"], r["gender"]) for r in rows] == [(0, 3, 20.0, "F"), (1, 1, 30.0, "M")]


def test_dump_prints_the_first_rows(spark, capsys):
    sinks.dump(spark.range(5), 2)
    out = capsys.readouterr().out
    assert "|1 " in out and "|2 " not in out and "top 2 rows" in out


def test_keyed_lines(spark, tmp_path):
    df = spark.createDataFrame([([1.0, 2.0], "reached")], "c array<double>, state string")
    sinks.write_keyed(df, str(tmp_path / "kv"), "c", "state")
    sinks.write_keyed(df, str(tmp_path / "k"), "c")
    assert spark.read.text(str(tmp_path / "kv")).collect()[0][0] == "1.0,2.0\treached"
    assert spark.read.text(str(tmp_path / "k")).collect()[0][0] == "1.0,2.0"


def test_history_folders(spark, tmp_path):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0)], "iteration int, shift double")
    sinks.write_history(df, str(tmp_path / "h"))
    assert {p.name for p in (tmp_path / "h").iterdir() if p.is_dir()} == {"iteration=0", "iteration=1"}


def test_generators_keep_their_ranges(spark):
    row = synthetic.points(spark, 3000).selectExpr("min(w)", "max(w)", "min(x)", "max(x)", "max(y)", "max(z)").head()
    assert row[0] >= 0 and row[1] <= 10000 and row[2] >= 20000 and row[3] <= 1000000
    assert row[4] <= 20000 and row[5] <= 30000
    assert synthetic.seed_points(spark, 4).count() == 4
    edges = synthetic.follows(spark, 2000, 20)
    assert edges.filter("id1 = id2 or id2 < 1 or id2 > 20 or date < 1 or date > 1000001").count() == 0
    assert edges.selectExpr("count(distinct id1)", "count(distinct id2)").head()[:] == (20, 20)
    log = synthetic.activity(spark, 2000, 20)
    assert log.filter("byWho = whatPage or whatPage < 1 or whatPage > 20").count() == 0
    people = synthetic.pages(spark, 1000)
    assert people.filter("userRegionCode < 1 or userRegionCode > 50").count() == 0
    listed = people.filter(people["userHobby"].isin(synthetic.HOBBIES)).count()
    assert 400 < listed < 600
    assert people.filter("not (length(userHobby) = 15 or userHobby rlike '^[A-Z][a-z ]+$')").count() == 0


def test_generators_do_not_depend_on_partitions(spark):
    a = synthetic.pages(spark, 500, seed=3)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, synthetic.pages(spark, 500, seed=3).repartition(3).collect()))
    assert sorted(map(tuple, a.collect())) != sorted(map(tuple, synthetic.pages(spark, 500, seed=4).collect()))


def test_a_failed_overwrite_leaves_the_old_data(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_delimited(spark.range(5), path)
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("x"))
    for write in (sinks.write_delimited, lambda df, to, overwrite: sinks.write_keyed(df, to, "x", overwrite=overwrite)):
        with pytest.raises(PySparkException):
            write(broken, path, overwrite=True)
        assert sorted(r.value for r in spark.read.text(path).collect()) == list("01234")
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    with pytest.raises(PySparkException):
        sinks.write_delimited(spark.range(2), path)
    sinks.write_delimited(spark.range(2), path, overwrite=True)
    assert spark.read.text(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_what_a_cut_off_commit_left_is_put_right(spark, tmp_path):
    path = tmp_path / "out"
    sinks.write_delimited(spark.range(3), str(path))
    path.rename(tmp_path / "_before-out")  # ended between the two moves
    folders.recover(spark, str(path))
    assert spark.read.text(str(path)).count() == 3
    sinks.write_delimited(spark.range(9), str(tmp_path / "_before-out"))  # ended before the former one was removed
    sinks.write_delimited(spark.range(4), str(path), overwrite=True)
    assert spark.read.text(str(path)).count() == 4 and [p.name for p in tmp_path.iterdir()] == ["out"]

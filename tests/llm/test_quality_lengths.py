from skeinset.llm.quality import quality_score, train


def test_long_labelled_texts_count(spark):
    good, bad = ("calm river stone light " * 2000, "BUY!! NOW!! $$$ " * 2000)
    docs = spark.createDataFrame([(i, good if i < 10 else bad) for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(20)], "doc_id long, quality int")
    model = train(docs, labels, "doc_id", "text", "quality")
    assert len(model.labels) == 20
    assert all((r.score > 0.5) == (r.doc_id < 10) for r in quality_score(docs, model).collect())

"""Fill-in-middle against a plain computation over code points."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from skeinset.llm import fim


def plain(key, text, rate=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def made_up(rng, size):
    return "".join(rng.choices(["word ", "längst ", "日本", "\n", "\n\n", "\r\n", "<P", ">", "\x00"], [9, 5, 3, 2, 1, 1, 0.01, 0.01, 1], k=size))


def test_fill_in_middle(spark, odd_docs, no_docs):
    rng = random.Random(1)
    shared = made_up(rng, 3000)
    texts = [made_up(rng, rng.choice([1, 5, 60, 700, 9000])) for _ in range(150)]
    texts += [shared, "x" + shared, shared * 3, "a" * 100_000, "\n" * 70_000, "a\n", "\n", "no end", "<M>", "y" * 5000 + "<S>" + "z" * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a\nb\nc"), (3, None), (3, "")]
    docs = odd_docs.select("doc_id", "text", "found").union(spark.createDataFrame([(*r, "x") for r in rows], "a long, b string, c string"))
    got = docs.withColumn("f", fim.fill_in_middle("doc_id", "text")).withColumn("back", fim.restored("f.output", "f.form"))
    for r in got.collect():
        assert tuple(r.f) == plain(r.doc_id, r.text) and r.back == (r.text or "")
    assert no_docs.select(fim.fill_in_middle("doc_id", "text")).count() == 0
    some = docs.select("doc_id", "text", fim.fill_in_middle("doc_id", "text", rate=30, spm_rate=90).alias("f")).collect()
    assert all(tuple(r.f) == plain(r.doc_id, r.text, 30, 90) for r in some) and {r.f.form for r in some} == {"plain", "spm", "psm"}


def test_chunks_follow_content():
    rng = random.Random(2)
    text = made_up(rng, 40_000).encode()
    ends = fim.ends_of_chunks(text)
    assert ends[-1] == len(text) and ends == sorted(set(ends)) and max(b - a for a, b in zip([0, *ends], ends)) <= fim.MOST
    moved = {e - 777 for e in fim.ends_of_chunks(b"x" * 777 + text)}
    assert len(set(ends) & moved) > 0.9 * len(ends)
    blocks, fim.BLOCK = fim.BLOCK, 1000
    try:
        assert fim.ends_of_chunks(text) == ends
    finally:
        fim.BLOCK = blocks


def test_marks_across_chunks_and_small_cache(monkeypatch):
    monkeypatch.setattr(fim, "CACHE_BYTES", 1000)
    chunks = fim.Chunks([m.encode() for m in fim.MARKS])
    rng = random.Random(3)
    text = made_up(rng, 30_000).replace("<P", "").encode()
    for end in fim.ends_of_chunks(text)[:20]:
        for back in (1, 2):
            assert chunks.text(text[: end - back] + b"<M>" + text[end + 3 - back :]).marked
    assert not chunks.text(text).marked and chunks.held < 1000 + 40_000


def test_one_run_of_the_function(spark, odd_docs):
    made = odd_docs.select("doc_id", fim.fill_in_middle("doc_id", "text").alias("f"))
    out = made.select(F.sha2("f.output", 256), F.sha2(fim.restored("f.output", "f.form"), 256), "f.n")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1

"""Operators without SQL against plain loops over their own contract."""

import gzip
import math
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo
from tokenizers import Tokenizer

import public_tokenizers
from skeinset.llm import packing, queries, warc
from skeinset.llm.quality import Settings, counts, quality_score, train

# --- quality -----------------------------------------------------------------------------------


def some_labelled(spark, n=150):
    rng = random.Random(2)
    words = [["calm", "river", "stone", "light", "and"], ["BUY!!", "NOW!!", "$$$", "and", "river"]]
    rows = [(i, " ".join(rng.choice(words[(i // 2) % 2]) for _ in range(rng.randint(1, 30)))) for i in range(n)]
    docs = spark.createDataFrame([*rows, (n, None), (n + 1, "")], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, (i // 2) % 2) for i in range(n)], "doc_id long, quality int")


def vote(model, text):
    """The weighted votes of the most similar vectors, pair by pair."""
    s = model.settings
    at, value = counts((text or "").encode(), s.features)
    weighted = [float(v) * float(model.rarity[f]) for f, v in zip(at, value)]
    made = [sum(w * float(model.projection[f][d]) for f, w in zip(at, weighted)) for d in range(model.projection.shape[1])]
    norm = math.sqrt(sum(x * x for x in made)) or 1.0
    near = sorted(((sum(x / norm * float(y) for x, y in zip(made, v)), i) for i, v in enumerate(model.vectors)), reverse=True)
    heft = [(max(c, 0.0) ** s.power, model.labels[i]) for c, i in near[: s.neighbours]]
    share = sum(w * y for w, y in heft) + s.prior_weight * model.prior
    return share / (sum(w for w, _ in heft) + s.prior_weight)


@pytest.mark.parametrize("neighbours", [7, 400])
def test_votes_equal_a_plain_loop(spark, neighbours):
    docs, labels = some_labelled(spark)
    model = train(docs, labels, "doc_id", "text", "quality", Settings(neighbours=neighbours, dimensions=6, block=11))
    assert len(model.labels) == 150
    for r in quality_score(docs, model).collect():
        assert abs(r.score - vote(model, r.text)) < 1e-4


def test_held_out_labels_change_no_score(spark, tmp_path):
    docs, labels = some_labelled(spark)
    got = []
    for name, flip in (("as_they_are", False), ("turned", True)):
        turned = [(r.doc_id, 1 - r.quality if flip and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.quality) for r in labels.collect()]
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(turned, labels.schema).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got.append((turned, sorted(map(tuple, queries.op9_quality(spark, f"{tmp_path}/{name}").collect()))))
    assert got[0][0] != got[1][0] and got[0][1] == got[1][1]
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in got[0][1])


# --- packing -----------------------------------------------------------------------------------


def test_pieces_of_long_and_odd_texts(spark, odd_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    want = []
    for doc_id, text in odd_docs.select("doc_id", "text").collect():
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((doc_id, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    found = packing.document_pieces(odd_docs, path).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert max(w[1] for w in want) > 1
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


# --- archives ----------------------------------------------------------------------------------

DATE = "2020-01-01T00:00:00Z"


def records(payload):
    return [
        warc.record_bytes("response", "a", "http://x/", None, payload, DATE),
        warc.record_bytes("revisit", "b", "http://y/", "a", payload, DATE),
        warc.record_bytes("response", "c", "http://z/", None, b"", DATE),
    ]


def test_header_filters_are_taken_over(spark):
    reader = warc.FilteringWarcReader({"path": "/none"}, spark.createDataFrame([], "record_type string, payload binary").schema)
    kind, content = EqualTo(("record_type",), "response"), EqualTo(("payload",), b"")
    assert list(reader.pushFilters([kind, content])) == [content]
    assert reader._wanted({"record_type": "response"}) and not reader._wanted({"record_type": "revisit"})
    assert not reader._wanted({"record_type": None})


def test_unwanted_payloads_are_not_decoded(spark, tmp_path):
    warc.register(spark)
    payload = np.random.default_rng(1).bytes(1 << 20)  # does not shrink, so its end is far from what is read ahead
    broken = bytearray(warc.gzip_member(records(payload)[0]))
    broken[-5000:-8] = b"\xff" * 4992
    (tmp_path / "x.warc.gz").write_bytes(bytes(broken) + b"".join(map(warc.gzip_member, records(payload)[1:])))

    def load(**options):  # anew for each use
        return spark.read.format("warc").options(**options).load(str(tmp_path))

    for condition, want in [("record_type = 'revisit'", ["b"]), ("target_uri = 'http://z/'", ["c"])]:
        assert [r.record_id for r in load(take_filters=True).filter(condition).collect()] == want
    assert [r.record_id for r in load(record_types="request, revisit").collect()] == ["b"]
    for whole in (load(take_filters=True).filter("record_id = 'a'"), load(), load(record_types="response")):
        with pytest.raises(Exception, match="zlib|CRC|incorrect|invalid"):
            whole.collect()


def test_a_loaded_table_can_be_used_more_than_once(spark, tmp_path):
    warc.register(spark)
    (tmp_path / "x.warc").write_bytes(b"".join(records(b"some text")))
    back = spark.read.format("warc").load(str(tmp_path))
    revisits, responses = back.filter("record_type = 'revisit'"), back.filter("record_type = 'response'")
    assert sorted(r[0] for r in revisits.union(responses).select("record_id").collect()) == ["a", "b", "c"]
    assert revisits.count() == 1 and back.count() == 3
    first = responses.selectExpr("record_id as refers_to", "payload as found")
    assert [bytes(r.found) for r in revisits.join(first, "refers_to").collect()] == [b"some text"]


@pytest.mark.parametrize("foreign", [lambda rs: b"".join(rs), lambda rs: b"".join(map(gzip.compress, rs))], ids=["plain", "gzip"])
def test_files_of_other_writers(spark, tmp_path, foreign):
    warc.register(spark)
    payload = "é\r\n\r\nx".encode() * 300
    (tmp_path / "x.warc").write_bytes(foreign(records(payload)))
    back = spark.read.format("warc").load(str(tmp_path))
    got = {r.record_id: (r.record_type, r.payload and bytes(r.payload), r.refers_to) for r in back.collect()}
    assert got["a"] == ("response", payload, None) and got["b"] == ("revisit", None, "a")
    assert got["c"][0] == "response" and not got["c"][1]
    assert [r.record_id for r in back.filter("record_type = 'revisit'").collect()] == ["b"]

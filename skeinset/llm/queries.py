"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinset.llm import sql
from skeinset.llm.common import bounded_batches, keep, scratch_path, utf8
from skeinset.llm.decontaminate import contamination
from skeinset.llm.fim import fill_in_middle, restored
from skeinset.llm.lmscore import Settings, score, train as train_lm
from skeinset.llm.packing import document_pieces, pack
from skeinset.llm.quality import quality_score, train
from skeinset.llm.rules import quality_rules
from skeinset.llm.sharding import hashed, hilbert_shards, log_scaled
from skeinset.llm.simhash import near_duplicates
from skeinset.llm.substrings import repeats_removed
from skeinset.llm.tokens import count_tokens
from skeinset.llm.urlrules import judge
from skeinset.llm.warc import register, with_revisits
from skeinset.llm.whitening import whiten

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", utf8("html").alias("payload"))
    name = F.concat(F.lit("urn:page:"), F.col("page_id").cast("string"))
    records = with_revisits(pages, "page_id", "payload").select(
        name.alias("record_id"),
        "record_type",
        F.col("url").alias("target_uri"),
        F.concat(F.lit("urn:page:"), F.col("refers_to").cast("string")).alias("refers_to"),
        "payload",
    )
    path = scratch_path(spark, "warc")
    records.write.format("warc").mode("append").save(path)

    def number(column: str):
        return F.substring(column, len("urn:page:") + 1, 20).cast("bigint")

    archive = spark.read.format("warc").option("take_filters", True).schema(
        "record_id string, record_type string, refers_to string, payload_digest string, payload_length bigint, payload binary"
    )
    responses = archive.load(path).filter("record_type = 'response'")
    bare = spark.read.format("warc").option("take_filters", True).schema(
        "record_id string, record_type string, refers_to string, payload_digest string, payload_length bigint"
    )
    revisits = bare.load(path).filter("record_type = 'revisit'")
    return responses.select(
        number("record_id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("bigint").alias("refers_to"),
    ).unionByName(
        revisits.select(
            number("record_id").alias("page_id"),
            F.col("payload_length").alias("payload_bytes"),
            F.substring("payload_digest", 6, 40).alias("payload_digest"),
            "record_type",
            number("refers_to").alias("refers_to"),
        )
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = utf8("text")
    docs = _read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), "lang", "source"
    )
    docs = keep(docs, "sizes")  # texts are read once
    bits = 5
    cell = [hashed(F.col("source"), bits), hashed(F.col("lang"), bits), log_scaled(F.col("size"), bits)]
    sharded = hilbert_shards(docs, cell, bits, ["doc_id", "text_crc32", "size"], shards=8)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op3_urlrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"select * from values {values} as r(host, path, verdict)")
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    counted = docs.select(
        "doc_id",
        F.octet_length(utf8("text")).cast("bigint").alias("n_bytes"),
        count_tokens("text", _vocabulary("byte_bpe_50k.json")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), words=4, bits=4)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_read(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    pieces = keep(document_pieces(docs, _vocabulary("word_bpe_49k.json"), end=1, tokens=4096), "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"])


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(_read(spark, sf_dir, "documents"), window=35)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, _read(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.item_ids"), 256).alias("items_sha256"),
        "found.contaminated",
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _read(spark, sf_dir, "labels").select("doc_id", "quality")
    model = train(docs, labels.filter(~held_out), "doc_id", "text", "quality")
    scored = quality_score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _read(spark, sf_dir, "documents").select("doc_id", quality_rules("text").alias("r"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[F.col(f"r.{n}").alias(n) for n in names])


def op11_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    model = train_lm(docs.filter("not held_out"), settings=Settings(order=2))
    scored = score(docs, model, ["doc_id", "held_out"])
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    made = docs.select("doc_id", fill_in_middle("doc_id", "text", seed=7, rate=100, spm_rate=50).alias("f"))
    return made.select(
        "doc_id", "f.n", "f.form", "f.prefix_chars", "f.middle_chars",
        F.sha2("f.output", 256).alias("output_sha256"),
        F.sha2(restored("f.output", "f.form"), 256).alias("restored_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_read(spark, sf_dir, "embeddings"), ["vec_id"], "embedding", components=4, scale=256.0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = [
    op1_warc, op2_sharding, op3_urlrules, op4_tokens, op5_simhash, op6_packing, op7_substrings, op8_decontaminate,
    op9_quality, op10_rules, op11_lmscore, op12_fim, op13_whitening, pipeline,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(sql.SQL)

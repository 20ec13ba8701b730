"""Each operator against a plain computation, on odd rows and on none."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skeinset.llm import decontaminate, packing, rules, sharding, simhash, substrings, tokens, urlrules, warc
from skeinset.llm.components import components
from skeinset.llm.quality import Settings, quality_score, train


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


# --- tokens and packing ----------------------------------------------------------------------

TEXTS = ["", "a  b\n\n c", "It's <|endoftext|> x", "\x1c a  b", "日本語　text ​ b", "Straße, ÀÉ's don't!!", "x" * 5000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_token_counts(spark, odd_docs, name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    docs = odd_docs.select("text").union(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    for text, n in docs.select("text", tokens.count_tokens("text", path).alias("n")).collect():
        assert n == len(whole.encode(text or "", add_special_tokens=False).ids)


def test_pieces_join_to_the_text():
    for t in TEXTS:
        assert "".join(tokens.pieces(t)) == t


def test_token_ids(spark, odd_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    docs = odd_docs.select("text").union(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    for text, ids in docs.select("text", packing.token_ids("text", path, 1).alias("ids")).collect():
        assert ids == [*whole.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("capacity", [packing.Capacity(), packing.Capacity(100, 3, 1e4), packing.Capacity(100, 9, 1.2e4, score="dot")])
def test_packing(spark, capacity):
    rng = random.Random(1)
    pieces = [(i, rng.choice([1, 7, capacity.tokens, rng.randint(1, capacity.tokens)])) for i in range(3000)]
    df = spark.createDataFrame(pieces + pieces[:50], "id long, length long")
    bins = defaultdict(list)
    for r in packing.pack(df, ["id"], capacity=capacity).collect():
        bins[r.sequence_id].append((r.offset, r.length))
    assert sum(map(len, bins.values())) == 3050
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(b) <= capacity.documents and sum(n * n for _, n in b) <= capacity.attention


def test_packing_nothing(no_docs):
    assert packing.pack(packing.document_pieces(no_docs, public_tokenizers.path("word_bpe_49k.json")), ["doc_id"]).count() == 0


# --- near-duplicates -------------------------------------------------------------------------


def plain_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_a_text_of_too_many_words_is_an_error(monkeypatch):
    monkeypatch.setattr(substrings, "_PLACE_BITS", 5)
    grams = np.arange(33, dtype=np.uint64) << np.uint64(40)
    substrings.anchors(grams[:32], 4)
    with pytest.raises(ValueError, match="more than 32 word sequences"):
        substrings.anchors(grams, 4)


def test_golay_covers():
    own, near, count = simhash.golay()
    assert sorted(Counter(count.tolist()).items()) == [(1, 277), (6, 1771)]
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 2000)
    _, index, used = simhash.near_codewords(words)
    for _ in range(3):
        flipped = words ^ (1 << rng.integers(0, 23, 2000)) ^ (1 << rng.integers(0, 23, 2000))
        _, index2, used2 = simhash.near_codewords(flipped)
        for a, b, c, d in zip(index, used, index2, used2):
            assert set(a[b]) & set(c[d])


def test_frequent_keys_are_divided_by_the_third_segment(spark, monkeypatch):
    """Fingerprints near the same codewords of two segments; none goes the way of tiles, all links are found."""
    def never(bits):
        raise AssertionError("tiles")

    monkeypatch.setattr(simhash, "_link_tiles", never)
    rng = random.Random(5)
    prints = {}
    for n in range(2000):
        p = 1 << rng.randrange(22) | 1 << 22 + rng.randrange(21) | rng.getrandbits(21) << 43
        prints[p] = None
        if n < 60:  # one bit of each of the two, one or two of the third
            third = 1 << 43 + rng.randrange(21) | 1 << 43 + rng.randrange(21)
            first = (p & (1 << 43) - 1) ^ (1 << n % 22) ^ (1 << 22 + n % 21)
            prints[first | (p >> 43 << 43) ^ third] = None
    prints = sorted(prints)
    keys, _ = simhash.keys_of(np.array(prints, dtype=np.uint64))
    run, size = np.unique(keys >> 2, return_counts=True)
    assert set(run[size > 600] >> 34) == {0}
    df = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long")
    found = components(simhash.links(df, 4, 600)).collect()
    got = {p: p for p in prints} | {r.node % 2**64: r.root % 2**64 for r in found}
    want = plain_roots(prints)
    groups = lambda m: sorted(sorted(p for p in m if m[p] == r) for r in set(m.values()))
    assert groups(got) == groups(want) and len(groups(want)) < len(prints) - 20


@pytest.mark.parametrize("limit", [20_000, 3])
def test_links_lose_nothing(spark, limit):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = set(centres)
    for c in centres[:20]:
        for _ in range(15):
            prints.add(c ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 6))}))
    prints = sorted(prints)
    df = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long")
    found = components(simhash.links(df, 4, limit)).collect()
    got = {p: p for p in prints} | {r.node % 2**64: r.root % 2**64 for r in found}
    want = plain_roots(prints)
    groups = lambda m: sorted(sorted(p for p in m if m[p] == r) for r in set(m.values()))
    assert groups(got) == groups(want)


def test_near_duplicates(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    prints = {p for p in (plain_fingerprint(r.text) for r in odd_docs.collect())}
    roots = plain_roots(sorted(prints))
    ids = defaultdict(list)
    for r in odd_docs.collect():
        ids[roots[plain_fingerprint(r.text)]].append(r.doc_id)
    want = [(r.doc_id, f"{plain_fingerprint(r.text):016x}", min((i for i in ids[roots[plain_fingerprint(r.text)]] if i is not None), default=None)) for r in odd_docs.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(no_docs).count() == 0


# --- substrings ------------------------------------------------------------------------------


def plain_removed(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(window)}
        left = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(left)).hexdigest()))
    return out


@pytest.mark.parametrize("limit", [20_000, 1])
@pytest.mark.parametrize("window", [5, 35])
def test_repeats_removed(spark, odd_docs, limit, window):
    rng = random.Random(window)
    pool = [[f"w{rng.randrange(30)}" for _ in range(rng.randint(20, 90))] for _ in range(12)]
    texts = [" ".join(sum(rng.choices(pool, k=rng.randint(1, 3)), [])) for _ in range(40)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "a long, b string"))
    rows = docs.collect()
    want = [(r.doc_id, *p) for r, p in zip(rows, plain_removed([r.text for r in rows], window))]
    got = rows_of(substrings.repeats_removed(docs, window=window, run_limit=limit), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(want, key=str)


def test_no_repeats(no_docs):
    assert substrings.repeats_removed(no_docs).count() == 0


# --- contamination, rules, quality -----------------------------------------------------------


@pytest.mark.parametrize("slice_bytes", [1 << 20, 150])
def test_contamination(spark, odd_docs, slice_bytes):
    rng = random.Random(3)
    items = [(i, " ".join(f"q{rng.randrange(12)}" for _ in range(rng.choice([2, 5, 12, 25])))) for i in range(12)]
    items += [(2, None), (None, "alone HERE"), (12, "..."), (10, items[10][1])]
    texts = [(50 + i, " ".join(f"Q{rng.randrange(12)}," for _ in range(200)) + " " + items[i][1]) for i in range(12)]
    docs = odd_docs.select("doc_id", "text", "found").union(spark.createDataFrame([(*t, "x") for t in texts], "a long, b string, c string"))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs, table, slice_bytes=slice_bytes)
    patterns = defaultdict(set)
    for i, t in items:
        w = decontaminate.words_of((t or "").encode())
        for j in range(max(len(w) - 9, 1) if w else 0):
            patterns[tuple(w[j : j + 10])].add("" if i is None else str(i))
    for r in found.collect():
        w = decontaminate.words_of((r.text or "").encode())
        hit, names = set(), set()
        for p, ids in patterns.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j : j + len(p)]) == p:
                    hit |= set(range(j, j + len(p)))
                    names |= ids
        assert (r.found.n_words, r.found.n_hit, r.found.item_ids) == (len(w), len(hit), sorted(names))
        assert r.found.contaminated == bool(hit) and sum(s.end - s.start for s in r.found.spans) == len(hit)


def test_searcher_is_small_and_shares_blocks():
    import pickle

    rng = random.Random(9)
    items = [(str(i), " ".join(f"{rng.getrandbits(32):x}" for _ in range(120)).encode()) for i in range(800)]
    size = sum(len(t) for _, t in items)
    searcher = decontaminate.Searcher(items, 10)
    assert len(pickle.dumps(searcher)) < 12 * size
    few = decontaminate.Searcher(items, 10)
    for patterns in few.sets:  # as if all blocks fell on four places
        patterns.mask, jumps = 3, np.frombuffer(patterns.jumps, np.uint8)
        patterns.jumps = bytes(int(jumps[i::4].min()) for i in range(4))
    for i in range(0, 800, 37):
        text = b"lead " * i + items[i][1][5:] + b" trail"
        n, spans, found = searcher.hits(text)
        assert found == {searcher.names.index(str(i))} and sum(b - a for a, b in spans) >= 119
        assert few.hits(text) == (n, spans, found)


def test_repeated_sequences():
    rng = random.Random(4)
    for n in (0, 1, 7, 40, 300):
        ids = np.array([rng.randrange(3) for _ in range(n)], dtype=np.int64)
        at = defaultdict(list)
        for size in range(1, n):
            for i in range(n - size + 1):
                at[tuple(ids[i : i + size].tolist())].append(i)
            if n > 100 and size > 12:
                break
        twice = {k: v for k, v in at.items() if len(v) > 1}
        covered = {i + j for k, v in twice.items() if len(k) == 4 for i in v for j in range(4)}
        got = rules.repeats(ids, 4)
        assert got[0] == len(covered)
        if n <= 100 and n > 4:
            assert got[1] == max(map(len, twice), default=0)


def test_quality_rules_on_odd_rows(odd_docs, no_docs):
    got = {r.doc_id: r.r for r in odd_docs.select("doc_id", rules.quality_rules("text").alias("r")).collect()}
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept
    assert got[4].n_words == 30_000 and got[7].n_symbols == 4 and got[8].base_failed
    assert no_docs.select(rules.quality_rules("text")).count() == 0


def test_quality_score(spark, odd_docs, no_docs):
    rng = random.Random(5)
    good = [" ".join(rng.choice(["calm", "river", "stone", "light"]) for _ in range(40)) for _ in range(60)]
    bad = [" ".join(rng.choice(["BUY!!", "NOW!!", "$$$"]) for _ in range(40)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120) if i % 3] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = train(docs, labels, "doc_id", "text", "quality", Settings(sample=60, dimensions=8))
    scores = {r.doc_id: r.score for r in quality_score(docs, model).collect()}
    assert all((scores[i] > 0.5) == (i < 60) for i in range(0, 120, 3))
    assert all(0 <= r.score <= 1 for r in quality_score(odd_docs, model).collect())
    empty = train(docs, labels.filter("false"), "doc_id", "text", "quality")
    assert {r.score for r in quality_score(odd_docs, empty).collect()} == {0.5} and quality_score(no_docs, model).count() == 0


# --- sharding, URL rules, archives -----------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 3)])
def test_hilbert_curve(spark, dims, bits):
    n = 1 << bits
    cells = spark.range(n**dims).select(F.array(*[(F.floor(F.col("id") / n**i) % n).cast("int") for i in range(dims)]).alias("c"))
    order = [r.c for r in cells.withColumn("h", sharding.hilbert_index(F.col("c"), dims, bits)).orderBy("h").collect()]
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(order, order[1:]))


def test_shards(spark, odd_docs, no_docs):
    many = odd_docs.union(odd_docs).union(spark.range(1000).selectExpr("id", "'t'", "'en'", "'s'", "1L", "'x'", "0", "1"))
    cell = [sharding.hashed(F.col("source"), 5), sharding.log_scaled(F.col("n_chars"), 5)]
    got = sharding.hilbert_shards(many, cell, 5, ["doc_id", "text"], 8, rows_per_part=100)
    slots = defaultdict(list)
    for r in got.collect():
        slots[r.shard].append((r.slot, r.curve))
    sizes = {len(s) for s in slots.values()}
    assert sorted(slots) == list(range(8)) and max(sizes) - min(sizes) <= 1 and sum(map(len, slots.values())) == many.count()
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in slots.values())
    along = [c for k in sorted(slots) for _, c in sorted(slots[k])]
    assert along == sorted(along)
    assert sharding.hilbert_shards(no_docs, cell, 5, ["doc_id"]).count() == 0


def test_url_rules(spark):
    given = [("com", "/"), ("a.com", "/x"), ("a.com", "/x/y"), ("b.a.com", ""), ("b.a.com", "/x/y"), ("net", "/é/"), ("c.net", "/")]
    table = [(h, p, "block" if i % 2 else "allow") for i, (h, p) in enumerate(given)]
    urls = [None, "", "a.com/x", "://", "http://A.com/x/y/z?q=/", "http://a.com", "http://xa.com/x", "s://b.a.com/x/y#f", "s://q.b.a.com/x"]
    urls += ["s://c.net/é/1", "s://net/é/", "s://a..com/x", "s://a.com:80/x", "s://com/", "s://a.com/x/\x00"] * 2
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules_df = spark.createDataFrame([*table, ("a.com", None, "allow"), ("com", "/", "allow")], "host string, path string, verdict string")
    for r in urlrules.judge(df, rules_df, slices=3).collect():
        rest = (r.url or "").partition("://")[2] if "://" in (r.url or "") else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in table if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, 0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[2], best[3])
    assert {r.verdict for r in urlrules.judge(df, rules_df.filter("false")).collect()} == {"allow"}


def test_archives(spark, tmp_path):
    warc.register(spark)
    long = "é" * 700
    rows = [(1, "http://a/\r\nX: y", long), (2, None, long), (3, "u", None), (4, "u v", ""), (2, "w", long), (None, "n", long), (5, "s", "short"), (6, "s", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")))
    marked = warc.with_revisits(pages, "page_id", "payload")
    assert rows_of(marked, "page_id", "record_type", "refers_to") == sorted(
        [(1, "revisit", 2), (2, "response", None), (2, "response", None), (None, "revisit", 2)]
        + [(i, "response", None) for i in (3, 4, 5, 6)], key=str)
    named = marked.select(
        F.col("page_id").cast("string").alias("record_id"), "record_type", F.col("url").alias("target_uri"),
        F.col("refers_to").cast("string").alias("refers_to"), "payload",
    )
    path = str(tmp_path / "archive")
    named.write.format("warc").option("roll_bytes", 200).mode("append").save(path)
    back = spark.read.format("warc").load(path)
    assert back.count() == len(rows)
    got = {r.record_id: r for r in back.filter("record_type = 'response'").collect()}
    assert bytes(got["2"].payload) == long.encode() and bytes(got["3"].payload) == b"" and got["4"].target_uri == "u%20v"
    old = back.filter("record_type = 'revisit' and target_uri like 'http%'").collect()
    assert [(r.record_id, r.payload, r.payload_length, r.refers_to) for r in old] == [("1", None, 1400, "2")]
    assert old[0].payload_digest == "sha1:" + hashlib.sha1(long.encode()).hexdigest() and "%0D%0A" in old[0].target_uri
    empty = str(tmp_path / "none")
    named.filter("false").write.format("warc").mode("append").save(empty)
    assert spark.read.format("warc").load(empty).count() == 0

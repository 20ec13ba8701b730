"""DuckDB SQL for the queries that SQL can express.

Words are what ASCII white space separates. Without SQL: op1 (a round trip through files), op2 (a hash of
Spark's decides places), op4 and op6 (tokenizers), op5 (XXH64), op9 (a trained
model), op11 (a Bloom filter), op13 (eigenvectors), the pipeline.
"""

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URLS = f"""WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, {_ASCII_LOWER.format("coalesce(regexp_extract(rest, '^[^/?#]*'), '')")} AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
r(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT h.page_id, h.host, h.path, max(struct_pack(n := length(rhost || rpath), rule := rhost || rpath, v := v)) AS best
      FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY ALL)
SELECT page_id, host, path, CASE WHEN best.n IS NOT NULL THEN best.rule END AS rule,
       CASE WHEN best.n IS NOT NULL THEN best.v ELSE 'allow' END AS verdict FROM m"""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

# A document is known by its row, as ids may be missing or repeat.
_SPLIT = f"""d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS MATERIALIZED (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d)"""


def _window(n: int, name: str, source: str = "g") -> str:
    """Windows of ``n`` words: r, i (of the first word), k."""
    parts = ", ".join(["word", *[f"lead(word, {j}) OVER o" for j in range(1, n)]])
    last = f"lead(word, {n - 1}) OVER o" if n > 1 else "word"
    return f"""{name} AS MATERIALIZED (SELECT r, i, sha256(k) AS k FROM (
      SELECT r, i, concat_ws(' ', {parts}) AS k, {last} AS z FROM {source} WINDOW o AS (PARTITION BY r ORDER BY i))
      WHERE z IS NOT NULL)"""


def _covered(n: int, windows: str, chosen: str, name: str) -> str:
    """Words in chosen windows of ``n`` words: r, n."""
    return f"""{name} AS (SELECT r, count(*) AS n FROM (
      SELECT DISTINCT r, unnest(range(i, i + {n})) AS i FROM {windows} WHERE {chosen}) GROUP BY r)"""


SUBSTRINGS = f"""WITH {_SPLIT}, {_window(35, 'x')},
twice AS (SELECT k FROM x GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM x WHERE k IN (SELECT k FROM twice)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM g ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""

_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
CONTAMINATION = f"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, {_PLAIN}) AS w
  FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_ASCII_LOWER.format('text')}, {_PLAIN}) AS w
      FROM benchmark WHERE text IS NOT NULL),
p AS MATERIALIZED (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM (
  SELECT item, w, least(10, len(w)) AS m, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM p),
x AS (SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM (
  SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hit AS MATERIALIZED (SELECT r, i, m, item FROM x JOIN p USING (m, k)),
words AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + m)) AS j FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS t FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

RULES = rf"""WITH {_SPLIT}, {_window(3, 'x3')}, {_window(8, 'x8')}, {_window(101, 'x101')},
t3 AS (SELECT *, count(*) OVER (PARTITION BY r, k) AS c FROM x3), {_covered(3, 't3', 'c > 1', 'c3')},
t8 AS (SELECT *, count(*) OVER (PARTITION BY r, k) AS c FROM x8), {_covered(8, 't8', 'c > 1', 'c8')},
long AS (SELECT DISTINCT r FROM (SELECT r FROM x101 GROUP BY r, k HAVING count(*) > 1)),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, r, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
        coalesce(c3.n, 0) AS n_repeat_words, coalesce(c8.n, 0) AS covered, long.r IS NOT NULL AS too_long
      FROM d LEFT JOIN lines USING (r) LEFT JOIN c3 USING (r) LEFT JOIN c8 USING (r) LEFT JOIN long USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * covered <= 4 * n_words AND NOT too_long AS kept FROM f"""

FILL_IN_MIDDLE = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
l AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
        ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM d),
c AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1))::BIGINT AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1))::BIGINT AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
             WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (SELECT *, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p"""

SQL = {
    "op3_urlrules": URLS,
    "op7_substrings": SUBSTRINGS,
    "op8_decontaminate": CONTAMINATION,
    "op10_rules": RULES,
    "op12_fim": FILL_IN_MIDDLE,
}

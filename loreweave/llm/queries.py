"""The registered queries of the operators, each next to its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import Catalog, table
from loreweave.llm import hashing_index, jaccard, language, lexical, linedup, lm, mixing, packing, rules, secrets, simhash, urls, whitening

catalog = Catalog()

#: Words of a DuckDB text column.
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


@catalog.add(rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_WORDS.format('text')} AS w, string_split(text, chr(10)) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS gram
      FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
s AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt
      FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n FROM s GROUP BY r),
f AS (SELECT r, unnest(l) AS line FROM w),
t AS (SELECT r, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' AS has_word,
             greatest(len({_WORDS.format('line')}), 1) AS n,
             len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
             len(list_filter({_WORDS.format('line')}, lambda x: x IN ('|', '»', '›', '•', '·', '→'))) AS alone
      FROM f),
v AS (SELECT *, NOT ((alone >= 3 AND alone >= 0.2 * n) OR symbols > 0.3 * n
               OR (length(line) <= 80 AND regexp_matches(line, '(?i){'|'.join(rules.BOILERPLATE)}'))
               OR (n >= 60 AND NOT regexp_matches(line, '[.!?…:;,。！？]'))) AS fine FROM t),
k AS (SELECT r, count(*) FILTER (has_word) - count(DISTINCT line) FILTER (has_word) AS n_dup_lines,
             sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (fine) AS kept_chars
      FROM v GROUP BY r),
b AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(kept_chars, 0)::BIGINT AS kept_chars
      FROM w JOIN k USING (r) LEFT JOIN c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND kept_chars >= 0.5 * word_chars AS kept,
       kept_chars
FROM b
""")
def op2_quality_rules(spark, sf_dir):
    cleaned = rules.clean(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")
    return cleaned.drop("n_lines", "n_kept_lines", "clean_text")


_SIZED = rf"""
z AS (SELECT row_number() OVER () AS r, doc_id, source, len({_WORDS.format('text')}) AS size,
             md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM z GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM t),
l AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
             ORDER BY source_size / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM w),
g AS (SELECT source, source_size, least(max(level) OVER () * weight, 3.0::DOUBLE * source_size) AS target FROM l)"""


@catalog.add(rf"""
WITH {_SIZED},
q AS (SELECT z.*, source_size, target, sum(size) OVER (
             PARTITION BY z.source ORDER BY key
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before
      FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.source),
e AS (SELECT *, CASE WHEN target > 0 THEN (round * source_size + before)::DOUBLE / target ELSE 0 END AS finish
      FROM q, range(3) AS r(round)),
c AS (SELECT finish, sum(sum(size)) OVER (ORDER BY finish) AS upto FROM e WHERE size > 0 GROUP BY finish),
m AS (SELECT coalesce(max(finish), 0) AS finish FROM c WHERE upto <= (SELECT sum(size) FROM z))
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * count(*) FILTER (finish <= (SELECT finish FROM m)))::BIGINT AS taken
FROM e GROUP BY r, doc_id, size, source, source_size, target
""")
def op4_mixing(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    return mixing.mix(docs, "doc_id", "source", "text").drop("source", "copies")


def _found(kind: str, pattern: str, rank: int, group: int, least: int) -> str:
    """SQL for ``r, kind, rank, start, end`` of a rule, from the pieces between its matches."""
    p = pattern.replace("'", "''")
    return rf"""
SELECT r, '{kind}' AS kind, {rank} AS rank, stop - length(m) AS start, stop FROM (
  SELECT r, ms[i] AS m, list_sum(list_transform(gaps[:i], lambda x: length(x)))
         + list_sum(list_transform(ms[:i], lambda x: length(x))) AS stop
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
    SELECT r, regexp_extract_all(text, '{p}') AS ms, regexp_split_to_array(text, '{p}') AS gaps FROM d)))
WHERE length(regexp_extract(m, '{p}', {group})) >= {least}"""


_FOUND = " UNION ALL ".join(
    _found(x.kind, x.pattern, k, x.group, x.least) for k, x in enumerate(secrets.RULES)
)


@catalog.add(rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({_FOUND}),
a AS (SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
             count(*) FILTER (rank = 2) AS n_hex,
             string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) AS spans,
             string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank)
               FILTER (rank <= 2) AS base
      FROM f GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
""")
def op5_secret_scans(spark, sf_dir):
    _, paths = secrets.scan(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = [r.kind for r in secrets.BASE]
    return paths.select(
        F.col("path").alias("doc_id"),
        *[number(k).alias(f"n_{k}") for k in base],
        F.sha2(secrets.joined(F.col("spans"), base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(urls.HOST_RULES, key=lambda r: -len(r.name))
)
_BLOCKED = " OR ".join(f"regexp_matches(url, '{r.pattern}')" for r in urls.PATTERN_RULES)


@catalog.add(rf"""
WITH p AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                  ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url,
             translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
v AS (SELECT *, CASE {_FITS} END AS rule FROM h)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN coalesce({_BLOCKED}, false) THEN 'block' ELSE 'allow' END AS verdict
FROM v
""")
def op10_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, "page_id", "url").drop("url", "patterns")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@catalog.add()
def op9_packing(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    packed = packing.pack(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@catalog.add(r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT r, doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line
            FROM (SELECT r, doc_id, string_split(text, chr(10)) AS ls FROM d))),
k AS (SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, k.key IS NOT NULL AND l.doc_id IS DISTINCT FROM k.last AS gone FROM l LEFT JOIN k USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
""")
def op6_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    lines = linedup.dedup_lines(docs, "doc_id", "text")
    return lines.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@catalog.add()
def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@catalog.add()
def op8_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = language.identify(docs, "doc_id", "text", "lang", tokenizer_path("piece_bpe_32k.model"))
    return found.select("row.doc_id", "held_out", "lang_pred", "score")


@catalog.add()
def op1_lm_scoring(spark, sf_dir):
    return lm.score(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")


@catalog.add()
def op3_hashing_index(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hashing_index.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0, 5)


@catalog.add()
def op11_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, "vec_id", "embedding")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@catalog.add(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS terms FROM benchmark),
q AS (SELECT i, item_id, unnest(terms) AS term FROM i),
n AS (SELECT r, len(terms) AS n FROM d WHERE len(terms) > 0),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), g),
m AS (SELECT r, 50 + (50 * n * docs) // words AS m FROM n, g),
s AS (SELECT i, item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM t JOIN w USING (term) JOIN m USING (r) JOIN q USING (term) GROUP BY i, item_id, r)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM s JOIN d USING (r) WHERE score > 0) WHERE rank <= 50
""")
def op12_ranked_search(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    return lexical.search(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text", items, "item_id", "text")


@catalog.add()
def op13_jaccard_join(spark, sf_dir):
    return jaccard.join(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")

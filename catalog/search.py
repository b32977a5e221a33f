"""Vector and text search, filters and reports."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import Catalog, table, texts
from loreweave.functions.vectors import cosine, id_oracle
from loreweave.operators import ann
from loreweave.operators import checks as K
from loreweave.operators import search as S
from loreweave.operators.bitmap_index import BitmapIndex
from loreweave.operators.gram_index import GramIndex
from loreweave.sources.staging import scratch

catalog = Catalog()

QUERY_VECTOR = 7  # the row whose vector is the single query


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.concat(F.col("vec_id").cast("string"), F.lit(":0")).alias("id"), F.lit("card_text").alias("source"),
        F.lit(0).alias("chunk_index"), F.concat(F.lit("label "), F.col("label").cast("string")).alias("chunk_text"),
        "vec_id", "label", "embedding",
    )


def one_query(spark: SparkSession, sf: str) -> list[float]:
    return table(spark, sf, "embeddings").filter(F.col("vec_id") == QUERY_VECTOR).first().embedding


def label_queries(spark: SparkSession, sf: str) -> DataFrame:
    """One query for each label: the vector of its lowest id."""
    first = F.min(F.struct("vec_id", "embedding"))
    return table(spark, sf, "embeddings").groupBy(F.col("label").alias("query_id")).agg(first.alias("v")).select(
        "query_id", F.col("v.vec_id").alias("vec_id"), F.col("v.embedding").alias("query_vector")
    )


def labelled_cards(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a label count as cards; ``toxic`` is the face, so most vectors have no card."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        F.col("doc_id").cast("string").alias("scryfall_oracle_id"), F.col("toxic").alias("face_index"),
        F.col("source").alias("name"),
    )


_COS = "round(list_cosine_similarity(e.embedding::DOUBLE[], {0}::DOUBLE[]), 12)"
_ONE = f"(SELECT embedding FROM embeddings WHERE vec_id = {QUERY_VECTOR})"
_SIM = _COS.format(_ONE)
_QUERIES = """q AS (
  SELECT label AS query_id, min(vec_id) AS vec_id, arg_min(embedding, vec_id) AS query_vector
  FROM embeddings GROUP BY label)"""


@catalog.add(f"""
SELECT vec_id, label, round({_SIM}, 6) AS similarity FROM embeddings e ORDER BY {_SIM} DESC, vec_id LIMIT 5""")
def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    hits = S.similar(
        table(spark, sf, "embeddings"), one_query(spark, sf), 5, id_col="vec_id", keep=["label"]
    )
    return hits.withColumn("similarity", F.round("similarity", 6))


@catalog.add(f"""
SELECT e.vec_id || ':0' AS id, d.source AS name, 'label ' || e.label AS chunk_text, round({_SIM}, 6) AS similarity
FROM embeddings e JOIN labels l ON l.doc_id = e.vec_id AND l.toxic = 0 JOIN documents d ON d.doc_id = l.doc_id
ORDER BY {_SIM} DESC, e.vec_id || ':0' LIMIT 5""")
def vector_topk_join(spark: SparkSession, sf: str) -> DataFrame:
    hits = S.vector_search(vectors(spark, sf), labelled_cards(spark, sf), one_query(spark, sf), "card_text", 5)
    return hits.withColumn("similarity", F.round("similarity", 6))


@catalog.add("""
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[],
         (SELECT list(x ORDER BY i) FROM (SELECT i, avg(v) AS x FROM (
            SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
          GROUP BY i))::DOUBLE[]), 6) AS similarity
FROM embeddings""")
def similarity_to_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine similarity of every vector to the mean vector, in SQL functions."""
    rows = table(spark, sf, "embeddings")
    mean = rows.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("x"))
    vector = mean.agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))  # one entry per dimension
    center = vector.select(F.transform("v", lambda p: p["x"]).alias("v")).first().v
    to = F.array(*[F.lit(x) for x in center])
    return rows.select("vec_id", F.round(cosine(F.col("embedding"), to), 6).alias("similarity"))


_BATCH = f"""
WITH {_QUERIES}, scored AS (
  SELECT query_id, e.vec_id AS id, {_COS.format('q.query_vector')} AS s FROM q, embeddings e
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM scored
)
SELECT query_id, id, round(s, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5"""


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("similarity", F.round("similarity", 6))


@catalog.add(_BATCH)
def vector_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(S.similar_batch(
        table(spark, sf, "embeddings"), label_queries(spark, sf), 5, id_col="vec_id"
    ))


@catalog.add(_BATCH)
def vector_batch_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same when the queries are too many for one broadcast."""
    return _rounded(S.similar_batch(
        table(spark, sf, "embeddings"), label_queries(spark, sf), 5, id_col="vec_id", block_floats=64 * 6
    ))


@catalog.add(f"""
WITH {_QUERIES}, scored AS (
  SELECT query_id, e.vec_id || ':0' AS id, d.source AS name, {_COS.format('q.query_vector')} AS s
  FROM q, embeddings e JOIN labels l ON l.doc_id = e.vec_id AND l.toxic = 0 JOIN documents d ON d.doc_id = l.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM scored
)
SELECT query_id, id, name, round(s, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 3""")
def vector_batch_join(spark: SparkSession, sf: str) -> DataFrame:
    known = labelled_cards(spark, sf)
    hits = S.similar_batch(S.known_vectors(vectors(spark, sf), known), label_queries(spark, sf), 3)
    named = hits.withColumn("scryfall_oracle_id", id_oracle(F.col("id"))).join(
        known.filter("face_index = 0").select("scryfall_oracle_id", "name"), "scryfall_oracle_id"
    )
    return _rounded(named.drop("scryfall_oracle_id"))


@catalog.add(f"""
WITH {_QUERIES}, scored AS (
  SELECT query_id, e.vec_id AS id, {_COS.format('q.query_vector')} AS s FROM q, embeddings e
), best AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM scored
)
SELECT query_id, q.vec_id AS expected, best.id AS found, best.id = q.vec_id AS ok
FROM best JOIN q USING (query_id) WHERE rank = 1""")
def top1_check(spark: SparkSession, sf: str) -> DataFrame:
    queries = label_queries(spark, sf)
    hits = S.similar_batch(table(spark, sf, "embeddings"), queries, 1, id_col="vec_id")
    return S.top1_check(hits, queries.select("query_id", F.col("vec_id").alias("expected")))


def _lists(spark: SparkSession, sf: str, nprobe: int) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    centroids = ann.train_lists(rows, lists=16, max_iter=5)
    assigned = ann.assign_lists(rows, centroids)
    return _rounded(ann.search_lists(
        assigned, centroids, label_queries(spark, sf), 5, nprobe, id_col="vec_id"
    ))


@catalog.add()
def ann_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate: 4 of 16 lists. Recall against the exact result is a test."""
    return _lists(spark, sf, 4)


@catalog.add(_BATCH)
def ann_topk_all_lists(spark: SparkSession, sf: str) -> DataFrame:
    """All lists: equal to the exact result."""
    return _lists(spark, sf, 16)


_PROBED = f"""
WITH {_QUERIES}, c AS (
  SELECT label, list(x ORDER BY i) AS centroid FROM (
    SELECT label, i, CAST(avg(v) AS FLOAT) AS x FROM (
      SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label
), lists AS (
  SELECT vec_id, embedding, arg_max(c.label, (round(list_cosine_similarity(embedding::DOUBLE[], centroid::DOUBLE[]), 9), -c.label)) AS list_id
  FROM embeddings, c GROUP BY ALL
), probes AS (
  SELECT query_id, query_vector, label AS list_id FROM (
    SELECT query_id, query_vector, c.label, row_number() OVER (PARTITION BY query_id ORDER BY
      round(list_cosine_similarity(query_vector::DOUBLE[], centroid::DOUBLE[]), 12) DESC, c.label) AS n FROM q, c) WHERE n <= 4
), ranked AS (
  SELECT query_id, vec_id AS id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (
    SELECT query_id, e.vec_id, {_COS.format('query_vector')} AS s FROM probes JOIN lists e USING (list_id))
)
SELECT query_id, id, round(s, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5"""


@catalog.add(_PROBED)
def ann_stored_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Lists around the mean vector of each label, written, read back and searched, 4 for each query."""
    rows = table(spark, sf, "embeddings")
    each = rows.select("label", F.posexplode("embedding").alias("i", "x"))
    mean = each.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).cast("float").alias("x"))
    lists = mean.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("label")
    centroids = np.array([[p["x"] for p in r["v"]] for r in lists.collect()], dtype="float64")  # one per label
    path = scratch(spark, "lists")
    ann.write_lists(ann.assign_lists(rows, centroids), path)
    return _rounded(ann.search_lists(
        spark.read.parquet(path), centroids, label_queries(spark, sf), 5, 4, id_col="vec_id"
    ))


# ---- Text and filters ------------------------------------------------------------

NAMES = ["small ring", "red widget", "Small Ring", "no such part"]


@catalog.add("""
WITH wanted AS (SELECT unnest(['small ring', 'red widget', 'Small Ring', 'no such part']) AS name)
SELECT name, count(p_partkey) AS n, count(p_partkey) > 0 AS found
FROM wanted LEFT JOIN part ON p_name = name GROUP BY name""")
def exact_lookup(spark: SparkSession, sf: str) -> DataFrame:
    wanted = spark.createDataFrame([(n,) for n in NAMES], "name string")
    return S.lookup(table(spark, sf, "part"), "p_name", wanted, "name")


@catalog.add("""
SELECT p_partkey, p_name, p_brand FROM part WHERE p_name IN ('small ring', 'red widget', 'Small Ring', 'no such part')""")
def find_rows(spark: SparkSession, sf: str) -> DataFrame:
    return S.find(table(spark, sf, "part"), "p_name", NAMES).select("p_partkey", "p_name", "p_brand")


PHRASES = ["the th", "QUE", "a_d", "in%on", "100%", "no such phrase"]


@catalog.add("""
WITH phrases AS (SELECT unnest(['the th', 'QUE', 'a_d', 'in%on', '100%', 'no such phrase']) AS phrase)
SELECT phrase, count(doc_id) AS n FROM phrases LEFT JOIN documents ON text ILIKE '%' || phrase || '%' GROUP BY phrase""")
def phrase_count(spark: SparkSession, sf: str) -> DataFrame:
    phrases = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    return S.phrase_counts(texts(spark, sf, "text"), "text", phrases)


@catalog.add("""
SELECT p_partkey, p_name FROM part
WHERE (list_has_all(string_split(p_name, ' '), ['small', 'ring']) AND p_size = 7)
   OR list_contains(string_split(p_name, ' '), 'widget')""")
def bitmap_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Names as arrays of words and sizes as maps: small rings of one size, or anything that is a widget."""
    rows = table(spark, sf, "part").select(
        "p_partkey", "p_name", F.split("p_name", " ").alias("words"),
        F.create_map(F.lit("size"), F.col("p_size").cast("string")).alias("props"),
    )
    index = BitmapIndex(spark, scratch(spark, "bitmaps"))
    index.write(rows, ["words", "props"])
    return index.rows({"words": ["small", "ring"], "props": ["size=7"]}, {"words": ["widget"]}).select("p_partkey", "p_name")


INDEXED = ["the th", "QUE", "e d", "tion", "no such phrase", "ung der"]


@catalog.add(f"""
WITH phrases AS (SELECT unnest({INDEXED}) AS phrase),
kept AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT phrase, doc_id AS id FROM phrases JOIN kept ON contains(lower(text), lower(phrase))""")
def phrase_index(spark: SparkSession, sf: str) -> DataFrame:
    """Phrases from posting lists: labelled documents first, then the others in a segment that takes out the toxic ones."""
    docs, labels = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), table(spark, sf, "labels")
    labelled = labels.select(F.col("doc_id").alias("id"))
    index = GramIndex(spark, scratch(spark, "grams"))
    index.add(docs.join(labelled, "id", "left_semi"))
    index.add(docs.join(labelled, "id", "left_anti"), labels.filter("toxic = 1").select(F.col("doc_id").alias("id")))
    return index.find(INDEXED)


@catalog.add("""
SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS has_ring,
       list_has_all(string_split(p_name, ' '), ['small', 'ring']) AS has_both,
       list_has_any(string_split(p_name, ' '), ['red', 'bolt']) AS has_any FROM part""")
def array_filters(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey", F.array_contains(words, "ring").alias("has_ring"),
        S.has_all(words, ["small", "ring"]).alias("has_both"), S.has_any(words, ["red", "bolt"]).alias("has_any"),
    )


@catalog.add("""
SELECT event_type, count(*) FILTER (props::JSON->>'k' = '69') AS legal, count(*) AS n FROM events GROUP BY event_type""")
def map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("m", F.from_json("props", "map<string,string>"))
    return rows.groupBy("event_type").agg(
        F.count_if(S.is_legal(F.col("m"), "k", "69")).alias("legal"), F.count("*").alias("n")
    )


# ---- Reports -----------------------------------------------------------------------


@catalog.add("""
SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS distinct_records,
       count(*) FILTER (CAST(substr(o_orderpriority, 1, 1) AS INTEGER) > 1) AS extra_faces,
       count(*) FILTER (o_orderstatus = 'P') AS missing_hash,
       (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1)) AS duplicate_keys,
       count(*) > 1000 AND count(*) FILTER (o_orderstatus = 'P') = 0
         AND (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1)) = 0 AS ok
FROM orders""")
def foundation(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("record"), (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("face"),
        F.when(F.col("o_orderstatus") == "F", "f").when(F.col("o_orderstatus") == "P", "").otherwise("o").alias("hash"),
    )
    return K.foundation(rows, "record", "face", "hash", min_rows=1000)


@catalog.add("""
SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1""")
def pk_dupes(spark: SparkSession, sf: str) -> DataFrame:
    return K.duplicate_keys(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"])


@catalog.add("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY source")
def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    return K.source_counts(table(spark, sf, "documents"))


EXPECTED = [("src0", 10), ("src1", 1_000_000_000), ("src7", 1), ("no_such_source", 1)]
_EXPECTED = "(VALUES ('src0', 10), ('src1', 1000000000), ('src7', 1), ('no_such_source', 1)) AS x(source, min_count)"


@catalog.add(f"""
SELECT x.source, count(doc_id) AS n, min_count, count(doc_id) >= min_count AS ok
FROM {_EXPECTED} LEFT JOIN documents d ON d.source = x.source GROUP BY x.source, min_count""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    expected = spark.createDataFrame(EXPECTED, "source string, min_count int")
    counts = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return K.coverage(counts, expected)


@catalog.add("""
SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' ORDER BY event_id DESC LIMIT 1""")
def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events")
    return K.last_success(log, "event_id", "event_type", "purchase").select("event_id", "user_id", "value")


@catalog.add("""
SELECT count(*) FILTER (event_type = 'purchase') AS successes, count(*) FILTER (event_type = 'purchase') > 0 AS ok
FROM events""")
def successful_runs(spark: SparkSession, sf: str) -> DataFrame:
    return K.successes(table(spark, sf, "events"), "event_type", "purchase")


@catalog.add("""
WITH v AS (
  SELECT source, CASE WHEN count(l.doc_id) = 0 THEN 'skip' WHEN avg(quality) >= 0.5 THEN 'pass' ELSE 'fail' END AS verdict
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY source)
SELECT count(*) FILTER (verdict = 'pass') AS passed, count(*) FILTER (verdict = 'fail') AS failed,
       count(*) FILTER (verdict = 'skip') AS skipped, count(*) AS total, count(*) FILTER (verdict = 'fail') = 0 AS ok FROM v""")
def verdict_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    per_source = rows.groupBy("source").agg(F.count("quality").alias("n"), F.avg("quality").alias("q"))
    checked = per_source.withColumn("verdict", K.verdict(F.col("q") >= 0.5, F.col("n") == 0))
    return K.verdict_totals(checked)

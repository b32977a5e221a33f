"""Taxonomy lookups, query expansion and tagging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import Catalog, table, texts
from catalog.chunks import slots_sql
from catalog.search import _COS
from loreweave.operators import taxonomy as X
from loreweave.operators.closure import ancestors, cycles
from loreweave.operators.tagging import tag_arrays, tag_texts
from loreweave.plans.retrieval import fan_out, merge_best
from loreweave.operators.search import similar_batch

catalog = Catalog()

# ---- A tree from the tables: region → nation → customer ---------------------------


def tree(spark: SparkSession, sf: str) -> DataFrame:
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    no_text = F.array().cast("array<string>")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    r_key = F.concat(F.lit("r"), F.col("r_regionkey").cast("string"))
    n_key = F.concat(r_key, F.lit(".n"), F.col("n_nationkey").cast("string"))
    c_key = F.concat(n_key, F.lit(".c"), F.col("c_custkey").cast("string"))

    def rows(df, key, parent, name, path, aliases, hints):
        return df.select(
            key.alias("key"), parent.cast("string").alias("parent_key"), F.col(name).alias("name"),
            F.lit(len(path) - 1).alias("depth"),
            F.array(*[F.col(p).cast("int") for p in path]).alias("dfs_ord"),
            aliases.alias("aliases"), F.concat(F.lit("About "), F.col(name)).alias("description"),
            hints.alias("oracle_hints"),
        )

    return (
        rows(region, r_key, F.lit(None), "r_name", ["r_regionkey"], F.array(F.upper("r_name")), no_text)
        .unionByName(rows(places, n_key, r_key, "n_name", ["r_regionkey", "n_nationkey"],
                          F.array("r_name", "n_name"), F.array("n_name", "r_name")))
        .unionByName(rows(
            customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")), c_key, n_key, "c_name",
            ["r_regionkey", "n_nationkey", "c_custkey"], F.array("c_mktsegment", "c_name"),
            F.array(F.lower("c_mktsegment"), F.col("n_name")),
        ))
    )


_TREE = """
WITH RECURSIVE tree AS (
  SELECT 'r' || r_regionkey AS key, NULL AS parent_key, r_name AS name, 0 AS depth, [r_regionkey] AS dfs_ord,
         [upper(r_name)] AS aliases, 'About ' || r_name AS description, []::VARCHAR[] AS oracle_hints FROM region
  UNION ALL
  SELECT 'r' || r_regionkey || '.n' || n_nationkey, 'r' || r_regionkey, n_name, 1, [r_regionkey, n_nationkey],
         [r_name, n_name], 'About ' || n_name, [n_name, r_name] FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'r' || r_regionkey || '.n' || n_nationkey || '.c' || c_custkey, 'r' || r_regionkey || '.n' || n_nationkey,
         c_name, 2, [r_regionkey, n_nationkey, c_custkey], [c_mktsegment, c_name], 'About ' || c_name,
         [lower(c_mktsegment), n_name]
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), below AS (
  SELECT key AS ancestor, key FROM tree
  UNION ALL
  SELECT b.ancestor, t.key FROM below b JOIN tree t ON t.parent_key = b.key
), alias_rows AS (
  SELECT lower(unnest(aliases)) AS alias, key, dfs_ord FROM tree
), alias_map AS (
  SELECT alias, arg_max(key, dfs_ord) AS key FROM alias_rows GROUP BY alias
), hints AS (
  SELECT ancestor, key, pos, hint FROM (
    SELECT b.ancestor, t.key, unnest(t.oracle_hints) AS hint, generate_subscripts(t.oracle_hints, 1) - 1 AS pos
    FROM below b JOIN tree t ON t.key = b.key)
)"""


@catalog.add(_TREE + """
SELECT key, parent_key, name, depth FROM tree ORDER BY dfs_ord""")
def taxonomy_walk(spark: SparkSession, sf: str) -> DataFrame:
    return X.walk(tree(spark, sf)).select("key", "parent_key", "name", "depth")


@catalog.add(_TREE + " SELECT key, name, description FROM tree WHERE key = 'r1.n6'")
def taxonomy_node(spark: SparkSession, sf: str) -> DataFrame:
    return X.node(tree(spark, sf), "r1.n6").select("key", "name", "description")


@catalog.add(_TREE + " SELECT alias, key FROM alias_map")
def alias_map(spark: SparkSession, sf: str) -> DataFrame:
    return X.alias_map(tree(spark, sf))


@catalog.add(_TREE + " SELECT ancestor, key, CAST(pos AS INTEGER) AS pos, hint FROM hints")
def hints_below(spark: SparkSession, sf: str) -> DataFrame:
    return X.hints_below(tree(spark, sf)).drop("dfs_ord")


@catalog.add(_TREE + """
SELECT b.ancestor, t.key, t.description FROM below b JOIN tree t ON t.key = b.key""")
def descriptions_below(spark: SparkSession, sf: str) -> DataFrame:
    return X.descriptions_below(tree(spark, sf)).drop("dfs_ord")


@catalog.add(_TREE + " SELECT 'taxonomy:' || key AS id, 0 AS chunk_index, description AS chunk_text FROM tree")
def taxonomy_chunks(spark: SparkSession, sf: str) -> DataFrame:
    from loreweave.operators.chunks import taxonomy_chunks as chunks

    return chunks(tree(spark, sf))


def terms(spark: SparkSession, sf: str) -> DataFrame:
    """Query terms: the market segments and nation names in use, and order priorities (no concepts)."""
    seg = table(spark, sf, "customer").select(F.initcap("c_mktsegment").alias("term"))
    names = table(spark, sf, "nation").select(F.lower("n_name").alias("term"))
    other = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("term"))
    return seg.union(names).union(other).distinct()


_TERMS = """, terms AS (
  SELECT DISTINCT upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS term FROM customer
  UNION SELECT lower(n_name) FROM nation UNION SELECT o_orderpriority FROM orders
)"""


@catalog.add(_TREE + _TERMS + " SELECT term, key FROM terms JOIN alias_map ON alias = lower(term)")
def concept_match(spark: SparkSession, sf: str) -> DataFrame:
    return X.match_terms(terms(spark, sf), X.alias_map(tree(spark, sf)))


@catalog.add(_TREE + _TERMS + """
SELECT DISTINCT term, m.key, hint FROM terms JOIN alias_map m ON alias = lower(term) JOIN hints h ON h.ancestor = m.key""")
def expand_terms(spark: SparkSession, sf: str) -> DataFrame:
    return X.expand_terms(terms(spark, sf), tree(spark, sf))


@catalog.add("""
SELECT c_custkey, c_name AS term, coalesce(n_name, c_mktsegment) AS full_term
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 3""")
def abbreviations_table(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").filter("n_regionkey < 3")
    known = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.lit(True).alias("known"))
    # The term is the nation's number where the table of abbreviations has it.
    rows = table(spark, sf, "customer").join(known, "c_nationkey", "left").select(
        "c_custkey", "c_name",
        F.when(F.col("known"), F.col("c_nationkey").cast("string")).otherwise(F.col("c_mktsegment")).alias("t"),
    )
    table_ = nation.select(F.col("n_nationkey").cast("string").alias("abbr"), F.col("n_name").alias("expansion"))
    return X.expand_abbreviations(rows, "t", table_).select("c_custkey", F.col("c_name").alias("term"), "full_term")


@catalog.add("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'enters the battlefield' WHEN 'view' THEN 'mana value'
  WHEN 'purchase' THEN 'competitive commander' WHEN 'signup' THEN 'etb' ELSE event_type END AS full_term FROM events""")
def abbreviations_fixed(spark: SparkSession, sf: str) -> DataFrame:
    term = F.expr("CASE event_type WHEN 'click' THEN 'ETB' WHEN 'view' THEN 'CMC' "
                  "WHEN 'purchase' THEN 'cEDH' WHEN 'signup' THEN 'etb' ELSE event_type END")
    rows = table(spark, sf, "events").select("event_id", term.alias("term"))
    return X.expand_abbreviations(rows, "term").select("event_id", "full_term")


# ---- Colours: the letters of a part's name that stand for a colour ------------------


@catalog.add("""
WITH p AS (SELECT p_partkey, list_filter(['W', 'U', 'B', 'R', 'G'], lambda c: contains(upper(p_name), c)) AS c FROM part)
SELECT p_partkey, 'golgari' AS grp, 'contains_all' AS mode FROM p WHERE list_has_all(c, ['B', 'G'])
UNION ALL SELECT p_partkey, 'grixis', 'contained_by' FROM p WHERE list_has_all(['U', 'B', 'R'], c)
UNION ALL SELECT p_partkey, 'gruul', 'exact' FROM p WHERE list_has_all(['R', 'G'], c) AND list_has_all(c, ['R', 'G'])""")
def colour_filter(spark: SparkSession, sf: str) -> DataFrame:
    letters = F.array(*[F.lit(c) for c in "WUBRG"])
    parts = table(spark, sf, "part").withColumn(
        "color_identity", F.filter(letters, lambda c: F.contains(F.upper("p_name"), c))
    )
    wanted = [("golgari", "contains_all"), ("grixis", "contained_by"), ("gruul", "exact")]
    out = [X.colour_filter(parts, g, mode=m).select("p_partkey", F.lit(g).alias("grp"), F.lit(m).alias("mode"))
           for g, m in wanted]
    return out[0].union(out[1]).union(out[2])


# ---- Tagging ---------------------------------------------------------------------------
# Hints: the benchmark passages, and the words of part names by brand.


def hints(spark: SparkSession, sf: str) -> DataFrame:
    passages = table(spark, sf, "benchmark").select(
        F.concat(F.lit("passage."), F.col("item_id").cast("string")).alias("key"), F.col("text").alias("hint")
    )
    words = table(spark, sf, "part").select(
        F.concat(F.lit("word."), F.lower("p_type")).alias("key"), F.explode(F.split("p_name", " ")).alias("hint")
    )
    return passages.union(words)


_TAGS = """
WITH h AS (
  SELECT DISTINCT key, lower(hint) AS hint FROM (
    SELECT 'passage.' || item_id AS key, text AS hint FROM benchmark
    UNION ALL SELECT 'word.' || lower(p_type), unnest(string_split(p_name, ' ')) FROM part)
), tags AS (
  SELECT DISTINCT doc_id, key FROM documents JOIN h ON contains(lower(text), hint)
)"""


@catalog.add(_TAGS + " SELECT doc_id, key FROM tags")
def tags(spark: SparkSession, sf: str) -> DataFrame:
    return tag_texts(texts(spark, sf, "doc_id", "text"), "doc_id", "text", hints(spark, sf))


@catalog.add(_TAGS + " SELECT doc_id, key FROM tags")
def tags_by_grams(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the hints in several blocks, each an automaton of its own."""
    return tag_texts(texts(spark, sf, "doc_id", "text"), "doc_id", "text", hints(spark, sf), characters=4096)


@catalog.add(_TAGS + " SELECT doc_id, string_agg(key, '|' ORDER BY key) AS tags FROM tags GROUP BY doc_id")
def tag_columns(spark: SparkSession, sf: str) -> DataFrame:
    found = tag_arrays(tags(spark, sf), "doc_id")
    return found.select("doc_id", F.array_join("taxonomy_tags", "|").alias("tags"))


# ---- Fan-out: term → concept → one search per hint → merged ------------------------------


@catalog.add(f"""
WITH hint AS (
  SELECT label, embedding FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
), best AS (
  SELECT h.label AS term, e.vec_id AS id, max({_COS.format('h.embedding')}) AS s FROM hint h, embeddings e GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY term ORDER BY s DESC, id) AS rank FROM best
)
SELECT term, id, round(s, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5""")
def fan_out_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A label's searches are its vectors whose document is marked toxic."""
    rows = table(spark, sf, "embeddings")
    marked = table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("vec_id"))
    searches = rows.join(marked, "vec_id", "left_semi").select(
        F.col("label").alias("term"), F.concat_ws("|", "label", "vec_id").alias("query_id"),
        F.col("embedding").alias("query_vector"),
    )
    hits = similar_batch(rows, searches, 5, id_col="vec_id")
    return merge_best(hits, searches.select("query_id", "term"), "term", 5).withColumn(
        "similarity", F.round("similarity", 6)
    )


@catalog.add(_TREE + _TERMS + f""", asked AS (
  SELECT DISTINCT term, hint FROM terms JOIN alias_map m ON alias = lower(term) JOIN hints h ON h.ancestor = m.key
), searches AS (SELECT DISTINCT hint FROM asked),
v AS ({slots_sql('documents', 'doc_id', 'text')}),
q AS ({slots_sql('searches', 'hint', 'hint')}),
vn AS (SELECT doc_id, sqrt(sum(value * value)) AS n FROM v GROUP BY 1),
qn AS (SELECT hint, sqrt(sum(value * value)) AS n FROM q GROUP BY 1),
met AS (SELECT hint, doc_id, sum(q.value * v.value) AS dot FROM q JOIN v USING (slot) GROUP BY ALL),
sims AS (SELECT qn.hint, vn.doc_id AS id, round(coalesce(dot, 0) / (qn.n * vn.n), 12) AS s
         FROM qn CROSS JOIN vn LEFT JOIN met ON met.hint = qn.hint AND met.doc_id = vn.doc_id),
best AS (SELECT term, id, max(s) AS s FROM asked JOIN sims USING (hint) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY s DESC, id) AS rank FROM best)
SELECT term, id, round(s, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5""")
def fan_out_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way from terms to documents, with hashed token vectors."""
    from loreweave.operators.embedding import hashing_backend

    model = hashing_backend(64)
    docs = texts(spark, sf, "doc_id", "text").withColumnRenamed("doc_id", "id")
    vectors = model.embed(docs, "text").select("id", "embedding")
    tax = tree(spark, sf)
    return fan_out(terms(spark, sf), tax, vectors, model, 5).withColumn("similarity", F.round("similarity", 6))


# ---- Trees as rows of key and parent: parts in families of forty -------------------------

_FAMILY = """
WITH RECURSIVE nodes AS (
  SELECT 'p' || p_partkey AS key, CASE
    WHEN p_partkey % 40 <> 0 THEN 'p' || greatest(p_partkey - 1 - p_partkey % 3, p_partkey // 40 * 40)
    WHEN p_partkey // 40 % 10 = 7 THEN 'p' || (p_partkey + 5) END AS parent_key FROM part
), up AS (
  SELECT n.key, n.parent_key AS ancestor FROM nodes n JOIN nodes p ON p.key = n.parent_key
  UNION SELECT up.key, n.parent_key FROM up JOIN nodes n ON n.key = up.ancestor JOIN nodes p ON p.key = n.parent_key
), rings AS (SELECT key FROM up WHERE key = ancestor), lost AS (SELECT DISTINCT key FROM up WHERE ancestor IN (SELECT key FROM rings))"""


def families(spark: SparkSession, sf: str) -> DataFrame:
    """Each part hangs on one up to three before it; in one family of ten the first hangs on a later one."""
    k = F.col("p_partkey")
    first = F.expr("p_partkey div 40 * 40")
    parent = F.when(k % 40 != 0, F.greatest(k - 1 - k % 3, first)).when(F.expr("p_partkey div 40 % 10 = 7"), k + 5)
    name = lambda c: F.concat(F.lit("p"), c.cast("string"))
    return table(spark, sf, "part").select(name(k).alias("key"), name(parent).alias("parent_key"))


@catalog.add(_FAMILY + " SELECT key, ancestor FROM up WHERE key NOT IN (SELECT key FROM lost)")
def tree_ancestors(spark: SparkSession, sf: str) -> DataFrame:
    return ancestors(families(spark, sf)).select("key", "ancestor")


@catalog.add(_FAMILY + """
SELECT key, min(ancestor) AS cycle FROM up WHERE ancestor IN (SELECT key FROM rings) GROUP BY key""")
def tree_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return cycles(families(spark, sf))

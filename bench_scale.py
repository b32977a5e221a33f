"""How the main jobs grow: python bench_scale.py [factor …] (default 10 100).

The tables of $BENCH_SF_DIR are repeated under new ids; in the skewed runs
every third row moves to one key. Prints one line per job and factor.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.functions.notation import expand_notation
from loreweave.operators import ann, sync
from loreweave.operators.embedding import hashing_backend, pending, with_hash
from loreweave.operators.normalize import keep_canonical, number_face_rows
from loreweave.operators.search import similar, similar_batch
from loreweave.operators.tagging import tag_texts
from loreweave.session import local_session

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def repeated(spark, name: str, key: str, factor: int, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{SF}/{name}.parquet")
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1)))).withColumn(
        key, F.col(key) * factor + F.col("copy")
    )
    path = f"{folder}/{name}-{factor}"
    copies.repartition(8 * max(1, factor // 10)).write.parquet(path)
    return spark.read.parquet(path)


def timed(name: str, factor: int, n: int, df: DataFrame) -> None:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    print(f"{name:28} x{factor:<4} {n:>10} rows {took:8.2f} s {n / took:12.0f} rows/s", flush=True)


def main() -> None:
    spark = local_session()
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for factor in [int(a) for a in sys.argv[1:]] or [10, 100]:
        docs = repeated(spark, "documents", "doc_id", factor, folder)
        n = docs.count()
        hashed = docs.withColumn("content_hash", F.md5("text"))
        old = hashed.filter("lang <> 'de'")
        new = hashed.filter("lang <> 'es'").withColumn(
            "content_hash", F.when(F.col("lang") == "fr", F.lit("new")).otherwise(F.col("content_hash"))
        )
        classes = sync.diff(old, new, ["doc_id"])
        timed("diff", factor, n, classes)
        timed("diff and merge", factor, n, sync.merge(old, new, ["doc_id"], classes))

        text = F.replace(F.replace("text", F.lit(" the "), F.lit(" {T}: ")), F.lit(" de "), F.lit(" — "))
        timed("expand_notation", factor, n, expand_notation(docs.withColumn("raw", text), "raw").select("clean_text"))
        chunks = with_hash(docs.select(
            F.col("doc_id").cast("string").alias("id"), F.lit(0).alias("chunk_index"), F.col("text").alias("chunk_text")
        ), "m")
        timed("pending chunks", factor, n, pending(chunks, chunks.filter("id like '%7%'")).select("id"))
        timed("hashing embedder", factor, n, hashing_backend(64).embed(docs.select("text"), "text").select("embedding"))
        hints = spark.read.parquet(f"{SF}/benchmark.parquet").select(
            F.col("item_id").cast("string").alias("key"), F.col("text").alias("hint"))
        timed("tags", factor, n, tag_texts(docs, "doc_id", "text", hints))

        third = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0, F.lit("hot"))
        skewed = docs.select("doc_id", "source", F.coalesce(third, F.md5("text")).alias("text_key"))
        timed("dedup", factor, n, keep_canonical(
            docs.select("doc_id", "source", F.md5("text").alias("text_key")), ["text_key"], "source", "doc_id"))
        timed("dedup, one key a third", factor, n, keep_canonical(skewed, ["text_key"], "source", "doc_id"))
        timed("face index, one key a third", factor, n, number_face_rows(
            docs.select("doc_id", F.lit(1).alias("entry"), F.coalesce(third, F.col("source")).alias("id")),
            "entry", "doc_id", "id"))

        vec = repeated(spark, "embeddings", "vec_id", factor, folder)
        nv = vec.count()
        few = spark.read.parquet(f"{SF}/embeddings.parquet").filter("label < 5").orderBy("vec_id").limit(100)
        queries = few.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
        one = few.first().embedding
        timed("top-5, 1 query", factor, nv, similar(vec, one, id_col="vec_id"))
        timed("top-5, 100 queries", factor, nv, similar_batch(vec, queries, 5, id_col="vec_id"))

    vec = spark.read.parquet(f"{SF}/embeddings.parquet")
    exact = similar_batch(vec, queries, 5, id_col="vec_id").select("query_id", "id").cache()
    centroids = ann.train_lists(vec, lists=100)
    ann.write_lists(ann.assign_lists(vec, centroids), f"{folder}/lists")
    lists = spark.read.parquet(f"{folder}/lists")
    for nprobe in (1, 5, 10, 30, 100):
        found = ann.search_lists(lists, centroids, queries, 5, nprobe, id_col="vec_id")
        recall = found.join(exact, ["query_id", "id"], "left_semi").count() / exact.count()
        print(f"recall@5, {nprobe:>3} of 100 lists: {recall:.3f}", flush=True)


if __name__ == "__main__":
    main()

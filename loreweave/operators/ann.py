"""Approximate top-k through an inverted file: vectors in lists around centroids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.functions.vectors import dot
from loreweave.operators.ranking import top_k
from loreweave.operators.search import similar_batch


def train_lists(
    vectors: DataFrame, lists: int = 100, *, vector_col: str = "embedding", seed: int = 42,
    max_iter: int = 20, fraction: float = 1.0,
) -> np.ndarray:
    """Centroids by cosine k-means on all vectors, or on a ``fraction`` of them if asked for."""
    if fraction < 1.0:
        vectors = vectors.sample(fraction=fraction, seed=seed)
    v = F.col(vector_col)
    usable = vectors.filter(v.isNotNull()).filter(dot(v, v) > 0)
    points = usable.select(array_to_vector(F.col(vector_col).cast("array<double>")).alias("features"))
    model = KMeans(
        k=lists, distanceMeasure="cosine", seed=seed, maxIter=max_iter, featuresCol="features"
    ).fit(points)
    return np.array(model.clusterCenters(), dtype="float64")


def assign_lists(
    vectors: DataFrame, centroids: np.ndarray, *, vector_col: str = "embedding"
) -> DataFrame:
    """Add ``list_id``, the nearest centroid; every row gets exactly one list."""
    norms = np.sqrt((centroids * centroids).sum(axis=1))
    unit = centroids / np.where(norms > 0, norms, 1.0)[:, None]
    shared = vectors.sparkSession.sparkContext.broadcast(unit)

    @F.arrow_udf("int")
    def nearest(v: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        out = np.empty(len(v), dtype="int32")
        step = max(4_000_000 // shared.value.shape[1], 1)  # rows whose copy is held at a time
        for i in range(0, len(v), step):
            part = v.slice(i, step)
            m = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1).astype("float64")
            out[i : i + step] = np.argmax(m @ shared.value.T, axis=1)
        return pa.array(out)

    return vectors.filter(F.col(vector_col).isNotNull()).withColumn("list_id", nearest(F.col(vector_col)))


def write_lists(assigned: DataFrame, path: str) -> None:
    """Store the lists as partitions; a large list is split over several tasks and files."""
    assigned.hint("rebalance", "list_id").write.mode("overwrite").partitionBy("list_id").parquet(path)


def centroid_table(spark: SparkSession, centroids: np.ndarray) -> DataFrame:
    """``list_id, centroid``; as an Arrow table it needs no Python workers on the executors."""
    rows = pa.array(centroids.astype("float32").tolist(), pa.list_(pa.float32()))
    return spark.createDataFrame(pa.table({"list_id": pa.array(range(len(rows)), pa.int32()), "centroid": rows}))


def search_lists(
    assigned: DataFrame, centroids: np.ndarray, queries: DataFrame, k: int = 5, nprobe: int = 10,
    *, id_col: str = "id", vector_col: str = "embedding",
) -> DataFrame:
    """Top-k of every query within its ``nprobe`` nearest lists.

    With ``nprobe`` equal to the number of lists the result is exact. Lists no
    query asks for are not read.
    """
    spark = assigned.sparkSession
    nprobe = min(nprobe, len(centroids))
    probes = similar_batch(
        centroid_table(spark, centroids), queries, nprobe, id_col="list_id", vector_col="centroid"
    ).select("query_id", F.col("id").alias("list_id"))
    asked = [r.list_id for r in probes.select("list_id").distinct().collect()]
    wanted = queries.join(probes, "query_id").select("query_id", "query_vector", "list_id")
    in_lists = assigned.filter(F.col("list_id").isin(asked))
    hits = similar_batch(
        in_lists, wanted, k, id_col=id_col, vector_col=vector_col, cell="list_id"
    ).drop("rank")
    return top_k(hits, ["query_id"], k, F.desc_nulls_last("similarity"), F.col("id"))

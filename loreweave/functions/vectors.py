"""Column expressions on vectors and vector ids."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; NULL if a vector has length zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def cosine_to(query: Sequence[float], digits: int):
    """A column function: cosine similarity of a vector column to one fixed vector.

    Whole Arrow batches are multiplied at once, which is several times faster
    than walking array elements in SQL. Every row is summed in the same order,
    so equal vectors get equal values.
    """
    fixed = [float(x) for x in query]

    @F.arrow_udf("double")
    def similarity(v: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        if not len(v):
            return pa.array([], pa.float64())
        q = np.array(fixed, dtype="float32").astype("float64")  # as stored vectors are
        s = np.empty(len(v))
        step = max(4_000_000 // max(len(q), 1), 1)  # rows whose copy is held at a time
        with np.errstate(invalid="ignore", divide="ignore"):
            for i in range(0, len(v), step):
                part = v.slice(i, step)
                m = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1).astype("float64")
                norms = np.sqrt((m * m).sum(axis=1)) * np.sqrt((q * q).sum())
                s[i : i + step] = (m * q).sum(axis=1) / norms
        return pa.array(np.round(s, digits), mask=np.isnan(s))

    return similarity


def card_id(oracle_id: Column, face_index: Column) -> Column:
    return F.concat_ws(":", oracle_id, face_index.cast("string"))


def id_oracle(vector_id: Column) -> Column:
    return F.split_part(vector_id, F.lit(":"), F.lit(1))


def id_face(vector_id: Column) -> Column:
    return F.split_part(vector_id, F.lit(":"), F.lit(2)).cast("int")

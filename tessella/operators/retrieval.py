"""Vectors of chunks: embedding, upsert, nearest neighbours, look-ups by metadata."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most query vectors that are sent to the workers at once: 4 MB at 64 dimensions in double precision.
BLOCK = 8192


def embed(df: DataFrame, key: str, text: str, dimensions: int = 64) -> DataFrame:
    """A deterministic stand-in for a model: words hashed with a sign into `dimensions` cells, scaled to unit length.

    All in the JVM; null and blank texts have the zero vector.
    """
    words = df.select(F.col(key), F.explode_outer(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")).alias("word"))
    h = F.xxhash64("word")
    cells = words.groupBy(key, F.pmod(h, F.lit(dimensions)).cast("int").alias("cell")).agg(F.coalesce(F.sum(F.when(F.col("word").isNull(), 0.0).otherwise(F.when(F.shiftright(h, 40) % 2 == 0, 1.0).otherwise(-1.0))), F.lit(0.0)).alias("v"))
    filled = cells.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("cell", F.lit(-1)), "v"))).alias("m"))
    raw = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(0.0)))
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda a, x: a + x * x))
    return filled.select(key, F.transform(raw, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0))).alias("embedding"))


def upsert(stored: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Rows of both, one for each key: the greatest version; rows with a null key are dropped."""
    rows = stored.unionByName(new, allowMissingColumns=True).filter(F.col(key).isNotNull())
    rest = [c for c in rows.columns if c not in (key, version)]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(version), F.xxhash64(*(F.col(c) for c in rest if rows.schema[c].dataType.typeName() != "map")))).alias("r"), F.max(version).alias(version)).select(key, version, "r.*")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", where=None) -> DataFrame:
    """The k nearest vectors of each query by squared Euclidean distance, ties by key: query_id, rank, key, distance.

    `queries` has query_id and the vector. Queries are a stated set: they go out in blocks of BLOCK, each of a bounded size
    and loaded one at a time, all vectors are read once for all blocks, and every task keeps only k rows for each query of
    its part of `vectors`, so what is shuffled is tasks x queries x k rows, not all pairs. Null vectors and those of another
    length are never near.
    """
    pool = vectors.filter(where) if where is not None else vectors
    rows = queries.select("query_id", F.col(vector).alias("v")).filter("query_id is not null and v is not null")
    shared, width, part = [], None, []

    def send() -> None:
        shared.append(vectors.sparkSession.sparkContext.broadcast((np.array([r[0] for r in part]), np.array([r[1] for r in part], dtype=np.float64))))
        part.clear()

    for r in rows.toLocalIterator():
        width = len(r[1]) if width is None else width
        if len(r[1]) == width:
            part.append(r)
        if len(part) == BLOCK:
            send()
    if part:
        send()
    if not shared:
        return pool.select(F.lit(0).cast("long").alias("query_id"), F.lit(0).alias("rank"), F.col(key), F.lit(0.0).alias("distance")).limit(0)
    kind = vectors.schema[key].dataType.simpleString()
    best = pool.select(F.col(key), F.col(vector).alias("v")).filter(F.size("v") == width).mapInPandas(_nearest_in(shared, k, key), f"query_id long, {key} {kind}, distance double")
    order = Window.partitionBy("query_id").orderBy("distance", key)
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", key, "distance")


def _nearest_in(shared, k: int, key: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top: list = [None] * len(shared)
        for batch in batches:
            for at in range(0, len(batch), 2048):
                piece = batch.iloc[at : at + 2048]
                v = np.array(piece["v"].tolist(), dtype=np.float64)
                names = piece[key].to_numpy()
                names = names.astype(str) if names.dtype == object else names
                for b, block in enumerate(shared):
                    _, q = block.value
                    # Sums in the order of the dimensions, as SQL folds them, so that ties are ties.
                    d = np.zeros((len(q), len(v)))
                    for j in range(v.shape[1]):
                        diff = q[:, j, None] - v[None, :, j]
                        d += diff * diff
                    own = np.broadcast_to(names, d.shape)
                    top_d, top_i = (d, own) if top[b] is None else (np.concatenate([top[b][0], d], 1), np.concatenate([top[b][1], own], 1))
                    if top_d.shape[1] > k:
                        order = np.lexsort((top_i, top_d), axis=1)[:, :k]
                        top_d, top_i = np.take_along_axis(top_d, order, 1), np.take_along_axis(top_i, order, 1)
                    top[b] = top_d, top_i
        for block, found in zip(shared, top):
            if found is not None:
                yield pd.DataFrame({"query_id": np.repeat(block.value[0], found[0].shape[1]), key: found[1].reshape(-1), "distance": found[0].reshape(-1)})

    return run


def by_metadata(df: DataFrame, where, limit: int = 100, *order: str) -> DataFrame:
    """The first `limit` rows that a condition holds for, in a stated order."""
    return df.filter(where).orderBy(*order).limit(limit)

"""Nearest other row by cosine, in blocks: no pairs are made or shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.session import ship_package, written

#: Vectors in a block, which is broadcast, and in one step against it.
BLOCK, STEP = 5_000, 500


def nearest_cosine(vectors: DataFrame, key: str, vector: str, places: int = 6) -> DataFrame:
    """For each row the other key of largest cosine, rounded to ``places`` (ties: the smallest key): (key, other,
    cosine). Rows whose cosine with all others is 0 are left out; keys are integers and distinct.

    Vectors are dealt by a hash of their key into blocks of some ``BLOCK`` rows; each is broadcast in turn and meets all
    vectors as a matrix product, and a row's best of all blocks is kept. Time grows with the square of the rows,
    as exact search does; memory and shuffle do not."""
    spark = vectors.sparkSession
    ship_package(spark)
    held = written(vectors.select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v")).where("v is not null"), "vectors")
    blocks = max(1, -(-held.count() // BLOCK))
    best = None

    def unit(x: np.ndarray) -> np.ndarray:
        n = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return np.divide(x, n, out=np.zeros_like(x), where=n > 0)

    def against(shared):
        def run(batches):
            others, matrix = shared.value
            for big in batches:
                for at in range(0, big.num_rows, STEP):
                    batch = big.slice(at, STEP)
                    k = batch.column(0).to_numpy()
                    x = unit(np.array(batch.column(1).to_pylist(), float).reshape(len(k), -1))
                    c = x @ matrix.T
                    np.round(c, places, out=c)
                    c[k[:, None] == others[None, :]] = -1.0
                    # Others are in the order of their keys, and the first of equal ones is taken.
                    j = c.argmax(axis=1)
                    top = c[np.arange(len(k)), j]
                    yield pa.RecordBatch.from_arrays([pa.array(k[top > 0]), pa.array(others[j][top > 0]), pa.array(top[top > 0])], ["k", "other", "cosine"])

        return run

    for b in range(blocks):
        rows = sorted((r["k"], r["v"]) for r in held.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == b).collect())
        if rows:
            block = np.array([k for k, _ in rows], np.int64), unit(np.array([v for _, v in rows], float))
            found = held.mapInArrow(against(spark.sparkContext.broadcast(block)), "k long, other long, cosine double")
            best = found if best is None else best.unionByName(found)
    if best is None:
        return held.select("k", F.lit(None).cast("long").alias("other"), F.lit(None).cast("double").alias("cosine")).withColumnRenamed("k", key)
    top = best.groupBy("k").agg(F.max(F.struct("cosine", (-F.col("other")).alias("o"))).alias("m"))
    return top.select(F.col("k").alias(key), (-F.col("m.o")).alias("other"), F.col("m.cosine").alias("cosine"))

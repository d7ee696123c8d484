"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Each block of rows is inverted: for every term (dimension) the rows that have it and their weights. Each sparse
query row walks its terms and scatters weight x posting into a dense array with one score for each row of the block.
A partition of that array selects the block's best, and the blocks' bests are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm.util import materialize

def _floor(x: Column) -> Column:
    """floor as a double, at any size: from 2^53 on, doubles have no fraction."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def quantise(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double; null where the vector is null or has a null or non-finite component."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: _floor(x.cast("double") * scale)))


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, row offsets and the concatenated components of a batch (id, vector)."""
    lists = batch.column(1)
    return batch.column(0).to_numpy(zero_copy_only=False), np.asarray(lists.offsets), np.asarray(lists.values)


class Queries:
    """Query rows: the non-zero terms of each with their weights."""

    def __init__(self, ids: list[int], vectors: list[list[float]]):
        self.ids = np.array(ids, np.int64)
        self.terms = [np.flatnonzero(np.array(v)) for v in vectors]
        self.weights = [np.array(v)[t] for v, t in zip(vectors, self.terms, strict=True)]
        self.most = max((float(np.abs(w).max()) for w in self.weights if len(w)), default=0.0)
        self.dims = max(map(len, vectors), default=0)

    def best(self, ids: np.ndarray, offsets: np.ndarray, flat: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, row ids, scores) of each query's k best rows of the block, ties to smaller ids."""
        order = np.argsort(ids, kind="stable")
        n = len(ids)
        owner = np.repeat(np.arange(n), np.diff(offsets))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        flat = flat[offsets[0] : offsets[-1]]
        term = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))
        row, some = rank[owner], flat != 0
        row, term, flat, ids = row[some], term[some], flat[some], ids[order]
        most = float(np.abs(flat).max()) if len(flat) else 0.0
        # sums that doubles or longs cannot hold exactly are added as Python integers
        kind = np.float64 if most * self.most * max(1, self.dims) < 2**53 else object
        weight = flat if kind is np.float64 else np.array([int(x) for x in flat], object)
        by_term = np.lexsort((row, term))
        row, term, weight = row[by_term], term[by_term], weight[by_term]
        edges = np.searchsorted(term, np.arange(self.dims + 1))
        postings = [(slice(None) if b - a == n else row[a:b], weight[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        for q, terms, weights in zip(self.ids.tolist(), self.terms, self.weights, strict=True):
            score = np.zeros(n, kind)
            for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
                rows, values = postings[t]
                score[rows] += (w if kind is np.float64 else int(w)) * values
            if kind is object:
                score = np.array([min(max(s, -(2**63)), 2**63 - 1) for s in score], np.int64)
            free = np.flatnonzero(ids != q)
            own = score[free]
            if len(own) > k:
                floor = np.partition(own, len(own) - k)[len(own) - k]
                pick = np.flatnonzero(own >= floor)
            else:
                pick = np.arange(len(own))
            pick = pick[::-1][np.argsort(own[pick][::-1], kind="stable")][::-1][:k]  # best first; of equals the smaller id
            yield q, ids[free[pick]], own[pick]


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, *, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256, query_bytes: int = 32 << 20, block_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest integer inner product with each query row.

    Components are quantised to floor(scale * x). Every row but those that carry the query's own id is a
    candidate; ties go to the smaller id. Vectors that are null or hold a null or non-finite component, and rows
    without id, take no part; a shorter vector has zeros for the rest, an empty one scores 0. Of query rows that
    share an id, the one with the smallest vector asks. Repeated rows are candidates each. Scores beyond a
    long are held at its ends. Empty tables give an empty result.

    Queries are held in blocks of at most `query_bytes`; each block is sent to all tasks and scans all rows,
    so an executor holds one block of queries and one of rows, whatever the number of either.
    """
    spark = rows.sparkSession
    base = rows.select(F.col(f"`{id_col}`").cast("long").alias("i"), quantise(vector, scale).alias("v")).where("i is not null and v is not null")
    asked = queries.select(F.col(f"`{id_col}`").cast("long").alias("i"), quantise(vector, scale).alias("v")).where("i is not null and v is not null").groupBy("i").agg(F.min("v").alias("v"))
    total = asked.agg(F.coalesce(F.sum(F.size("v") * 16 + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // query_bytes))
    if blocks > 1:
        asked = materialize(asked, "topk-queries")
    parts = []
    for b in range(blocks):
        own = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b)
        got = own.collect()  # at most about query_bytes
        sent = spark.sparkContext.broadcast(([r.i for r in got], [r.v for r in got]))

        def score(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            asking = Queries(*sent.value)
            for batch in batches:
                for at in range(0, batch.num_rows, block_rows):
                    part = batch.slice(at, block_rows)
                    found = list(asking.best(*_rows(part), k))
                    if not found:
                        continue
                    q = np.repeat([x for x, *_ in found], [len(i) for _, i, _ in found])
                    values = [int(s) for *_, own in found for s in own]
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(np.concatenate([i for _, i, _ in found]), pa.int64()), pa.array(values, pa.int64())], ["query_id", "vec_id", "score"])

        part = base.mapInArrow(score, "query_id long, vec_id long, score long")
        parts.append(part if blocks == 1 else materialize(part, "topk-block"))
        if blocks > 1:
            sent.unpersist()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    # ranked within each task first (a group limit before the exchange), so a query gets k rows from each task
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

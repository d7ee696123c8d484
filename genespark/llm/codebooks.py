"""Compression of vectors to short codes: integer Lloyd codebooks for each part, with Hamerly's bounds.

A vector is cut into equal consecutive parts and each part is replaced by the index of its nearest codebook entry.
Between rounds every part keeps one upper bound of the distance to its own entry and one lower bound of the distance
to the second nearest. As entries move, the bounds are loosened; all entries are scanned only where the bounds fail.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genespark.llm.util import discard, join_hot, materialize

#: Scaled components are held at plus and minus this value.
MOST = 1 << 40
#: Bounds are doubles: each is loosened by this share, which is far above the rounding of the steps that make it.
SLACK = 1e-12


def _up(x: np.ndarray) -> np.ndarray:
    return x + np.abs(x) * SLACK


def _down(x: np.ndarray) -> np.ndarray:
    return x - np.abs(x) * SLACK


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x (n, d) to all rows of c (m, d), as doubles or, where these are too small, Python integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * most * most < 2**53:
        x, c = x.astype(np.float64), c.astype(np.float64)
        return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None]
    x, c = x.astype(object), c.astype(object)
    return np.stack([((x - e) ** 2).sum(1) for e in c], 1)


def own_squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to the rows of c at the same place."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    gap = x.astype(np.int64) - c if 4 * x.shape[1] * most * most < 2**62 else x.astype(object) - c.astype(object)
    return (gap * gap).sum(1)


def _roots(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(np.float64))


@dataclass
class Books:
    """Codebooks of all parts, (parts, entries, width) integers, and what bounds need to know of them."""

    entries: np.ndarray
    drift: np.ndarray  # how far each entry has moved since the bounds were kept
    rest: np.ndarray  # for each entry, how far any other has moved at most
    gap: np.ndarray  # half the distance from each entry to the nearest other one

    @classmethod
    def of(cls, entries: np.ndarray, before: np.ndarray | None = None) -> Books:
        parts, n, _ = entries.shape
        drift, rest, gap = np.zeros((parts, n)), np.zeros((parts, n)), np.full((parts, n), np.inf)
        for p in range(parts):
            if before is not None:
                drift[p] = _up(_roots(own_squares(entries[p], before[p])))
                top = int(drift[p].argmax())
                rest[p] = drift[p, top]
                rest[p, top] = np.delete(drift[p], top).max(initial=0.0)
            if n > 1:
                apart = _roots(squares(entries[p], entries[p]))
                np.fill_diagonal(apart, np.inf)
                gap[p] = _down(apart.min(1) / 2)
        return cls(entries, drift, rest, gap)

    def assign(self, v: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
        """Moves codes (n, parts) of the vectors v (n, parts, width) to the nearest entries and renews the bounds, in place; the number of parts scanned in full.

        A part keeps its entry if it is strictly nearer than any other can be; so a tie is always scanned, and goes to the lower index.
        """
        scanned = 0
        for p in range(v.shape[1]):
            x, a = v[:, p], code[:, p]
            u, low = _up(upper[:, p] + self.drift[p][a]), _down(lower[:, p] - self.rest[p][a])
            limit = np.maximum(low, self.gap[p][a])
            at = np.flatnonzero(~(u < limit))
            u[at] = _up(_roots(own_squares(x[at], self.entries[p][a[at]])))
            at = at[~(u[at] < limit[at])]
            if len(at):
                scanned += len(at)
                far = squares(x[at], self.entries[p])
                best, row = far.argmin(1), np.arange(len(at))
                code[at, p] = best
                u[at] = _up(_roots(far[row, best]))
                far = far.astype(np.float64)
                far[row, best] = np.inf
                low[at] = _down(np.sqrt(far.min(1)))
            upper[:, p], lower[:, p] = u, low
        return scanned

    def errors(self, v: np.ndarray, code: np.ndarray) -> list[int]:
        """Squared distances to the own entries, summed over parts and held at the largest long."""
        total = np.zeros(len(v), object)
        for p in range(v.shape[1]):
            total += own_squares(v[:, p], self.entries[p][code[:, p]])
        return [min(int(e), 2**63 - 1) for e in total]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def quantise(vector: str, scale: int) -> Column:
    """floor(scale * x) of each component; null where the vector is null or holds a null or non-finite component."""
    v = F.col(f"`{vector}`")
    double = lambda x: x.cast("double")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(double(x)) | (F.abs(double(x)) == float("inf")))
    held = lambda x: F.floor(F.greatest(F.least(double(x) * scale, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("long")
    return F.when(v.isNotNull() & ~bad, F.transform(v, held))


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """A copy of a list column as (rows, parts, width)."""
    n = len(column)
    return np.array(column.flatten().to_numpy(zero_copy_only=False)).reshape(n, parts, -1) if n else np.zeros((0, parts, 0))


def _flat(column: pa.Array, parts: int) -> np.ndarray:
    return _matrix(column, parts)[:, :, 0]


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(x.reshape(-1), kind))


def _assigned(state: DataFrame, books: Books, parts: int, block_rows: int) -> DataFrame:
    """The state with the nearest entries of `books`; `was` holds the codes before."""
    sent = state.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                v, was = _matrix(part.column("v"), parts), _flat(part.column("code"), parts).astype(np.int64)
                upper, lower = _flat(part.column("upper"), parts), _flat(part.column("lower"), parts)
                code = np.maximum(was, 0)
                own.assign(v, code, upper, lower)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("i", "label", "v")), _lists(was, pa.int32()), _lists(code, pa.int32()), _lists(upper, pa.float64()), _lists(lower, pa.float64())], ["i", "label", "v", "was", "code", "upper", "lower"])

    kind = state.schema
    schema = T.StructType([kind["i"], kind["label"], kind["v"], *T.StructType.fromDDL("was array<int>, code array<int>, upper array<double>, lower array<double>").fields])
    return state.select("i", "label", "v", "code", "upper", "lower").mapInArrow(run, schema)


def _changes(state: DataFrame, parts: int, entries: int) -> list:
    """What the last assignment added to and took from the sum and the count of each entry: rows (part, entry, position, total, n).

    Only vectors with a changed code are read. Each task sends one row an entry, and Spark adds those up; what comes
    to the driver has the size of the codebooks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: np.ndarray | None = None
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v, was, code = _matrix(batch.column(0), parts), _flat(batch.column(1), parts), _flat(batch.column(2), parts)
            if sums is None:
                sums = np.zeros((parts, entries, v.shape[2]), object)
            # a batch's sums fit in longs: 2^40 times at most 2^22 rows
            for p in range(parts):
                new = was[:, p] != code[:, p]
                for side, sign in ((code[:, p], 1), (was[:, p], -1)):
                    at = np.flatnonzero(new & (side >= 0))
                    if len(at):
                        at = at[np.argsort(side[at], kind="stable")]
                        entry, first, n = np.unique(side[at], return_index=True, return_counts=True)
                        sums[p, entry] += sign * np.add.reduceat(v[at, p], first, axis=0).astype(object)
                        counts[p, entry] += sign * n
        if sums is not None:
            p, e = np.nonzero(counts.astype(bool) | (sums != 0).any(2))
            if len(p):
                values = pa.array([[Decimal(int(x)) for x in row] for row in sums[p, e]], pa.list_(pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), values, pa.array(counts[p, e], pa.int64())], ["part", "entry", "sums", "n"])

    partial = state.where("was <> code").select("v", "was", "code").mapInArrow(run, "part int, entry int, sums array<decimal(38,0)>, n long")
    by_place = partial.select("part", "entry", "n", F.posexplode("sums").alias("place", "x"))
    return by_place.groupBy("part", "entry", "place").agg(F.sum("x").alias("total"), F.sum("n").alias("n")).collect()


def compress(rows: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, block_rows: int = 8192) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each vector, after `rounds` rounds of Lloyd's algorithm in integers.

    Components become floor(scale * x), held at plus and minus 2^40. Vectors that are null or hold a null or non-finite
    component are dropped. The largest length, rounded up to whole parts, counts for all: shorter vectors, empty ones too,
    have zeros for the rest. Codebooks start as the vectors of the smallest ids (null last; equal ids by vector), fewer
    entries where there are fewer rows. Repeated rows count each. Distances are exact at any size, and errors beyond a
    long are held at its end. Equal labels share label_error, nulls together. An empty table gives an empty result; other
    columns, whatever their names, are not read.

    The driver holds the codebooks, parts x entries x width integers, and nothing that grows with the rows. The vectors
    and their bounds are a table in the shared folder, rewritten each round by tasks that need no shuffle.
    """
    kept = rows.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label}`").alias("label"), quantise(vector, scale).alias("v")).where("v is not null")
    width = kept.agg(F.max(F.size("v")).alias("w")).first().w
    if width is None:
        return kept.select(F.col("i").alias(id_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = max(parts, -(-width // parts) * parts)
    padded = kept.withColumn("v", F.when(F.size("v") == width, F.col("v")).otherwise(F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))))
    first = padded.orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()  # at most `entries` rows
    books = Books.of(np.array([r.v for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy())
    same = lambda x: F.array_repeat(F.lit(x), parts)
    state = padded.select("i", "label", "v", same(-1).alias("code"), same(float("inf")).alias("upper"), same(0.0).alias("lower"))
    sums, counts = np.zeros(books.entries.shape, object), np.zeros(books.entries.shape[:2], object)
    for _ in range(rounds):
        following = materialize(_assigned(state, books, parts, block_rows), "codes")
        discard(state)
        state = following
        for r in _changes(state, parts, len(first)):
            sums[r.part, r.entry, r.place] += int(r.total)
            if not r.place:
                counts[r.part, r.entry] += r.n
        entry = books.entries.copy()
        for p, e in zip(*np.nonzero(counts), strict=True):
            entry[p, e] = [int(x) // int(counts[p, e]) for x in sums[p, e]]
        books = Books.of(entry, books.entries)
    final = _with_errors(_assigned(state, books, parts, block_rows), books, parts)
    codes = materialize(final, "codes-final")
    discard(state)
    by_label = materialize(codes.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1)).cast("long").alias("label_error"), F.count(F.lit(1)).alias("n")), "codes-labels")
    out = join_hot(codes, by_label, {"label": "label"}, "n")
    return out.select(F.col("i").alias(id_col), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _with_errors(state: DataFrame, books: Books, parts: int) -> DataFrame:
    """i, label, code as hexadecimal digits, error."""
    sent = state.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code = _flat(batch.column(3), parts).astype(np.int64)
                digits = [row.tobytes().hex() for row in code.astype(np.uint8)]
                errors = sent.value.errors(_matrix(batch.column(2), parts), code)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digits, pa.string()), pa.array(errors, pa.int64())], ["i", "label", "code", "error"])

    schema = T.StructType([state.schema["i"], state.schema["label"], *T.StructType.fromDDL("code string, error long").fields])
    return state.select("i", "label", "v", "code").mapInArrow(run, schema)

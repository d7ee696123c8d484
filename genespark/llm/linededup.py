"""Incremental line dedup: sharded cuckoo filters in front of exact reference-count tables.

The exact table holds one row for each key (line, stripped and lower-cased, as a 128-bit hash) with the number
of documents that hold it and the largest id among them; postings (key, document) make deletions exact. Each
shard of the key space has a cuckoo filter of the keys in its reference table: on insertion, a key that the
filter does not hold is new for certain, skips the lookup and enters the filter; on deletion, keys whose count falls to
zero leave it. A filter is made anew only when it is full or when the shards are doubled, as they are before a batch that would bring more than
`keys_a_shard` keys to one, so no task's filter grows with the index. So any sequence of insertions and deletions ends in the state that a build from scratch gives.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.llm.util import Texts, join_hot, lists, map_text, materialize

STRIP = b" \t\n\x0b\x0c\r"


class CuckooFilter:
    """Partial-key cuckoo filter: buckets of four 16-bit fingerprints, each key in one of two buckets.

    All operations take arrays of distinct 64-bit keys. A key that was inserted is always found; one that was
    not is found by chance in about 1 of 8,000 cases. Only inserted keys may be deleted.
    """

    SLOTS = 4

    def __init__(self, n_buckets: int, table: np.ndarray | None = None):
        self.n = n_buckets
        self.table = np.zeros((n_buckets, self.SLOTS), np.uint16) if table is None else table

    @classmethod
    def build(cls, keys: np.ndarray) -> "CuckooFilter":
        """A filter of the keys, at most 80 % full; doubled until all fit."""
        n = 8
        while n * cls.SLOTS * 0.8 < len(keys):
            n *= 2
        while not (out := cls(n)).insert(keys):
            n *= 2
        return out

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        table = np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy()
        return cls(len(table), table)

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = keys.view(np.uint64) if keys.dtype == np.int64 else keys.astype(np.uint64)
        return ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16), ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24) & np.uint64(self.n - 1)).astype(np.int64)  # not the low bits, which tell the shard

    def _other(self, bucket: np.ndarray, finger: np.ndarray) -> np.ndarray:
        return bucket ^ (((finger.astype(np.uint64) * np.uint64(0x5BD1E995C6A4A793)) >> np.uint64(20)) & np.uint64(self.n - 1)).astype(np.int64)

    def insert(self, keys: np.ndarray, rounds: int = 500) -> bool:
        """Insert keys, all at once by rounds; False if some found no place (then the filter must be rebuilt)."""
        finger, bucket = self._places(keys)
        pick = np.random.default_rng(7)
        for k in range(rounds):
            order = np.argsort(bucket, kind="stable")
            finger, bucket = finger[order], bucket[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            free = self.table[bucket] == 0
            place = free & (np.cumsum(free, 1) == (rank + 1)[:, None])
            ok = place.any(1)
            self.table[bucket[ok], place[ok].argmax(1)] = finger[ok]
            finger, bucket = finger[~ok], bucket[~ok]
            if not len(finger):
                return True
            if k % 2:  # its other bucket was full as well: one of each bucket pushes a fingerprint out
                full, one = np.unique(bucket, return_index=True)
                slot = pick.integers(0, self.SLOTS, len(full))
                out = self.table[full, slot].copy()
                self.table[full, slot] = finger[one]
                finger[one] = out
            bucket = self._other(bucket, finger)
        return False

    def add(self, keys: np.ndarray, known: bool = False) -> bool:
        """Insert keys that are not held (known: their fingerprints may be, from other keys); False if the filter is full."""
        keys = keys if known else keys[~self.contains(keys)]
        if int((self.table != 0).sum()) + len(keys) > 0.9 * self.table.size:
            return False
        return self.insert(keys)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        finger, bucket = self._places(keys)
        return (self.table[bucket] == finger[:, None]).any(1) | (self.table[self._other(bucket, finger)] == finger[:, None]).any(1)

    def delete(self, keys: np.ndarray) -> None:
        finger, first = self._places(keys)
        for f, b, o in zip(finger, first, self._other(first, finger), strict=True):
            for at in (b, o):
                if len(hit := np.flatnonzero(self.table[at] == f)):
                    self.table[at, hit[0]] = 0
                    break


def _only_with_filter(change: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For cogroups of keys and filters: shards without a filter give nothing, those without keys their filter as it is."""

    def run(keys: pa.Table, cells: pa.Table) -> pa.Table:
        if not cells.num_rows or not keys.num_rows:
            return pa.table({"shard": cells["shard"], "cells": cells["cells"]})
        return change(keys, cells)

    return run


def _line_keys(text: bytes, least: int) -> list[tuple[bytes, int | None]]:
    """Each line with its 128-bit key, None below `least` code points."""
    out = []
    for line in text.split(b"\n"):
        s = line.strip(STRIP)
        n = len(s)
        if n >= least and not s.isascii() and n < 4 * least:
            n = len(s.decode("utf-8", "replace"))
        out.append((line, xxhash.xxh3_128_intdigest(s.lower()) if n >= least else None))
    return out


def postings(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", least: int = 40) -> DataFrame:
    """(doc, k1, k2): each key of each document once. Rows that share an id count as one document."""

    def make():
        def of(texts: Texts) -> list[pa.Array]:
            keys, counts = [], []
            for i in range(texts.n):
                own = {k for _, k in _line_keys(texts.bytes(i), least) if k is not None}
                keys += own
                counts.append(len(own))
            high = np.fromiter((k >> 64 for k in keys), np.uint64, len(keys)).view(np.int64)
            low = np.fromiter((k & 0xFFFFFFFFFFFFFFFF for k in keys), np.uint64, len(keys)).view(np.int64)
            return [lists(high, counts), lists(low, counts)]

        return of

    rows = map_text(docs, text, make, [("k1", "array<long>"), ("k2", "array<long>")], keep=[id_col])
    rows = rows.select(F.col(f"`{id_col}`").alias("doc"), F.inline(F.arrays_zip("k1", "k2")))
    ids = docs.select(F.col(f"`{id_col}`").alias("doc"))
    return rows.distinct() if ids.groupBy("doc").count().where("count > 1").limit(1).count() else rows


@dataclass(frozen=True)
class LineIndex:
    """What has been inserted: postings(doc, k1, k2), refs(shard, k1, k2, n, last), filters(shard, cells).

    Lines that many documents hold are joined as join_hot() does: none of them is one task.
    """

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    keys_a_shard: int = 500_000

    @classmethod
    def empty(cls, like: DataFrame, shards: int = 64, keys_a_shard: int = 500_000) -> "LineIndex":
        """An index without documents, for postings of the schema of `like`."""
        none = like.where("false")
        refs = none.select(F.lit(0).alias("shard"), "k1", "k2", F.lit(0).cast("long").alias("n"), F.col("doc").alias("last"))
        return cls(none, refs, none.select(F.lit(0).alias("shard"), F.lit(b"").alias("cells")), shards, keys_a_shard)

    def _shard(self) -> Column:
        return F.pmod("k1", F.lit(self.shards)).cast("int").alias("shard")

    def grown(self, keys: int) -> "LineIndex":
        """The index with its shards doubled until `keys` keys take no more than keys_a_shard in each; itself if they do."""
        shards = self.shards
        while keys > shards * self.keys_a_shard:
            shards *= 2
        if shards == self.shards:
            return self
        more = replace(self, shards=shards)
        refs = materialize(self.refs.select(more._shard(), "k1", "k2", "n", "last"), "line-refs")
        return replace(more, refs=refs, filters=more._filters(refs))

    def _count(self, rows: DataFrame) -> DataFrame:
        """Exact counts by key; partial sums before the shuffle, so a hot key sends one row a task."""
        return rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("last")).select(self._shard(), "k1", "k2", "n", "last")

    def insert(self, rows: DataFrame, fresh: bool = False) -> "LineIndex":
        """Add postings. fresh: none of their documents is held yet; otherwise those held are left out first.

        Each shard that the batch touches loads its filter, which tells what may be held from what is new for certain;
        the new keys go into that filter (it is made anew, at twice the size, only when they no longer fit). Only keys that
        may be held are looked up, so the exact table is joined with those, and its other rows pass through unread by keys.
        """
        if not fresh:
            rows = materialize(rows.join(self.postings, (rows.k1 == self.postings.k1) & (rows.k2 == self.postings.k2) & rows.doc.eqNullSafe(self.postings.doc), "left_anti"), "line-postings")
        index = self.grown(self.refs.count() + rows.count())
        return index._insert(rows)

    def _insert(self, rows: DataFrame) -> "LineIndex":
        batch = self._count(rows)
        kind = batch.schema["last"].dataType.simpleString()

        def probe(keys: pa.Table, cells: pa.Table) -> pa.Table:
            """What the filter says of each key; the last row carries the filter with the new ones in it (null: it is full)."""
            held = CuckooFilter.load(cells["cells"][0].as_py()) if cells.num_rows else None
            shard = (keys if keys.num_rows else cells)["shard"][0].as_py()
            k = keys["k1"].to_numpy()
            seen = held.contains(k) if held is not None else np.zeros(len(k), bool)
            new = np.unique(k[~seen])
            held = CuckooFilter.build(new) if held is None else held if held.add(new) else None
            one = {"shard": [shard], "k1": [None], "k2": [None], "n": [None], "last": [None], "seen": [held is None], "cells": [None if held is None else held.dump()]}
            types = pa.schema([*keys.schema, ("seen", pa.bool_()), ("cells", pa.binary())])
            rows = keys.append_column("seen", pa.array(seen)).append_column("cells", pa.nulls(len(k), pa.binary()))
            return pa.concat_tables([rows.cast(types), pa.table({c: pa.array(v, types.field(c).type) for c, v in one.items()}, types)])

        marked = materialize(batch.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(probe, f"shard int, k1 long, k2 long, n long, last {kind}, seen boolean, cells binary"), "line-marked")
        keys = marked.where("n is not null")
        held = materialize(keys.where("seen").select("shard", "k1", "k2", F.col("n").alias("n_"), F.col("last").alias("last_")), "line-held")
        old = self.refs.join(held, ["shard", "k1", "k2"], "full").select("shard", "k1", "k2", (F.coalesce("n", F.lit(0).cast("long")) + F.coalesce("n_", F.lit(0).cast("long"))).alias("n"), F.greatest("last", "last_").alias("last"))
        refs = materialize(old.unionByName(keys.where("not seen").select("shard", "k1", "k2", "n", "last")), "line-refs")
        # keys that the filter held by chance only have no fingerprint of their own yet: a deletion would take another's
        chance = held.select("shard", "k1").distinct().join(self.refs.select("k1"), "k1", "left_anti")

        def add(keys: pa.Table, cells: pa.Table) -> pa.Table:
            out = CuckooFilter.load(cells["cells"][0].as_py())
            fits = out.add(keys["k1"].to_numpy(), known=True)
            return pa.table({"shard": cells["shard"].combine_chunks(), "cells": pa.array([out.dump() if fits else None], pa.binary())})

        ready = marked.where("cells is not null").select("shard", "cells")
        filters = materialize(chance.groupBy("shard").cogroup(ready.groupBy("shard")).applyInArrow(_only_with_filter(add), "shard int, cells binary"), "line-filters")
        full = materialize(filters.where("cells is null").select("shard").unionByName(marked.where("n is null and seen").select("shard")).distinct(), "line-full")
        if full.limit(1).count():
            filters = filters.where("cells is not null").unionByName(self._filters(refs.join(full, "shard", "left_semi")))
        return replace(self, postings=self.postings.unionByName(rows), refs=refs, filters=filters)

    def _filters(self, refs: DataFrame) -> DataFrame:
        """Filters made anew from the exact table, for shards whose filter is full."""

        def build(keys: pa.Table) -> pa.Table:
            cells = CuckooFilter.build(np.unique(keys["k1"].to_numpy()))
            return pa.table({"shard": pa.array([keys["shard"][0].as_py()], pa.int32()), "cells": pa.array([cells.dump()], pa.binary())})

        return materialize(refs.select("shard", "k1").groupBy("shard").applyInArrow(build, "shard int, cells binary"), "line-filters")

    def delete(self, ids: DataFrame) -> "LineIndex":
        """Take documents out again: ids has one column of document ids (nulls: the documents without id)."""
        ids = ids.toDF("gone").distinct()
        gone = self.postings.join(ids, self.postings.doc.eqNullSafe(ids.gone), "left_semi")
        left = materialize(self.postings.join(ids, self.postings.doc.eqNullSafe(ids.gone), "left_anti"), "line-postings")
        touched = materialize(gone.select("k1", "k2").distinct().join(self.refs.select("k1", "k2", "n"), ["k1", "k2"]), "line-touched")
        again = self._count(join_hot(left, touched, {"k1": "k1", "k2": "k2"}, "n"))
        refs = materialize(self.refs.join(touched, ["k1", "k2"], "left_anti").select("shard", "k1", "k2", "n", "last").unionByName(again), "line-refs")
        # several keys may share their first half: a fingerprint goes only when none of them is left
        dead = touched.select("k1").distinct().join(refs.select("k1"), "k1", "left_anti").select(self._shard(), "k1")

        def drop(keys: pa.Table, cells: pa.Table) -> pa.Table:
            held = CuckooFilter.load(cells["cells"][0].as_py())
            held.delete(keys["k1"].to_numpy())
            return pa.table({"shard": cells["shard"].combine_chunks(), "cells": pa.array([held.dump()], pa.binary())})

        filters = materialize(dead.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(_only_with_filter(drop), "shard int, cells binary"), "line-filters")
        return replace(self, postings=left, refs=refs, filters=filters)

    def doomed(self, min_docs: int) -> DataFrame:
        """(doc, drop): the keys that each document loses, as an array of structs (k1, k2)."""
        hot = materialize(self.refs.where(F.col("n") >= min_docs).select("k1", "k2", "n", "last"), "line-hot")
        lost = join_hot(self.postings, hot, {"k1": "k1", "k2": "k2"}, "n").where(~F.col("doc").eqNullSafe(F.col("last")))
        return lost.groupBy("doc").agg(F.collect_list("k1").alias("d1"), F.collect_list("k2").alias("d2"))


def build(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", least: int = 40, batches: int = 2, keys_a_shard: int = 500_000) -> LineIndex:
    """An index of all documents, inserted in batches (by id hash)."""
    rows = materialize(postings(docs, id_col=id_col, text=text, least=least), "line-postings")
    shards = max(16, -(-rows.count() // keys_a_shard))
    index = LineIndex.empty(rows, shards, keys_a_shard)
    for k in range(batches):
        part = rows if batches == 1 else rows.where(F.pmod(F.xxhash64("doc"), F.lit(batches)) == k)
        index = index.insert(part, fresh=True)
    return replace(index, postings=rows)


def dedup_lines(docs: DataFrame, index: LineIndex, *, id_col: str = "doc_id", text: str = "text", least: int = 40, min_docs: int = 5, keep: list[str] | None = None, out_text: str = "text") -> DataFrame:
    """Documents without the lines that at least `min_docs` documents of the index hold.

    A line of at least `least` code points (stripped of blanks, A-Z lower-cased) stays in the largest id that
    holds it only. Adds n_lines, n_dropped and the kept text as `out_text`. A null or empty text is one empty
    line and stays as it is ('' for null). Rows that share an id count as one document and lose the same
    lines; null ids are one document, smaller than any other. An empty table gives an empty result. Texts and lines are
    read whole, however long; kept columns called like results are replaced.
    """
    doomed = index.doomed(min_docs)
    keep = docs.columns if keep is None else keep
    names = [c for c in dict.fromkeys([*keep, text])]
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col(f"`{id_col}`").alias("doc_"))
    rows = rows.join(doomed, F.col("doc_").eqNullSafe(F.col("doc")), "left")

    def make():
        def of(texts: Texts, d1: pa.Array, d2: pa.Array) -> list[pa.Array]:
            kept, lines, dropped = [], [], []
            for i in range(texts.n):
                raw = texts.bytes(i)
                if not d1[i].is_valid:
                    kept.append(raw)
                    lines.append(raw.count(b"\n") + 1)
                    dropped.append(0)
                    continue
                bad = {((a & (2**64 - 1)) << 64) | (b & (2**64 - 1)) for a, b in zip(d1[i].as_py(), d2[i].as_py(), strict=True)}
                own = _line_keys(raw, least)
                stay = [line for line, k in own if k not in bad]
                kept.append(b"\n".join(stay))
                lines.append(len(own))
                dropped.append(len(own) - len(stay))
            return [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]

        return of

    at = names.index(text)
    out = map_text(rows, f"c{at}", make, [("n_lines", "long"), ("n_dropped", "long"), ("kept_", "string")], keep=[f"c{i}" for i in range(len(names)) if names[i] in keep], args=["d1", "d2"])
    inner = [c for c in keep if c not in ("n_lines", "n_dropped", out_text)]
    return out.select(*(F.col(f"c{names.index(c)}").alias(c) for c in inner), "n_lines", "n_dropped", F.col("kept_").alias(out_text))

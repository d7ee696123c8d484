"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are normalised to words joined by single spaces, and each window of item words becomes one byte pattern
with a space at either end. For each class of pattern lengths, a block shift table says how far a position can
be skipped, a suffix-hash table which patterns to test where the shift is zero, and a direct comparison
confirms an occurrence. The scan walks thousands of places of a text block in step (one array operation for
all of them), so it stays vectorised although each place skips at its own pace.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm.util import Texts, lists, map_text, materialize

_LOWER = np.full(256, 0x20, np.uint8)
for _c in range(256):
    if 0x30 <= _c <= 0x39 or 0x61 <= _c <= 0x7A or _c >= 0x80:
        _LOWER[_c] = _c
    elif 0x41 <= _c <= 0x5A:
        _LOWER[_c] = _c + 32
_BREAK = 0x0A


def normalise(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buffer, starts): texts as '\\n w1 w2 ... ', and where each begins. Bytes outside words separate them."""
    raw = np.frombuffer(b"".join(x for t in texts for x in (b"\n ", t, b" ")), np.uint8)
    sizes = np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts))
    at = np.cumsum(sizes) - sizes
    out = _LOWER[raw]
    word = out != 0x20
    keep = word.copy()
    keep[1:] |= word[:-1]
    out[at] = _BREAK
    keep[at] = keep[at + 1] = True
    index = np.cumsum(keep) - 1
    return out[keep], index[at]


@dataclass
class WuManber:
    """Patterns of one class of lengths: shift table, suffix-hash buckets, and where each pattern stands in the items' text.

    All arrays: they are made once, on the driver, and sent to the tasks as they are.
    """

    start: np.ndarray  # of each pattern in the text of all items
    lengths: np.ndarray
    n_words: np.ndarray
    owner_from: np.ndarray  # the items of pattern p are owners[owner_from[p] : owner_from[p + 1]]
    owners: np.ndarray
    m: int = 0
    block: int = 0
    bits: int = 0
    shift: np.ndarray | None = None
    bucket: np.ndarray | None = None
    members: np.ndarray | None = None
    head: np.ndarray | None = None

    def index(self, text: np.ndarray) -> "WuManber":
        """Build the tables from the items' text."""
        self.m = int(self.lengths.min())
        self.block = min(8, self.m)
        self.bits = min(20, max(14, int(len(self.start) * 64).bit_length()))
        # a shorter shift than possible is right too: one byte each
        self.shift = np.full(1 << self.bits, min(255, self.m - self.block + 1), np.uint8)
        words = _eights(text)
        self.head = words[self.start] & self._mask
        last = None
        for j in range(self.block, self.m + 1):
            last = self._hash(words[self.start + j - self.block])
            if self.m - j < 255:
                np.minimum.at(self.shift, last, np.uint8(self.m - j))
        order = np.argsort(last, kind="stable")
        self.bucket, self.members = last[order].astype(np.int32), order.astype(np.int32)
        return self

    @property
    def _mask(self) -> np.uint64:
        return np.uint64((1 << (8 * self.block)) - 1)

    def _hash(self, words: np.ndarray) -> np.ndarray:
        return (((words & self._mask) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, buffer: np.ndarray, items: bytes, lane: int = 192) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, start) of all occurrences; buffer is a block of normalised texts, items the text of all items."""
        n = len(buffer)
        if n < self.m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        words = _eights(buffer)
        at = np.arange(self.m, n + 1, lane, dtype=np.int64)  # one past the end of the block
        end = np.minimum(at + lane, n + 1)
        spots = []
        while len(at):
            jump = self.shift[self._hash(words[at - self.block])].astype(np.int64)
            if len(zero := at[jump == 0]):
                spots.append(zero)
            at = at + np.maximum(jump, 1)
            going = at < end
            at, end = at[going], end[going]
        if not spots:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spot = np.concatenate(spots)
        h = self._hash(words[spot - self.block])
        low, high = np.searchsorted(self.bucket, h, "left"), np.searchsorted(self.bucket, h, "right")
        many = high - low
        start = np.repeat(spot - self.m, many)
        member = self.members[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        good = ((words[start] & self._mask) == self.head[member]) & (start + self.lengths[member] <= n)
        start, member = start[good], member[good]
        if len(start):
            flat = buffer.tobytes()
            same = np.fromiter((flat[s : s + z] == items[p : p + z] for s, p, z in zip(start.tolist(), self.start[member].tolist(), self.lengths[member].tolist(), strict=True)), bool, len(start))
            start, member = start[same], member[same]
        return member, start


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number (zeros over the end), without a copy for each."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))


class Matcher:
    """Windows of all items, by class of length (powers of two), each class with tables of its own."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        text, starts = normalise([(t or "").encode("utf-8") for _, t in items]) if items else (np.zeros(0, np.uint8), np.zeros(0, np.int64))
        self.items, self.names, self.classes = text.tobytes(), [i for i, _ in items], []
        blank = text == 0x20
        word = np.flatnonzero(np.append(False, blank[:-1] & ~blank[1:] & (text[1:] != _BREAK))) if len(text) else np.zeros(0, np.int64)
        blanks = np.flatnonzero(blank)
        after = blanks[np.searchsorted(blanks, word)]  # the blank behind each word
        item = np.searchsorted(starts, word, "right") - 1
        count = np.bincount(item, minlength=len(items))
        some = np.flatnonzero(count)
        windows = np.maximum(count[some] - window + 1, 1)
        own = np.repeat(some, windows)
        first = np.repeat((np.cumsum(count) - count)[some], windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        size = np.minimum(count[own], window)
        at, end = word[first] - 1, after[first + size - 1] + 1
        if not len(at):
            return
        digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(self.items[a:z]) for a, z in zip(at.tolist(), end.tolist(), strict=True)), np.uint64).reshape(-1, 2)
        # equal windows are one pattern of several items
        order = np.lexsort((own, digest[:, 1], digest[:, 0]))
        digest, own, at, length, size = digest[order], own[order], at[order], (end - at)[order], size[order]
        new = np.append(True, (digest[1:] != digest[:-1]).any(1))
        pattern = np.cumsum(new) - 1
        pair = new | np.append(True, own[1:] != own[:-1])
        pattern_of, owner = pattern[pair], own[pair]
        begin = np.append(np.flatnonzero(np.append(True, pattern_of[1:] != pattern_of[:-1])), len(pattern_of))
        at, length, size = at[new], length[new], size[new]
        kind = np.frexp(length.astype(float))[1]
        for k in np.unique(kind):
            one = np.flatnonzero(kind == k)
            many = begin[one + 1] - begin[one]
            owners = owner[np.repeat(begin[one] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            table = WuManber(at[one], length[one].astype(np.int32), size[one].astype(np.int32), np.append(0, np.cumsum(many)).astype(np.int32), owners.astype(np.int32))
            self.classes.append(table.index(text))

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[str]], list[list[tuple[int, int]]]]:
        """For each text: its words, its hit words, the items that occur, and the hit runs (first word, one past the last)."""
        buffer, starts = normalise(texts)
        first = np.zeros(len(buffer) + 1, bool)
        first[1:-1] = (buffer[:-1] == 0x20) & (buffer[1:] != 0x20) & (buffer[1:] != _BREAK)
        upto = np.cumsum(first)  # word starts at or before each byte
        base = upto[starts]
        ends = np.append(starts[1:], len(buffer))
        n_words = upto[ends] - base
        change = np.zeros(int(upto[-1]) + 2, np.int64)
        found: list[set[str]] = [set() for _ in texts]
        for table in self.classes:
            pattern, start = table.find(buffer, self.items)
            if not len(start):
                continue
            word = upto[start]  # index of the first word: as many start before it
            np.add.at(change, word, 1)
            np.add.at(change, word + table.n_words[pattern], -1)
            doc = np.searchsorted(starts, start, "right") - 1
            for d, p in set(zip(doc.tolist(), pattern.tolist(), strict=True)):
                own = table.owners[table.owner_from[p] : table.owner_from[p + 1]].tolist()
                found[d].update(self.names[i] for i in own if self.names[i] is not None)
        hit = np.cumsum(change)[:-1] > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = total[base + n_words] - total[base]
        runs: list[list[tuple[int, int]]] = []
        for d in range(len(texts)):
            if not n_hit[d]:
                runs.append([])
                continue
            own = np.diff(np.concatenate([[0], hit[base[d] : base[d] + n_words[d]].astype(np.int8), [0]]))
            runs.append(list(zip(np.flatnonzero(own == 1).tolist(), np.flatnonzero(own == -1).tolist(), strict=True)))
        return n_words, n_hit, [sorted(x) for x in found], runs


FIELDS = [("n_words", "long"), ("n_hit", "long"), ("items", "array<string>"), ("hit_from", "array<int>"), ("hit_to", "array<int>")]


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, keep: list[str] | None = None, most_bytes: int = 8 << 20) -> DataFrame:
    """Words of each document that lie in windows of benchmark items.

    Adds n_words, n_hit, items (ids of the items with occurring windows, sorted as strings), hit_from and
    hit_to (runs of hit words). Items of fewer than `window` words are one window; items without words or
    with null text have none; windows of an item with null id hit words but name no item; repeated items
    count once. Null or empty texts have no words. An empty benchmark hits nothing.

    Repeated rows get the same result. The benchmark is read in parts of at most `most_bytes` of text (its size is
    summed first). The driver builds the tables of a part once, as arrays of at most about forty bytes a word, and
    sends those; a larger benchmark takes several scans whose hit runs are merged by row. A text is read as a whole: memory
    is a few times that of the longest one. Kept columns called like results are replaced.
    """
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{item_text}`"))), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) // most_bytes))
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").cast("string").alias("t")).distinct()
    columns = list(docs.columns if keep is None else keep)
    spark = docs.sparkSession

    def scan(rows: DataFrame, column: str, k: int, kept: list[str]) -> DataFrame:
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k)
        sent = spark.sparkContext.broadcast(Matcher([(r.i, r.t) for r in own.collect()], window))

        def make():
            matcher = sent.value

            def of(texts: Texts) -> list[pa.Array]:
                n_words, n_hit, found, runs = matcher.scan([texts.bytes(i) for i in range(texts.n)])
                sizes = [len(r) for r in runs]
                return [
                    pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(found, pa.list_(pa.string())),
                    lists(np.array([a for r in runs for a, _ in r], np.int32), sizes), lists(np.array([b for r in runs for _, b in r], np.int32), sizes),
                ]

            return of

        return map_text(rows, column, make, FIELDS, keep=kept)

    if parts == 1:
        return scan(docs, text, 0, columns)
    names = [c for c in columns if c not in {n for n, _ in FIELDS}]
    base = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col(f"`{text}`").cast("string").alias("t_"))
    base = materialize(base.withColumn("uid", F.monotonically_increasing_id()), "decontam")
    scans = [materialize(scan(base, "t_", k, ["uid"]).where(F.lit(k == 0) | (F.col("n_hit") > 0)), "decontam-part") for k in range(parts)]
    hits = scans[0]
    for one in scans[1:]:
        hits = hits.unionByName(one)
    gather = lambda c: F.flatten(F.collect_list(c)).alias(c)
    merged = hits.groupBy("uid").agg(F.max("n_words").alias("n_words"), gather("items"), gather("hit_from"), gather("hit_to"))
    begins, ends = merged.schema["hit_from"].dataType, merged.schema["hit_to"].dataType

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, low, high = [], [], []
            for a, z in zip(batch.column(3), batch.column(4), strict=True):
                a, z = a.values.to_numpy(), z.values.to_numpy()
                order = np.argsort(a, kind="stable")
                a, z = a[order], np.maximum.accumulate(z[order])
                new = np.append(True, a[1:] > z[:-1]) if len(a) else np.zeros(0, bool)
                low.append(a[new])
                high.append(z[np.append(new[1:], True)] if len(a) else z)
                n_hit.append(int((high[-1] - low[-1]).sum()))
            sizes = [len(x) for x in low]
            none = np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), batch.column(2), lists(np.concatenate([*low, none]), sizes), lists(np.concatenate([*high, none]), sizes)], ["uid", "n_words", "n_hit", "items", "hit_from", "hit_to"])

    merged = merged.withColumn("items", F.array_sort(F.array_distinct("items"))).mapInArrow(join, f"uid long, n_words long, n_hit long, items array<string>, hit_from {begins.simpleString()}, hit_to {ends.simpleString()}")
    return base.join(merged, "uid").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), *(n for n, _ in FIELDS))


def contaminated(hit: str = "n_hit", words: str = "n_words"):
    """At least one hit word in twenty."""
    return (F.col(hit) > 0) & (20 * F.col(hit) >= F.col(words))

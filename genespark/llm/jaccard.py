"""N-gram Jaccard self-join by token-combination prefixes.

Tokens (hashed word n-grams) have a global order: rare ones first, then those of the frequent class, by hash within
each. Two sets of sufficient overlap share a token among the first few of each (the prefix). If the first shared
one is rare, a single-token index finds the pair. Otherwise all shared tokens are frequent, and prefixes that
are longer by c share at least c + 1 of them; frequent tokens are dealt into c cells, so two of those fall into one
cell, and an index of two-token combinations within cells finds the pair. So nothing is indexed under a frequent
token alone. Within each index list, parity bitmaps bound the difference of two sets from below; a spanning forest
of the pairs that this leaves is verified on the texts. Two similar sets are in one tree of a list's forest, which
connects them by links unless one of its own pairs fails. So the trees with a failed pair are joined where they share
sets, and of such a cluster all pairs that are not yet known to be connected are looked at too: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm.graph import components
from genespark.llm.util import Texts, discard, lists, map_text, materialize, mix64, pieces

_BASE = 0x9E3779B97F4A7C15 | 1
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_CELLS = 22
_U = np.uint64


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased), and the number of words of each text."""
    raw = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    if not len(raw):
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    inside = ~_BLANK[raw]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # words of any length by doubling: eight bytes at a time, the rest masked
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view(_U), (len(raw) + 1,), (1,))
    size = end - start
    out = size.astype(_U) * _U(_BASE)
    live, at = np.arange(len(start)), start.copy()
    while len(live):
        left = np.minimum(end[live] - at, 8)
        part = eight[at] & (_U(0xFFFFFFFFFFFFFFFF) >> (_U(8) * (8 - left).astype(_U)))
        out[live] = mix64(out[live] ^ part)
        more = end[live] - at > 8
        live, at = live[more], at[more] + 8
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return out, np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))


def token_lists(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; fewer words than n give one token, none give none."""
    words, counts = _word_hashes(texts)
    grams = mix64(words + _U(1))
    for k in range(1, n):
        ahead = np.concatenate([words[k:], np.zeros(k, _U)])[: len(words)]
        grams = mix64(grams * _U(_BASE) + ahead)
    at = 0
    for c in counts.tolist():
        if c >= n:
            yield np.unique(grams[at : at + c - n + 1])
        elif c:
            yield np.array([xxhash.xxh3_64_intdigest(words[at : at + c].tobytes(), seed=c)], _U)
        else:
            yield np.zeros(0, _U)
        at += c


def frequent_cells(docs: DataFrame, *, text: str, n: int, local: int = 8, least: int = 64) -> np.ndarray:
    """A bitmap over 2^22 cells of token hashes: those that are frequent.

    A task reports cells that it met `local` times; cells that reach `least` over all tasks are frequent. Any
    such function of the token keeps the join exact, it only has to be the same everywhere. A token outside
    the class is met fewer than `local` times in most tasks, which bounds the lists of rare tokens.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << _CELLS, np.int32)
        for part in pieces(batches, 0, 1 << 21):
            texts = Texts(part.column(0))
            words, counts = _word_hashes([texts.bytes(i) for i in range(texts.n)])
            grams = mix64(words + _U(1))
            for k in range(1, n):
                grams = mix64(grams * _U(_BASE) + np.concatenate([words[k:], np.zeros(k, _U)])[: len(words)])
            # n-grams over the end of a text are counted as well: noise that cannot make results wrong
            np.add.at(seen, (grams >> _U(64 - _CELLS)).astype(np.int64), 1)
        at = np.flatnonzero(seen >= local)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["cell", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(count, "cell int, n long")
    return collect_cells(rows.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def collect_cells(cells: DataFrame) -> np.ndarray:
    """The packed bitmap of cells (cell). Tasks pack 64 cells into a word: the driver gets 2^16 rows at most, however many cells there are."""
    bit = F.expr("shiftleft(1L, cell & 63)")
    found = cells.groupBy(F.expr("cell div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << (_CELLS - 6), "<i8")
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return np.packbits(np.unpackbits(words.view(np.uint8), bitorder="little"))


def _ceil_share(n: int, t: int) -> int:
    return (t * n + 99) // 100


def index_keys(tokens: np.ndarray, frequent: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(rare, combined): the index keys of a sorted set at threshold t per cent."""
    n = len(tokens)
    prefix = n - _ceil_share(n, t) + 1
    cell = (tokens >> _U(64 - _CELLS)).astype(np.int64)
    often = (frequent[cell >> 3] >> (7 - (cell & 7)) & 1).astype(bool)
    rare, common = tokens[~often], tokens[often]
    keys = []
    # partners have between t n and n / t tokens: the size class of the larger set is one of these two
    for c in {n.bit_length(), (100 * n // t).bit_length()}:
        cells = max(1, (100 - t) * (1 << (c - 1)) // 100)
        head = common[: max(0, prefix + cells - len(rare))]
        if len(head) < 2:
            continue
        own = (mix64(head + _U(c)) % _U(cells)).astype(np.int64)
        order = np.argsort(own, kind="stable")
        own, head = own[order], head[order]
        for gap in range(1, len(head)):
            same = own[gap:] == own[:-gap]
            if not same.any():
                break
            keys.append(mix64(mix64(head[:-gap][same] + _U(c)) ^ (head[gap:][same] * _U(_BASE))))
    return rare[:prefix], np.concatenate(keys) if keys else np.zeros(0, _U)


def bitmap(tokens: np.ndarray) -> bytes:
    """2 to 4 parity bits a token (512 at least): bit j is the parity of the number of tokens that hash to j."""
    size = max(512, 1 << (2 * len(tokens)).bit_length())
    at = (mix64(tokens ^ _U(0xABCDEF)) & _U(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=size) & 1).astype(bool)).tobytes()


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmaps (rows of 64-bit words) that fewer bits would have given: parities of both halves, again and again."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def profiles(docs: DataFrame, frequent: np.ndarray, *, id_col: str, text: str, n: int, t: int) -> DataFrame:
    """id, size, node (hash of the set, null if empty), bits, rare and combined keys.

    Of documents with the same set, a task gives bits and keys for the first only.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)
    smallest = next(k for k in range(2, 1000) if _ceil_share(k + 1, t) <= k)  # smaller sets only match equal ones

    def make():
        cells, seen = sent.value, set()

        def of(texts: Texts) -> list[pa.Array]:
            size, node, bits, rare, combined = [], [], [], [], []
            none = np.zeros(0, _U)
            for tokens in token_lists([texts.bytes(i) for i in range(texts.n)], n):
                size.append(len(tokens))
                key = xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63) if len(tokens) else None
                node.append(key)
                first = key is not None and key not in seen and len(tokens) >= smallest
                if first:
                    seen.add(key)
                bits.append(bitmap(tokens) if first else None)
                r, c = index_keys(tokens, cells, t) if first else (none, none)
                rare.append(r)
                combined.append(c)
            as_list = lambda parts: lists(np.concatenate([*parts, none]).view(np.int64), [len(p) for p in parts])
            return [pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, pa.binary()), as_list(rare), as_list(combined)]

        return of

    return map_text(docs, text, make, [("size", "long"), ("node", "long"), ("bits", "binary"), ("rare", "array<long>"), ("combined", "array<long>")], keep=[id_col], most_bytes=1 << 20)


def _gather(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got) if got else None


def _parts(rows: DataFrame, each: int) -> int:
    """Partitions for stored rows that a function holds a partition of: by their number, so that none grows with the table."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // each)


def _node_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct sets of two or more nodes under the keys of a partition, which holds all rows (key, node) of its keys."""
    table = _gather(batches)
    if table is None:
        return
    key, node = table.column(0).to_numpy(), table.column(1).to_numpy()
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[fresh], node[fresh]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(start, len(key)))
    seen = {node[a : a + n].tobytes() for a, n in zip(start[size > 1].tolist(), size[size > 1].tolist(), strict=True)}
    sets = [np.frombuffer(x, np.int64) for x in sorted(seen)]
    for at in range(0, len(sets), 5000):
        part = sets[at : at + 5000]
        yield pa.RecordBatch.from_arrays([lists(np.concatenate(part), [len(x) for x in part])], ["nodes"])


def blocks_of(rows: DataFrame, group: str, block: int) -> DataFrame:
    """(gid, across, own, node) from (group, node, n), n rows a group: groups as pairs of blocks of about `block` nodes."""
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other")).alias("gid"), (F.col("blocks") > 1).alias("several"), F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "node").select("gid", (F.col("several") & (F.col("bi") != F.col("bj"))).alias("across"), "own", "node")


def index_lists(rows: DataFrame, block: int = 2000) -> DataFrame:
    """(gid, across, own, node): the nodes that share an index key. Keys with the same nodes count once.

    Lists longer than `block`, of rare tokens or of combinations, are split into pairs of blocks, so no list is one
    task; with across, only pairs of nodes from different blocks (own) count.
    """
    keys = rows.select(F.explode(F.concat("rare", "combined")).alias("key"), "node")
    # most keys are met once: partial counts and one join by key leave the others, with the lengths of their lists
    many = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = materialize(keys.join(many.hint("shuffle_hash"), "key"), "jaccard-keys")
    short = keys.where(F.col("n") <= block).select("key", "node")
    sets = short.repartition(_parts(short, 500_000), "key").mapInArrow(_node_sets, "nodes array<long>").distinct()
    sets = sets.select(F.xxhash64("nodes").alias("gid"), F.lit(False).alias("across"), F.lit(0).alias("own"), F.explode("nodes").alias("node"))
    return sets.unionByName(blocks_of(keys.where(F.col("n") > block).distinct(), "key", block))


class _Bitmaps:
    """Bitmaps of a group's nodes, of different sizes; compared at the smaller size of a pair, or below."""

    def __init__(self, bits: list[bytes], fine: bool):
        self.words = np.array([len(x) // 8 for x in bits])
        # for lists a quarter of the bits tells unrelated sets apart
        self.used = self.words if fine else np.maximum(8, self.words // 4)
        self.bits, self.made = bits, {}

    def at(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all nodes that have `words` or more, folded; and each node's row."""
        if words not in self.made:
            some = np.flatnonzero(self.used >= words)
            row = np.full(len(self.bits), -1)
            row[some] = np.arange(len(some))
            out = np.zeros((len(some), words), _U)
            for w in np.unique(self.words[some]):
                own = some[self.words[some] == w]
                out[row[own]] = fold(np.frombuffer(b"".join(self.bits[i] for i in own), _U).reshape(len(own), w), words)
            self.made[words] = out, row
        return self.made[words]

    def apart(self, i: int, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(j), np.int64)
        common = np.minimum(self.used[i], self.used[j])
        for w in np.unique(common):
            table, row = self.at(int(w))
            own = common == w
            out[own] = np.bitwise_count(table[row[i]] ^ table[row[j[own]]]).sum(1)
        return out


def candidate_pairs(t: int, forest: bool):
    """For partitions of groups with sizes, bitmaps and known roots: pairs (tree, a, b) to verify.

    forest: pairs that join the group's nodes as far as they may be similar; tree tells the parts of a group. Otherwise all pairs that may be similar
    and have different roots, by the full bitmaps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _gather(batches)
        if table is None:
            return
        gid, node, size, root, own = (table.column(c).to_numpy() for c in ("gid", "node", "size", "root", "own"))
        across, bits = table.column("across").to_numpy(zero_copy_only=False), table.column("bits")
        order = np.lexsort((size, gid))
        start = np.flatnonzero(np.append(True, gid[order][1:] != gid[order][:-1]))
        x, y, z_ = [], [], []
        for a, z in zip(start.tolist(), np.append(start[1:], len(order)).tolist(), strict=True):
            at = order[a:z]
            at = at[np.unique(node[at], return_index=True)[1]]
            at = at[np.argsort(size[at], kind="stable")]
            n, group, r, side, apart = size[at], node[at], root[at].copy(), own[at], across[at[0]]
            maps = _Bitmaps([bits[int(i)].as_py() for i in at], not forest)
            # sizes ascend: partners of i end where sizes pass n / t
            stop = np.searchsorted(n, n * 100 // t, "right")
            ends = []
            for i in range(len(at) - 1):
                j = np.arange(i + 1, stop[i])
                j = j[(r[j] != r[i]) & ((side[j] != side[i]) if apart else True)]
                if not len(j):
                    continue
                total = n[i] + n[j]
                overlap = (t * total + 99 + t) // (100 + t)
                j = j[(overlap <= n[i]) & (maps.apart(i, j) <= total - 2 * overlap)]
                if not len(j):
                    continue
                if forest:
                    joined, one = np.unique(r[j], return_index=True)
                    j = j[one]
                    r[np.isin(r, joined)] = r[i]
                x.append(np.full(len(j), group[i]))
                y.append(group[j])
                ends.append(np.full(len(j), i))
            if ends:
                tree = r[np.concatenate(ends)].view(_U)  # by the roots at the end, when the trees are grown
                z_.append(mix64(tree ^ np.array([gid[order[a]]]).view(_U)).view(np.int64))
        if x:
            x, y, z_ = np.concatenate(x), np.concatenate(y), np.concatenate(z_)
            for at in range(0, len(x), 50_000):
                cut = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(z_[cut]), pa.array(np.minimum(x, y)[cut]), pa.array(np.maximum(x, y)[cut])], ["tree", "a", "b"])

    return run


def verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame, *, id_col: str, text: str, n: int, t: int, fan: int = 500) -> DataFrame:
    """(a, b, linked) for each pair, from the texts of one document of each set.

    A pair's texts meet under its first set; one with many partners is dealt into groups of about `fan`, each with a
    copy of its text.
    """
    fans = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / fan).cast("int").alias("salts"))
    children = pairs.join(fans, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("node"))
    parents = fans.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("node"))
    wanted = materialize(children.unionByName(parents).join(reps, "node").select("a", "salt", "node", "rep"), "verify")
    groups = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted.count() // 2000)
    # always dealt by id, at every size: the texts are many times the list of those wanted, which is hashed
    texts = docs.select(F.col(f"`{id_col}`").alias("rep_"), F.col(f"`{text}`").cast("string").alias("t")).join(wanted.hint("shuffle_hash"), F.col("rep_").eqNullSafe(F.col("rep"))).select("t", "a", "salt", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        members: dict[int, set[int]] = {}
        for part in pieces(batches, 0, 1 << 20):
            got = Texts(part.column(0))
            for tokens, a, node in zip(token_lists([got.bytes(i) for i in range(got.n)], n), part.column(1).to_pylist(), part.column(3).to_pylist(), strict=True):
                # rows that share an id may have other texts
                if len(tokens) and xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63) == node:
                    sets.setdefault(node, tokens)
                    members.setdefault(a, set()).add(node)
        out = []
        for a, nodes in members.items():
            x = sets[a]
            for node in sorted(nodes - {a}):
                y = sets[node]
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                out.append((a, node, 100 * both >= t * (len(x) + len(y) - both)))
        if out:
            a, b, linked = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return texts.repartition(groups, "a", "salt").mapInArrow(compare, "a long, b long, linked boolean").distinct()


def join_similar(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", n: int = 4, t: int = 85, block: int = 2000) -> DataFrame:
    """n_shingles and component_id of each document: its group under links of Jaccard similarity of t per cent or more.

    Tokens are word n-grams (words are runs of non-blanks, A-Z lower-cased); fewer words than n are one token.
    component_id is the smallest id reachable over links, its own included. Texts without words (null, empty)
    have n_shingles 0 and are linked with nothing, not even each other. Repeated rows and rows that share an
    id each count as documents; a null id is never the smallest unless its group has no other. Tokens and sets
    are told apart by 64-bit hashes. An empty table gives an empty result. Texts are read whole: a document's set of n-grams is
    held in memory, however long it is. Other columns are not read.
    """
    frequent = frequent_cells(docs, text=text, n=n)
    found = materialize(profiles(docs, frequent, id_col=id_col, text=text, n=n, t=t).withColumnRenamed(id_col, "id_"), "jaccard-profiles")
    nodes = materialize(found.where("node is not null").groupBy("node").agg(F.min("id_").alias("rep"), F.max("size").alias("size"), F.max("bits").alias("bits")), "jaccard-nodes")
    reps = nodes.select("node", "rep")
    listed = materialize(index_lists(found.where("bits is not null").select("node", "rare", "combined"), block), "jaccard-lists")
    groups = _parts(listed, 200_000)
    facts = nodes.where("bits is not null").select("node", "size", "bits")
    shape = "tree long, a long, b long"
    options = {"id_col": id_col, "text": text, "n": n, "t": t}
    first = listed.join(facts, "node").withColumn("root", F.col("node")).repartition(groups, "gid").mapInArrow(candidate_pairs(t, True), shape)
    first = materialize(first, "jaccard-forests")
    done = materialize(verify(first.select("a", "b").distinct(), docs, reps, **options), "jaccard-verified")
    roots = components(done.where("linked"))
    # trees of which a pair failed, joined where they share sets: all their pairs with different roots, each once
    failed = first.join(done.where("not linked").select("a", "b"), ["a", "b"]).select("tree").distinct()
    around = components(first.join(failed, "tree", "left_semi").select("a", "b").distinct()).withColumnRenamed("root", "cluster")
    around = materialize(around.join(around.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), "cluster"), "jaccard-clusters")
    second = blocks_of(around, "cluster", block).join(facts, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    second = second.repartition(_parts(around, 50_000), "gid").mapInArrow(candidate_pairs(t, False), shape).select("a", "b").distinct().join(done, ["a", "b"], "left_anti")
    more = materialize(second, "jaccard-pairs")
    if more.limit(1).count():
        late = materialize(verify(more, docs, reps, **options).where("linked"), "jaccard-verified")
        if late.limit(1).count():
            roots = components(done.where("linked").unionByName(late))
    discard(listed)
    discard(first)
    grouped = nodes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_node = grouped.join(least, "root").select("node", "component_id")
    out = found.select("id_", "size", "node").join(by_node, "node", "left")
    return out.select(F.col("id_").alias(id_col), F.col("size").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("id_")).otherwise(F.col("component_id")).alias("component_id"))

"""The prefix trie of conversations, by chained digests.

A conversation's digest at depth d hashes its digest at depth d - 1 with its d-th turn, so equal digests are equal
prefixes. Every prefix becomes a row; rows that agree in depth and digest are one node. Subtree sums add each node's
own values to all its ancestors. Texts are hashed as they are read; no shuffle carries them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm.util import discard, join_hot, materialize

ROOT = hashlib.sha256(b"").digest()
NODE = ["depth", "digest"]


def turns(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, pos, said, chars): the turns of each conversation in order from 1, with a digest of role and text and the code points of the text.

    Ordered by turn, null first; turns of the same number by their digest, so reruns agree, and repeated rows are turns
    each. Null roles and texts are empty. Rows without a conversation id belong to none and are left out.
    """
    said = [F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")) for x in (role, text)]
    marked = F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said)  # the length tells where the role ends
    rows = conversations.select(F.col(f"`{conv}`").cast("long").alias("c"), F.col(f"`{turn}`").alias("turn"), F.unhex(F.sha2(F.encode(marked, "utf-8"), 256)).alias("said"), F.length(said[1]).cast("long").alias("chars"))
    order = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "said")
    return rows.where("c is not null").select("c", F.row_number().over(order).cast("long").alias("pos"), "said", "chars")


def shared_heads(rows: DataFrame, heads: Column, base: Column, most: int) -> DataFrame:
    """The turns of rebuilt conversations: the first `heads` turns of the conversation `base`, then the own ones after as many.

    `heads` (at most `most`) and `base` are expressions of c. A base without turns gives none. A row with pos 0 stands
    for each conversation itself, so those without turns remain.
    """
    every = rows.where("pos = 1").select("c", heads.alias("heads"), base.alias("base"))
    first = rows.where(F.col("pos") <= most).withColumnRenamed("c", "base")
    lent = every.join(first, "base").where("pos <= heads").select("c", "pos", "said", "chars")
    own = rows.where(F.col("pos") > heads)
    return _with_roots(own.unionByName(lent), every)


def _with_roots(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    return rows.unionByName(conversations.select("c", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("said"), F.lit(0).cast("long").alias("chars")))


def as_they_are(rows: DataFrame) -> DataFrame:
    """Turns as trie() takes them, without any rebuilding."""
    return _with_roots(rows, rows.where("pos = 1"))


def prefixes(rows: DataFrame) -> DataFrame:
    """(c, depth, digest, parent, chars, ends) of every prefix of every conversation; `ends` marks the whole conversation.

    A task walks its conversations turn by turn and holds one digest, however long a conversation is.
    """

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["c", "depth", "digest", "parent", "chars", "ends"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        last: tuple | None = None  # the newest prefix: only the next row tells whether its conversation ends there
        for batch in batches:
            out = []
            for c, said, chars in zip(*(batch.column(x).to_pylist() for x in ("c", "said", "chars")), strict=True):
                if last is not None:
                    out.append((*last, last[0] != c))
                if said is None:
                    last = (c, 0, ROOT, None, 0)
                else:
                    last = (c, last[1] + 1, hashlib.sha256(last[2] + said).digest(), last[2], chars)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)], names)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((*last, True), kinds, strict=True)], names)

    return rows.repartition("c").sortWithinPartitions("c", "pos").mapInArrow(chain, "c long, depth long, digest binary, parent binary, chars long, ends boolean")


def id_digests(ends: DataFrame, block: int = 1 << 16) -> DataFrame:
    """(digest, ends_sha256): SHA-256 of the ids c of each digest in ascending order, in decimals with commas.

    Ids are sorted over all tasks by digest and id, so those of one node may lie in many tasks; each joins them to texts of at
    most `block` ids. A second pass feeds these to the hash in order: a node with n ids is n / `block` rows there, read one
    after the other, as SHA-256 requires.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            out = []
            for digest, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (digest != node or len(ids) == block):
                    out.append((node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = digest
                ids.append(c)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.string()))], ["digest", "least", "ids"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))], pa.string())], ["digest", "least", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for digest, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if digest == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = digest, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], ["digest", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["digest", "ends_sha256"])

    blocks = ends.select("digest", "c").repartitionByRange("digest", "c").sortWithinPartitions("digest", "c").mapInArrow(joined, "digest binary, least long, ids string")
    return blocks.repartition("digest").sortWithinPartitions("digest", "least").mapInArrow(hashed, "digest binary, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """One row for each distinct prefix: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, digest.

    `rows` are turns with a row at position 0 for each conversation (`shared_heads`, `as_they_are`). conv_id is the smallest
    conversation with the prefix; a conversation without turns is a member of the root alone. No conversations: no rows.

    A node belongs to its smallest member. The nodes of one member are the lower end of its path, so what they give to an
    ancestor is a sum along the path: each member sends one row to each of its prefixes, never one for each pair
    of a node and an ancestor, and the sums over members are added up partly in each task.
    """
    paths = materialize(prefixes(rows), "prefixes")
    grouped = paths.groupBy(*NODE).agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"), F.max("chars").alias("chars"), F.max("parent").alias("parent"))
    up = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    so_far = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = grouped.select(
        *NODE, "conv_id", "n_convs", "parent",
        F.sum((F.col("n_convs") - 1) * F.col("chars")).over(so_far).alias("saved"),
        F.max((F.col("n_ends") == F.col("n_convs")).cast("long")).over(so_far).alias("leaves"),
        F.lead("depth").over(up).isNull().alias("top"),
    )
    nodes = materialize(own, "trie-nodes")

    tops = nodes.where("top").select(F.col("conv_id").alias("c"), F.col("depth").alias("from"), "saved", "leaves")
    above = paths.select("c", *NODE).join(tops, "c").where("depth < from").select(*NODE, "saved", "leaves", F.lit(0).cast("long").alias("children"))
    below = nodes.select(*NODE, "saved", "leaves", F.lit(0).cast("long").alias("children"))
    child = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("parent").alias("digest"), F.lit(0).cast("long").alias("saved"), F.lit(0).cast("long").alias("leaves"), F.lit(1).cast("long").alias("children"))
    sums = above.unionByName(below).unionByName(child).groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.sum("children").alias("n_children"))
    whole = materialize(nodes.drop("saved", "leaves").join(sums, NODE), "trie-sums")

    # below the top of its path a node's parent has the same smallest member; only tops look theirs up
    first = whole.where("top and depth > 0").withColumn("above", F.col("depth") - 1)
    parents = whole.where("n_children > 0").select(F.col("depth").alias("p_depth"), F.col("digest").alias("p_digest"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_"))
    looked_up = join_hot(first, parents, {"above": "p_depth", "parent": "p_digest"}, "n_").drop("above")
    rest = whole.where("not top or depth = 0").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    ends = id_digests(paths.where("ends"))
    out = looked_up.unionByName(rest).join(ends, "digest", "left")
    out = materialize(out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "digest"), "trie")
    for used in (paths, nodes, whole):
        discard(used)
    return out

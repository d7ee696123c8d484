"""Exact substring dedup by bucket-pointer refinement over content-chosen suffixes.

A byte goes if a string of `span` bytes that covers it starts anywhere else too. Sorting all suffixes of a
large corpus would shuffle many times its size, so:

1. Every position has an initial bucket, the identifier of its q-gram (built by doubling). The least bucket among
   the q-grams of a window is its anchor. Equal windows have equal anchors, and neighbouring windows mostly
   share theirs, so a text falls into runs of windows with one anchor: about two runs for each span - q + 1 bytes.
2. Runs meet by anchor, with an identifier of their whole content only. Equal runs repeat in full. Runs whose anchor
   is unique do not repeat at all. Only runs that share an anchor but not the content are undecided.
3. The texts of undecided runs (and one of each repeated run beside them) meet by anchor. There, all positions
   start in the bucket of their q-gram, and a round sorts the positions that share a bucket on the bucket pointers
   of the position `depth` later. The new pointers are what the next round reads at its later offsets, so depth
   doubles; positions alone in their bucket keep their pointer and are not sorted again. Window positions that
   share a bucket at depth `span` are repeated.

Anchors met more often than `hot` times are never gathered. Their undecided runs are halved again and again, at the
same distances from the anchor in all runs: blocks of windows that are equal in full are repeated; a block whose
common middle (the bytes that all its windows share) occurs once is not; only the others are halved. Equal blocks are
counted in salted groups first, and one of each goes on, so no group meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm.util import Texts, discard, lists, map_text, materialize, mix64, pieces, release

_U = np.uint64
_C = [(_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)), (_U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)), (_U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3)), (_U(0x589965CC75374CC3), _U(0x1D8E4E27C47D124F)), (_U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53)), (_U(0x94D049BB133111EB), _U(0xBF58476D1CE4E5B9)), (_U(0x2545F4914F6CDD1D), _U(0xD1342543DE82EF95))]
Q = 32


def pair(first: np.ndarray, later: np.ndarray, level: int) -> np.ndarray:
    """Identifier of a bucket that is refined by the identifier at a later offset."""
    a, b = _C[level % len(_C)]
    return mix64(first * a + later * b)


def gram_ids(data: np.ndarray) -> np.ndarray:
    """Identifiers of all 32-grams (64 bits), by doubling; positions over the end are left off."""
    ids = data.astype(_U) + _U(1)
    width = 1
    for level in range(5):
        if len(ids) <= width:
            return np.zeros(0, _U)
        a, b = _C[level]
        ids = ids[:-width] * a + ids[width:] * b
        if width == 4:
            ids = mix64(ids)
        width *= 2
    return mix64(ids)


def span_ids(ids: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Identifiers of the strings of `span` bytes at positions `at`, from 32-gram identifiers."""
    out = ids[at]
    for level, offset in enumerate([*range(Q, span - Q, Q), span - Q]):
        out = pair(out, ids[at + offset], level)
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    n = len(x) - w + 1
    if n <= 0:
        return np.zeros(0, x.dtype)
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


SELF = 1 << 15  # in p: the anchor occurs more than once in the run, which may then repeat within itself


def window_runs(texts: Texts, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, p, anchor, content) of all runs; p is start << 16 | SELF? | windows."""
    data, starts = texts.joined()
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none, none, none.view(_U), none.view(_U)
    ids = gram_ids(data)
    least = sliding_min(ids, span - Q + 1)
    room = np.maximum(texts.lengths - span + 1, 0)  # windows of each text
    doc = np.repeat(np.arange(texts.n), room)
    own = np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room)
    at = own + starts[doc]
    anchor = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    # periodic texts give long runs: cut them
    size = np.diff(np.append(first, len(at)))
    most = span - Q + 1
    if len(size) and size.max() > most:
        parts = -(-size // most)
        first = np.repeat(first, parts) + most * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        size = np.diff(np.append(first, len(at)))
    content = pair(span_ids(ids, at[first], span), span_ids(ids, at[first + size - 1], span), 5) + size.astype(_U)
    head = at[first]
    self_ = np.zeros(len(first), bool)
    for low in range(0, len(first), 4096):
        cut = slice(low, low + 4096)
        reach = np.arange(int(size[cut].max()) + most - 1)
        grams = ids[np.minimum(head[cut, None] + reach, len(ids) - 1)] == anchor[first][cut, None]
        self_[cut] = (grams & (reach < (size[cut] + most - 1)[:, None])).sum(1) > 1
    return doc[first], own[first] << 16 | self_ * SELF | size, anchor[first], content


def _runs(docs: DataFrame, text: str, keep: list[str], span: int) -> DataFrame:
    """keep, row (a number for each row), and the runs of each text as arrays a, s, p."""

    def make():
        context = TaskContext.get()
        state = [context.partitionId() << 36]

        def of(texts: Texts) -> list[pa.Array]:
            doc, p, anchor, content = window_runs(texts, span)
            counts = np.bincount(doc, minlength=texts.n)
            row = np.arange(state[0], state[0] + texts.n)
            state[0] += texts.n
            return [pa.array(row), lists(anchor.view(np.int64), counts), lists(content.view(np.int64), counts), lists(p, counts)]

        return of

    return map_text(docs, text, make, [("row", "long"), ("a", "array<long>"), ("s", "array<long>"), ("p", "array<long>")], keep=keep, most_bytes=1 << 20)


RUN, ASK, ASK_HOT = 0, 1, 2
MASK = ~SELF


def _decide(dealt: DataFrame) -> DataFrame:
    """(a, row, p, what) from (part, a, s, row, p, hot): repeated runs, and the runs whose text is needed.

    Windows over sorted, spillable partitions: the rows of a part are never held as a whole by a function.
    """
    same = Window.partitionBy("part", "s")
    times = F.count(F.lit(1)).over(same)
    first = F.row_number().over(same.orderBy("row", "p")) == 1
    whole = Window.partitionBy("part")
    several = F.min("s").over(whole) != F.max("s").over(whole)  # other contents beside this one
    marked = dealt.select("a", "row", "p", "hot", (times > 1).alias("twice"), first.alias("first"), several.alias("several"))
    ask = F.col("first") & (F.col("several") | F.col("hot") | (~F.col("twice") & (F.col("p").bitwiseAND(F.lit(SELF)) > 0)))
    what = F.filter(F.array(F.when(F.col("twice"), F.lit(RUN)), F.when(ask, F.when(F.col("hot"), F.lit(ASK_HOT)).otherwise(F.lit(ASK)))), lambda x: x.isNotNull())
    return marked.select("a", "row", F.col("p").bitwiseAND(F.lit(MASK)).alias("p"), F.explode(what).alias("what"))


def pieces_of_run(body: bytes, anchor: int, span: int) -> list[tuple[int, int, int]]:
    """(first window, windows, distance of the anchor from it): parts of a run whose windows have the anchor at one place.

    A window's anchor is the leftmost q-gram of that identifier in it.
    """
    grams = np.flatnonzero(gram_ids(np.frombuffer(body, np.uint8)).view(np.int64) == anchor)
    at = grams[np.searchsorted(grams, np.arange(len(body) - span + 1))]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return list(zip(first.tolist(), np.diff(np.append(first, len(at))).tolist(), (at[first] - first).tolist(), strict=True))


def _texts_of_runs(span: int):
    """Rows (text, row, a[], p[], hot[]) to (a, row, start, size, off, body): the bytes of a run, or of a hot run's pieces.

    off is the distance of the anchor from the first window, -1 for runs that are not hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 0, 1 << 20):
            texts = Texts(part.column(0))
            rows = part.column(1).to_pylist()
            out: list[tuple] = []
            for i in range(texts.n):
                text = texts.bytes(i)
                for a, p, hot in zip(part.column(2)[i].as_py(), part.column(3)[i].as_py(), part.column(4)[i].as_py(), strict=True):
                    start, size = p >> 16, p & 0xFFFF
                    body = text[start : start + size + span - 1]
                    if not hot:
                        out.append((a, rows[i], start, size, -1, body))
                        continue
                    out += [(a, rows[i], start + first, n, off, body[first : first + n + span - 1]) for first, n, off in pieces_of_run(body, a, span)]
            for at in range(0, len(out), 20_000):
                cols = zip(*out[at : at + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["a", "row", "start", "size", "off", "body"])

    return run


def _measured(blocks: DataFrame, width: int, span: int) -> DataFrame:
    """Adds u and i: identifiers of a block's whole content and of what all windows at its 2^width distances share.

    Both are within the anchor and the block's place; i depends on the place alone, not on which of its windows the
    run has, so blocks of different runs can be compared.
    """
    most = span - Q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(0, part.num_rows, 4096):
                own = part.slice(at, 4096)
                a, size, off = (own.column(own.schema.get_field_index(c)).to_numpy() for c in ("a", "size", "off"))
                bodies = own.column(own.schema.get_field_index("body")).to_pylist()
                data = np.frombuffer(b"".join(bodies), np.uint8)
                if not len(data):
                    continue
                lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
                head = np.cumsum(lengths) - lengths
                ids = gram_ids(data)
                place = off >> width
                low = place << width
                high = np.minimum(low + (1 << width) - 1, most)
                u = pair(span_ids(ids, head, span), span_ids(ids, head + size - 1, span), 5) + size.astype(_U)
                i = np.zeros(len(a), _U)
                shared = span - (high - low)
                for n in np.unique(shared):  # two lengths at most: only the last place is cut
                    one = shared == n
                    i[one] = span_ids(ids, head[one] + off[one] - low[one], int(n))
                key = pair(a.view(_U), place.astype(_U), width)
                u, i = pair(key, mix64(u ^ off.astype(_U)), 3), pair(key, i, 4)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(u.view(np.int64)), pa.array(i.view(np.int64))], [*own.schema.names, "u", "i"])

    return blocks.mapInArrow(run, "a long, row long, start long, size long, off long, known boolean, body binary, u long, i long")


def _salted_count(rows: DataFrame, key: str, salt: Column, salts: int, keep_first: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rest, heads): rows by key in groups of key and salt; heads, the first of each group, then know whether the key has others.

    heads has `several` (the key occurs more than once) and `lead` (first of its key); in rest the key always does.
    """
    order = [keep_first, "row", "start"] if keep_first is not None else ["row", "start"]
    near = Window.partitionBy(key, "salt")
    one = rows.withColumn("salt", F.pmod(salt, F.lit(salts))).withColumn("n1", F.count(F.lit(1)).over(near)).withColumn("k1", F.row_number().over(near.orderBy(*order)))
    rest = one.where("k1 > 1")
    far = Window.partitionBy(key)
    heads = one.where("k1 = 1").withColumn("n2", F.sum("n1").over(far)).withColumn("k2", F.row_number().over(far.orderBy(*order)))
    return rest, heads.withColumn("several", F.col("n2") > 1).withColumn("lead", F.col("k2") == 1)


def halve(blocks: DataFrame, span: int, salts: int) -> DataFrame | None:
    """(row, p): the repeated windows among hot runs' pieces (a, row, start, size, off, body). None if there are none."""
    names = ["a", "row", "start", "size", "off", "known", "body"]
    live = blocks.select(*names[:5], F.lit(False).alias("known"), "body")
    found = None
    for width in range((span - Q).bit_length(), -1, -1):
        measured = materialize(_measured(live, width, span), "halves")
        # equal blocks: all are repeated, and the first goes on as a witness; one that is known to be repeated comes first
        rest, heads = _salted_count(measured, "u", F.xxhash64("row", "start"), salts, F.col("known").cast("int") * -1)
        heads = materialize(heads, "heads")
        code = F.shiftleft("start", 16).bitwiseOR(F.col("size")).alias("p")
        own = rest.where("not known").select("row", code).unionByName(heads.where("not known and several").select("row", code))
        found = materialize(own if found is None else found.unionByName(own), "loud")
        leads = heads.where("lead").select(*names[:5], (F.col("known") | F.col("several")).alias("known"), "body", "u", "i")
        # what several different blocks share in their middle may repeat in a part: halve those
        rest, heads = _salted_count(leads, "i", F.col("u"), salts)
        live = rest.select(*names).unionByName(heads.where("several").select(*names))
        if not width:
            break
        cut = F.shiftleft(F.shiftright("off", width - 1), width - 1)  # the far half has the distances from here on
        far = F.least("size", F.col("off") - cut + 1)
        body = lambda a, n: F.substring("body", (a + 1).cast("int"), (n + span - 1).cast("int"))
        none = F.lit(0).cast("long")
        halves = F.array(
            F.struct("start", far.alias("size"), "off", body(none, far).alias("body")),
            F.struct((F.col("start") + far).alias("start"), (F.col("size") - far).alias("size"), (F.col("off") - far).alias("off"), body(far, F.col("size") - far).alias("body")),
        )
        live = live.select("a", "row", "known", F.inline(F.filter(halves, lambda h: h["size"] > 0))).select(*names)
        live = materialize(live, "halves")
        if live.limit(1).count() == 0:
            break
    return found


def refine(bodies: np.ndarray, position: np.ndarray, group: np.ndarray, span: int) -> np.ndarray:
    """Which of the window positions have an equal window in their group, by bucket-pointer refinement.

    pointer is each position's bucket: at first that of its q-gram, then a round sorts the positions whose
    bucket has others on (pointer, pointer `step` later) and stores the refined pointers, which the next round reads at
    its own later offsets. Depth doubles up to `span`; the last step overlaps.
    """
    order = np.argsort(grams := gram_ids(bodies), kind="stable")
    pointer = np.empty(len(grams), np.int64)
    pointer[order] = np.cumsum(np.append(0, grams[order][1:] != grams[order][:-1]))
    live, depth = np.arange(len(pointer)), Q
    while depth < span:
        step = min(depth, span - depth)
        # positions whose later offset is over the end have no string of this depth, and stay apart
        live = live[live + step < len(pointer)]
        if not len(live):
            break
        here, later = pointer[live], pointer[live + step]
        order = np.lexsort((later, here))
        here, later, live = here[order], later[order], live[order]
        head = np.append(True, here[1:] != here[:-1])
        new = head | np.append(True, later[1:] != later[:-1])
        # a refined bucket is named by the place of its first member among all that are sorted, above all older names
        name = np.maximum.accumulate(np.where(new, np.arange(len(live)), 0)) + int(pointer.max(initial=0)) + 1
        pointer[live] = name
        alone = new & np.append(new[1:], True)
        live, depth = live[~alone], depth + step
    key = pair(group.astype(_U), pointer[position].astype(_U), 0)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(position), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _refined(span: int, chunk: int = 1 << 20):
    """Rows (a, row, start, body) of whole anchors to repeated runs (row, p)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        a, row, start = (table.column(c).to_numpy() for c in ("a", "row", "start"))
        body = table.column("body").to_pylist()
        del table, got
        order = np.argsort(a, kind="stable")
        sizes = np.array([len(body[i]) for i in order])
        ends = np.append(np.flatnonzero(a[order][1:] != a[order][:-1]) + 1, len(order))  # groups stay whole
        total = np.concatenate([[0], np.cumsum(sizes)])
        low = 0
        while low < len(order):
            high = int(ends[min(np.searchsorted(total[ends], total[low] + chunk), len(ends) - 1)])
            own = order[low:high]
            buffer = np.frombuffer(b"".join(body[i] for i in own), np.uint8)
            length = sizes[low:high]
            windows = length - span + 1
            base = np.repeat(np.cumsum(length) - length, windows)
            within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            hit = refine(buffer, base + within, np.repeat(a[own], windows), span)
            owner = np.repeat(np.arange(len(own)), windows)
            edge = hit.copy()
            edge[1:] &= ~(hit[:-1] & (owner[1:] == owner[:-1]))
            first = np.flatnonzero(edge)
            stop = hit.copy()
            stop[:-1] &= ~(hit[1:] & (owner[1:] == owner[:-1]))
            last = np.flatnonzero(stop)
            if len(first):
                p = (start[own[owner[first]]] + within[first]) << 16 | (last - first + 1)
                yield pa.RecordBatch.from_arrays([pa.array(row[own[owner[first]]]), pa.array(p)], ["row", "p"])
            low = high

    return run


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", span: int = 200, keep: list[str] | None = None, hot: int = 4096, salts: int = 64) -> DataFrame:
    """Removes every byte that is covered by a string of `span` UTF-8 bytes which also starts anywhere else.

    Strings are judged on the input and never cross documents; occurrences in one document and overlapping
    ones count. Adds n_bytes, n_removed, run_from, run_to (the maximal removed runs) and kept (binary, since a
    cut may fall within a character). Null texts are empty; texts shorter than `span` lose nothing; repeated rows
    are copies of each other. Rows are matched by id and text, so ids may be null or repeat. An empty table gives
    an empty result. Strings are told apart by 64-bit identifiers within a 64-bit anchor. Texts are read whole, however long;
    memory is a few times that of the longest one.
    """
    if span < 2 * Q or span > 2**15:
        raise ValueError(f"span must be {2 * Q} to {2**15}")
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    names = list(dict.fromkeys(keep))
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col(f"`{id_col}`").alias("i_"), F.col(f"`{text}`").cast("string").alias("t_"))
    rows = rows.withColumn("h_", F.xxhash64("t_"))
    found = materialize(_runs(rows.select("i_", "h_", "t_"), "t_", ["i_", "h_"], span), "runs")
    named = found.select("row", "i_", "h_")
    runs = found.select("row", F.inline(F.arrays_zip("a", "s", "p")))
    # anchors that are met too often, counted exactly where their sixteen leading bits are
    top = F.shiftrightunsigned("a", 48)
    crowded = materialize(runs.groupBy(top.alias("top")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("top"), "crowded")
    busy = materialize(runs.withColumn("top", top).join(crowded, "top", "left_semi").groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("a", F.lit(True).alias("hot")), "hot")
    dealt = runs.join(busy, "a", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    dealt = dealt.withColumn("part", F.when(F.col("hot"), F.xxhash64("a", "s", F.pmod(F.xxhash64("row", "p"), F.lit(salts)))).otherwise(F.col("a")))
    verdict = materialize(_decide(dealt), "verdict")
    release(spark)
    asks = verdict.where(F.col("what") > RUN).groupBy("row").agg(F.collect_list("a").alias("a"), F.collect_list("p").alias("p"), F.collect_list(F.col("what") == ASK_HOT).alias("hot"))
    asks = materialize(asks.join(named, "row"), "asks")
    joined = rows.select("t_", "i_", "h_").join(asks.select(F.col("i_").alias("j_"), F.col("h_").alias("g_"), "row", "a", "p", "hot"), (F.col("h_") == F.col("g_")) & F.col("i_").eqNullSafe(F.col("j_")))
    bodies = materialize(joined.select("t_", "row", "a", "p", "hot").mapInArrow(_texts_of_runs(span), "a long, row long, start long, size long, off long, body binary"), "bodies")
    release(spark)
    cold = bodies.where("off < 0").select("a", "row", "start", "body")
    size = cold.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size) // (8 << 20))
    late = cold.repartition(parts, "a").mapInArrow(_refined(span), "row long, p long")
    runs_of = verdict.where(F.col("what") == RUN).select("row", "p").unionByName(late)
    if busy.limit(1).count():
        runs_of = runs_of.unionByName(halve(bodies.where("off >= 0"), span, salts))
    runs_of = runs_of.groupBy("row").agg(F.collect_list("p").alias("p"))
    spans = materialize(runs_of.join(named, "row").groupBy("i_", "h_").agg(F.flatten(F.collect_list("p")).alias("p")), "spans")
    discard(found)
    discard(bodies)
    release(spark)

    def make():
        def of(texts: Texts, p: pa.Array) -> list[pa.Array]:
            removed, begin, end, kept, counts = [], [], [], [], []
            for i in range(texts.n):
                body = texts.bytes(i)
                if not p[i].is_valid:
                    removed.append(0), counts.append(0), kept.append(body)
                    continue
                code = p[i].values.to_numpy()
                change = np.zeros(len(body) + 1, np.int64)
                np.add.at(change, code >> 16, 1)
                np.add.at(change, (code >> 16) + (code & 0xFFFF) + span - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                begin.append(np.flatnonzero(edge == 1)), end.append(np.flatnonzero(edge == -1))
                counts.append(len(begin[-1])), removed.append(int(gone.sum()))
                kept.append(np.frombuffer(body, np.uint8)[~gone].tobytes())
            join = lambda x: np.concatenate([*x, np.zeros(0, np.int64)])
            return [pa.array(texts.lengths.astype(np.int64)), pa.array(removed, pa.int64()), lists(join(begin), counts), lists(join(end), counts), pa.array(kept, pa.binary())]

        return of

    new = [("n_bytes", "long"), ("n_removed", "long"), ("run_from", "array<long>"), ("run_to", "array<long>"), ("kept", "binary")]
    last = rows.join(spans.select(F.col("i_").alias("j_"), F.col("h_").alias("g_"), "p"), (F.col("h_") == F.col("g_")) & F.col("i_").eqNullSafe(F.col("j_")), "left")
    out = map_text(last, "t_", make, new, keep=[f"c{i}" for i in range(len(names))], args=["p"])
    taken = {n for n, _ in new}
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in taken), *(n for n, _ in new))

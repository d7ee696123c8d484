"""Comparison of predicted gene models with a reference, for any number of predictions at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.operators.intervals import cut_with_levels, interval_join, levels_of
from genespark.operators.lineage import cut
from genespark.operators.selection import medians

MERGED, FRAGMENT, EXHAUSTIVE = 0.5, 0.5, 8
RECORD = ("level", "classification", "ref_id", "pred_id", "chrom", "strand", "ref_start", "ref_end", "pred_start", "pred_end", "overlap_bp", "sn", "sp", "f1", "boundary_5p", "boundary_3p")


def classify_genes(ref: DataFrame, pred: DataFrame, width: int = 2000) -> DataFrame:
    """One record for each (prediction, reference gene), and one for each novel predicted gene.

    ref: chrom, strand, start, end, id. pred: the same and `prediction` (a label). All labels are classified in one
    pass of windows over the overlaps: merged (a predicted gene covers over half of each of several), fragmented
    (several predicted genes lie by half or more in one), else the best overlap among predicted genes that are
    neither; none: missing. Ties go to the smaller start, then id. A predicted gene without any overlap is novel.
    """
    pred, of_pred = cut_with_levels(pred, width)  # read by the join and for novel genes
    [of_ref] = levels_of(ref, width=width)
    labels = pred.select("prediction").distinct()
    ov = interval_join(ref.select("chrom", "strand", "start", "end", "id"), pred, width=width, prefixes=("r_", "p_"), levels=(of_ref, of_pred))
    # read by the windows and by what decides on novel genes: the join is run once
    ov = cut(ov.select("r_id", "r_start", "r_end", "p_id", "p_start", "p_end", F.col("p_prediction").alias("prediction"), "bp"))
    over_ref, over_pred = F.col("bp") / (F.col("r_end") - F.col("r_start") + 1) > MERGED, F.col("bp") / (F.col("p_end") - F.col("p_start") + 1) >= FRAGMENT
    cover = ov.select("prediction", "r_id", "p_id", "p_start", "p_end", "bp", over_ref.alias("over_ref"), over_pred.alias("over_pred"))
    by_pred, by_ref = Window.partitionBy("prediction", "p_id"), Window.partitionBy("prediction", "r_id")
    step = cover.withColumn("merging", F.count_if("over_ref").over(by_pred) >= 2).withColumn("lone", F.count(F.lit(1)).over(by_pred) == 1)
    step = step.withColumn("merged", F.max(F.col("merging") & F.col("over_ref")).over(by_ref)).withColumn("lone", F.min("lone").over(by_ref))
    step = step.withColumn("fragmented", ~F.col("merged") & (F.count_if("over_pred").over(by_ref) >= 2))
    # where no predicted gene of a reference gene meets another, all is known; the rest is moved by predicted gene once more
    taken = F.col("fragmented") & F.col("over_pred")
    best = F.row_number().over(by_ref.orderBy("excluded", F.desc("bp"), "p_start", "p_id"))
    chosen = step.where("lone").withColumn("excluded", F.col("merging") | taken).withColumn("k", best)
    chosen = chosen.unionByName(step.where("not lone").withColumn("excluded", F.col("merging") | F.max(taken).over(by_pred)).withColumn("k", best))
    chosen = chosen.where("k = 1").select("prediction", "r_id", "merged", "fragmented", "excluded", "p_id", "p_start", "p_end", "bp")
    grid = ref.select("chrom", "strand", "start", "end", "id").join(F.broadcast(labels))  # one row a label: as many as predictions are compared
    rows = grid.join(chosen, (F.col("id") == F.col("r_id")) & chosen.prediction.eqNullSafe(grid.prediction), "left").drop(chosen.prediction)
    kind = F.when(F.col("r_id").isNull(), "missing").when(F.col("merged"), "merged").when(F.col("fragmented"), "fragmented").when(F.col("excluded"), "missing").when((F.col("start") == F.col("p_start")) & (F.col("end") == F.col("p_end")), "exact").otherwise("inexact")
    rows = rows.withColumn("classification", kind).withColumn("hit", F.col("classification").isin("exact", "inexact"))
    hit = lambda c: F.when(F.col("hit"), c)
    sn, sp = F.col("bp") / (F.col("end") - F.col("start") + 1), F.col("bp") / (F.col("p_end") - F.col("p_start") + 1)
    plus = F.col("strand") == "+"
    b5 = F.when(plus, F.col("p_start") - F.col("start")).otherwise(F.col("end") - F.col("p_end"))
    b3 = F.when(plus, F.col("p_end") - F.col("end")).otherwise(F.col("start") - F.col("p_start"))
    found = rows.select(
        "prediction", F.lit("gene").alias("level"), "classification", F.col("id").alias("ref_id"), hit(F.col("p_id")).alias("pred_id"), "chrom", "strand", F.col("start").alias("ref_start"), F.col("end").alias("ref_end"),
        hit(F.col("p_start")).alias("pred_start"), hit(F.col("p_end")).alias("pred_end"), hit(F.col("bp")).alias("overlap_bp"), hit(sn).alias("sn"), hit(sp).alias("sp"), hit(2 * sn * sp / (sn + sp)).alias("f1"), hit(b5).alias("boundary_5p"), hit(b3).alias("boundary_3p"),
    )
    touched = ov.select("prediction", F.col("p_id").alias("id"))
    novel = pred.join(touched, (pred.id == touched.id) & pred.prediction.eqNullSafe(touched.prediction), "left_anti")
    empty = {c: F.lit(None).cast(found.schema[c].dataType).alias(c) for c in RECORD}
    novel = novel.select("prediction", *(F.lit("gene").alias("level") if c == "level" else F.lit("novel").alias(c) if c == "classification" else F.col({"pred_id": "id", "pred_start": "start", "pred_end": "end"}[c]).alias(c) if c.startswith("pred_") else F.col(c) if c in ("chrom", "strand") else empty[c] for c in RECORD))
    return found.unionByName(novel)


def best_assignment(overlap: list[list[int]], exhaustive: bool | None = None) -> list[tuple[int, int]]:
    """Pairs (row, column) of greatest total overlap; pairs without overlap are left out.

    Up to eight rows and columns: the optimum, by dynamic programming over sets of columns, and of several optima
    the first in lexicographic order of the columns taken by each row (of the rows taken by each column, if there
    are more rows). Beyond: greedily by overlap, ties by row, then column.
    """
    n, m = len(overlap), len(overlap[0]) if overlap else 0
    if not (max(n, m) <= EXHAUSTIVE if exhaustive is None else exhaustive):
        out, rows, cols = [], set(), set()
        for _, i, j in sorted((-w, i, j) for i, r in enumerate(overlap) for j, w in enumerate(r) if w > 0):
            if i not in rows and j not in cols:
                out.append((i, j))
                rows.add(i), cols.add(j)
        return out
    if n > m:
        return sorted((i, j) for j, i in best_assignment([list(c) for c in zip(*overlap, strict=True)], True))
    # best[i][used]: greatest total of rows i.. when the columns in `used` are taken
    best = [dict() for _ in range(n + 1)]
    sets = [s for s in range(1 << m)]
    best[n] = {s: 0 for s in sets}
    for i in range(n - 1, -1, -1):
        for s in sets:
            if bin(s).count("1") == i:
                best[i][s] = max(overlap[i][j] + best[i + 1][s | 1 << j] for j in range(m) if not s >> j & 1)
    out, used = [], 0
    for i in range(n):
        j = next(j for j in range(m) if not used >> j & 1 and overlap[i][j] + best[i + 1][used | 1 << j] == best[i][used])
        used |= 1 << j
        out.append((i, j))
    return [(i, j) for i, j in out if overlap[i][j] > 0]


#: So many pairs of lines at most are held against each other at a time in a task.
HELD = 1 << 21
PAIR = ("prediction", "ref_parent", "pred_parent")
LINE = ("id", "chrom", "strand", "start", "end")


def _codes(*columns: pa.Array) -> list[np.ndarray]:
    """Strings as numbers that order them alike, in all columns together; -1 for null."""
    all_ = pa.concat_arrays(columns).dictionary_encode()
    rank = np.empty(len(all_.dictionary) + 1, dtype=np.int64)
    rank[pc.sort_indices(all_.dictionary).to_numpy()] = np.arange(len(all_.dictionary))
    rank[-1] = -1
    found = rank[all_.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)]
    return np.split(found, np.cumsum([len(c) for c in columns])[:-1])


def _same(*keys: np.ndarray) -> np.ndarray:
    """A number for each row: equal for equal keys, growing with them, the first key first."""
    order = np.lexsort(keys[::-1])
    steps = np.zeros(len(order), dtype=np.int64)
    for k in keys:
        steps[1:] |= np.diff(k[order]) != 0
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(steps)
    return out


def _place(row: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How many smaller values of `row` its group has; values belong to one group and grow with it."""
    values, at = np.unique(row, return_inverse=True)
    first = np.full(group.max(initial=0) + 1, len(values))
    np.minimum.at(first, group, at)
    return at - first[group]


def _assigned(pair: np.ndarray, row: np.ndarray, column: np.ndarray, bp: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Which overlaps best_assignment() takes, for many pairs of parents at once: row, column (numbers of lines, in order), bp.

    Where each line of the shorter side overlaps one line more than any other, and these differ, that is the answer. Pairs of two
    lines at most a side are decided by the two sums; what is left goes through best_assignment() pair by pair.
    """
    _, pair = np.unique(pair, return_inverse=True)
    n = pair.max(initial=-1) + 1
    a, b = _place(row, pair), _place(column, pair)
    size = lambda x: np.bincount(np.unique(np.stack([pair, x]), axis=1)[0], minlength=n)
    rows, columns = size(a), size(b)

    def sole(own: np.ndarray, other: np.ndarray, lines: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest overlap of each line of one side, and the pairs where these are the answer."""
        _, line = np.unique(own, return_inverse=True)
        top = np.zeros(line.max(initial=-1) + 1, dtype=np.int64)
        np.maximum.at(top, line, bp)
        best = bp == top[line]
        _, seat = np.unique(other, return_inverse=True)
        clash = np.bincount(seat[best], minlength=seat.max(initial=-1) + 1)[seat] > 1
        tie = np.bincount(line[best], minlength=len(top))[line] > 1
        wrong = np.bincount(pair[best & (clash | tie)], minlength=n) > 0
        return best, ~wrong & (lines <= others)

    by_row, sure_row = sole(row, column, rows, columns)
    by_column, sure_column = sole(column, row, columns, rows)
    taken = np.where(sure_row[pair], by_row, sure_column[pair] & by_column)
    sure = sure_row | sure_column
    two = ~sure & (rows <= 2) & (columns <= 2) & (np.bincount(pair[~small], minlength=n) == 0)
    straight, cross = (np.bincount(pair, weights=np.where((a == b) == same, bp, 0), minlength=n) for same in (True, False))
    taken |= two[pair] & ((a == b) == (straight >= cross)[pair])
    rest = np.flatnonzero(~(sure | two)[pair])
    rest = rest[np.argsort(pair[rest], kind="stable")]
    for own in np.split(rest, np.flatnonzero(np.diff(pair[rest])) + 1) if len(rest) else ():
        k = pair[own[0]]
        table = [[0] * int(columns[k]) for _ in range(rows[k])]
        at = {}
        for x in own.tolist():
            table[a[x]][b[x]] = int(bp[x])
            at[int(a[x]), int(b[x])] = x
        taken[[at[ij] for ij in best_assignment(table, bool(small[own[0]]))]] = True
    return taken


def _matched(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Matches and what is left over on both sides, from one row a pair of parents with lists of their lines."""
    sides, parent = [], []
    for prefix in ("", "p_"):
        lists = {c: batch.column(prefix + c) for c in LINE}
        sides.append({c: x.flatten() for c, x in lists.items()})
        parent.append(pc.list_parent_indices(lists["id"]).to_numpy().astype(np.int64))
    r, p = sides
    times = batch.column("times").to_numpy()
    number = lambda x: x.fill_null(0).to_numpy(zero_copy_only=False)
    place = [_codes(r[c], p[c]) for c in ("chrom", "strand")]
    names = [_codes(x["id"])[0] for x in sides]
    spans = [(number(x["start"]), number(x["end"])) for x in sides]
    whole = [np.logical_and.reduce([x[c].is_valid().to_numpy(zero_copy_only=False) for c in LINE[1:]]) for x in sides]
    line = [_same(g, *span, name) for g, span, name in zip(parent, spans, names, strict=True)]
    count = [np.bincount(g, minlength=len(times)) for g in parent]
    first = np.cumsum(count[1]) - count[1]
    # lines of one side against all of the other side below the same parents, some at a time
    wide = count[1][parent[0]]
    ends = np.cumsum(wide)
    found, begin = [], 0
    while begin < len(wide):
        done = ends[begin] - wide[begin]
        stop = max(begin + 1, int(np.searchsorted(ends, done + HELD, "right")))
        i = np.repeat(np.arange(begin, stop), wide[begin:stop])
        j = first[parent[0][i]] + np.arange(len(i)) - (ends[i] - wide[i] - done)
        bp = np.minimum(spans[0][1][i], spans[1][1][j]) - np.maximum(spans[0][0][i], spans[1][0][j]) + 1
        ok = (bp > 0) & whole[0][i] & whole[1][j]
        for left, right in place:
            ok &= left[i] == right[j]
        found.append((i[ok], j[ok], bp[ok]))
        begin = stop
    i, j, bp = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 3
    # lines that are alike are one
    once = np.sort(np.unique(np.stack([line[0][i], line[1][j]]), axis=1, return_index=True)[1])
    i, j, bp = i[once], j[once], bp[once]
    pair = parent[0][i]
    small = np.maximum(count[0], count[1])[pair] * times[pair] <= EXHAUSTIVE
    taken = _assigned(pair, line[0][i], line[1][j], bp, small)
    i, j, bp = i[taken], j[taken], bp[taken]

    def left_over(k: int, hit: np.ndarray) -> np.ndarray:
        """Lines without a match, by id: those that share one count as matched together."""
        own = _same(parent[k], names[k])
        out = np.flatnonzero(~np.isin(own, own[hit]) | (names[k] < 0))
        return np.repeat(out, times[parent[k][out]])

    lost, extra = left_over(0, i), left_over(1, j)
    nil = lambda n, kind: pa.nulls(n, kind)
    groups = np.concatenate([pair[taken], parent[0][lost], parent[1][extra]])
    at = lambda side, c, rows: side[c].take(pa.array(rows))
    joined = lambda *x: pa.concat_arrays(x)
    kind = joined(*(pa.array([name] * n, pa.string()) for name, n in (("match", len(i)), ("missing", len(lost)), ("fp", len(extra)))))
    out = {c: batch.column(c).take(pa.array(groups)) for c in PAIR} | {"classification": kind}
    out |= {"ref_id": joined(at(r, "id", i), at(r, "id", lost), nil(len(extra), r["id"].type)), "pred_id": joined(at(p, "id", j), nil(len(lost), p["id"].type), at(p, "id", extra))}
    out |= {c: joined(at(r, c, i), at(r, c, lost), at(p, c, extra)) for c in ("chrom", "strand")}
    out |= {f"ref_{c}": joined(at(r, c, i), at(r, c, lost), nil(len(extra), r[c].type)) for c in ("start", "end")}
    out |= {f"pred_{c}": joined(at(p, c, j), nil(len(lost), p[c].type), at(p, c, extra)) for c in ("start", "end")}
    out["overlap_bp"] = joined(pa.array(bp, pa.int64()), nil(len(lost) + len(extra), pa.int64()))
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = _matched(batch)
        for k in range(0, out.num_rows, 10_000):
            yield out.slice(k, 10_000)


def _below(parents: DataFrame, ref: DataFrame, pred: DataFrame) -> DataFrame:
    """A row for each pair of parents: how often it is given (`times`), lists of the reference's lines below it, and of the prediction's (p_...).

    Lines are moved once, by parent, where they become lists; these are stored, and what is moved to meet the other side's.
    """
    def lists(rows: DataFrame, by: list[str], prefix: str) -> DataFrame:
        line = F.struct(F.col("id").cast("string").alias("id"), "chrom", "strand", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
        return rows.where("parent_id is not null").groupBy(*by).agg(F.collect_list(line).alias("x")).select(*(F.col(c).alias(f"{c}_") for c in by), *(F.col(f"x.{c}").alias(prefix + c) for c in LINE))

    pairs = parents.where("ref_parent is not null and pred_parent is not null").repartition("ref_parent").groupBy(*PAIR).agg(F.count(F.lit(1)).alias("times"))
    own = lists(ref, ["parent_id"], "")
    r = cut(pairs.join(own, F.col("ref_parent") == F.col("parent_id_"), "left").select(*PAIR, "times", *LINE))
    p = cut(lists(pred, ["prediction", "parent_id"], "p_"))
    met = (F.col("pred_parent") == F.col("parent_id_")) & F.col("prediction").eqNullSafe(F.col("prediction_"))
    return r.join(p, met, "left").drop("parent_id_", "prediction_")


def _records(level: str, below: DataFrame) -> DataFrame:
    """Records of the lines of _below()."""
    kinds = {c: t for c, t in below.dtypes if c in PAIR}
    spec = [*(f"{c} {t}" for c, t in kinds.items()), "classification string", "ref_id string", "pred_id string", "chrom string", "strand string", *(f"{c} long" for c in RECORD[6:11])]
    whole = below.select(*PAIR, "times", *(prefix + c for prefix in ("", "p_") for c in LINE)).where("id is not null or p_id is not null")
    rows = whole.mapInArrow(_match, ", ".join(spec)).withColumn("level", F.lit(level))
    sn, sp = F.col("overlap_bp") / (F.col("ref_end") - F.col("ref_start") + 1), F.col("overlap_bp") / (F.col("pred_end") - F.col("pred_start") + 1)
    plus, hit = F.col("strand") == "+", F.col("classification") == "match"
    b5 = F.when(plus, F.col("pred_start") - F.col("ref_start")).otherwise(F.col("ref_end") - F.col("pred_end"))
    b3 = F.when(plus, F.col("pred_end") - F.col("ref_end")).otherwise(F.col("ref_start") - F.col("pred_start"))
    more = {"sn": sn, "sp": sp, "f1": 2 * sn * sp / (sn + sp), "boundary_5p": b5, "boundary_3p": b3}
    return rows.select(*PAIR, *RECORD[:11], *(F.when(hit, v).alias(c) for c, v in more.items()))


def match_parts(level: str, parents: DataFrame, ref: DataFrame, pred: DataFrame) -> DataFrame:
    """Records of sub-features whose parents were matched: match, missing, fp.

    parents: prediction, ref_parent, pred_parent. ref, pred: chrom, strand, start, end, id, parent_id (pred also
    prediction). Within a pair of parents, lines are matched as by best_assignment: the optimum if both sides have eight at
    most, else greedily. The lines below one parent are a row; a task holds a batch of these. Missing and fp are decided by id, so
    lines that share an id count as matched together. Lines without a contig, strand, start or end match nothing.
    """
    return _records(level, _below(parents, ref, pred))


def _gaps(below: DataFrame) -> DataFrame:
    """The introns, as hierarchy.introns() makes them, between the lines of _below()."""
    def between(prefix: str, parent: str) -> Column:
        lines = F.arrays_zip(*(F.col(prefix + c).alias(c) for c in ("start", "id", "chrom", "strand", "end")))
        x = F.sort_array(lines)  # by start, then id, nulls first
        gap = lambda v, k: F.struct(F.concat_ws(":", parent, F.lit("intron"), (k + 1).cast("string")).alias("id"), v["chrom"].alias("chrom"), v["strand"].alias("strand"), (v["end"] + 1).alias("start"), (F.get(x, k + 1)["start"] - 1).alias("end"))
        gaps = F.filter(F.transform(x, gap), lambda v: v["end"].isNotNull())
        return F.when(F.col(prefix + "id").isNotNull(), gaps)

    rows = below.select(*PAIR, "times", between("", "ref_parent").alias("r_"), between("p_", "pred_parent").alias("q_"))
    return rows.select(*PAIR, "times", *(F.col(f"r_.{c}").alias(c) for c in LINE), *(F.col(f"q_.{c}").alias(f"p_{c}") for c in LINE))


def compare(ref: dict[str, DataFrame], pred: dict[str, DataFrame], width: int = 2000) -> DataFrame:
    """Records of genes, of mRNAs in matched genes, and of CDS and introns in matched mRNAs.

    ref: genes (chrom, strand, start, end, id), mrnas and cds (also parent_id). pred: the same, each with `prediction`.
    """
    # each level is read by the next and by the union: computed once, and plans don't grow with the levels
    genes = cut(classify_genes(ref["genes"], pred["genes"], width))
    hits = genes.where(F.col("classification").isin("exact", "inexact")).select("prediction", F.col("ref_id").alias("ref_parent"), F.col("pred_id").alias("pred_parent"))
    mrnas = cut(match_parts("mrna", hits, ref["mrnas"], pred["mrnas"]))
    inner = mrnas.where("classification = 'match'").select("prediction", F.col("ref_id").alias("ref_parent"), F.col("pred_id").alias("pred_parent")).distinct()
    below = _below(inner, ref["cds"], pred["cds"])  # introns lie between the same lines: these are moved and stored once
    cds, parts = _records("cds", below), _records("intron", _gaps(below))
    return genes.unionByName(mrnas.drop("ref_parent", "pred_parent")).unionByName(cds.drop("ref_parent", "pred_parent")).unionByName(parts.drop("ref_parent", "pred_parent"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _ratios(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("sensitivity", ratio(F.col("tp"), F.col("tp") + F.col("fn"))).withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp")))
    return rows.withColumn("f1", ratio(2 * F.col("sensitivity") * F.col("precision"), F.col("sensitivity") + F.col("precision")))


def gene_stats(records: DataFrame) -> DataFrame:
    """One row a prediction: counts of classes, tp, fn, fp and ratios, means and medians of matched genes, boundary differences."""
    c = F.col("classification")
    counts = {k: F.count_if(c == k).alias(k) for k in ("exact", "inexact", "missing", "merged", "fragmented", "novel")}
    off = lambda b: F.when(c == "inexact", F.abs(F.col(b)))
    # read by the means, the medians and their keys: records are made once, and what is read of them stored
    rows = cut(records.where("level = 'gene'").select("prediction", "classification", "sn", "sp", "f1", "boundary_5p", "boundary_3p"))
    out = rows.groupBy("prediction").agg(
        *counts.values(), F.coalesce(F.avg("sn"), F.lit(0.0)).alias("mean_sn"), F.coalesce(F.avg("sp"), F.lit(0.0)).alias("mean_sp"), F.coalesce(F.avg("f1"), F.lit(0.0)).alias("mean_f1"),
        F.count_if(F.col("f1") >= 0.99).alias("perfect"), F.avg(off("boundary_5p")).alias("mean_5p"), F.avg(off("boundary_3p")).alias("mean_3p"),
    )
    middle = medians(rows, ["prediction"], {"median_f1": F.col("f1"), "median_5p": off("boundary_5p"), "median_3p": off("boundary_3p")})
    out = out.join(middle.withColumnRenamed("prediction", "p_"), F.col("prediction").eqNullSafe(F.col("p_")), "left").drop("p_")
    out = out.withColumn("tp", F.col("exact") + F.col("inexact")).withColumn("fn", F.col("missing") + F.col("fragmented") + F.col("merged")).withColumn("fp", F.col("novel"))
    return _ratios(out.withColumnRenamed("mean_f1", "mean_gene_f1")).withColumn("ref_total", F.col("tp") + F.col("fn"))


def part_stats(records: DataFrame) -> DataFrame:
    """One row for each (prediction, level) below genes: tp, fn, fp and ratios, over children of matched parents only."""
    c = F.col("classification")
    out = records.where("level <> 'gene'").groupBy("prediction", "level").agg(F.count_if(c == "match").alias("tp"), F.count_if(c == "missing").alias("fn"), F.count_if(c == "fp").alias("fp"), F.coalesce(F.avg("f1"), F.lit(0.0)).alias("mean_part_f1"))
    return _ratios(out)


def f1_by_level(records: DataFrame, labels: Sequence[str]) -> DataFrame:
    """F1 of each level (rows) for each prediction (columns)."""
    c = F.col("classification")
    counts = {"tp": c.isin("exact", "inexact", "match"), "fn": c.isin("missing", "merged", "fragmented"), "fp": c.isin("novel", "fp")}
    rows = _ratios(records.groupBy("prediction", "level").agg(*(F.count_if(x).alias(k) for k, x in counts.items()))).select("prediction", "level", "f1")
    return rows.groupBy("level").pivot("prediction", list(labels)).agg(F.first("f1"))


def agreement(records: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(class, labels, n): how many reference genes got a class from exactly that set of predictions.

    Classes: match (exact or inexact), missing, merged, fragmented; the empty set counts too. Empty below two labels.
    """
    if not labels:
        raise ValueError("no predictions")
    if len(set(labels)) < len(labels):
        raise ValueError("labels must differ")
    genes = records.where("level = 'gene' and classification <> 'novel'")
    if len(labels) < 2:
        genes = genes.where("false")
    kind = F.when(F.col("classification").isin("exact", "inexact"), "match").otherwise(F.col("classification"))
    classes = ("match", "missing", "merged", "fragmented")
    by_ref = genes.groupBy("ref_id").agg(*(F.sort_array(F.collect_set(F.when(kind == k, F.col("prediction")))).alias(k) for k in classes))
    long = by_ref.select(F.explode(F.array(*(F.struct(F.lit(k).alias("class"), F.col(k).alias("labels")) for k in classes))).alias("x")).select("x.class", "x.labels")
    return long.groupBy("class", "labels").agg(F.count(F.lit(1)).alias("n"))


def agreement_buckets(powerset: DataFrame, n_labels: int) -> DataFrame:
    """(class, bucket, n): all, none, unique or other, for many predictions."""
    size = F.size("labels")
    bucket = F.when(size == n_labels, "all").when(size == 0, "none").when(size == 1, "unique").otherwise("other")
    return powerset.groupBy("class", bucket.alias("bucket")).agg(F.sum("n").alias("n"))

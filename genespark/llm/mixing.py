"""Mixing overlapping sources to token quotas by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold them). A flow network
(origin -> pattern, one arc for each repetition at a convex cost -> source -> sink, the quota) routes tokens;
its size depends on the number of patterns and sources only. Each pattern's flow is then realised by whole
documents in seeded order: full repetitions for all, one more for those before a cut. The cut is found from
sums by hash bucket, so only the rows of one bucket a pattern are ever put in order.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm.util import WS, materialize


def word_count(text: str) -> Column:
    """Number of runs of non-blank characters; null: 0."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(f"[^{WS}]+")).cast("long"), F.lit(0).cast("long"))


def spread(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of `total` by weight, none above `most` times its size; the excess is shared again by weight."""
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in sorted(free) if left * weights[i] / weight >= most * sizes[i]] if weight else sorted(free)
        if not over:
            for i in free:
                target[i] = left * weights[i] / weight
            break
        for i in over:
            target[i] = float(most * sizes[i]) if weight else 0.0
        left -= sum(target[i] for i in over)
        free -= set(over)
    return target


def route(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], repeats: int) -> list[list[int]]:
    """Min-cost flow from patterns (their sources, their tokens) to source quotas.

    The k-th repetition of a pattern costs k, so the marginal cost is convex and tokens are repeated only where
    no unused ones reach the quota. Successive shortest paths with potentials (Dijkstra). Returns, for each
    pattern, the tokens sent to each of its sources.
    """
    n_p, n_s = len(patterns), len(quotas)
    origin, sink = n_p + n_s, n_p + n_s + 1
    graph: list[list[int]] = [[] for _ in range(n_p + n_s + 2)]
    head, cap, cost = [], [], []

    def arc(u: int, v: int, c: int, w: int) -> int:
        for a, b, x, y in ((u, v, c, w), (v, u, 0, -w)):
            graph[a].append(len(head))
            head.append(b), cap.append(x), cost.append(y)
        return len(head) - 2

    to = []
    for i, (members, tokens) in enumerate(patterns):
        for k in range(repeats):
            arc(origin, i, int(tokens), k)
        to.append([arc(i, n_p + s, int(tokens) * repeats, 0) for s in members])
    for s, q in enumerate(quotas):
        arc(n_p + s, sink, int(q), 0)
    potential = [0] * len(graph)
    while True:
        dist, via, heap = {origin: 0}, {}, [(0, origin)]
        done = set()
        while heap:
            d, u = heapq.heappop(heap)
            if u in done:
                continue
            done.add(u)
            for e in graph[u]:
                if cap[e] and (nd := d + cost[e] + potential[u] - potential[head[e]]) < dist.get(head[e], 1 << 60):
                    dist[head[e]], via[head[e]] = nd, e
                    heapq.heappush(heap, (nd, head[e]))
        if sink not in dist:
            return [[cap[e ^ 1] for e in arcs] for arcs in to]
        far = max(dist.values())
        potential = [p + dist.get(v, far) for v, p in enumerate(potential)]
        path, v = [], sink
        while v != origin:
            path.append(via[v])
            v = head[via[v] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push


def mix(docs: DataFrame, member: Column, size: Column, *, id_col: str = "doc_id", quotas: dict[str | None, float] | None = None, weights: Sequence[float] = (1,), share: float = 1.0, repeats: int = 2, seed: int = 17, buckets: int = 4096, most_patterns: int = 20_000) -> DataFrame:
    """How often the mix takes each document.

    member: array<string>, the sources that hold the document (null or empty: the source null). size: tokens,
    0 or more. quotas: tokens wanted from each source; if None, `share` of all tokens is spread over the sources
    in code-point order (null last) by repeating `weights`, none above `repeats` times its size.
    Returns id_col, size, source_size and target (those of the first member source), taken (tokens with
    repetitions), copies, sources (the pattern). One row for each input row.

    Each pattern's taken tokens differ from its flow by at most half a document. Rows in the same seeded
    place (repeated rows) are ordered by id and size, so reruns agree. An empty table gives an empty result;
    null ids are kept; documents of size 0 take 0. Patterns and sources are a configuration dimension: more
    than `most_patterns` patterns raise ValueError, since the plan is solved in the driver. Only sizes are read of texts,
    so their length doesn't matter; columns called like results are not carried over.
    """
    spark = docs.sparkSession
    members = F.array_sort(F.array_distinct(F.when(F.size(F.coalesce(member, F.array().cast("array<string>"))) > 0, member).otherwise(F.array(F.lit(None).cast("string")))))
    rows = docs.select(F.col(f"`{id_col}`").alias("i"), F.to_json(members).alias("p"), F.greatest(F.coalesce(size.cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")).alias("z"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "i", "z"))
    rows = materialize(rows.withColumn("b", F.shiftrightunsigned("h", 40) % buckets), "mix")
    by_bucket = materialize(rows.groupBy("p", "b").agg(F.sum("z").alias("z")), "mix-buckets")
    found = by_bucket.groupBy("p").agg(F.sum("z").alias("z")).limit(most_patterns + 1).collect()
    if len(found) > most_patterns:
        raise ValueError(f"more than {most_patterns} membership patterns")
    found = sorted((json.loads(r.p), r.p, r.z) for r in found) if all(None not in json.loads(r.p) for r in found) else sorted(((json.loads(r.p), r.p, r.z) for r in found), key=lambda x: [(s is None, s or "") for s in x[0]])
    # UTF-8 order of strings is code-point order, as Python's
    names = sorted({s for m, _, _ in found for s in m}, key=lambda s: (s is None, s or ""))
    at = {s: k for k, s in enumerate(names)}
    held = [sum(z for m, _, z in found if s in m) for s in names]
    if quotas is None:
        target = spread(held, [weights[k % len(weights)] for k in range(len(names))], share * sum(z for *_, z in found), repeats)
    else:
        target = [float(quotas.get(s, 0.0)) for s in names]
    flows = route([([at[s] for s in m], z) for m, _, z in found], [round(t) for t in target], repeats)
    plan = []
    for (m, p, z), f in zip(found, flows, strict=True):
        full, rest = divmod(sum(f), z) if z else (0, 0)
        plan.append((p, int(full), int(rest), held[at[m[0]]], float(target[at[m[0]]])))
    sheet = spark.createDataFrame(plan, "p string, full long, rest long, source_size long, target double")
    # the bucket in which each pattern's last repetition ends: a window over at most `buckets` sums a pattern
    w = Window.partitionBy("p").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        by_bucket.withColumn("before", F.coalesce(F.sum("z").over(w), F.lit(0).cast("long")))
        .join(F.broadcast(sheet), "p")
        .where("before <= rest and rest < before + z")
        .select("p", F.col("b").alias("cut"), (F.col("rest") - F.col("before")).alias("part"))
    )
    sheet = F.broadcast(sheet.join(cuts, "p", "left"))  # one row a pattern, at most most_patterns
    rows = rows.join(sheet, "p")
    inside = Window.partitionBy("p").orderBy("h", "i", "z").rowsBetween(Window.unboundedPreceding, -1)
    at_cut = rows.where("b = cut").withColumn("before", F.coalesce(F.sum("z").over(inside), F.lit(0).cast("long"))).withColumn("more", (F.col("before") + F.col("z") / 2 < F.col("part")).cast("long"))
    clear = rows.where("cut is null or b <> cut").withColumn("more", F.coalesce((F.col("b") < F.col("cut")).cast("long"), F.lit(0).cast("long")))
    out = at_cut.drop("before").unionByName(clear)
    copies = F.col("full") + F.col("more")
    return out.select(F.col("i").alias(id_col), F.col("z").alias("size"), "source_size", "target", (copies * F.col("z")).alias("taken"), copies.alias("copies"), F.col("p").alias("sources"))

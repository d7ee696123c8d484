"""Contigs cut into tiles, so that a join moves the tiles that are asked for and no contig is one row of a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = 65_536


def tiled(contigs: DataFrame, size: int = TILE, over: int = 1, name: str = "chrom") -> DataFrame:
    """(chrom, tile, n, piece): bases from tile * size + 1 on, and the first `over` (`size` at most) of what follows; n is the contig's length.

    contigs: chrom, seq; rows that are tiles already (tile, n, piece) are passed on. An empty or null sequence has one empty tile.
    """
    if "piece" in contigs.columns:
        return contigs.select(name, "n", "tile", "piece")
    rows = contigs.select(name, F.coalesce("seq", F.lit("")).alias("_seq"))
    parts = F.when(F.col("_seq") == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all("_seq", F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))
    # the sequence is left behind with its parts: each further use would work it out again
    rows = rows.select(name, parts.alias("_p"))
    n = (F.size("_p").cast("long") - 1) * size + F.length(F.get("_p", F.size("_p") - 1))
    joined = F.transform("_p", lambda p, i: F.concat(p, F.substring(F.coalesce(F.get("_p", i + 1), F.lit("")), 1, over))) if over else F.col("_p")
    return rows.select(name, n.alias("n"), F.posexplode(joined).alias("tile", "piece")).select(name, "n", F.col("tile").cast("long").alias("tile"), "piece")


def entering(rows: DataFrame, keys: list[str], order: str, step: Column, states: int, block: int = 1024) -> DataFrame:
    """(keys, order, state): the state from 0 to `states` - 1 in which a walk along each key's rows comes to a row; it begins in 0.

    `step` is an array: a row turns state s into step[s]. Steps are functions, so those of a block of rows combine into one
    before it is known in which state the block is entered: a first pass combines each block, a second walks along the
    blocks, a third along the rows of each. No array is longer than a block or than the blocks of a key.
    """
    listed = rows.select(*keys, F.col(order).alias("at_"), step.cast("array<int>").alias("step_"), F.expr(f"`{order}` div {block}").alias("block_"))
    blocks = listed.groupBy(*keys, "block_").agg(F.sort_array(F.collect_list(F.struct("at_", "step_"))).alias("rows_"))
    same = F.array(*(F.lit(s) for s in range(states)))
    blocks = blocks.withColumn("all_", F.reduce("rows_", same, lambda acc, x: F.transform(acc, lambda s: F.get(x["step_"], s))))

    def walk(steps: Column, name: str, first: Column) -> Column:
        """An array with the state before each step."""
        none = F.array().cast("array<int>")
        return F.reduce(steps, F.struct(first.alias("now"), none.alias("seen")), lambda acc, x: F.struct(F.get(x[name], acc["now"]).alias("now"), F.array_append(acc["seen"], acc["now"]).alias("seen")), lambda acc: acc["seen"])

    whole = blocks.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("block_", "all_"))).alias("b_"))
    begun = whole.select(*keys, F.explode(F.zip_with("b_", walk(F.col("b_"), "all_", F.lit(0)), lambda b, s: F.struct(b["block_"].alias("block_"), s.alias("first_")))).alias("x")).select(*keys, "x.block_", "x.first_")
    rows = blocks.select(*keys, "block_", "rows_").join(begun, [*keys, "block_"])
    out = F.zip_with("rows_", walk(F.col("rows_"), "step_", F.col("first_")), lambda r, s: F.struct(r["at_"].alias("at"), s.alias("state")))
    return rows.select(*keys, F.explode(out).alias("x")).select(*keys, F.col("x.at").alias(order), F.col("x.state").alias("state"))

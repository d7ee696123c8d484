"""Exact selection by rank: medians of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.operators.lineage import cut

CELLS = 1024


def select_ranks(rows: DataFrame, wanted: DataFrame, keys: list[str], cells: int = CELLS) -> DataFrame:
    """(keys, rank, value): the value of each wanted rank (from 1) among the key's values in ascending order.

    rows: keys, value (double, not null). wanted: keys, rank, low and high, the least and the greatest value of the key. Keys
    are not null. Each round counts the values between low and high in `cells` equal cells, finds the cell that has the rank,
    and goes on with the least and the greatest value in it, until these are the same. A round reads the rows once, and
    adds up at most `cells` rows a key and rank; no key's values are ever sorted or gathered.
    """
    on = [*keys, "rank"]
    now = wanted.withColumn("left", F.col("rank"))
    ready = None
    while True:
        now = cut(now.select(*on, "left", "low", "high"))
        found = now.where("low = high").select(*on, F.col("low").alias("value"))
        ready = found if ready is None else ready.unionByName(found)
        open_ = now.where("low < high")
        if not open_.limit(1).count():
            return ready
        v, low, span = F.col("value"), F.col("low"), F.col("high") - F.col("low")
        # the span of two doubles may be none: then halves
        part = F.when(span < float("inf"), (v - low) / span).otherwise((v / 2 - low / 2) / (F.col("high") / 2 - low / 2))
        cell = F.least(F.floor(part * cells), F.lit(cells - 1).cast("long"))
        met = rows.join(open_, keys).where("value between low and high").withColumn("cell", cell)
        counts = met.groupBy(*on, "cell").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.first("left").alias("left"))
        upto = Window.partitionBy(*on).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("sum_", F.sum("n").over(upto)).where("sum_ - n < left and left <= sum_")
        now = counts.withColumn("left", F.col("left") - (F.col("sum_") - F.col("n")))


def medians(rows: DataFrame, keys: list[str], columns: dict[str, Column], cells: int = CELLS) -> DataFrame:
    """(keys, a column for each of `columns`): exact medians as doubles, null where a key has no values.

    Nulls are passed over, null keys are keys, NaN and infinite values are errors of the caller. Of an even number of values the two in
    the middle count half each. One round of select_ranks serves all columns and keys.
    """
    key = F.struct(*keys)
    pairs = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), c.cast("double").alias("value")) for name, c in columns.items())))
    long = cut(rows.select(key.alias("of"), pairs.alias("x")).select("of", "x.name", "x.value").where("value is not null"))
    facts = cut(long.groupBy("of", "name").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")))
    ranks = facts.select("of", "name", "low", "high", F.explode(F.array_distinct(F.array(F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")))).alias("rank"))
    both = select_ranks(long, ranks, ["of", "name"], cells).groupBy("of", "name").agg((F.min("value") * 0.5 + F.max("value") * 0.5).alias("m"))
    every = rows.select(key.alias("of")).distinct()
    out = both.groupBy("of").pivot("name", list(columns)).agg(F.first("m"))
    return every.join(out, "of", "left").select(*(F.col(f"of.{k}").alias(k) for k in keys), *columns)

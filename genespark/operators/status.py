"""States of steps, databases and tool logs as small aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def step_status(steps: DataFrame, by: str = "prefix") -> DataFrame:
    """(by, status) of steps (by, status): failed before running; completed if all are; running otherwise."""
    state = F.col("status")
    any_of = lambda s: F.bool_or(state.eqNullSafe(F.lit(s)))
    out = F.when(any_of("failed"), "failed").when(any_of("running"), "running").when(F.bool_and(state.eqNullSafe(F.lit("completed"))), "completed").otherwise("running")
    return steps.groupBy(by).agg(out.alias("status"))


def status_of(steps: DataFrame, prefix: str) -> DataFrame:
    """(status) of one pipeline; without steps it is pending."""
    found = step_status(steps.where(F.col("prefix") == prefix))
    return found.agg(F.coalesce(F.max("status"), F.lit("pending")).alias("status"))


def database_status(registry: DataFrame, manifest: DataFrame, files: DataFrame, wanted: Column | None = None) -> DataFrame:
    """(name, state, ok): registry (name, file) against manifest (name, md5) and files (file, md5).

    state: missing (no file), unlisted (no manifest entry), ok, or corrupted (another md5). wanted chooses entries.
    """
    rows = registry if wanted is None else registry.where(wanted)
    rows = rows.join(manifest.select("name", F.col("md5").alias("_listed"), F.lit(True).alias("_known")), "name", "left")
    rows = rows.join(files.select("file", F.col("md5").alias("_found"), F.lit(True).alias("_there")), "file", "left")
    state = F.when(F.col("_there").isNull(), "missing").when(F.col("_known").isNull(), "unlisted").when(F.col("_listed") == F.col("_found"), "ok").otherwise("corrupted")
    return rows.select("name", state.alias("state")).withColumn("ok", F.col("state") == "ok")


def counted(rows: DataFrame, what: Column, least: int) -> DataFrame:
    """(n, few): rows for which `what` holds, and whether they are fewer than `least`."""
    n = F.count_if(what)
    return rows.agg(n.alias("n"), (n < least).alias("few"))


def transcripts_counted(rows: DataFrame) -> DataFrame:
    """Headers of a FASTA file (value); fewer than 1000 are few."""
    return counted(rows, F.col("value").startswith(">"), 1000)


def training_counted(rows: DataFrame) -> DataFrame:
    """Records of training files (value); 500 or fewer are few."""
    return counted(rows, F.col("value").startswith("LOCUS"), 501)


def introns_counted(rows: DataFrame) -> DataFrame:
    """Lines of an intron table (value) that are no comments; fewer than 5000 are few."""
    return counted(rows, ~F.col("value").startswith("#"), 5000)


def accessions(rows: DataFrame) -> DataFrame:
    """(accession): the first word of each FASTA header (value)."""
    return rows.where(F.col("value").startswith(">")).select(F.regexp_extract("value", r"^>\s*(\S+)", 1).alias("accession"))


def stop_shares(rows: DataFrame, code: int = 1) -> DataFrame:
    """(k, share): the shares of tag, taa and tga in a training log (line_no, value), in file order; 0, 0, 1 for code 6."""
    if code == 6:
        return rows.sparkSession.createDataFrame([(1, "0"), (2, "0"), (3, "1")], "k int, share string")
    bare = F.trim(F.regexp_replace(F.regexp_replace("value", "[()]", ""), r"\s+", " "))
    found = rows.where(F.col("value").rlike("(tag|taa|tga):"))
    return found.select(F.row_number().over(Window.orderBy("line_no")).alias("k"), F.element_at(F.split(bare, " "), -1).alias("share"))  # a log's few lines


def with_stop_shares(config: DataFrame, shares: DataFrame) -> DataFrame:
    """(line_no, value): a parameter file whose k-th stop-codon line has the k-th share as second word."""
    stop = F.col("value").rlike("amberprob|ochreprob|opalprob")
    numbered = config.where(stop).select(F.col("line_no").alias("_l"), F.row_number().over(Window.orderBy("line_no")).alias("k")).join(F.broadcast(shares), "k")  # three lines
    words = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    changed = F.array_join(F.concat(F.slice(words, 1, 1), F.array("share"), F.slice(words, F.lit(3), F.greatest(F.size(words) - 2, F.lit(0)))), " ")
    rows = config.join(F.broadcast(numbered.select("_l", "share")), F.col("line_no") == F.col("_l"), "left")
    return rows.select("line_no", F.when(F.col("share").isNotNull(), changed).otherwise(F.rtrim("value")).alias("value"))


def intron_distribution(rows: DataFrame) -> DataFrame:
    """(value): the last 'introns' line of a fit (line_no, value): words 4 to the fourth last as %f, without the second."""
    line = rows.where(F.col("value").rlike(r"^introns\s")).agg(F.max_by("value", "line_no").alias("v"))
    words = F.split(F.trim(F.regexp_replace("v", r"\s+", " ")), " ")
    kept = F.slice(words, F.lit(4), F.greatest(F.size(words) - 6, F.lit(0)))
    numbers = F.transform(kept, lambda x: F.format_string("%f", x.cast("double")))
    return line.select(F.coalesce(F.array_join(F.filter(numbers, lambda _, i: i != 1), " "), F.lit("")).alias("value"))


def labels(paths: DataFrame) -> DataFrame:
    """(position, label) of paths (position, path): file stems; those that several share are numbered _1, _2, ... by position."""
    name = F.substring_index("path", "/", -1)
    stem = F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_replace(name, r"\.[^.]+$", "")).otherwise(name)
    own = Window.partitionBy("stem")
    rows = paths.withColumn("stem", stem).withColumn("_n", F.count(F.lit(1)).over(own)).withColumn("_k", F.row_number().over(own.orderBy("position")))
    return rows.select("position", F.when(F.col("_n") > 1, F.concat_ws("_", "stem", F.col("_k").cast("string"))).otherwise(F.col("stem")).alias("label"))


def output_errors(steps: DataFrame, files: DataFrame, valid: DataFrame) -> DataFrame:
    """(step, state): completed steps whose output is missing, empty or unparseable.

    steps: step, status, output (null: none expected); files: path, size; valid: path of the GFF files that parse. Only
    outputs that end in .gff or .gff3 must be in `valid`.
    """
    rows = steps.where("status = 'completed' and output is not null and output <> ''").join(files.select(F.col("path").alias("output"), "size"), "output", "left")
    rows = rows.join(valid.select(F.col("path").alias("output"), F.lit(True).alias("_valid")).distinct(), "output", "left")
    state = F.when(F.col("size").isNull(), "missing").when(F.col("size") == 0, "empty").when(F.col("output").rlike(r"\.gff3?$") & F.col("_valid").isNull(), "unparseable")
    return rows.select("step", state.alias("state")).where("state is not null")

"""Corpus preparation: five stages over `documents`, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genespark.llm import decontam, jaccard, langid, linededup, mixing
from genespark.llm.util import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Stages are statistical (language, mix): there is no SQL for run()'s rows.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.4) -> DataFrame:
    """Rejects documents without letters (or text) and those of which no language makes up `least` of the words.

    Equal texts are judged alike; repeated rows all stay or all go, and each counts in the model. An empty table stays empty.
    """
    model = langid.train(docs)
    out = langid.identify(docs, model, keep=[c for c in docs.columns if c != "score"])
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents hold stay in one; n_chars follows the text.

    Rows that share an id count as one document and lose the same lines; null ids are one document, smaller than any other.
    A null text becomes an empty one. An empty table stays empty.
    """
    out = linededup.dedup_lines(docs, linededup.build(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, the smallest id; documents without words all stay.

    Similar: sets of five words, a Jaccard similarity of 0.8 or more. Of rows that share an id and a text one stays, the first
    by source, lang and n_chars; a null id counts as larger than any other. An empty table stays empty.
    """
    groups = jaccard.join_similar(docs, n=5, t=80)
    chosen = materialize(groups.where((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id_"), (F.col("n_shingles") == 0).alias("bare")), "chosen")
    ids = chosen.groupBy("id_").agg(F.count(F.lit(1)).alias("n"), F.max("bare").alias("bare"))
    # dealt by id at every size: the ids grow with the documents
    out = docs.join(ids.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("id_")), "inner")
    if ids.where("n > 1").limit(1).count():
        # rows that share an id: of those with the same text one stays
        same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang", "n_chars")
        out = out.withColumn("k_", F.row_number().over(same)).where("k_ = 1 or bare")
    return out.select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one word in twenty lies in benchmark windows go; repeated rows alike. Null texts have no words and stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = decontam.find_contamination(docs.select(*COLUMNS), benchmark)
    return out.where(~decontam.contaminated()).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document that is left enters the mix.

    Documents are put in order by a seeded hash of id and size, equal ones by id and size, so reruns agree; repeated rows are
    documents of their own. Without documents there is no row.
    """
    out = mixing.mix(docs, F.array("source"), mixing.word_count("text"), weights=(3, 1, 2), share=1.5, repeats=2)
    return out.select("doc_id", F.get(F.from_json("sources", "array<string>"), 0).alias("source"), "size", "source_size", "target", "taken", "copies")


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

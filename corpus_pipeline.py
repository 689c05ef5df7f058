"""The corpus pipeline: stages that each take (spark, docs, sf_dir) and return a DataFrame.

All but the last return the columns of ``documents``. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketloom.llm import decontaminate, mixing, quality, sharding, simhash
from docketloom.llm.common import crc_mod, free_name, small, staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    kept = free_name(docs.columns, "predicted")
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0, predicted_col=kept)
    return scored.where(F.col(kept) == 1).select(docs.columns)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, written with a number for each row, and the number's name. Decisions are made over the numbers and a few
    narrow columns and come back to the rows by a join, to which the decisions are broadcast while they are small."""
    row = free_name(docs.columns, "row")
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group of near duplicates stays: the one with the least id, null being the last; of rows with
    equal ids, any one. Rows get numbers and are written with them, as ids may be null or repeated."""
    numbered, row = _numbered(docs)
    key = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    marked = simhash.near_duplicates(numbered.select(key.alias("key"), "text"), id_col="key")
    gone = staged(marked.where("key.row != component_id.row").select(F.col("key.row").alias(row)), "near_copies")
    return numbered.join(small(gone), row, "left_anti").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark's windows in a twentieth of their words or more go. Each row goes by its own text: others
    with its id, or without an id like it, stay."""
    found = decontaminate.overlap(docs, table(spark, sf_dir, "benchmark"), key_col="bad_key")
    bad = staged(found.where(decontaminate.contaminated()).select("doc_id", "bad_key").distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["bad_key"])
    return docs.join(small(bad), same, "left_anti").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: a document is left out or comes up to three times."""
    numbered, row = _numbered(docs)
    mixed = mixing.mix(numbered.select(F.col(row).alias("row"), "doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    copies = free_name([*docs.columns, row], "copies")
    taken = small(staged(mixed.where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies)), "copies"))
    return mixing.repeated(numbered.join(taken, row), docs.columns, copies)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets a shard and a place in it."""
    numbered, row = _numbered(docs)
    placed = sharding.shard(numbered.select(F.col(row).alias("row"), "doc_id", "text"), keep=["row"])
    new = {c: free_name([*docs.columns, row], c) for c in ("size", "shard", "slot")}
    placed = small(staged(placed.select(F.col("row").alias(row), *[F.col(c).alias(name) for c, name in new.items()]), "placed"))
    return numbered.join(placed, row).select(*docs.columns, *new.values())


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage{k}")
    return docs


#: The classifier, SimHash and the mixing can't be said in SQL; tests/llm compares the stages with brute force instead.
ORACLE_SQL = None

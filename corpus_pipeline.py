"""A corpus pipeline over ``documents``: each stage calls one operator.

Every stage works on all that the stage before it kept, and all but the last
return the columns of ``documents``.  A row without an id cannot be matched
with others, so only the quality and encoding stages act on it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairo.llm.decontaminate import find_contamination
from kairo.llm.lines import remove_repeated_lines
from kairo.llm.near import near_components
from kairo.llm.pieces import round_trip
from kairo.llm.quality import select_documents
from kairo.llm.queries import prepare, tokenizer_file
from kairo.session import materialize, release

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = (select_documents(docs, labels).filter("selected")
            .select(F.col("doc_id").alias("id"), "text_crc32").distinct())
    crc = F.crc32(F.coalesce("text", F.lit("")))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (crc == F.col("text_crc32")),
                     "left_semi").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Multi-line chunks that occur earlier go, and with them documents of
    which nothing is left."""
    prepare(spark)
    changed = (remove_repeated_lines(docs).filter("n_removed > 0")
               .select("doc_id", "kept").dropDuplicates(["doc_id"]))
    text = F.coalesce("kept", "text")
    return (docs.join(changed, "doc_id", "left")
            .filter("kept IS NULL OR trim(BOTH ' \\t\\r\\n' FROM kept) <> ''")
            .withColumns({"text": text, "n_chars": F.when(F.col("kept").isNotNull(), F.length(text))
                                                    .otherwise(F.col("n_chars")).cast("long")})
            .select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles,
    similarity 0.8 or more; the smallest id)."""
    prepare(spark)
    kept = near_components(docs).filter("kept").select("doc_id")
    known = docs.join(kept, "doc_id", "left_semi")
    return known.unionByName(docs.filter("doc_id IS NULL")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the remaining texts' ids and of their decoding."""
    prepare(spark)
    return round_trip(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Hashed models, signatures and merges have no SQL form; on a small fixture the
#: stages after quality are tested against brute force instead, one on another.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = docs
        docs, _ = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)

"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairo.llm import chat, collocations, sharding, vector_codes
from kairo.llm.decontaminate import find_contamination
from kairo.llm.html_text import extract_text
from kairo.llm.lines import remove_repeated_lines
from kairo.llm.near import near_components
from kairo.llm.pieces import round_trip
from kairo.llm.quality import select_documents
from kairo.llm.simhash import fingerprint_edits
from kairo.llm.suffix import remove_repeats
from kairo.llm.token_counts import count_tokens, sample_edits
from kairo.session import ship_package


#: Bounds of an Arrow batch between the JVM and Python: texts may be long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
         "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m")}


def prepare(spark: SparkSession) -> None:
    """Ship the package and, where the session has Spark's defaults, bound the
    batches of map functions."""
    ship_package(spark)
    for key, (default, ours) in BATCH.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, ours)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where the public vocabulary files lie; queries read the environment's copy.
def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight contiguous shards of near equal bytes; equal texts stay together."""
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the multi-line chunks that occur earlier."""
    return remove_repeated_lines(_table(spark, sf_dir, "documents")).drop("kept")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text before and after three edits."""
    import public_tokenizers
    return count_tokens(_table(spark, sf_dir, "documents"),
                        tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                        sample_edits())


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every text, of its edited text, and their likeness."""
    return fingerprint_edits(_table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of their decoding."""
    return round_trip(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weights and Gumbel top-k selection of all documents."""
    return select_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a window that is 0.8 or more similar to a benchmark item."""
    return find_contamination(_table(spark, sf_dir, "documents"),
                              _table(spark, sf_dir, "benchmark"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls that conversations give, linked, ordered, validated."""
    calls, results = chat.conversation_calls(_table(spark, sf_dir, "conversations"))
    return chat.link_tool_calls(calls, results, chat.TOOLS) \
               .withColumn("problems", F.array_join("problems", "; "))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets overlap by 0.85."""
    return near_components(_table(spark, sf_dir, "documents"), words=3, num=85, den=100)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 100-byte strings that also start earlier, removed."""
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-quantised codes of all vectors, with the errors they leave."""
    return vector_codes.compress_vectors(_table(spark, sf_dir, "embeddings")) \
                       .withColumn("code", vector_codes.code_hex()).drop("label")


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(_table(spark, sf_dir, "pages"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language's 2,000 best phrases of two to four words."""
    return collocations.mine_phrases(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_line_dedup, op3_token_counts, op4_document_fingerprints, op5_sentencepiece,
    op6_quality_classifier, op7_benchmark_decontamination, op8_chat_formatting,
    op9_minhash_near_dedup, op10_suffix_array_dedup, op11_vector_codes,
    op12_html_extraction, op13_collocations,
)}

ORACLE: dict[str, str] = {"op1_sharding": sharding.ORACLE, "op8_chat_formatting": chat.ORACLE,
                          "op11_vector_codes": vector_codes.ORACLE,
                          "op13_collocations": collocations.ORACLE}

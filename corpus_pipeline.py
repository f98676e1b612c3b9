"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again for the next one.  All but the last return the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import decontam, packing, pii, quality, simhash, tokens
from colloquy.llm.common import settle, table, without

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CAPACITY = 2048


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score >= 0.5).  A row is
    scored by its own text; nulls score as empty texts."""
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.scored(docs.select(*COLUMNS), model).filter("score >= 0.5").select(*COLUMNS)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest doc_id
    (null ids last), then text hash.  Rows are told apart by id and text, so a
    different text of the same id, or of none, stays."""
    docs = docs.select(*COLUMNS)
    rows = settle(simhash.first_of_components(docs), "groups")
    copies = rows.filter("NOT first").select("doc_id", "text_hash").distinct()
    kept = without(docs.withColumn("text_hash", F.xxhash64("text")), copies, "doc_id", "text_hash").select(*COLUMNS)
    repeated = rows.filter("first").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked as ``[KIND]``; ``n_chars`` follows the new text."""
    docs = docs.select(*COLUMNS)
    out = pii.masked(docs, pii.train(docs))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of packed sequences of at most 2048 ids."""
    pieces = tokens.token_pieces(docs, tokens.tokenizer_path(tokens.WORD_BPE), CAPACITY, end_id=0)
    return packing.pack(pieces, CAPACITY).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_unseen),
    ("personal_data", mask_personal),
    ("packing", pack_sequences),
]

# The stages hold trained models, 64-bit hashes of shingles and a tokenizer,
# which SQL cannot express; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}

"""From raw documents to token ids, in five stored stages.

Quality filter, near-duplicate removal, personal data, source mix, BPE. Every stage takes what its
predecessor kept, as read back from Parquet, and all but the last give the columns of documents.
Each stage accepts nulls, empty texts, repeated rows and empty tables as its operator does.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremere.llm import bpe, mix, minhash, pii, quality
from wiremere.session import remove, run_folder, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject: every row by its own text, with or without doc_id."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = quality.classify(docs, labels, hashed=True).filter("predicted = 0")
    rejected = rejected.select(F.col("doc_id").alias("id"), "text_hash").distinct()
    docs = docs.select(COLUMNS)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("text_hash"))
    return docs.join(rejected, same, "left_anti").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; of equal rows one.

    Every row goes by its own text: different texts of one doc_id all stay. Rows that differ in other
    columns only are one document, and the least of them stays. Rows without doc_id belong to no group and
    stay.
    """
    stays = minhash.near_duplicates(docs, rows=True).filter("stays and doc_id is not null")
    stays = stays.select(F.col("doc_id").alias("id"), "text_hash").distinct()
    docs = docs.select(COLUMNS)
    same = [F.col("doc_id").cast("long") == F.col("id"), F.xxhash64(F.col("text").cast("string")) == F.col("text_hash")]
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    groups = docs.join(stays, same).groupBy("id", "text_hash").agg(F.min(F.struct("doc_id", *rest, "text")).alias("row"))
    return groups.select("row.*").select(COLUMNS).unionByName(docs.filter("doc_id is null"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every span of personal data replaced by its kind."""
    found = pii.find(docs.select(COLUMNS), redacted=True)
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out to meet the sources' target weights."""
    return mix.mixed(docs.select(COLUMNS))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with the digests of ids and decoded text."""
    coded = bpe.encode(docs.select(COLUMNS), decoded=True)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
    ("bpe", encode_texts),
]

# SQL cannot express the first three stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each stored before the next one starts.

    What a stage has stored for itself goes when its result is written, and its input, if another stage's
    result, goes with it. Only the last result stays.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        with run_folder(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs

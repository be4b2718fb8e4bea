"""Registered queries of this subpackage, and DuckDB checks where SQL can express the result."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremere.llm import alignment, bpe, clusters, licences, minhash, mix, pii, quality, shards, spots, topk, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_quality_scores(spark, sf):
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op2_bpe_round_trip(spark, sf):
    coded = bpe.encode(table(spark, sf, "documents").select("doc_id", "text"), decoded=True)
    return coded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_near_duplicates(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"))


@query
def op4_spot_signatures(spark, sf):
    rows = spots.with_neighbours(table(spark, sf, "documents"))
    edited = F.sha2("edited_text", 256).alias("edited_sha256")
    rest = ["fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return rows.select("doc_id", "n_chars", edited, *rest)


@query
def op5_top_k_search(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"))


ORACLES["op5_top_k_search"] = """
WITH t AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS terms FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.terms, d.terms)::BIGINT AS score
  FROM t q JOIN t d ON d.vec_id <> q.vec_id AND len(d.terms) = len(q.terms) WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op6_shard_placement(spark, sf):
    return shards.place(table(spark, sf, "documents").select("doc_id"))


ORACLES["op6_shard_placement"] = shards.sql()


@query
def op7_licence_scan(spark, sf):
    found = licences.scan(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("matches", lambda m: m["base"])

    def labels(matches):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))))

    places = F.transform(base, lambda m: m["word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


@query
def op8_source_mix(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op8_source_mix"] = mix.SQL


@query
def op9_personal_data(spark, sf):
    found = pii.find(table(spark, sf, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    base = F.filter("spans", lambda s: s["base"])
    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


@query
def op10_warc_archive(spark, sf):
    records = warc.read(warc.write(table(spark, sf, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op10_warc_archive"] = warc.SQL


@query
def op11_token_alignment(spark, sf):
    return alignment.align(table(spark, sf, "documents"))


@query
def op12_centroid_clusters(spark, sf):
    return clusters.cluster(table(spark, sf, "embeddings"))


ORACLES["op12_centroid_clusters"] = clusters.sql()


@query
def op13_url_filter(spark, sf):
    return urls.judge(table(spark, sf, "pages"))

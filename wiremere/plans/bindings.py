"""The test tables seen as lake tables.

One SQL text per input, which Spark and the DuckDB check both run. All rows of the tables take part.
"""

from pyspark.sql import DataFrame, SparkSession

COMPANY = """CASE o_custkey % 6 WHEN 0 THEN 'Munich Re' WHEN 1 THEN 'Swiss Re' WHEN 2 THEN 'Aon'
  WHEN 3 THEN 'Guy Carpenter' WHEN 4 THEN 'Hannover Re' ELSE 'Acme Retail' END"""

# Orders as news: dates over years, repeated URLs and texts, blank texts, padded, empty and NULL URLs.
NEWS = f"""
SELECT o_orderkey AS seq,
  CAST(o_orderkey AS VARCHAR(20)) AS id,
  concat('rss::feed', CAST(o_custkey % 5 AS VARCHAR(20))) AS source_name,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL
       WHEN o_orderkey % 3 = 1
         THEN concat(' https://example.com/n/', CAST(o_orderkey % 4000 AS VARCHAR(20)), ' ')
       ELSE '' END AS source_url,
  concat(company, ' news ', CAST(o_custkey % 40 AS VARCHAR(20))) AS title,
  CASE WHEN o_orderkey % 29 = 0 THEN '   ' ELSE concat(
    CASE o_orderstatus WHEN 'P' THEN 'Reportedly, ' ELSE '' END,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN concat(company, ' acquires a rival for $',
        CAST(CAST(floor(o_totalprice / 400) AS INT) AS VARCHAR(20)), ' million')
      WHEN '2-HIGH' THEN concat('Hurricane strikes the coast; damage of $',
        CAST(o_custkey % 4 AS VARCHAR(20)), '.5 billion, ', company, ' bears a part')
      WHEN '3-MEDIUM' THEN CASE WHEN o_custkey % 2 = 0
        THEN concat('Moody''s has downgraded ', company, ' by one notch')
        ELSE concat('S&P sees a darker outlook for ', company) END
      WHEN '4-NOT SPECIFIED' THEN concat('BaFin licence review of ', company,
        CASE WHEN o_custkey % 2 = 0 THEN ' ends in licence revocation' ELSE ' continues' END)
      ELSE concat('Sports results, week ', CAST(o_custkey % 52 AS VARCHAR(20))) END) END AS raw_text,
  '{{}}' AS raw_metadata,
  o_orderdate AS ingested_at
FROM (SELECT *, {COMPANY} AS company FROM orders) o
"""

# Events as signals: missing titles, empty and malformed entity lists, all sentiments.
SIGNALS = """
SELECT CAST(event_id AS VARCHAR(20)) AS id,
  CASE WHEN event_type IN ('click','view') THEN 'Competitor_Strategy'
       WHEN event_type IN ('purchase','signup') THEN 'Broker_Dynamics'
       ELSE 'Emerging_Risks' END AS signal_category,
  CASE WHEN event_id % 11 = 0 THEN NULL
       ELSE concat(event_type, ' u', CAST(user_id AS VARCHAR(20))) END AS title,
  concat('Event ', CAST(event_id AS VARCHAR(20)), ' of type ', event_type) AS summary,
  CASE WHEN event_id % 17 = 0 THEN 'not json' WHEN event_id % 13 = 0 THEN '[]'
       ELSE concat('["user_', CAST(user_id % 20 AS VARCHAR(20)), '","k_',
                   CAST(value_k % 10 AS VARCHAR(20)), '"]') END AS key_entities,
  CASE event_id % 5 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEGATIVE' WHEN 2 THEN 'MIXED'
       ELSE 'NEUTRAL' END AS sentiment,
  CAST(CASE WHEN value > 500 THEN 1.0 ELSE value / 500 END AS FLOAT) AS confidence_score,
  value > 100 AS action_required,
  ts AS extracted_at,
  concat('https://example.com/e/', CAST(event_id AS VARCHAR(20))) AS source_url,
  concat('rss::', event_type) AS source_name
FROM (SELECT *, CAST({K} AS INT) AS value_k FROM events) e
"""

# Events as model replies, two thirds of them broken in one way each or irrelevant.
PAYLOADS = """
SELECT CAST(event_id AS VARCHAR(20)) AS bronze_id, CASE event_id % 12
  WHEN 0 THEN 'not json'
  WHEN 1 THEN '{"key_entities":[],"confidence_score":0.5,"action_required":false}'
  WHEN 2 THEN '{"is_relevant":false,"key_entities":[],"confidence_score":0.91,"action_required":false}'
  WHEN 3 THEN '{"is_relevant":true,"signal_category":"Other","summary":"s","key_entities":[],"confidence_score":0.5,"action_required":true}'
  WHEN 4 THEN '{"is_relevant":true,"signal_category":"Emerging_Risks","summary":"s","key_entities":[],"confidence_score":1.5,"action_required":true}'
  WHEN 5 THEN '{"is_relevant":true,"signal_category":"Emerging_Risks","key_entities":[],"confidence_score":0.5,"action_required":true}'
  WHEN 6 THEN '{"is_relevant":true,"summary":"s","key_entities":["A"],"confidence_score":0.5,"action_required":true}'
  WHEN 7 THEN concat('{"is_relevant":true,"signal_category":"Broker_Dynamics","summary":"', repeat('x', 1001), '","key_entities":[],"confidence_score":0.5,"action_required":true}')
  ELSE concat('{"is_relevant":true,"signal_category":"',
    CASE WHEN event_type IN ('click','view') THEN 'Competitor_Strategy'
         WHEN event_type = 'error' THEN 'Emerging_Risks' ELSE 'Broker_Dynamics' END,
    '","summary":"e', CAST(event_id AS VARCHAR(20)),
    '","key_entities":["user_', CAST(user_id % 20 AS VARCHAR(20)), '"],"sentiment":',
    CASE WHEN event_id % 2 = 0 THEN 'null' ELSE '"NEGATIVE"' END,
    ',"confidence_score":0.', CAST(10 + user_id % 90 AS VARCHAR(20)),
    ',"action_required":', CASE WHEN value > 50 THEN 'true' ELSE 'false' END, ',"extra":1}') END AS payload
FROM events
"""

# Documents and web pages as articles: long texts in four languages, HTML, exact copies.
DOCUMENT_ARTICLES = """
SELECT doc_id AS seq, source AS source_name, CAST(NULL AS VARCHAR(10)) AS source_url,
  concat(source, ' ', CAST(doc_id AS VARCHAR(20))) AS title, text AS raw_text
FROM documents
"""
PAGE_ARTICLES = """
SELECT 1000000000 + page_id AS seq, 'pages' AS source_name, url AS source_url,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html AS raw_text
FROM pages
"""

# News as feed entries before text resolution.
FEED_ENTRIES = f"""
SELECT concat('https://feeds.example.com/', source_name) AS feed_url,
  CASE WHEN source_name = 'rss::feed4' THEN NULL ELSE source_name END AS feed_title,
  seq AS pos,
  CASE WHEN seq % 7 = 0 THEN NULL ELSE trim(source_url) END AS link,
  CASE WHEN seq % 31 = 0 THEN NULL ELSE title END AS title,
  CASE WHEN seq % 4 = 0 THEN '' ELSE raw_text END AS summary,
  CASE WHEN seq % 5 = 0 THEN concat('Full: ', raw_text) ELSE '' END AS content,
  CASE WHEN seq % 9 = 0 THEN NULL ELSE CAST(CAST(ingested_at AS DATE) AS VARCHAR(20)) END AS published,
  split(CASE WHEN seq % 6 = 0 THEN ',insurance' ELSE concat('insurance,', title) END, ',') AS tags,
  split(CASE WHEN seq % 8 = 0 THEN '' ELSE 'A. Writer' END, ',') AS authors
FROM ({NEWS}) n
"""

# Events as status rows, two for each article they speak of, in random order of time.
STATUS_LOG = """
SELECT CAST(CAST(floor(event_id / 2) AS BIGINT) AS VARCHAR(20)) AS bronze_id,
  CASE event_type WHEN 'click' THEN 'silver' WHEN 'view' THEN 'noise' WHEN 'signup' THEN 'retry'
    ELSE 'failed' END AS status,
  CASE WHEN event_type IN ('error', 'purchase')
    THEN concat('error ', CAST(event_id AS VARCHAR(20))) END AS error,
  ts AS logged_at
FROM events
"""

BINDINGS = {
    "news": NEWS,
    "signals": SIGNALS,
    "payloads": PAYLOADS,
    "document_articles": DOCUMENT_ARTICLES,
    "page_articles": PAGE_ARTICLES,
    "feed_entries": FEED_ENTRIES,
    "status_log": STATUS_LOG,
}

# The one expression that the two engines spell differently.
SPARK_K = "get_json_object(props, '$.k')"
DUCKDB_K = "json_extract_string(props, '$.k')"

TABLES = ["orders", "events", "documents", "pages", "labels"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A binding over the tables of a folder."""
    sql = BINDINGS[name].replace("{K}", SPARK_K)
    for base in TABLES:
        if f"FROM {base}" in sql:
            table(spark, sf_dir, base).createOrReplaceTempView(f"bound_{base}")
            sql = sql.replace(f"FROM {base}", f"FROM bound_{base}")
    return spark.sql(sql)


def with_bindings(names: list[str], select: str) -> str:
    """The DuckDB text of a query over bindings."""
    ctes = ",\n".join(f"{n} AS ({BINDINGS[n].replace('{K}', DUCKDB_K)})" for n in names)
    return f"WITH {ctes}\n{select}"

"""The DuckDB check of every registered query, written from the semantics, not from the Spark code."""

from wiremere import constants as C
from wiremere.plans.bindings import with_bindings
from wiremere.plans.queries import (
    ARCHIVE_FROM,
    ARCHIVE_SOURCES,
    ARCHIVE_TO,
    STORED_BEFORE,
    TEST_LEXICON,
    WEEKS,
)

ORACLES: dict[str, str] = {}


def check(name: str, bindings: list[str], select: str) -> None:
    ORACLES[name] = with_bindings(bindings, select) if bindings else select


# ---- SQL pieces ----

BLANK = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"


def stripped(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def hashed(url: str = "source_url", body: str = "raw_text") -> str:
    return f"sha256(coalesce(nullif({stripped(url)}, ''), {stripped(body)}))"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def label(x: str) -> str:
    return f"CASE WHEN {x} IN ('Competitor_Strategy','Broker_Dynamics','Emerging_Risks') THEN replace({x}, '_', ' ') ELSE {x} END"


SCORE = "CASE sentiment WHEN 'POSITIVE' THEN 1.0::DOUBLE WHEN 'NEGATIVE' THEN -1.0 WHEN 'MIXED' THEN 0.5 ELSE 0.0 END"
WEEK = "strftime(extracted_at, '%Y-W%V')"
DAY = "strftime(extracted_at, '%Y-%m-%d')"
NEWEST = "extracted_at DESC NULLS LAST, id"
LOOSE_LIST = (
    "CASE WHEN json_valid(key_entities) AND json_type(key_entities::JSON) = 'ARRAY' "
    "THEN from_json(key_entities::JSON, '[\"VARCHAR\"]') ELSE [] END"
)
HASHES = f"""
batch AS (SELECT *, {hashed()} AS content_hash FROM news
          WHERE source_name <> '' AND {stripped('raw_text')} <> ''),
stored AS (SELECT DISTINCT content_hash FROM batch WHERE ingested_at < TIMESTAMP '{STORED_BEFORE}'),
fresh AS (SELECT DISTINCT ON (content_hash) * FROM batch
          WHERE content_hash NOT IN (SELECT content_hash FROM stored) ORDER BY content_hash, seq)"""
STATE = """
state AS (SELECT * FROM status_log
          QUALIFY row_number() OVER (PARTITION BY bronze_id ORDER BY logged_at DESC) = 1)"""
MENTIONS = f"""
mention AS (SELECT id AS signal_id, unnest({LOOSE_LIST}) AS entity_name,
    CASE signal_category WHEN 'Competitor_Strategy' THEN 'Competitor'
      WHEN 'Broker_Dynamics' THEN 'Broker' ELSE 'Risk' END AS entity_type,
    signal_category AS category FROM signals)"""


def chain(bindings: list[str], ctes: str, select: str) -> str:
    return with_bindings(bindings, "").rstrip() + ",\n" + ctes.strip() + "\n" + select


# ---- feeds and sources ----

check("feed_cap", ["feed_entries"], """
SELECT feed_url, pos, title FROM feed_entries
QUALIFY row_number() OVER (PARTITION BY feed_url ORDER BY pos) <= 20""")

check("feed_cap_large", ["feed_entries"], """
SELECT feed_url, pos FROM feed_entries
QUALIFY row_number() OVER (PARTITION BY feed_url ORDER BY pos) <= 2000""")

RESOLVED = f"""
SELECT *, {stripped("CASE WHEN content <> '' THEN content WHEN summary <> '' THEN summary "
                    "ELSE headline END")} AS body
FROM (SELECT *, coalesce(title, 'Untitled') AS headline FROM feed_entries)"""

check("resolve_text", ["feed_entries"],
      f"SELECT feed_url, pos, headline AS title, body AS raw_text FROM ({RESOLVED})")

META = """json_object('feed_title', coalesce(feed_title, feed_url), 'feed_url', feed_url,
  'published', published, 'tags', [x for x in tags if x <> ''],
  'authors', [x for x in authors if x <> ''])"""

check("feed_metadata", ["feed_entries"], f"""
SELECT feed_url, pos, 'rss::' || coalesce(feed_title, feed_url) AS source_name,
  CAST({META} AS VARCHAR) AS raw_metadata FROM feed_entries""")

check("feed_dedup", ["feed_entries"], """
SELECT DISTINCT ON (dedup_key) feed_url, pos, dedup_key
FROM (SELECT *, CASE WHEN link <> '' THEN link ELSE coalesce(title, 'Untitled') END AS dedup_key
      FROM feed_entries) ORDER BY dedup_key, feed_url, pos""")

check("keyword_filter", ["feed_entries"], """
SELECT feed_url, pos FROM feed_entries
WHERE coalesce(title, 'Untitled') || ' ' || summary ILIKE '%munich re%'""")

SAID = """(link <> '' OR title IS NOT NULL AND title <> '' OR summary <> '' OR content <> '')"""
check("feed_articles", ["feed_entries"], f"""
SELECT 'rss::' || coalesce(feed_title, feed_url) AS source_name, link AS source_url,
  headline AS title, body AS raw_text, CAST({META} AS VARCHAR) AS raw_metadata
FROM (SELECT DISTINCT ON (k) * FROM (
        SELECT *, CASE WHEN link <> '' THEN link ELSE headline END AS k FROM ({RESOLVED}) r
        QUALIFY row_number() OVER (PARTITION BY feed_url ORDER BY pos) <= 500) WHERE {SAID}
      ORDER BY k, feed_url, pos)
WHERE headline || ' ' || summary ILIKE '%news 1%' AND body <> ''""")

check("feed_articles_all", ["feed_entries"], f"""
SELECT 'rss::' || coalesce(feed_title, feed_url) AS source_name, link AS source_url,
  headline AS title, body AS raw_text, CAST({META} AS VARCHAR) AS raw_metadata
FROM (SELECT DISTINCT ON (k) * FROM (
        SELECT *, CASE WHEN link <> '' THEN link ELSE headline END AS k FROM ({RESOLVED}) r)
      WHERE {SAID} ORDER BY k, feed_url, pos)
WHERE body <> ''""")

check("feed_rejects", ["feed_entries"], f"""
SELECT 'rss::' || coalesce(feed_title, feed_url) AS source_name, pos,
  CASE WHEN pos % 37 = 0 THEN '<item>' || title END AS raw_text,
  CASE WHEN pos % 37 = 0 AND title IS NOT NULL THEN 'entry is not well-formed'
    ELSE 'entry has no link, title or text' END AS reject_reason
FROM feed_entries WHERE pos % 37 = 0 AND title IS NOT NULL OR coalesce({SAID}, FALSE) = FALSE
UNION ALL
SELECT 'rss::' || coalesce(feed_title, feed_url), pos, body, 'raw_text is empty'
FROM (SELECT DISTINCT ON (k) * FROM (
        SELECT *, CASE WHEN link <> '' THEN link ELSE headline END AS k FROM ({RESOLVED}) r)
      WHERE {SAID} AND (pos % 37 <> 0 OR title IS NULL) ORDER BY k, feed_url, pos)
WHERE body = ''""")

check("feed_files", ["news"], f"""
SELECT coalesce({stripped('source_url')}, '-') AS link, title, {stripped('raw_text')} AS summary,
  strftime(ingested_at, '%Y-%m-%d') AS published, replace(title, ' news ', '|') AS tags,
  CAST(NULL AS VARCHAR) AS feed_title FROM news""")

check("article_contract", ["news"], f"""
SELECT seq, source_name, CASE WHEN source_name = '' THEN 'source_name is empty'
  WHEN {stripped('raw_text')} = '' THEN 'raw_text is empty' END AS reject_reason FROM news""")

FOUND_IN_ARCHIVE = f"""
SELECT seq, source_name, title, raw_text, ingested_at FROM news
WHERE ingested_at BETWEEN TIMESTAMP '{ARCHIVE_FROM}' AND TIMESTAMP '{ARCHIVE_TO} 23:59:59.999999'
  AND source_name IN ({', '.join(map(text, ARCHIVE_SOURCES))})
  AND title || ' ' || raw_text ILIKE '%re%'"""
check("archive_scan", ["news"], f"{FOUND_IN_ARCHIVE} ORDER BY ingested_at, seq LIMIT 200")
check("archive_scan_all", ["news"], FOUND_IN_ARCHIVE)

check("archive_documents", ["document_articles"], f"""
SELECT 'archive' AS source_name, 'https://archive.example.com/' || seq AS source_url, title,
  md5(raw_text) AS text_md5,
  CAST(json_object('source_id', source_name, 'source_name', upper(source_name),
    'published_date', '2024-01-30', 'document_type', 'Report') AS VARCHAR) AS raw_metadata
FROM document_articles WHERE {stripped('raw_text')} <> ''""")

ALL_ARTICLES = "(SELECT * FROM document_articles UNION ALL SELECT * FROM page_articles)"
BOTH = ["document_articles", "page_articles"]

check("union_sources", BOTH, f"""
SELECT seq, source_name, source_url, title, md5(raw_text) AS text_md5, length(raw_text) AS chars
FROM {ALL_ARTICLES}""")

# ---- text functions ----

check("strip_text", ["news"],
      f"SELECT seq, {stripped('source_url')} AS url, {stripped('raw_text')} AS text FROM news")
check("content_hash", ["news"], f"SELECT seq, {hashed()} AS content_hash FROM news")
check("content_hash_articles", BOTH, f"SELECT seq, {hashed()} AS content_hash FROM {ALL_ARTICLES}")
check("text_preview", ["document_articles"],
      "SELECT seq, left(raw_text, 200) AS preview FROM document_articles")
PROMPT = """CASE WHEN title <> '' THEN 'HEADLINE: ' || title || chr(10) || chr(10) ELSE '' END
  || CASE WHEN source_url <> '' THEN 'SOURCE URL: ' || source_url || chr(10) || chr(10) ELSE '' END
  || 'ARTICLE TEXT:' || chr(10) || """
check("model_input", BOTH,
      f"SELECT seq, {PROMPT} left(raw_text, 3072) AS model_input FROM {ALL_ARTICLES}")
check("model_input_whole", BOTH,
      f"SELECT seq, md5({PROMPT} raw_text) AS model_input_md5 FROM {ALL_ARTICLES}")

for _name, _table, _key, _at in [
    ("date_buckets", "signals", "id", "extracted_at"),
    ("date_buckets_news", "news", "seq", "ingested_at"),
]:
    check(_name, [_table], f"""
SELECT {_key} AS id, CAST({_at} AS DATE) AS date, strftime({_at}, '%Y-%m') AS year_month,
  strftime({_at}, '%Y-W%V') AS year_week, strftime({_at}, '%Y-%m-%d') AS day,
  strftime({_at}, '%Y-%m-%d %H:%M') AS minute FROM {_table}""")

check("parse_entities", ["signals"], f"""
SELECT id, CAST(len(names) AS BIGINT) AS entities, array_to_string(names, '|') AS names
FROM (SELECT id, {LOOSE_LIST} AS names FROM signals)""")

check("sentiment_lookup", ["signals"], f"""
SELECT id, {SCORE} AS sentiment_score, {label('signal_category')} AS category_label,
  CASE signal_category WHEN 'Competitor_Strategy' THEN 'Competitor'
    WHEN 'Broker_Dynamics' THEN 'Broker' ELSE 'Risk' END AS entity_type FROM signals""")

# ---- Bronze ----

ORACLES["bronze_insert_ignore"] = chain(["news"], HASHES, """
SELECT left(sha256('bronze|' || content_hash), 32) AS id, content_hash, source_name, source_url,
  title, raw_text, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at FROM fresh""")
ORACLES["bronze_insert_probe"] = chain(["news"], HASHES, "SELECT seq, content_hash FROM fresh")
check("articles_dedup", BOTH, f"""
SELECT DISTINCT ON (content_hash) seq, source_name, content_hash
FROM (SELECT *, {hashed()} AS content_hash FROM {ALL_ARTICLES} WHERE {stripped('raw_text')} <> '')
ORDER BY content_hash, seq""")
ORACLES["bronze_dedup_report"] = chain(["news"], HASHES, """
SELECT (SELECT count(*) FROM batch) AS batch_rows, (SELECT count(*) FROM fresh) AS inserted,
  (SELECT count(*) FROM stored) AS hashes_stored_before,
  (SELECT count(*) FROM batch) - (SELECT count(*) FROM fresh) AS duplicates""")
ORACLES["existing_hashes"] = chain(["news"], HASHES, """
SELECT content_hash FROM stored WHERE content_hash IN (SELECT content_hash FROM batch)""")

# ---- status ----

LOG = ["status_log"]
NEWS_LOG = ["news", "status_log"]
TODO = """(SELECT n.* FROM news n LEFT JOIN state s ON s.bronze_id = n.id
  WHERE coalesce(s.status, 'new') NOT IN ('silver', 'noise', 'failed'))"""

ORACLES["status_current"] = chain(LOG, STATE, "SELECT bronze_id, status, error, logged_at FROM state")
ORACLES["work_queue"] = chain(NEWS_LOG, STATE, f"""
SELECT id, source_name, title, ingested_at FROM {TODO}
ORDER BY ingested_at ASC NULLS LAST, id LIMIT 50""")
ORACLES["backlog"] = chain(NEWS_LOG, STATE, f"SELECT id, ingested_at FROM {TODO}")
ORACLES["dead_letter_queue"] = chain(NEWS_LOG, STATE, """
SELECT n.id, n.source_name, n.source_url, n.title, left(n.raw_text, 200) AS raw_text_preview,
  n.ingested_at, s.error AS processing_error
FROM news n JOIN state s ON s.bronze_id = n.id AND s.status = 'failed'""")
ORACLES["dead_letter_page"] = chain(NEWS_LOG, STATE, """
SELECT n.id, n.title, s.error AS processing_error
FROM news n JOIN state s ON s.bronze_id = n.id AND s.status = 'failed'
ORDER BY n.ingested_at DESC NULLS LAST, n.id LIMIT 50""")
ORACLES["dlq_retry"] = chain(NEWS_LOG, STATE, """
SELECT bronze_id, 'retry' AS status, CAST(NULL AS VARCHAR) AS error, 'manual' AS run_id,
  TIMESTAMP '2024-02-01 00:00:00' AS logged_at
FROM state WHERE status = 'failed'
  AND bronze_id IN (SELECT id FROM news WHERE source_name = 'rss::feed2')""")
ORACLES["backlog_after_retry"] = chain(NEWS_LOG, STATE, """
SELECT id FROM news WHERE id NOT IN
  (SELECT bronze_id FROM state WHERE status IN ('silver', 'noise'))""")

# ---- extraction ----


def word(column: str, word_: str) -> str:
    """A whole word: neither letter, digit nor underscore on either side."""
    quoted = "".join(c if c.isalnum() or c == " " else f"\\x{{{ord(c):x}}}" for c in word_.lower())
    edge = r"[^\p{L}\p{N}_]"
    return f"regexp_matches(lower({column}), '(^|{edge}){quoted}({edge}|$)')"


def any_word(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(word(column, w) for w in words) + ")"


def classified(lexicon: dict[str, list[str]], source: str) -> str:
    counts = {
        c: " + ".join(f"CAST({word('raw_text', w)} AS INT)" for w in words)
        for c, words in lexicon.items()
    }
    ranked = sorted(lexicon)
    columns = ", ".join(f"{counts[c]} AS n{i}" for i, c in enumerate(ranked))
    names = [f"n{i}" for i in range(len(ranked))]
    total, top = " + ".join(names), f"greatest({', '.join(names)})"
    winner = " ".join(f"WHEN n{i} = {top} THEN {text(c)}" for i, c in enumerate(ranked))
    return f"""
SELECT *, {total} > 0 AS is_relevant, CAST({total} AS BIGINT) AS hits,
  CASE WHEN {total} > 0 THEN CASE {winner} END END AS signal_category,
  CASE WHEN {total} > 0 THEN CAST({top} AS DOUBLE) / ({total}) ELSE 0.0::DOUBLE END AS confidence
FROM (SELECT *, {columns} FROM {source})"""


CLASSIFIED = "SELECT seq, is_relevant, signal_category, round(confidence, 6) AS confidence, hits FROM"
check("lexicon_classify", ["news"], f"{CLASSIFIED} ({classified(C.LEXICON, 'news')})")
check("lexicon_classify_articles", BOTH, f"{CLASSIFIED} ({classified(TEST_LEXICON, ALL_ARTICLES)})")

AMOUNT = r"\$([0-9]+(?:\.[0-9]+)?) ?(?:billion|bn|million|m)\b"
USD = rf"""coalesce(list_max([CAST(regexp_extract(x, '[0-9]+(?:\.[0-9]+)?') AS DOUBLE)
    * CASE WHEN regexp_matches(x, 'b') THEN 1000000000.0 ELSE 1000000.0 END
  for x in regexp_extract_all(lower(raw_text), '{AMOUNT}')]), 0.0::DOUBLE)"""
COMPANIES = C.COMPETITOR_NAMES + C.BROKER_NAMES
ACTION = rf"""(
  ({any_word('raw_text', COMPANIES)} AND regexp_matches(lower(raw_text), '\b(acqui|merg)')
     AND usd >= 500000000)
  OR (regexp_matches(lower(raw_text), '\b(hurricane|earthquake|flood|wildfire|pandemic)')
     AND usd >= 1000000000)
  OR (({any_word('raw_text', COMPANIES)} OR regexp_matches(lower(raw_text), '\b(reinsurer|syndicate)\b'))
     AND regexp_matches(lower(raw_text), '\b(lloyd''s|bafin|finma|iais)\b')
     AND regexp_matches(lower(raw_text), '\b(sanction|suspend|revoke|revocation|intervention)'))
  OR ({any_word('raw_text', COMPANIES)} AND regexp_matches(lower(raw_text), '\bdowngraded?\b')
     AND regexp_matches(lower(raw_text), '\b(moody''s|s&p|fitch|am best)\b')))
  AND NOT regexp_matches(lower(raw_text), '\b(reportedly|rumoured|expected|may|could)\b')"""
NEWS_ACTION = f"SELECT *, {ACTION} AS action_rule FROM (SELECT *, {USD} AS usd FROM news)"

check("action_rules", ["news"], f"""
SELECT seq, usd, action_rule AS action_required FROM ({NEWS_ACTION})""")

FIELD = "json_extract(j, '$.{0}')"
TYPE = "json_type(j, '$.{0}')"
READ = f"""
SELECT *, CASE WHEN ok THEN payload::JSON END AS j FROM
  (SELECT *, json_valid(payload) AS ok FROM payloads)"""
NUMERIC = "('BIGINT','UBIGINT','DOUBLE')"
TYPED = f"""
SELECT *,
  CASE WHEN {TYPE.format('is_relevant')} = 'BOOLEAN' THEN CAST(j->>'$.is_relevant' AS BOOLEAN) END AS is_relevant,
  CASE WHEN {TYPE.format('signal_category')} = 'VARCHAR' THEN j->>'$.signal_category' END AS signal_category,
  CASE WHEN {TYPE.format('summary')} = 'VARCHAR' THEN j->>'$.summary' END AS summary,
  CASE WHEN {TYPE.format('sentiment')} = 'VARCHAR' THEN j->>'$.sentiment' END AS sentiment,
  CASE WHEN {TYPE.format('key_entities')} = 'ARRAY'
    THEN from_json(json_extract(j, '$.key_entities'), '["VARCHAR"]') ELSE [] END AS key_entities,
  CASE WHEN {TYPE.format('confidence_score')} IN {NUMERIC}
    THEN CAST(j->>'$.confidence_score' AS DOUBLE) ELSE 0.0::DOUBLE END AS confidence_score,
  CASE WHEN {TYPE.format('action_required')} = 'BOOLEAN'
    THEN CAST(j->>'$.action_required' AS BOOLEAN) ELSE FALSE END AS action_required
FROM ({READ})"""
RULES = f"""[
  CASE WHEN {TYPE.format('is_relevant')} IS NULL THEN 'is_relevant is missing' END,
  CASE WHEN signal_category NOT IN ('Competitor_Strategy','Broker_Dynamics','Emerging_Risks')
    THEN 'signal_category is not a known category' END,
  CASE WHEN length(summary) > 1000 THEN 'summary is over 1000 characters' END,
  CASE WHEN sentiment NOT IN ('POSITIVE','NEGATIVE','NEUTRAL','MIXED')
    THEN 'sentiment is not a known sentiment' END,
  CASE WHEN NOT confidence_score BETWEEN 0 AND 1 THEN 'confidence_score is outside 0..1' END,
  CASE WHEN is_relevant AND signal_category IS NULL
    THEN 'signal_category is required when relevant' END,
  CASE WHEN is_relevant AND coalesce(summary, '') = ''
    THEN 'summary is required when relevant' END]"""
VIOLATIONS = f"""
SELECT *, CASE WHEN NOT ok THEN 'payload is not a JSON object'
  ELSE array_to_string([v for v in {RULES} if v IS NOT NULL], '; ') END AS violations
FROM ({TYPED})"""
ROUTED = f"""
SELECT *, CASE WHEN violations <> '' THEN 'failed' WHEN is_relevant THEN 'silver' ELSE 'noise' END AS outcome,
  CASE WHEN violations <> '' THEN 'Signal extraction failed: ' || violations END AS error
FROM ({VIOLATIONS})"""

check("parse_payload", ["payloads"], f"""
SELECT bronze_id, is_relevant, signal_category, length(summary) AS summary_chars,
  array_to_string(key_entities, '|') AS key_entities, sentiment, confidence_score, action_required
FROM ({TYPED})""")
check("action_gate", ["payloads"], f"""
SELECT bronze_id, action_required AND confidence_score >= 0.70 AS action_required FROM ({TYPED})""")
check("validate_signals", ["payloads"], f"SELECT bronze_id, violations FROM ({VIOLATIONS})")
check("route_outcomes", ["payloads"], f"SELECT bronze_id, outcome, error FROM ({ROUTED})")
check("batch_outcome", ["payloads"],
      f"SELECT outcome, count(*) AS records FROM ({ROUTED}) GROUP BY outcome")
check("noise_records", ["payloads"], f"SELECT bronze_id FROM ({ROUTED}) WHERE outcome = 'noise'")
check("silver_rows", ["news", "payloads"], f"""
SELECT left(sha256('silver|' || r.bronze_id), 32) AS id, r.bronze_id, n.source_name, n.source_url,
  n.title, r.signal_category, r.summary,
  CAST(json_extract(r.j, '$.key_entities') AS VARCHAR) AS key_entities,
  coalesce(r.sentiment, 'NEUTRAL') AS sentiment, CAST(r.confidence_score AS FLOAT) AS confidence_score,
  r.action_required, TIMESTAMP '2024-02-01 00:00:00' AS extracted_at, 'replay' AS llm_model,
  r.payload AS raw_llm_response
FROM ({ROUTED}) r, news n WHERE n.id = r.bronze_id AND r.outcome = 'silver'""")
check("lineage", ["news", "payloads"], f"""
SELECT r.bronze_id, r.signal_category, 'replay' AS llm_model, r.payload AS raw_llm_response,
  md5(n.raw_text) AS text_md5, n.ingested_at
FROM ({ROUTED}) r, news n WHERE n.id = r.bronze_id AND r.outcome = 'silver'""")

FOUND = ", ".join(
    f"CASE WHEN {word('raw_text', n)} THEN {text(n)} END" for n in COMPANIES
)
GOOD, BAD = any_word("raw_text", C.POSITIVE_WORDS), any_word("raw_text", C.NEGATIVE_WORDS)
MOOD = f"CASE WHEN {GOOD} AND {BAD} THEN 'MIXED' WHEN {GOOD} THEN 'POSITIVE' WHEN {BAD} THEN 'NEGATIVE' ELSE 'NEUTRAL' END"
check("extract_lexicon", ["news"], f"""
SELECT id AS bronze_id, CASE WHEN is_relevant THEN 'silver' ELSE 'noise' END AS outcome,
  signal_category, CASE WHEN is_relevant THEN title END AS summary,
  array_to_string([n for n in [{FOUND}] if n IS NOT NULL], '|') AS key_entities,
  CASE WHEN is_relevant THEN {MOOD} END AS sentiment,
  is_relevant AND action_rule AND confidence >= 0.70 AS action_required
FROM ({classified(C.LEXICON, f"({NEWS_ACTION})")})""")

check("extract_model", ["news"], """
SELECT id AS bronze_id,
  CASE WHEN body LIKE '%licence%' THEN 'failed' WHEN body LIKE '%Hurricane%' THEN 'silver'
    ELSE 'noise' END AS outcome,
  CASE WHEN body LIKE '%licence%' THEN 'Signal extraction failed: no answer' END AS error,
  CASE WHEN body NOT LIKE '%licence%' AND body LIKE '%Hurricane%' THEN 'Emerging_Risks' END
    AS signal_category
FROM (SELECT id, concat(title, source_url, raw_text) AS body FROM news)""")

check("signal_to_noise", [], f"""
WITH c AS (
  SELECT count(*) AS n, CAST(sum(CAST(quality = 1 AS INT)) AS BIGINT) AS r,
    CAST(sum(CAST(is_relevant AS INT)) AS BIGINT) AS kept,
    CAST(sum(CAST(is_relevant AND quality = 1 AS INT)) AS BIGINT) AS hit
  FROM ({classified(TEST_LEXICON, "(SELECT *, text AS raw_text FROM documents JOIN labels USING (doc_id))")})),
p AS (SELECT *, hit::DOUBLE / kept AS p FROM c)
SELECT n AS articles, r AS relevant, kept AS predicted, round(p, 6) AS precision,
  round(hit::DOUBLE / r, 6) AS recall, round(r::DOUBLE / n, 6) AS sn_before,
  round(p * r / (p * r + (1 - p) * (n - r)), 6) AS sn_after FROM p""")

# ---- Gold ----

SUMMARY = """
SELECT signal_category, count(*) AS total_signals,
  CAST(sum(CASE WHEN action_required THEN 1 ELSE 0 END) AS BIGINT) AS action_items,
  avg(CAST(confidence_score AS DOUBLE)) AS mean, max(extracted_at) AS latest_signal_at
FROM signals GROUP BY ALL"""
PCT = f"SELECT *, {label('signal_category')} AS category, round(mean * 100, 1) AS pct FROM ({SUMMARY})"
S = ["signals"]

SUMMARY_OUT = f"""
SELECT signal_category, total_signals, action_items, round(mean, 6) AS avg_confidence,
  latest_signal_at FROM ({SUMMARY})"""
check("gold_signal_summary", S, SUMMARY_OUT)
check("stream_gold", S, SUMMARY_OUT)
check("gold_report", S, f"""
SELECT category, total_signals, action_items, pct AS avg_confidence_pct,
  strftime(latest_signal_at, '%Y-%m-%d %H:%M') AS latest_signal, action_items > 0 AS attention
FROM ({PCT})""")
check("gold_grand_total", S, f"""
SELECT category, total_signals, action_items, pct AS avg_confidence_pct,
  pct AS weighted_avg_confidence_pct FROM ({PCT})
UNION ALL
SELECT 'GRAND TOTAL', CAST(sum(total_signals) AS BIGINT), CAST(sum(action_items) AS BIGINT),
  round_even(avg(pct), 1),
  (SELECT round(avg(CAST(confidence_score AS DOUBLE)) * 100, 1) FROM signals) FROM ({PCT})""")
check("kpi_cards", S, f"""
SELECT CAST(sum(total_signals) AS BIGINT) AS total_signals,
  CAST(sum(action_items) AS BIGINT) AS action_items, round_even(avg(pct), 1) AS avg_confidence_pct
FROM ({PCT})""")
check("sentiment_distribution", S, "SELECT sentiment, count(*) AS count FROM signals GROUP BY sentiment")
BREAKDOWN = """
SELECT action_required, if(action_required, 'Action Required', 'Monitor') AS status,
  count(*) AS count FROM signals GROUP BY action_required"""
check("action_breakdown", S, BREAKDOWN)
check("sentiment_share", S, """
SELECT sentiment, count(*) AS count,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM signals), 6) AS share_pct
FROM signals GROUP BY sentiment""")
check("action_share", S, f"""
SELECT *, round(count * 100.0::DOUBLE / (SELECT count(*) FROM signals), 6) AS share_pct
FROM ({BREAKDOWN})""")
check("category_sentiment", S, f"""
SELECT {label('signal_category')} AS category_label, sentiment, count(*) AS count
FROM signals WHERE signal_category IS NOT NULL AND sentiment IS NOT NULL GROUP BY ALL""")
check("sentiment_trend", S, f"""
SELECT {DAY} AS day, {label('signal_category')} AS category_label,
  round(avg({SCORE}), 6) AS avg_sentiment FROM signals
WHERE extracted_at IS NOT NULL AND signal_category IS NOT NULL GROUP BY ALL""")
check("dashboard_header", S, """
SELECT count(*) AS signals, count(DISTINCT signal_category) AS categories FROM signals""")
ORACLES["lake_stats"] = chain(["news", "signals", "status_log"], STATE, """
SELECT (SELECT count(*) FROM news) AS bronze_total, (SELECT count(*) FROM signals) AS silver_total,
  (SELECT count(*) FROM state WHERE status = 'failed') AS dlq_total""")
check("lake_gold", S, f"""
SELECT signal_category, total_signals, action_items, round(coalesce(mean, 0), 3) AS avg_confidence
FROM ({SUMMARY})""")

# ---- entities ----

JOINED = f"""
SELECT m.entity_name, m.entity_type, s.signal_category, s.action_required, s.title,
  strftime(s.extracted_at, '%Y-W%V') AS year_week, {SCORE} AS score
FROM mention m JOIN signals s ON s.id = m.signal_id"""

COMPETITORS = chain(S, MENTIONS, f"""
SELECT entity_name, signal_category, count(*) AS count FROM ({JOINED})
WHERE entity_type = 'Competitor' GROUP BY ALL""")
for _name in ("competitor_activity", "competitor_activity_star", "competitor_activity_files"):
    ORACLES[_name] = COMPETITORS

RISK_WEEK = f"""
SELECT entity_name, year_week, count(*) AS count, round(avg(score), 6) AS avg_sent FROM ({JOINED})
WHERE entity_type = 'Risk' AND signal_category = 'Emerging_Risks' GROUP BY ALL"""
ORACLES["risk_week"] = ORACLES["risk_week_star"] = chain(S, MENTIONS, RISK_WEEK)


def week_columns(source: str, row: str) -> str:
    columns = ", ".join(
        f"CAST(sum(CASE WHEN year_week = '{w}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{w}\"" for w in WEEKS
    )
    return f"SELECT {row}, {columns} FROM ({source}) GROUP BY {row}"


ORACLES["risk_heatmap"] = chain(S, MENTIONS, week_columns(
    f"SELECT * FROM ({JOINED}) WHERE entity_type = 'Risk'", "entity_name"))
check("risk_heatmap_by_title", S, week_columns(
    f"SELECT title, {WEEK} AS year_week FROM signals "
    "WHERE signal_category = 'Emerging_Risks' AND title IS NOT NULL", "title"))

MATRIX = """count(*) AS count, round(avg({score}), 6) AS avg_sent,
  CAST(sum(CASE WHEN action_required THEN 1 ELSE 0 END) AS BIGINT) AS actions,
  CAST((sum(CASE WHEN action_required THEN 1 ELSE 0 END) + 1) * 15 AS BIGINT) AS bubble_size"""
ORACLES["broker_matrix"] = ORACLES["broker_matrix_star"] = chain(S, MENTIONS, f"""
SELECT entity_name AS entity, {MATRIX.format(score='score')} FROM ({JOINED})
WHERE entity_type = 'Broker' GROUP BY ALL""")
for _name, _entity in {"": "left(title, 30)", "whole_": "title"}.items():
    check(f"broker_matrix_by_{_name}title", S, f"""
SELECT {_entity} AS entity, {MATRIX.format(score=SCORE)} FROM signals
WHERE signal_category = 'Broker_Dynamics' AND title IS NOT NULL GROUP BY ALL""")
ORACLES["dim_entities"] = chain(S, MENTIONS, "SELECT * FROM mention")

# ---- signal lists ----

DERIVED = f"""
SELECT *, {label('signal_category')} AS category_label, {SCORE} AS sentiment_score,
  CAST(extracted_at AS DATE) AS extracted_date, strftime(extracted_at, '%Y-%m') AS year_month,
  {WEEK} AS year_week, {DAY} AS day FROM signals"""
check("signals_enriched", S, f"""
SELECT id, category_label, sentiment_score, extracted_date, year_month, year_week, day
FROM ({DERIVED})""")
check("fact_signals", S,
      f"SELECT * EXCLUDE (key_entities, extracted_at) FROM ({DERIVED})")
check("intelligence_feed", S, f"""
SELECT id, CAST(extracted_at AS DATE) AS date, {label('signal_category')} AS category, summary,
  upper(coalesce(sentiment, 'NEUTRAL')) AS sentiment,
  round(CAST(confidence_score AS DOUBLE) * 100, 1) AS confidence_pct, action_required, title,
  source_url, coalesce(source_url LIKE 'http%', FALSE) AS has_link FROM signals""")
NEWS_COLUMNS = """id, day, category_label, title, left(summary, 200) AS summary, sentiment,
  coalesce(action_required, FALSE) AS action, source_url"""
check("news_table", S, f"SELECT {NEWS_COLUMNS} FROM ({DERIVED}) ORDER BY {NEWEST} LIMIT 50")
check("category_feed", S, """
SELECT id, title, sentiment, extracted_at FROM signals WHERE signal_category = 'Broker_Dynamics'""")
check("latest_risks", S, f"""
SELECT id, title, summary, confidence_score, extracted_at FROM signals
WHERE signal_category = 'Emerging_Risks' ORDER BY {NEWEST} LIMIT 10""")
check("action_items", S, """
SELECT id, title, signal_category, summary, source_url FROM signals WHERE action_required""")
for _period, _test in {
    "month": "strftime(ingested_at, '%Y-%m') = '1996-12'",
    "week": "strftime(ingested_at, '%Y-W%V') = '1996-W01'",
    "day": "strftime(ingested_at, '%Y-%m-%d') = '1996-12-30'",
}.items():
    check(f"timeline_{_period}", ["news"], f"""
SELECT id, strftime(ingested_at, '%Y-%m-%d') AS day, 'Emerging Risks' AS category_label, title,
  left(raw_text, 200) AS summary, 'NEUTRAL' AS sentiment, seq % 2 = 0 AS action, source_url
FROM news WHERE {_test}""")

# ---- whole runs ----

ONCE = f"""(SELECT DISTINCT ON (content_hash) * FROM
  (SELECT *, {hashed()} AS content_hash FROM news WHERE {stripped('raw_text')} <> '')
  ORDER BY content_hash, seq)"""
JUDGED = classified(
    C.LEXICON, f"(SELECT *, {ACTION} AS action_rule FROM (SELECT *, {USD} AS usd FROM {ONCE}))"
)
check("whole_run", ["news"], f"""
SELECT left(sha256('silver|' || bronze_id), 32) AS id, * FROM (
  SELECT left(sha256('bronze|' || content_hash), 32) AS bronze_id, source_name, source_url, title,
    signal_category, title AS summary,
    CAST(to_json([n for n in [{FOUND}] if n IS NOT NULL]) AS VARCHAR) AS key_entities,
    {MOOD} AS sentiment, action_rule AND confidence >= 0.70 AS action_required,
    'lexicon-1' AS llm_model
  FROM ({JUDGED}) WHERE is_relevant)""")

# ---- streams ----

check("stream_ingest", ["document_articles"], f"""
SELECT DISTINCT ON (content_hash) content_hash, source_name, title
FROM (SELECT *, {hashed()} AS content_hash FROM document_articles WHERE {stripped('raw_text')} <> '')
ORDER BY content_hash, seq""")

# ---- stored lakes ----

ORACLES["hash_lookup"] = ORACLES["existing_hashes"]
ORACLES["open_articles"] = chain(NEWS_LOG, STATE, """
SELECT n.id, coalesce(s.status, 'new') AS status, s.error
FROM news n LEFT JOIN state s ON s.bronze_id = n.id
WHERE coalesce(s.status, 'new') NOT IN ('silver', 'noise')""")

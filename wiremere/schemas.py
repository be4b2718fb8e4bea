"""Table contracts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TEXT, TIME, FLAG = T.StringType(), T.TimestampType(), T.BooleanType()
TEXTS = T.ArrayType(TEXT)


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


ARTICLE = _fields(source_name=TEXT, source_url=TEXT, title=TEXT, raw_text=TEXT, raw_metadata=TEXT)

BRONZE = _fields(
    id=TEXT,
    content_hash=TEXT,
    source_name=TEXT,
    source_url=TEXT,
    title=TEXT,
    raw_text=TEXT,
    raw_metadata=TEXT,
    ingested_at=TIME,
)

REJECT = _fields(
    source_name=TEXT,
    source_url=TEXT,
    title=TEXT,
    raw_text=TEXT,
    raw_metadata=TEXT,
    reject_reason=TEXT,
    rejected_at=TIME,
)

STATUS = _fields(bronze_id=TEXT, status=TEXT, error=TEXT, logged_at=TIME, run_id=TEXT)

# Articles that are not done yet, and the hashes of all articles by their beginning.
OPEN = _fields(id=TEXT, ingested_at=TIME, ingest_date=T.DateType(), status=TEXT, error=TEXT, logged_at=TIME)

HASHES = _fields(content_hash=TEXT, prefix=TEXT)

SILVER = _fields(
    id=TEXT,
    bronze_id=TEXT,
    source_name=TEXT,
    source_url=TEXT,
    title=TEXT,
    signal_category=TEXT,
    summary=TEXT,
    key_entities=TEXT,
    sentiment=TEXT,
    confidence_score=T.FloatType(),
    action_required=FLAG,
    extracted_at=TIME,
    llm_model=TEXT,
    raw_llm_response=TEXT,
)

FACT_SIGNALS = _fields(
    id=TEXT,
    signal_category=TEXT,
    category_label=TEXT,
    title=TEXT,
    summary=TEXT,
    sentiment=TEXT,
    sentiment_score=T.DoubleType(),
    confidence_score=T.FloatType(),
    action_required=FLAG,
    source_url=TEXT,
    source_name=TEXT,
    extracted_date=T.DateType(),
    year_month=TEXT,
    year_week=TEXT,
    day=TEXT,
)

DIM_ENTITIES = _fields(signal_id=TEXT, entity_name=TEXT, entity_type=TEXT, category=TEXT)

FEED_ENTRY = _fields(
    feed_url=TEXT,
    feed_title=TEXT,
    pos=T.LongType(),
    link=TEXT,
    title=TEXT,
    summary=TEXT,
    content=TEXT,
    published=TEXT,
    tags=TEXTS,
    authors=TEXTS,
)

ARCHIVE_DOCUMENT = _fields(
    ResultUrl=TEXT,
    Title=TEXT,
    Date=TEXT,
    DocumentType=TEXT,
    Source=_fields(Id=TEXT, Name=TEXT),
    Document=_fields(Content=TEXT),
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)

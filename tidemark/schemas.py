"""Schemas of the raw (Bronze) zone; sources read by these, never by inference."""

from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType(), "strings": ArrayType(StringType())}


def _schema(**fields: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields.items()])


NEWS = _schema(
    event_id="string", schema_version="int", event_type="string", source="string", url="string", title="string", summary="string",
    content="string", author="string", image_url="string", rulebased_tickers="strings", ner_tickers="strings", merged_tickers="strings",
    ticker_extraction_strategy="string", article_enrichment_status="string", content_length="int", published_at_raw="string",
    published_at_utc="string", published_at_vn="string", published_precision="string", collected_at_utc="string", ingest_date="string",
)

MARKET = _schema(
    event_id="string", schema_version="int", event_type="string", ticker="string", session_date="string", interval="string",
    open="double", high="double", low="double", close="double", volume="double", currency="string", price_adjustment="string",
    source="string", collected_at_utc="string", ingest_date="string",
)

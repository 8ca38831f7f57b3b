"""Crawl summary records and record shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# record type per preset (fixed values)
RECORD_TYPES = {"faq": "faq", "product": "production-description", "complex": "complex_get_data", "js": "js"}
# source-URL field name per preset
URL_FIELDS = {"faq": "faq_url", "product": "production_description_url",
              "complex": "complex_web_target_url", "js": "complex_web_target_js_url"}


def stringify_headers(headers) -> Column:
    """``MAP<BINARY, ARRAY<BINARY>>`` -> ``MAP<STRING, ARRAY<STRING>>`` (UTF-8).

    Null values stay null. (Non-byte, non-text, non-list values cannot occur in a
    typed map; the reference raises on them.)
    """
    h = F.col(headers) if isinstance(headers, str) else headers
    return F.map_from_entries(F.transform(
        F.map_entries(h),
        lambda e: F.struct(F.decode(e["key"], "UTF-8").alias("key"),
                           F.transform(e["value"], lambda v: F.decode(v, "UTF-8")).alias("value"))))


def stringify_value(value, nested: int = 2) -> Column:
    """H16 for a VARIANT: text stays, bytes become UTF-8 text, lists element by element, null stays null.

    Any other type (numbers, booleans, objects, times) is an error that names it. Lists may hold lists, ``nested`` deep.
    """
    v = F.col(value) if isinstance(value, str) else value
    kind = F.schema_of_variant(v)
    bad = F.raise_error(F.concat(F.lit("unsupported value type "), kind)).cast("variant")
    text = F.decode(F.try_variant_get(v, "$", "binary"), "UTF-8").cast("variant")
    items = bad
    if nested:
        items = F.to_variant_object(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: stringify_value(x, nested - 1)))
    return (F.when(v.isNull() | (kind == "VOID"), F.lit(None).cast("variant")).when(kind == "STRING", v)
            .when(kind == "BINARY", text).when(kind.startswith("ARRAY"), items).otherwise(bad))


def stringify_typed_headers(headers) -> Column:
    """``MAP<BINARY, VARIANT>`` -> ``MAP<STRING, VARIANT>`` whose values are text, lists of text or null."""
    h = F.col(headers) if isinstance(headers, str) else headers
    return F.map_from_entries(F.transform(
        F.map_entries(h), lambda e: F.struct(F.decode(e["key"], "UTF-8").alias("key"), stringify_value(e["value"]).alias("value"))))


def crawl_summary(exchanges: DataFrame, request_headers: str = "req_headers", response_headers: str = "resp_headers",
                  meta: str = "meta", flags: str = "flags") -> DataFrame:
    """Request and response summary structs, ``crawl_meta`` (VARIANT, any shape) and ``crawl_flags`` (array of text).

    Headers are typed maps of byte lists, or maps of VARIANT values.
    """
    def headers(c: str) -> Column:
        typed = exchanges.schema[c].dataType.valueType.typeName() == "variant"
        return stringify_typed_headers(c) if typed else stringify_headers(c)

    out = exchanges.withColumn("request_summary", F.struct(
        F.col("req_url").alias("url"), F.col("method").alias("method"), headers(request_headers).alias("headers")))
    out = out.withColumn("response_summary", F.struct(
        F.col("url").alias("url"), F.col("status").alias("status"), headers(response_headers).alias("headers")))
    return out.withColumnsRenamed({meta: "crawl_meta", flags: "crawl_flags"})


def drop_bulky(df: DataFrame) -> DataFrame:
    """Remove the raw response and the processed html before writing."""
    return df.drop(*[c for c in ("response", "html_processed", "html", "req_headers", "resp_headers") if c in df.columns])


def tag_records(df: DataFrame, kind: str) -> DataFrame:
    """Source URL under the preset's field name plus the constant ``type``."""
    return df.withColumn(URL_FIELDS[kind], F.col("url")).withColumn("type", F.lit(RECORD_TYPES[kind]))


def to_json_record(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One JSON document per row (non-ASCII kept as is)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("json"))

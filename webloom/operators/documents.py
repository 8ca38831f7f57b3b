"""Nested documents: one per kept page, with its map of targets, as the record files hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.operators.summary import RECORD_TYPES, URL_FIELDS

# field that holds a record's targets, per preset (fixed values)
TARGET_FIELDS = {"faq": "target_faq_div_xpath", "product": "production_description_div",
                 "complex": "complex_web_target", "js": "complex_web_target_js"}
TARGETS_TYPE = "map<string,array<string>>"
KEYS = ["page_id", "site", "type", "url"]


def documents(long: DataFrame) -> DataFrame:
    """``(page_id, site, type, url, targets)`` from the long form of an extraction.

    Pages without any value have no rows in the long form and get no document (F8); a target's values keep their
    document order. Targets are sorted by name, so equal documents have equal text.
    """
    per_target = long.groupBy(*KEYS, "target").agg(F.sort_array(F.collect_list(F.struct("idx", "value"))).alias("v"))
    listed = F.sort_array(F.collect_list(F.struct("target", F.transform("v", lambda x: x["value"]).alias("values"))))
    return per_target.groupBy(*KEYS).agg(F.map_from_entries(listed).alias("targets"))


def _of_type(build) -> Column:
    """``build(kind)`` of the row's record type."""
    out = F.lit(None)
    for kind, name in RECORD_TYPES.items():
        out = F.when(F.col("type") == name, build(kind)).otherwise(out)
    return out


def json_text(extra: list[str] | None = None) -> Column:
    """The document as JSON, its fields named as its type names them; ``extra`` columns come along under their names."""
    extra = [F.col(c) for c in (extra or [])]
    return _of_type(lambda kind: F.to_json(F.struct(
        "page_id", *extra, F.col("targets").alias(TARGET_FIELDS[kind]), F.col("url").alias(URL_FIELDS[kind]), "type"))).cast("string")


def parse(lines: DataFrame, json: str = "value") -> DataFrame:
    """``(page_id, type, url, targets)`` of JSON documents of any type, other columns kept."""
    schema = "page_id bigint, type string, " + ", ".join(
        [f"{f} {TARGETS_TYPE}" for f in TARGET_FIELDS.values()] + [f"{f} string" for f in URL_FIELDS.values()])
    rest = [c for c in lines.columns if c != json]
    d = lines.select(*rest, F.from_json(json, schema).alias("d"))
    pick = lambda fields: F.coalesce(*[F.col("d")[f] for f in fields.values()])
    return d.select(*rest, "d.page_id", "d.type", pick(URL_FIELDS).alias("url"), pick(TARGET_FIELDS).alias("targets"))


def variant_records(docs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """U4: differently shaped records as one table: typed key columns and the whole document as a VARIANT payload."""
    return docs.select(*[c for c in KEYS if c in docs.columns], F.parse_json(json_text(extra)).alias("payload"))


def variant_values(records: DataFrame) -> DataFrame:
    """``(page_id, site, type, url, field, target, idx, value)``: the values in the payloads of ``variant_records``, whatever
    their type's field is called."""
    fields = ", ".join(f"'{f}'" for f in TARGET_FIELDS.values())
    return records.sparkSession.sql(f"""
        SELECT r.page_id, r.site, r.type, r.url, f.key AS field, t.key AS target, CAST(v.pos AS BIGINT) AS idx, variant_get(v.value, '$', 'string') AS value
        FROM {{records}} AS r, LATERAL variant_explode(r.payload) AS f, LATERAL variant_explode(f.value) AS t,
             LATERAL variant_explode(t.value) AS v
        WHERE f.key IN ({fields})""", records=records)

"""Site-config source.

A config file becomes two tables: ``sites`` (one row per site) and ``rules`` (structured rule steps, see
``webloom.operators.rules``). Rules arrive as structured steps: no XPath parser is built.

``read_configs`` reads JSON files with Spark, from any store it reaches, as VARIANT. ``read_sites`` reads YAML or JSON
files on the driver (config, not data) into ``sites`` alone.
"""

from __future__ import annotations

import glob
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

try:  # PyYAML is optional; JSON configs work without it
    import yaml  # type: ignore
except Exception:  # pragma: no cover
    yaml = None

SITES_SCHEMA = T.StructType([
    T.StructField("site", T.StringType(), False),
    T.StructField("kind", T.StringType(), True),
    T.StructField("start_urls", T.ArrayType(T.StringType()), True),
    T.StructField("allowed_domains", T.ArrayType(T.StringType()), True),
    # NULL = no restriction, empty = nothing allowed
    T.StructField("fragments", T.ArrayType(T.StringType()), True),
    T.StructField("strip", T.BooleanType(), True),
    T.StructField("target_div", T.StringType(), True),
    T.StructField("config_json", T.StringType(), True),
])


def load_config_file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json") or yaml is None:
        return json.loads(text)
    return yaml.safe_load(text)


def site_name(path: str) -> str:
    """Site = file name up to the first '.'."""
    return os.path.basename(path).split(".", 1)[0]


def config_to_site_row(site: str, cfg: dict, kind: str | None = None) -> tuple:
    frag = cfg.get("further_allowed_domains", None)
    strip = cfg.get("data_deal", None)
    return (
        site,
        kind or cfg.get("kind"),
        list(cfg.get("start_urls") or []),
        list(cfg.get("allowed_domains") or []),
        None if frag is None else list(frag or []),
        None if strip is None else bool(strip),
        cfg.get("target_div"),
        json.dumps(cfg, ensure_ascii=False, sort_keys=True),
    )


def list_config_files(config_dir: str, names: list[str] | None = None) -> list[str]:
    """S3: every config file in a directory, or only the named sites."""
    files = sorted(glob.glob(os.path.join(config_dir, "*.yml")) + glob.glob(os.path.join(config_dir, "*.yaml"))
                   + glob.glob(os.path.join(config_dir, "*.json")))
    if names is not None:
        files = [f for f in files if site_name(f) in set(names)]
    return files


def read_sites(spark: SparkSession, config_dir: str, names: list[str] | None = None) -> DataFrame:
    """S2+S3: one ``sites`` row per config file (all sites in one job)."""
    rows = [config_to_site_row(site_name(p), load_config_file(p)) for p in list_config_files(config_dir, names)]
    return spark.createDataFrame(rows, SITES_SCHEMA)


def sites_from_dicts(spark: SparkSession, configs: dict[str, dict]) -> DataFrame:
    rows = [config_to_site_row(k, v) for k, v in configs.items()]
    return spark.createDataFrame(rows, SITES_SCHEMA)


def config_value(config_json_col, path: str, type_: str = "string"):
    """Nested config access, e.g. ``config_value('config_json', '$.a.b')``."""
    from pyspark.sql import functions as F
    col = F.col(config_json_col) if isinstance(config_json_col, str) else config_json_col
    return F.variant_get(F.parse_json(col), path, type_)


STEPS_TYPE = "array<struct<axis: string, tag: string, attr: string, values: array<string>, pos: int>>"


def read_configs(spark: SparkSession, path: str, names: list[str] | None = None, glob: str = "*.json") -> DataFrame:
    """S3: ``(site, config VARIANT)``, one row per JSON file below ``path``, or only those of the named sites.

    The site is the config's own ``site`` if it has one, else the file's name up to its first '.'. A file that is no
    JSON fails the job.
    """
    from pyspark.sql import functions as F
    files = spark.read.option("wholetext", True).option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    config = files.select(F.split_part(F.col("_metadata.file_name"), F.lit("."), F.lit(1)).alias("file"), F.parse_json("value").alias("config"))
    site = F.coalesce(F.variant_get("config", "$.site", "string"), F.col("file"))
    out = config.select(site.alias("site"), "config")
    return out if names is None else out.where(F.col("site").isin(names))


def config_sites(configs: DataFrame) -> DataFrame:
    """The ``sites`` table of ``read_configs``. A missing or null list of fragments is no restriction, an empty one
    allows nothing."""
    from pyspark.sql import functions as F
    get = lambda path, kind: F.variant_get("config", path, kind)
    none = F.array().cast("array<string>")
    return configs.select(
        "site", get("$.kind", "string").alias("kind"),
        F.coalesce(get("$.start_urls", "array<string>"), none).alias("start_urls"),
        F.coalesce(get("$.allowed_domains", "array<string>"), none).alias("allowed_domains"),
        get("$.further_allowed_domains", "array<string>").alias("fragments"), get("$.data_deal", "boolean").alias("strip"),
        get("$.target_div", "string").alias("target_div"), F.to_json("config").alias("config_json"))


def config_rules(configs: DataFrame) -> DataFrame:
    """The ``rules`` table of ``read_configs``: ``rules`` maps a target to its alternatives, each a list of steps.

    One row per site, target and alternative; a step's missing fields are null.
    """
    return configs.sparkSession.sql(f"""
        SELECT c.site, t.key AS target, a.pos AS alt, variant_get(a.value, '$', '{STEPS_TYPE}') AS steps
        FROM {{configs}} AS c, LATERAL variant_explode(variant_get(c.config, '$.rules', 'variant')) AS t,
             LATERAL variant_explode(t.value) AS a""", configs=configs)


def config_text(site: str, config: dict, rules: dict | None = None) -> str:
    """A config as the JSON text that ``read_configs`` reads; ``rules`` as in ``operators.rules.rules_df``."""
    steps = {target: [[dict(zip(("axis", "tag", "attr", "values", "pos"), s)) for s in alt] for alt in alts] for target, alts in (rules or {}).items()}
    return json.dumps({"site": site, **config, "rules": steps}, ensure_ascii=False)


# Site configs over the test corpus (hand-made, like the four shipped samples):
# one site per top-level domain of the generated pages, with the three fragment
# cases (no restriction / some fragments / nothing allowed).
CORPUS_SITES = {
    "news_com": {"kind": "faq", "allowed_domains": ["example.com"],
                 "start_urls": [], "data_deal": False},
    "news_net": {"kind": "product", "allowed_domains": ["example.net"],
                 "further_allowed_domains": ["/en/", "/de/", "utm_source"], "start_urls": [], "data_deal": True},
    "blogs_org": {"kind": "complex", "allowed_domains": ["example.org"],
                  "further_allowed_domains": [], "start_urls": [], "data_deal": True},
    "spam": {"kind": "js", "allowed_domains": ["spam-farm.example.org", "cheap-pills.example.com"],
             "further_allowed_domains": [".html", "#top"], "start_urls": [], "data_deal": True},
}

# One site covering the whole test corpus (used by the rule queries).
CORPUS_WIDE_SITE = {"kind": "faq", "allowed_domains": ["example.com", "example.net", "example.org"],
                    "start_urls": [], "data_deal": True}

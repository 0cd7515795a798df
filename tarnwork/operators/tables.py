"""The relational model: explicit schemas of all base tables, and a bundle of DataFrames by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The column lists of the model, as DDL.
SCHEMAS: dict[str, str] = {
    "cve": "cve_id string, title string, cna string, summary string, technical_details string, published string, modified string, discovered string, priority_score int, confidence double, data_version string, data_type string, state string, assigner_org_id string, vuln_status string, source_identifier string",
    "vendor": "vendor_id bigint, name string, website string, country string",
    "cve_vendor": "cve_id string, vendor_id bigint, role string",
    "product": "product_id bigint, name string, vendor_id bigint, product_type string, family string, component string",
    "affected_product": "id bigint, cve_id string, product_id bigint, affected boolean, notes string, source string",
    "product_cpe_vendor": "product_id bigint, slug string, n bigint",
    "cve_cpe_vendor": "cve_id string, slug string",
    "product_candidate": "cve_id string, product_id bigint, matched_text string",
    "version_range": "id bigint, affected_product_id bigint, start_including string, start_excluding string, end_including string, end_excluding string, fixed_version string, raw_text string",
    "cwe": "cwe_id string, name string, description string",
    "cve_cwe": "cve_id string, cwe_id string",
    "cvss": "id bigint, cve_id string, version string, score double, vector string, severity string, attack_vector string, attack_complexity string, privileges_required string, user_interaction string, scope string, confidentiality_impact string, integrity_impact string, availability_impact string, metric_source string, metric_type string, exploitability_score double, impact_score double",
    "exploit": "cve_id string, maturity string, public_poc boolean, metasploit boolean, ransomware_usage boolean, in_the_wild boolean, notes string",
    "exploit_artefact": "id bigint, cve_id string, source string, stable_id string, url string, artefact_type string, platform string, published_date string, confidence string",
    "kev": "cve_id string, listed boolean, date_added string, due_date string, notes string, vulnerability_name string, required_action string, vendor_project string, product_label string, short_description string, source string",
    "intel": "cve_id string, epss_score double, epss_percentile double",
    "intel_string_list": "id bigint, cve_id string, kind string, value string",
    "cpe_match": "id bigint, cve_id string, criteria string, match_criteria_id string, vulnerable boolean",
    "reference": "id bigint, cve_id string, url string, source string, title string, trust string",
    "reference_tag": "reference_id bigint, tag string",
    "tag": "id bigint, name string",
    "cve_tag": "cve_id string, tag_id bigint",
    "pipeline_run": "phase string, last_completed_at string, last_watermark string",
}
CVE_CHILDREN = ("cve_vendor", "affected_product", "cve_cwe", "cvss", "exploit", "exploit_artefact", "kev", "intel", "intel_string_list", "cpe_match", "reference", "cve_tag", "cve_cpe_vendor", "product_candidate")
AXES = ("attack_vector", "attack_complexity", "privileges_required", "user_interaction", "scope", "confidentiality_impact", "integrity_impact", "availability_impact")


class Tables(dict):
    """name -> DataFrame; a table is built by `loader` when it is first asked for, and is empty if nothing makes it."""

    def __init__(self, spark: SparkSession, given: dict[str, DataFrame] | None = None, loader: Callable[..., DataFrame | None] | None = None):
        super().__init__(given or {})
        self.spark, self.loader, self.given = spark, loader, frozenset(given or ())

    def __missing__(self, name: str) -> DataFrame:
        made = self.loader(name) if self.loader else None
        self[name] = self.spark.createDataFrame([], SCHEMAS[name]) if made is None else made
        return self[name]

    def by(self, name: str, key: str) -> DataFrame:
        """The table for use by key: a loader that deals its rows out deals them by that."""
        made = self.loader(name, key) if self.loader and name not in self.given else None
        return self[name] if made is None else made

    def replaced(self, **new: DataFrame) -> Tables:
        return Tables(self.spark, {**self, **new}, self.loader)


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """df with exactly the table's columns, cast; columns that it lacks are null."""
    from pyspark.sql import functions as F

    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(have[f.name]) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name)])

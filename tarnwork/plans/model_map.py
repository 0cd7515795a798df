"""The test tables read as the relational model: orders are records, lineitem their scores and products, and so on.

Each model table is one projection whose expressions mean the same in Spark SQL and DuckDB, so that a query and
its oracle see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.lineage import parts_of
from ..operators.tables import Tables, conform

_D = "substring(cast(o_orderdate as string), 1, 10)"
_CVE = "'CVE-' || cast(o_orderkey as string)"
_LCVE = "'CVE-' || cast(l_orderkey as string)"
_ECVE = "'CVE-' || cast(user_id as string)"


def _shift(sign: str, k: int, tail: str) -> str:
    return f"cast(cast(substring({_D}, 1, 4) as int) {sign} cast(o_orderkey % {k} as int) as string) || substring({_D}, 5, 6) || '{tail}'"


# name: (source, distinct, filter, {column: expression})
MODEL: dict[str, tuple[str, bool, str, dict[str, str]]] = {
    "cve": ("orders", False, "true", {
        "cve_id": _CVE, "title": "o_orderpriority || ' record ' || cast(o_custkey as string)", "summary": "o_orderpriority || ' seen in state ' || o_orderstatus",
        "cna": "case when o_custkey % 17 = 0 then '' when o_custkey % 19 = 0 then null else 'org' || cast(o_custkey % 23 as string) end",
        "published": f"case when o_orderkey % 41 = 0 then '' when o_orderkey % 43 = 0 then null else {_D} || 'T10:00:00+00:00' end",
        "modified": f"case when o_orderkey % 11 = 0 then '' else {_shift('+', 3, 'T08:30:00+00:00')} end",
        "discovered": f"case when o_orderkey % 4 = 0 then null else {_shift('-', 2, 'T12:00:00+00:00')} end",
        "assigner_org_id": "case when o_custkey % 13 = 0 then ' ' else 'a' || cast(o_custkey % 40 as string) end",
        "vuln_status": "case o_orderstatus when 'F' then 'Analyzed' when 'O' then 'Modified' else '' end",
    }),
    "vendor": ("supplier", False, "true", {"vendor_id": "s_suppkey", "name": "case when s_suppkey % 10 = 3 then '' else s_name end"}),
    "cve_vendor": ("lineitem", True, "true", {"cve_id": _LCVE, "vendor_id": "l_suppkey", "role": "case when l_linenumber % 2 = 1 then 'primary' else 'affected' end"}),
    "product": ("part", False, "true", {"product_id": "p_partkey", "name": "case when p_partkey % 29 = 0 then 'n/a' else p_name end", "vendor_id": "p_partkey % 10 + 1", "product_type": "case when p_size % 7 = 0 then '' else p_brand end", "component": "''"}),
    "affected_product": ("lineitem", True, "true", {"id": "l_orderkey * 1000000 + l_partkey", "cve_id": _LCVE, "product_id": "l_partkey", "affected": "l_partkey % 2 = 0", "source": "case l_partkey % 3 when 0 then 'cpe' when 1 then 'cna' end"}),
    "version_range": ("lineitem", True, "l_partkey % 5 <> 0", {"id": "l_orderkey * 1000000 + l_partkey", "affected_product_id": "l_orderkey * 1000000 + l_partkey", "raw_text": "'v' || cast(l_partkey as string)"}),
    "cwe": ("nation", False, "true", {"cwe_id": "'CWE-' || cast(n_nationkey as string)", "name": "n_name"}),
    "cve_cwe": ("lineitem", True, "true", {"cve_id": _LCVE, "cwe_id": "'CWE-' || cast(l_suppkey % 25 as string)"}),
    "cvss": ("lineitem", False, "true", {
        "id": "l_orderkey * 1000000 + l_partkey", "cve_id": _LCVE, "score": "l_quantity / 5", "attack_vector": "case l_returnflag when 'A' then 'NETWORK' when 'N' then 'LOCAL' else '' end",
        "attack_complexity": "case when l_linenumber > 3 then 'HIGH' else 'LOW' end", "privileges_required": "case when l_linestatus = 'O' then 'NONE' else 'LOW' end", "user_interaction": "case when l_linenumber % 3 = 0 then 'REQUIRED' else 'NONE' end",
        "scope": "case when l_partkey % 4 = 0 then null else 'UNCHANGED' end", "confidentiality_impact": "case when l_suppkey % 2 = 0 then 'HIGH' else 'NONE' end", "integrity_impact": "case when l_suppkey % 3 = 0 then 'HIGH' else 'LOW' end", "availability_impact": "case when l_suppkey % 5 = 0 then ' ' else 'HIGH' end",
        "exploitability_score": "case when l_partkey % 9 = 0 then null else l_discount * 40 end", "impact_score": "l_tax * 70 + 0.0",
    }),
    "exploit": ("orders", False, "true", {"cve_id": _CVE, "maturity": "case when o_orderkey % 6 = 0 then 'FUNCTIONAL' when o_orderkey % 6 = 1 then ' ' when o_orderkey % 6 = 2 then null else 'POC' end", "public_poc": "case o_orderkey % 3 when 0 then true when 1 then false end", "metasploit": "case o_orderkey % 7 when 0 then true when 1 then false end", "ransomware_usage": "o_orderkey % 31 = 0", "in_the_wild": "o_custkey % 9 = 0"}),
    "exploit_artefact": ("events", False, "true", {"id": "event_id", "cve_id": _ECVE, "source": "event_type", "stable_id": "cast(event_id as string)", "url": "'https://x/' || cast(event_id as string)", "published_date": "substring(cast(ts as string), 1, 10)", "confidence": "case when event_id % 3 = 0 then 'high' else 'low' end"}),
    "kev": ("orders", False, "o_orderkey % 5 = 0", {"cve_id": _CVE, "listed": "o_orderkey % 10 = 0", "date_added": f"case when o_orderkey % 70 = 0 then '' else {_shift('+', 2, '')} end", "due_date": f"case when o_orderkey % 60 = 0 then null else {_shift('+', 3, '')} end", "required_action": "o_orderpriority", "vendor_project": "case when o_custkey % 8 = 0 then ' ' else ' v' || cast(o_custkey % 37 as string) end", "product_label": "'p' || cast(o_custkey % 61 as string)", "source": "case when o_custkey % 3 = 0 then 'cisa' when o_custkey % 3 = 1 then 'nvd' else '' end"}),
    "intel": ("orders", False, "o_orderkey % 4 <> 1", {"cve_id": _CVE, "epss_score": "case when o_orderkey % 7 = 0 then null else (o_custkey % 1000) / 1000.0e0 end", "epss_percentile": "case when o_orderkey % 7 = 0 then null else (o_custkey % 1009) / 1000.0e0 end"}),
    "intel_string_list": ("events", False, "true", {"id": "event_id", "cve_id": _ECVE, "kind": "case when event_id % 11 = 0 then '' else event_type end", "value": "' v' || cast(event_id % 90 as string)"}),
    "cpe_match": ("lineitem", False, "true", {"id": "l_orderkey * 1000000 + l_partkey", "cve_id": _LCVE, "criteria": "'cpe:2.3:a:' || case when l_orderkey % 6 = 5 then '*' when l_orderkey % 11 < 9 then 'slug_1' else 'slug_' || cast(l_orderkey % 6 as string) end || ':prod_' || cast(l_partkey % 200 as string) || ':*:*'", "match_criteria_id": "case when l_linenumber % 4 = 0 then null else cast(l_linenumber as string) end", "vulnerable": "l_linenumber % 3 <> 0"}),
    "reference": ("events", False, "true", {"id": "event_id", "cve_id": _ECVE, "url": "'https://s' || cast(user_id % 30 as string) || '.example/' || cast(event_id as string)", "source": "case when event_id % 13 = 0 then null else event_type end", "trust": "case when event_id % 5 = 0 then 'VENDOR' when event_id % 5 = 1 then '' else 'COMMUNITY' end"}),
    "reference_tag": ("events", False, "event_id % 3 <> 0", {"reference_id": "event_id", "tag": "case when event_id % 4 = 0 then 'Patch' when event_id % 4 = 1 then ' exploit' else event_type end"}),
    "pipeline_run": ("region", False, "true", {"phase": "lower(r_name)", "last_completed_at": "'2024-01-0' || cast(r_regionkey + 1 as string) || 'T00:00:00+00:00'", "last_watermark": "cast(r_regionkey as string)"}),
}


def model_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All model tables, each read when a query first asks for it."""

    def load(name: str, key: str | None = None) -> DataFrame | None:
        if name not in MODEL:
            return None
        source, distinct, keep, columns = MODEL[name]
        path = f"{sf_dir}/{source}.parquet"
        df = spark.read.parquet(path).where(keep).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        if distinct:  # few rows repeat, so these are dealt by record once, which the joins and counts by record then need not do again
            df = df.repartition(parts_of(spark, path), key or ("cve_id" if "cve_id" in columns else "affected_product_id")).distinct()
        return conform(df, name)

    return Tables(spark, loader=load)


def prelude() -> str:
    """The same tables as DuckDB CTEs; `reference` is named refs."""
    parts = []
    for name, (source, distinct, keep, columns) in MODEL.items():
        alias = "refs" if name == "reference" else name
        parts.append(f"{alias} AS (SELECT {'DISTINCT ' if distinct else ''}{', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source} WHERE {keep})")
    parts += [
        "pub AS (SELECT *, try_cast(published AS TIMESTAMP) AS pts FROM cve WHERE trim(coalesce(published, '')) <> '')",
        "cmax AS (SELECT cve_id, max(score) AS cvss_max FROM cvss GROUP BY 1)",
        "named AS (SELECT vendor_id, name AS vendor_name FROM vendor WHERE trim(coalesce(name, '')) <> '')",
        "ve AS (SELECT e.cve_id, e.role, n.vendor_id, n.vendor_name FROM cve_vendor e JOIN pub USING (cve_id) JOIN named n USING (vendor_id))",
        "pcvss AS (SELECT s.* FROM cvss s JOIN pub USING (cve_id))",
        "pexp AS (SELECT s.* FROM exploit s JOIN pub USING (cve_id))",
        "part_ AS (SELECT s.* FROM exploit_artefact s JOIN pub USING (cve_id))",
        "pkev AS (SELECT s.*, p.pts, p.published AS pub_text FROM kev s JOIN pub p USING (cve_id) WHERE listed)",
        "pintel AS (SELECT s.* FROM intel s JOIN pub USING (cve_id))",
        "plist AS (SELECT s.* FROM intel_string_list s JOIN pub USING (cve_id))",
        "prefs AS (SELECT s.* FROM refs s JOIN pub USING (cve_id))",
    ]
    return "WITH " + ",\n".join(parts) + "\n"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

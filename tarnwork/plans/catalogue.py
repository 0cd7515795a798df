"""Registered queries of the reference's operator shapes, each with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import views as V
from .model_map import model_tables, prelude

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def on_model(name: str, build: Callable, sql: str | None, rounded: tuple[str, ...] = ()) -> None:
    """Register build(tables); the SQL sees the model's CTEs. `rounded` columns are rounded to 6 places on both sides."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(model_tables(spark, sf_dir))
        return df.withColumns({c: F.round(c, 6) for c in rounded})

    REGISTRY[name] = (run, prelude() + sql if sql else None)


def plain(name: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    REGISTRY[name] = (build, sql)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in REGISTRY.items() if s}


SEV = "CASE WHEN {0} IS NULL THEN 'UNKNOWN' WHEN {0} >= 9 THEN 'CRITICAL' WHEN {0} >= 7 THEN 'HIGH' WHEN {0} >= 4 THEN 'MEDIUM' WHEN {0} > 0 THEN 'LOW' ELSE 'NONE' END"
YM = "strftime({0}, '%Y-%m')"


def unset(c: str, label: str = "(unset)") -> str:
    return f"coalesce(nullif(trim({c}), ''), '{label}')"


def _views() -> None:
    sev = SEV.format("cvss_max")
    ym = YM.format("pts")
    # A counts and coverage
    on_model("overview_counts", V.overview, """SELECT (SELECT count(*) FROM cve) AS cves_total, (SELECT count(*) FROM pub) AS cves_in_window, (SELECT count(*) FROM pcvss) AS cvss_rows,
      (SELECT count(*) FROM pintel WHERE epss_score IS NOT NULL) AS with_epss, (SELECT count(*) FROM pkev) AS kev_listed, (SELECT count(DISTINCT vendor_id) FROM ve) AS vendors,
      (SELECT substr(min(published), 1, 10) FROM pub) AS first_published, (SELECT substr(max(published), 1, 10) FROM pub) AS last_published""")
    sources = {"cvss": "cvss", "epss": "intel WHERE epss_score IS NOT NULL", "kev": "kev WHERE listed", "cwe": "cve_cwe", "vendor": "cve_vendor JOIN named USING (vendor_id)", "product": "affected_product", "cpe": "cpe_match", "reference": "refs"}
    on_model("enrichment_coverage", V.enrichment_coverage, "SELECT e AS enrichment, present, total, round(present / total, 6) AS share FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS e, (SELECT count(*) FROM pub WHERE cve_id IN (SELECT cve_id FROM {v})) AS present" for k, v in sources.items()) + ") CROSS JOIN (SELECT count(*) AS total FROM pub)", ("share",))
    named = {"reference": "refs"}
    held = [n for n in V.ROW_COUNT_TABLES if n not in ("tag", "cve_tag")]
    on_model("table_row_counts", V.table_row_counts, " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS n_rows FROM {named.get(n, n)}" for n in held) + " UNION ALL SELECT 'tag', 0 UNION ALL SELECT 'cve_tag', 0")
    on_model("dimension_counts", V.dimension_counts, "SELECT " + ", ".join(f"(SELECT count(DISTINCT nullif(trim({c}), '')) FROM {t}) AS {a}" for t, c, a in (("cve", "cna", "cnas"), ("vendor", "name", "vendors"), ("product", "name", "products"), ("cwe", "cwe_id", "cwes"), ("refs", "source", "reference_sources"), ("reference_tag", "tag", "reference_tags"))))
    on_model("pipeline_runs", V.pipeline_runs, "SELECT phase, last_completed_at, last_watermark FROM pipeline_run")
    on_model("flag_totals", V.exploit_flag_totals, "SELECT count(*) AS total, count(*) FILTER (public_poc) AS public_poc, count(*) FILTER (metasploit) AS metasploit, count(*) FILTER (ransomware_usage) AS ransomware_usage, count(*) FILTER (in_the_wild) AS in_the_wild FROM pexp")
    on_model("artefact_totals", lambda t: V.artefact_totals(t, sources=("click", "view", "purchase")), "SELECT count(*) AS total, count(DISTINCT cve_id) AS cves, count(*) FILTER (source = 'click') AS click, count(*) FILTER (source = 'view') AS view, count(*) FILTER (source = 'purchase') AS purchase FROM part_")
    on_model("range_coverage", V.version_range_coverage, "SELECT count(*) AS affected, count(h.id) AS with_range, count(*) - count(h.id) AS without_range FROM affected_product a LEFT JOIN (SELECT DISTINCT affected_product_id AS id FROM version_range) h USING (id)")
    # B time series
    on_model("pub_monthly", V.publications_monthly, f"SELECT {ym} AS ym, count(*) AS n FROM pub WHERE pts IS NOT NULL GROUP BY 1")
    on_model("pub_yearly", V.publications_yearly, "SELECT strftime(pts, '%Y') AS y, count(*) AS n FROM pub GROUP BY 1")
    on_model("pub_yoy", V.publications_yoy, "SELECT CAST(year(pts) AS INT) AS year, CAST(month(pts) AS INT) AS month, count(*) AS n FROM pub WHERE pts IS NOT NULL GROUP BY 1, 2")
    on_model("pub_weekly", V.publications_weekly, "SELECT strftime(pts, '%Y-%W') AS yw, count(*) AS n FROM pub WHERE pts IS NOT NULL GROUP BY 1")
    on_model("kev_added_monthly", V.kev_added_monthly, "SELECT strftime(d, '%Y-%m') AS ym, count(*) AS n FROM (SELECT try_cast(substr(date_added, 1, 10) AS DATE) AS d FROM pkev) WHERE d IS NOT NULL GROUP BY 1")
    on_model("itw_monthly", V.in_the_wild_monthly, f"SELECT {ym} AS ym, count(*) AS n FROM pub JOIN exploit USING (cve_id) WHERE in_the_wild AND pts IS NOT NULL GROUP BY 1")
    on_model("rolling_mean_monthly", lambda t: V.rolling_mean(V.publications_monthly(t), "ym", "n", 3), f"SELECT ym, n, round(avg(n) OVER (ORDER BY ym ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling FROM (SELECT {ym} AS ym, count(*) AS n FROM pub WHERE pts IS NOT NULL GROUP BY 1)", ("rolling",))
    on_model("last_n_years", lambda t: V.last_years(V.publications_yoy(t), "year", 3), "SELECT year, month, n FROM (SELECT *, dense_rank() OVER (ORDER BY year DESC) AS rk FROM (SELECT CAST(year(pts) AS INT) AS year, CAST(month(pts) AS INT) AS month, count(*) AS n FROM pub WHERE pts IS NOT NULL GROUP BY 1, 2)) WHERE rk <= 3")
    on_model("two_phase_topk_monthly", lambda t: V.cna_monthly(t, top_k=10), f"SELECT {ym} AS ym, trim(cna) AS cna, count(*) AS n FROM pub WHERE pts IS NOT NULL AND trim(cna) IN (SELECT cna FROM (SELECT trim(cna) AS cna, count(*) AS n FROM pub WHERE trim(coalesce(cna, '')) <> '' GROUP BY 1 ORDER BY n DESC, cna LIMIT 10)) GROUP BY 1, 2")
    # C severities and buckets
    on_model("severity_distribution", V.severity_distribution, f"SELECT {sev} AS severity, count(*) AS n FROM pub LEFT JOIN cmax USING (cve_id) GROUP BY 1")
    on_model("severity_monthly", V.severity_monthly, f"SELECT {ym} AS ym, {sev} AS severity, count(*) AS n FROM pub LEFT JOIN cmax USING (cve_id) WHERE pts IS NOT NULL GROUP BY 1, 2")
    on_model("severity_windowed", lambda t: V.severity_distribution(t, "1995-01-01", "1996-06-30"), f"SELECT {sev} AS severity, count(*) AS n FROM pub LEFT JOIN cmax USING (cve_id) WHERE substr(published, 1, 10) BETWEEN '1995-01-01' AND '1996-06-30' GROUP BY 1")
    on_model("year_stats", V.cvss_year_stats, "SELECT strftime(pts, '%Y') AS pub_year, round(avg(cvss_max), 6) AS avg_max_cvss, count(*) AS n_cves_with_cvss, count(*) FILTER (cvss_max >= 9) AS n_critical FROM pub JOIN cmax USING (cve_id) GROUP BY 1", ("avg_max_cvss",))
    top_cwe = "(SELECT cwe_id, c.name AS cwe_name, count(*) AS n FROM cve_cwe JOIN pub USING (cve_id) JOIN cwe c USING (cwe_id) GROUP BY 1, 2 ORDER BY n DESC, cwe_id LIMIT 12)"
    on_model("cwe_totals", V.cwe_totals, f"SELECT * FROM {top_cwe}")
    on_model("cwe_monthly", lambda t: V.cwe_monthly(t, ["CWE-3", "CWE-7"]), f"SELECT {ym} AS ym, cwe_id, c.name AS cwe_name, count(*) AS n FROM pub JOIN cve_cwe USING (cve_id) JOIN cwe c USING (cwe_id) WHERE cwe_id IN ('CWE-3', 'CWE-7') AND pts IS NOT NULL GROUP BY 1, 2, 3")
    on_model("category_severity_heatmap", V.cwe_severity_heatmap, f"SELECT cwe_id, cwe_name, {sev} AS severity, count(*) AS n FROM cve_cwe JOIN pub USING (cve_id) JOIN {top_cwe} USING (cwe_id) LEFT JOIN cmax USING (cve_id) GROUP BY 1, 2, 3")
    on_model("decile_share", V.kev_share_by_decile, "SELECT CAST(CASE WHEN epss_percentile >= 1 THEN 9 WHEN epss_percentile < 0 THEN 0 ELSE trunc(epss_percentile * 10) END AS BIGINT) AS decile, count(*) AS n_total, count(k.cve_id) AS n_kev, round(count(k.cve_id) / count(*), 6) AS kev_share FROM pintel LEFT JOIN (SELECT DISTINCT cve_id FROM kev WHERE listed) k USING (cve_id) WHERE epss_percentile IS NOT NULL GROUP BY 1", ("kev_share",))
    due = "CASE WHEN d IS NULL THEN 'No due date' WHEN d < DATE '1997-01-01' THEN 'Overdue' WHEN d <= DATE '1997-01-31' THEN 'Due in 30 days' WHEN d <= DATE '1997-04-01' THEN 'Due in 90 days' ELSE 'Due later' END"
    on_model("due_buckets", lambda t: V.kev_due_buckets(t, "1997-01-01"), f"SELECT {due} AS bucket, count(*) AS n FROM (SELECT try_cast(substr(due_date, 1, 10) AS DATE) AS d FROM pkev) GROUP BY 1")
    mix = f"SELECT CASE WHEN k.cve_id IS NULL THEN 'non-KEV' ELSE 'KEV' END AS grp, {sev} AS severity, count(*) AS n FROM pub LEFT JOIN (SELECT DISTINCT cve_id FROM kev WHERE listed) k USING (cve_id) LEFT JOIN cmax USING (cve_id) GROUP BY 1, 2"
    on_model("kev_severity_mix", V.kev_severity_mix, mix)
    on_model("share_within_group", lambda t: V.share_within(V.kev_severity_mix(t), "grp", "n"), f"SELECT grp, severity, n, round(n / sum(n) OVER (PARTITION BY grp), 6) AS share FROM ({mix})", ("share",))
    wide = lambda x, lo, hi, k: f"CAST(CASE WHEN {hi} <= {lo} THEN 1 ELSE greatest(1, least({k}, ceil(({x} - {lo}) / (({hi} - {lo}) / {k})))) END AS BIGINT)"
    on_model("density_2d", V.epss_density, f"SELECT {wide('epss_percentile', 'p0', 'p1', 20)} AS pct_bin, {wide('cvss_max', 'c0', 'c1', 11)} AS cvss_bin, count(*) AS n FROM (SELECT *, min(epss_percentile) OVER () AS p0, max(epss_percentile) OVER () AS p1, min(cvss_max) OVER () AS c0, max(cvss_max) OVER () AS c1 FROM pintel JOIN cmax USING (cve_id) WHERE epss_percentile IS NOT NULL AND cvss_max IS NOT NULL) GROUP BY 1, 2")
    on_model("epss_scores", V.epss_scores, "SELECT epss_score FROM pintel WHERE epss_score IS NOT NULL")
    on_model("epss_histogram", V.epss_histogram, "SELECT CAST(CASE WHEN epss_score < 0 THEN 0 WHEN epss_score >= 1 THEN 60 ELSE trunc(60 * epss_score) + 1 END AS BIGINT) AS bin, count(*) AS n FROM pintel WHERE epss_score IS NOT NULL GROUP BY 1")
    # D top lists and distributions
    on_model("top_vendors", V.vendors_aggregate, "SELECT vendor_name, count(DISTINCT cve_id) AS cve_count FROM ve GROUP BY 1 ORDER BY cve_count DESC, vendor_name LIMIT 28")
    on_model("top_vendors_role", V.top_vendors, "SELECT vendor_name, role, count(DISTINCT cve_id) AS cve_count FROM ve GROUP BY 1, 2 ORDER BY cve_count DESC, vendor_name, role LIMIT 28")
    on_model("top_vendor_ids", V.top_vendor_ids, "SELECT vendor_id, vendor_name, count(DISTINCT cve_id) AS cve_count FROM ve GROUP BY 1, 2 ORDER BY cve_count DESC, vendor_id LIMIT 28")
    on_model("role_totals", V.vendor_role_totals, "SELECT role, count(DISTINCT cve_id) AS distinct_cves, count(*) AS edges FROM ve GROUP BY 1")
    on_model("role_mix", V.vendor_role_mix, """SELECT vendor_name, count(*) FILTER (p AND NOT a) AS cves_primary_only, count(*) FILTER (a AND NOT p) AS cves_affected_only, count(*) FILTER (a AND p) AS cves_both_roles, CAST(sum(ep) AS BIGINT) AS edge_primary, CAST(sum(ea) AS BIGINT) AS edge_affected
      FROM (SELECT vendor_id, vendor_name, cve_id, bool_or(role = 'primary') AS p, bool_or(role = 'affected') AS a, count(*) FILTER (role = 'primary') AS ep, count(*) FILTER (role = 'affected') AS ea FROM ve GROUP BY 1, 2, 3) GROUP BY 1 ORDER BY count(*) DESC, vendor_name LIMIT 100""")
    on_model("assigner_share", V.assigner_share, "SELECT trim(assigner_org_id) AS org, count(*) AS n, round(count(*) / (SELECT count(*) FROM pub), 6) AS share FROM pub WHERE trim(assigner_org_id) <> '' GROUP BY 1 ORDER BY n DESC, org LIMIT 24", ("share",))
    on_model("top_n_plus_other", lambda t: V.top_and_other(V.assigner_share(t, n=40), "org", "n"), "SELECT CASE WHEN rn <= 12 THEN org ELSE 'Other' END AS org, CAST(sum(n) AS BIGINT) AS n FROM (SELECT *, row_number() OVER (ORDER BY n DESC, org) AS rn FROM (SELECT trim(assigner_org_id) AS org, count(*) AS n FROM pub WHERE trim(assigner_org_id) <> '' GROUP BY 1 ORDER BY n DESC, org LIMIT 40)) GROUP BY 1")
    on_model("top_products", V.top_products, "SELECT vendor_name, p.name AS product_name, count(DISTINCT cve_id) AS n FROM affected_product a JOIN pub USING (cve_id) JOIN product p USING (product_id) JOIN named v ON v.vendor_id = p.vendor_id WHERE trim(coalesce(p.name, '')) <> '' GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 24")
    on_model("vendors_by_products", V.vendors_by_products, "SELECT vendor_name, count(DISTINCT product_id) AS n_products FROM product JOIN named USING (vendor_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 24")
    on_model("label_dist_unset", V.maturity_distribution, f"SELECT {unset('maturity', 'NONE')} AS maturity, count(*) AS n FROM pexp GROUP BY 1")
    on_model("label_dist_raw", lambda t: V.maturity_distribution(t, group_on="raw"), f"SELECT {unset('m', 'NONE')} AS maturity, n FROM (SELECT maturity AS m, count(*) AS n FROM pexp GROUP BY maturity)")
    on_model("product_types", V.product_types, f"SELECT {unset('product_type', 'UNKNOWN')} AS product_type, count(*) AS n FROM product GROUP BY 1")
    on_model("status_dist", V.status_distribution, f"SELECT {unset('vuln_status')} AS vuln_status, count(*) AS n FROM pub GROUP BY 1")
    on_model("status_by_year", V.status_by_year, f"SELECT strftime(pts, '%Y') AS year, {unset('vuln_status')} AS vuln_status, count(*) AS n FROM pub GROUP BY 1, 2")
    on_model("recency_heatmap", V.recency_heatmap, "SELECT strftime(m, '%Y') AS mod_year, strftime(pts, '%Y') AS pub_year, count(*) AS n FROM (SELECT *, try_cast(modified AS TIMESTAMP) AS m FROM pub) WHERE m IS NOT NULL AND pts IS NOT NULL GROUP BY 1, 2")
    axes = " UNION ALL ".join(f"SELECT '{a}' AS axis, {unset(a)} AS value FROM pcvss" for a in V.AXES)
    on_model("axis_dist_unpivot", V.axis_distribution, f"SELECT axis, value, count(*) AS n FROM ({axes}) GROUP BY 1, 2")
    on_model("av_pr_heatmap", V.vector_privilege_heatmap, f"SELECT {unset('attack_vector')} AS av, {unset('privileges_required')} AS pr, count(*) AS n FROM pcvss GROUP BY 1, 2")
    on_model("per_key_hist", V.cpe_per_cve, "SELECT matches, count(*) AS cves FROM (SELECT cve_id, count(*) AS matches FROM cpe_match JOIN pub USING (cve_id) GROUP BY 1) GROUP BY 1")
    on_model("refs_per_cve", V.references_per_cve, "SELECT refs, count(*) AS cves FROM (SELECT cve_id, count(*) AS refs FROM prefs GROUP BY 1) GROUP BY 1")
    on_model("hist_clamped", lambda t: V.clamp_tail(V.cpe_per_cve(t), "matches", "cves", 5), "SELECT least(m, 5) AS matches, CAST(sum(c) AS BIGINT) AS cves, CASE WHEN least(m, 5) >= 5 THEN '5+' ELSE CAST(least(m, 5) AS VARCHAR) END AS label FROM (SELECT m, count(*) AS c FROM (SELECT cve_id, count(*) AS m FROM cpe_match JOIN pub USING (cve_id) GROUP BY 1) GROUP BY 1) GROUP BY 1, 3")
    on_model("artefact_top", V.top_artefact_cves, "SELECT a.cve_id, title, count(*) AS artefacts, count(DISTINCT source) AS sources FROM exploit_artefact a JOIN pub USING (cve_id) GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20")
    on_model("artefact_sources", V.artefact_sources, "SELECT source, confidence, count(*) AS n FROM part_ GROUP BY 1, 2")
    on_model("kev_sources", V.kev_source_split, f"SELECT {unset('source')} AS source, count(*) AS n FROM pkev GROUP BY 1")
    for name, c in (("kev_vendor_top", "vendor_project"), ("kev_product_top", "product_label"), ("kev_action_top", "required_action")):
        on_model(name, {"vendor_project": V.kev_top_vendor_project, "product_label": V.kev_top_product_label, "required_action": V.kev_top_required_action}[c], f"SELECT trim({c}) AS {c}, count(*) AS n FROM pkev WHERE trim(coalesce({c}, '')) <> '' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 24")
    on_model("ref_sources_top", V.top_reference_sources, f"SELECT {unset('source')} AS source, count(*) AS n FROM prefs GROUP BY 1 ORDER BY n DESC, 1 LIMIT 24")
    on_model("ref_trust", V.reference_trust, f"SELECT {unset('trust')} AS trust, count(*) AS n FROM prefs GROUP BY 1")
    on_model("ref_tags_top", V.reference_tags, "SELECT trim(tag) AS tag, count(*) AS n FROM prefs r JOIN reference_tag g ON g.reference_id = r.id WHERE trim(coalesce(tag, '')) <> '' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 24")
    on_model("tag_coverage_yearly", lambda t: V.tag_coverage_yearly(t, ["patch"]), "SELECT strftime(pts, '%Y') AS year, count(*) AS n_total, count(g.cve_id) AS n_tagged, round(count(g.cve_id) / count(*), 6) AS share FROM pub LEFT JOIN (SELECT DISTINCT r.cve_id FROM refs r JOIN reference_tag t ON t.reference_id = r.id WHERE lower(trim(tag)) = 'patch') g USING (cve_id) GROUP BY 1", ("share",))
    on_model("poc_tag_coverage_yearly", lambda t: V.tag_coverage_yearly(t, X.POC_TAGS), "SELECT strftime(pts, '%Y') AS year, count(*) AS n_total, count(g.cve_id) AS n_tagged, round(count(g.cve_id) / count(*), 6) AS share FROM pub LEFT JOIN (SELECT DISTINCT r.cve_id FROM refs r JOIN reference_tag t ON t.reference_id = r.id WHERE lower(trim(tag)) IN ('exploit', 'x_refsource_exploit-db', 'signature')) g USING (cve_id) GROUP BY 1", ("share",))
    on_model("intel_kinds", V.intel_kinds, f"SELECT {unset('kind')} AS kind, count(*) AS n FROM plist GROUP BY 1")
    on_model("intel_values_top", lambda t: V.top_intel_values(t, "click"), "SELECT trim(value) AS value, count(*) AS n FROM plist WHERE kind = 'click' AND trim(value) <> '' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 12")
    on_model("pivot_wide", lambda t: V.wide(V.severity_monthly(t), "ym", "severity", "n", list(V.X.SEVERITY_ORDER)), f"SELECT ym, {', '.join(f"CAST(coalesce(sum(n) FILTER (severity = '{s}'), 0) AS BIGINT) AS {s}" for s in V.X.SEVERITY_ORDER)} FROM (SELECT {ym} AS ym, {sev} AS severity, count(*) AS n FROM pub LEFT JOIN cmax USING (cve_id) WHERE pts IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
    on_model("coverage_melt", lambda t: V.present_missing(V.enrichment_coverage(t)), "SELECT enrichment, round(present * 100 / total, 1) AS share_pct, s.state, CASE s.state WHEN 'present' THEN present ELSE total - present END AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS enrichment, (SELECT count(*) FROM pub WHERE cve_id IN (SELECT cve_id FROM {v})) AS present" for k, v in sources.items()) + ") CROSS JOIN (SELECT count(*) AS total FROM pub) CROSS JOIN (VALUES ('present'), ('missing')) s(state)")
    # E funnels and lags
    steps = ["true", "score IS NOT NULL", "attack_vector = 'NETWORK'", "privileges_required = 'NONE'", "user_interaction = 'NONE'", "integrity_impact = 'HIGH'"]
    stages = ("All", "Scored", "Remote", "No privileges", "No interaction", "High integrity impact")
    on_model("funnel", V.remote_funnel, " UNION ALL ".join(f"SELECT {k} AS step, '{x}' AS stage, (SELECT count(DISTINCT p.cve_id) FROM pub p LEFT JOIN cvss USING (cve_id) WHERE {' AND '.join(steps[: k + 1])}) AS n" for k, x in enumerate(stages)))
    on_model("pressure_having", V.vendor_wild_pressure, "SELECT vendor_name, count(DISTINCT cve_id) AS n_total, count(i.cve_id) AS n_itw, round(count(i.cve_id) / count(DISTINCT cve_id), 6) AS share FROM ve LEFT JOIN (SELECT DISTINCT cve_id FROM exploit WHERE in_the_wild) i USING (cve_id) GROUP BY 1 HAVING n_total >= 25 ORDER BY count(i.cve_id) / count(DISTINCT cve_id) DESC, n_total DESC, vendor_name LIMIT 24", ("share",))
    lag = lambda a, b, f: f"SELECT cve_id, CAST(trunc((epoch_us({a}) - epoch_us({b})) / 86400000000.0) AS INT) AS days FROM (SELECT cve_id, pts, try_cast(modified AS TIMESTAMP) AS m, try_cast(discovered AS TIMESTAMP) AS d FROM pub) WHERE {f} >= TIMESTAMP '1970-01-01' AND {a} IS NOT NULL AND {b} IS NOT NULL"
    on_model("lag_days", V.modified_lag, lag("m", "pts", "m"))
    on_model("discovered_lag", V.discovered_lag, lag("pts", "d", "d"))
    on_model("remediation_span", V.kev_remediation_span, "SELECT cve_id, CAST(b - a AS INT) AS days FROM (SELECT cve_id, try_cast(substr(date_added, 1, 10) AS DATE) AS a, try_cast(substr(due_date, 1, 10) AS DATE) AS b FROM pkev) WHERE a IS NOT NULL AND b IS NOT NULL")
    on_model("listing_lag", V.kev_listing_lag, "SELECT cve_id, CAST(a - CAST(pts AS DATE) AS INT) AS days FROM (SELECT cve_id, pts, try_cast(substr(date_added, 1, 10) AS DATE) AS a FROM pkev) WHERE a IS NOT NULL")
    # F graph
    pairs = "SELECT a.vendor_name AS vendor_a, b.vendor_name AS vendor_b, count(*) AS shared_cves FROM e a JOIN e b ON a.cve_id = b.cve_id AND a.vendor_id < b.vendor_id GROUP BY a.vendor_id, b.vendor_id, 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 2000"
    edges = "(SELECT DISTINCT cve_id, vendor_id, vendor_name FROM ve WHERE vendor_id IN (SELECT vendor_id FROM (SELECT vendor_id, count(DISTINCT cve_id) AS c FROM ve GROUP BY 1 ORDER BY c DESC, vendor_id LIMIT 28)))"
    every = "(SELECT DISTINCT cve_id, vendor_id, vendor_name FROM ve)"
    on_model("cooccurrence_pairs", V.cooccurrence_pairs, f"SELECT * FROM (WITH e AS {every} {pairs.removesuffix(' LIMIT 2000')})")
    on_model("cooccurrence_matrix", V.cooccurrence_cells, f"SELECT vendor_a, vendor_b, shared_cves FROM (WITH e AS {edges} {pairs}) UNION ALL SELECT vendor_b, vendor_a, shared_cves FROM (WITH e AS {edges} {pairs})")
    on_model("cooccurrence_graph", V.cooccurrence_graph, f"""SELECT 'node' AS kind, vendor_name AS source, CAST(NULL AS VARCHAR) AS target, cve_count AS weight, round(least(8 + sqrt(cve_count), 40), 6) AS size FROM (SELECT vendor_id, vendor_name, count(DISTINCT cve_id) AS cve_count FROM ve GROUP BY 1, 2 ORDER BY cve_count DESC, vendor_id LIMIT 28)
      UNION ALL SELECT 'edge', vendor_a, vendor_b, shared_cves, NULL FROM (WITH e AS {edges} {pairs})""", ("size",))
    on_model("phase_age_days", lambda t: V.phase_age_days(t["pipeline_run"], "2024-02-10 12:00:00").select("phase", "age_days"), "SELECT phase, CAST(floor((epoch(TIMESTAMP '2024-02-10 12:00:00') - epoch(CAST(last_completed_at AS TIMESTAMP))) / 86400) AS BIGINT) AS age_days FROM pipeline_run")
    on_model("lag_clipped", lambda t: V.clip(V.kev_listing_lag(t), "days", 0, 400), "SELECT cve_id, CAST(greatest(0, least(400, a - CAST(pts AS DATE))) AS INT) AS days FROM (SELECT cve_id, pts, try_cast(substr(date_added, 1, 10) AS DATE) AS a FROM pkev) WHERE a IS NOT NULL")
    on_model("non_critical", lambda t: V.non_critical(V.cvss_year_stats(t), "n_cves_with_cvss", "n_critical").select("pub_year", "non_critical"), "SELECT strftime(pts, '%Y') AS pub_year, count(*) FILTER (cvss_max < 9) AS non_critical FROM pub JOIN cmax USING (cve_id) GROUP BY 1")
    # samples: ordered by a hash, so that both engines pick the same rows
    h = lambda *k: "md5('0|' || " + " || '|' || ".join(f"CAST({x} AS VARCHAR)" for x in k) + ")"
    on_model("sample_scatter", lambda t: V.epss_cvss_sample(t, n=500), f"SELECT i.cve_id, epss_score, cvss_max FROM (SELECT * FROM pintel WHERE epss_score IS NOT NULL ORDER BY {h('cve_id')}, cve_id LIMIT 500) i LEFT JOIN cmax USING (cve_id)")
    on_model("subscore_sample", lambda t: V.subscore_sample(t), f"SELECT cve_id, exploitability_score, impact_score, score, {SEV.format('score')} AS severity FROM pcvss WHERE exploitability_score IS NOT NULL AND impact_score IS NOT NULL ORDER BY md5('0|' || cve_id || '|' || CAST(id AS VARCHAR)), cve_id, id LIMIT 5000")
    on_model("sample_epss_severity", lambda t: V.epss_by_severity(t, n=500), f"SELECT {sev} AS severity, epss_score FROM (SELECT * FROM pintel WHERE epss_score IS NOT NULL ORDER BY {h('cve_id')}, cve_id LIMIT 500) i LEFT JOIN cmax USING (cve_id)")
    on_model("sample_itw_vs_rest", lambda t: V.exploit_vs_cvss(t, n=500), f"SELECT 'In the wild' AS grp, cvss_max FROM pexp JOIN cmax USING (cve_id) WHERE in_the_wild UNION ALL SELECT * FROM (SELECT 'Other', cvss_max FROM pexp JOIN cmax USING (cve_id) WHERE NOT in_the_wild ORDER BY {h('cve_id')}, cve_id LIMIT 500)")


_views()
from . import catalogue_more  # noqa: E402, F401  registers the rest

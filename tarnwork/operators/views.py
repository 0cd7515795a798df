"""Analytic views over the model: each takes Tables and returns a DataFrame.

`low` and `high` bound the publication date (ISO text, inclusive, either may be None); rows without a
publication date are out of every windowed view. Top lists break ties by name or id, so they are
deterministic. `group_on="raw"` groups labelled columns by the stored value instead of by the label.
"""

from __future__ import annotations

from collections.abc import Callable

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .lineage import stored
from .tables import AXES, Tables

VIEWS: dict[str, Callable[..., DataFrame]] = {}


def view(f):
    VIEWS[f.__name__] = f
    return f


# building blocks


def published(t: Tables, low=None, high=None) -> DataFrame:
    return t["cve"].where(X.in_window("published", low, high))


def cvss_max(t: Tables) -> DataFrame:
    return t["cvss"].groupBy("cve_id").agg(F.max("score").alias("cvss_max"))


def named_vendors(t: Tables) -> DataFrame:
    return t["vendor"].where(X.not_blank("name"))


def top(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), *[F.asc(c) for c in ties]).limit(n)


def n_rows(name: str = "n") -> Column:
    return F.count("*").alias(name)


def label_counts(df: DataFrame, column: str, label: str, name: str, group_on: str = "label") -> DataFrame:
    """Counts by the column's label, or by its raw values shown with their label."""
    if group_on == "raw":
        return df.groupBy(F.col(column).alias("__raw")).agg(n_rows()).select(X.unset("__raw", label).alias(name), "n")
    return df.groupBy(X.unset(column, label).alias(name)).agg(n_rows())


def of_published(t: Tables, name: str, low, high) -> DataFrame:
    return t[name].join(published(t, low, high).select("cve_id"), "cve_id")


def vendor_edges(t: Tables, low, high, role: str | None = None) -> DataFrame:
    """(vendor_id, vendor_name, cve_id, role) of named vendors and published records."""
    edges = of_published(t, "cve_vendor", low, high)
    if role:
        edges = edges.where(F.col("role") == role)
    return edges.join(named_vendors(t).select("vendor_id", F.col("name").alias("vendor_name")), "vendor_id")


# overview and coverage


@view
def overview(t: Tables, low=None, high=None) -> DataFrame:
    cves = published(t, low, high)
    one = lambda df, e: df.agg(e)
    parts = [
        one(t["cve"], n_rows("cves_total")),
        one(cves, n_rows("cves_in_window")),
        one(of_published(t, "cvss", low, high), n_rows("cvss_rows")),
        one(of_published(t, "intel", low, high).where("epss_score is not null"), n_rows("with_epss")),
        one(of_published(t, "kev", low, high).where("listed"), n_rows("kev_listed")),
        one(vendor_edges(t, low, high), F.count_distinct("vendor_id").alias("vendors")),
        cves.agg(F.substring(F.min("published"), 1, 10).alias("first_published"), F.substring(F.max("published"), 1, 10).alias("last_published")),
    ]
    out = parts[0]
    for p in parts[1:]:  # one row each
        out = out.crossJoin(p)
    return out


COVERAGE = ("cvss", "epss", "kev", "cwe", "vendor", "product", "cpe", "reference")


@view
def enrichment_coverage(t: Tables, low=None, high=None) -> DataFrame:
    cves = published(t, low, high).select("cve_id")
    listed = t["kev"].where("listed")
    sources = {
        "cvss": t["cvss"], "epss": t["intel"].where("epss_score is not null"), "kev": listed, "cwe": t["cve_cwe"], "vendor": t["cve_vendor"].join(named_vendors(t), "vendor_id", "left_semi"),
        "product": t["affected_product"], "cpe": t["cpe_match"], "reference": t["reference"],
    }
    # one bag of (record, source) marks, combined before its only shuffle, meets the records once
    marks = None
    for k, name in enumerate(COVERAGE):
        one = sources[name].select("cve_id", F.lit(1 << k).alias("bit"))
        marks = one if marks is None else marks.unionAll(one)
    held = cves.join(marks.groupBy("cve_id").agg(F.bit_or("bit").alias("bits")), "cve_id", "left")
    has = lambda k: F.count_if(F.col("bits").bitwiseAND(F.lit(1 << k)) != 0)
    one = held.agg(n_rows("total"), *[has(k).alias(f"has_{name}") for k, name in enumerate(COVERAGE)]).where("total > 0")
    rows = one.select("total", F.inline(F.array(*[F.struct(F.lit(name).alias("enrichment"), F.col(f"has_{name}").alias("present")) for name in COVERAGE])))
    return rows.select("enrichment", "present", "total", (F.col("present") / F.col("total")).alias("share"))


ROW_COUNT_TABLES = ("cve", "vendor", "cve_vendor", "product", "affected_product", "version_range", "cwe", "cve_cwe", "cvss", "exploit", "kev", "intel", "intel_string_list", "cpe_match", "reference", "reference_tag", "tag", "cve_tag", "pipeline_run")


@view
def table_row_counts(t: Tables) -> DataFrame:
    out = None
    for name in ROW_COUNT_TABLES:
        one = t[name].agg(n_rows("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        out = one if out is None else out.unionAll(one)
    return out.orderBy(F.desc("n_rows"), "table")


@view
def dimension_counts(t: Tables) -> DataFrame:
    distinct = lambda df, c, name: df.agg(F.count_distinct(X.blank_to_null(c)).alias(name))
    parts = [distinct(t["cve"], "cna", "cnas"), distinct(t["vendor"], "name", "vendors"), distinct(t["product"], "name", "products"), distinct(t["cwe"], "cwe_id", "cwes"), distinct(t["reference"], "source", "reference_sources"), distinct(t["reference_tag"], "tag", "reference_tags")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)
    return out


@view
def pipeline_runs(t: Tables) -> DataFrame:
    return t["pipeline_run"].orderBy("phase")


@view
def version_range_coverage(t: Tables) -> DataFrame:
    held = t["version_range"].select(F.col("affected_product_id").alias("id")).distinct().withColumn("has", F.lit(1))
    return t["affected_product"].join(held, "id", "left").agg(n_rows("affected"), F.count("has").alias("with_range"), F.count_if(F.col("has").isNull()).alias("without_range"))


# vendors and graph


@view
def top_vendors(t: Tables, low=None, high=None, n: int = 28, role: str | None = None) -> DataFrame:
    return top(vendor_edges(t, low, high, role).groupBy("vendor_name", "role").agg(F.count_distinct("cve_id").alias("cve_count")), n, "cve_count", "vendor_name", "role")


@view
def vendors_aggregate(t: Tables, low=None, high=None, n: int = 28, role: str | None = None) -> DataFrame:
    return top(vendor_edges(t, low, high, role).groupBy("vendor_name").agg(F.count_distinct("cve_id").alias("cve_count")), n, "cve_count", "vendor_name")


@view
def top_vendor_ids(t: Tables, low=None, high=None, n: int = 28) -> DataFrame:
    return top(vendor_edges(t, low, high).groupBy("vendor_id", "vendor_name").agg(F.count_distinct("cve_id").alias("cve_count")), n, "cve_count", "vendor_id")


@view
def vendor_role_totals(t: Tables, low=None, high=None) -> DataFrame:
    return vendor_edges(t, low, high).groupBy("role").agg(F.count_distinct("cve_id").alias("distinct_cves"), n_rows("edges"))


@view
def vendor_role_mix(t: Tables, low=None, high=None, n: int = 100) -> DataFrame:
    e = vendor_edges(t, low, high)
    per = e.groupBy("vendor_id", "vendor_name", "cve_id").agg(F.max(F.col("role") == "primary").alias("p"), F.max(F.col("role") == "affected").alias("a"), F.count_if(F.col("role") == "primary").alias("ep"), F.count_if(F.col("role") == "affected").alias("ea"))
    mix = per.groupBy("vendor_name").agg(
        F.count_if(F.col("p") & ~F.col("a")).alias("cves_primary_only"), F.count_if(F.col("a") & ~F.col("p")).alias("cves_affected_only"), F.count_if(F.col("p") & F.col("a")).alias("cves_both_roles"), F.sum("ep").alias("edge_primary"), F.sum("ea").alias("edge_affected"), F.count("*").alias("total")
    )
    return top(mix, n, "total", "vendor_name").drop("total")


MEMBERS = 512  # vendors of a record that are paired in one task; records with more are dealt out by pairs of such blocks
MAX_NAMES = 500_000  # vendors whose names are broadcast


def _vendor_pairs(edges: DataFrame) -> DataFrame:
    """(ia, ib), ia < ib: a row for each record of edges(cve_id, vendor_id) and two of its vendors."""
    listed = edges.groupBy("cve_id").agg(F.sort_array(F.collect_set("vendor_id")).alias("ids")).withColumn("n", F.size("ids"))
    listed = stored(listed.where("n > 1"), "vendor-lists")
    few = listed.where(F.col("n") <= MEMBERS).select(F.col("ids").alias("l"), F.col("ids").alias("r"))
    blocks = F.transform(F.sequence(F.lit(0), F.col("n") - 1, F.lit(MEMBERS)), lambda i: F.slice("ids", i + 1, MEMBERS))
    many = listed.where(F.col("n") > MEMBERS).select("cve_id", blocks.alias("blocks")).select("cve_id", "blocks", F.posexplode("blocks").alias("p", "l"))
    many = many.select("cve_id", "p", "l", F.posexplode("blocks").alias("q", "r")).where("p <= q").repartition("cve_id", "p", "q").select("l", "r")
    rows = few.unionAll(many).select(F.explode("l").alias("ia"), "r")
    return rows.select("ia", F.explode(F.filter("r", lambda x: x > F.col("ia"))).alias("ib"))


@view
def cooccurrence_pairs(t: Tables, low=None, high=None, top_k: int | None = None, max_pairs: int | None = None) -> DataFrame:
    """All pairs of named vendors with a record in common, or those among the top_k vendors; the max_pairs most frequent, if given.

    A record's vendors are paired where its rows were dealt, those of a large one in blocks dealt out anew. Only ids are shuffled and counted; names follow."""
    names = named_vendors(t).select("vendor_id", F.col("name").alias("vendor_name")).distinct()
    if names.limit(MAX_NAMES + 1).count() <= MAX_NAMES:
        names = F.broadcast(names)
    e = of_published(t, "cve_vendor", low, high).select("cve_id", "vendor_id").join(names, "vendor_id", "left_semi")
    if top_k is not None:
        e = e.join(top_vendor_ids(t, low, high, top_k).select("vendor_id"), "vendor_id", "left_semi")
    pairs = _vendor_pairs(e).groupBy("ia", "ib").agg(n_rows("shared_cves"))
    pairs = pairs.join(names.toDF("ia", "vendor_a"), "ia").join(names.toDF("ib", "vendor_b"), "ib").select("vendor_a", "vendor_b", "shared_cves")
    pairs = pairs.orderBy(F.desc("shared_cves"), "vendor_a", "vendor_b")
    return pairs if max_pairs is None else pairs.limit(max_pairs)


MAX_PAIRS = 2000  # of the matrix and the graph


@view
def cooccurrence_cells(t: Tables, low=None, high=None, top_k: int = 28) -> DataFrame:
    """The symmetric matrix as cells; absent cells are 0."""
    p = cooccurrence_pairs(t, low, high, top_k, MAX_PAIRS)
    return p.unionAll(p.select(F.col("vendor_b").alias("vendor_a"), F.col("vendor_a").alias("vendor_b"), "shared_cves"))


@view
def cooccurrence_matrix(t: Tables, low=None, high=None, top_k: int = 12) -> DataFrame:
    names = [r[0] for r in top_vendor_ids(t, low, high, top_k).select("vendor_name").distinct().orderBy("vendor_name").collect()]
    return cooccurrence_cells(t, low, high, top_k).groupBy("vendor_a").pivot("vendor_b", names).agg(F.sum("shared_cves")).na.fill(0)


@view
def cooccurrence_graph(t: Tables, low=None, high=None, node_cap: int = 28) -> DataFrame:
    """Nodes and edges in one table: kind, source, target, weight, size."""
    nodes = top_vendor_ids(t, low, high, node_cap).select(F.lit("node").alias("kind"), F.col("vendor_name").alias("source"), F.lit(None).cast("string").alias("target"), F.col("cve_count").alias("weight"), F.least(8 + F.sqrt("cve_count"), F.lit(40.0)).alias("size"))
    edges = cooccurrence_pairs(t, low, high, node_cap, MAX_PAIRS).select(F.lit("edge"), "vendor_a", "vendor_b", "shared_cves", F.lit(None).cast("double"))
    return nodes.unionAll(edges)


# time series


@view
def publications_monthly(t: Tables, low=None, high=None) -> DataFrame:
    return published(t, low, high).groupBy(X.month_key("published").alias("ym")).agg(n_rows()).where("ym is not null").orderBy("ym")


@view
def publications_yearly(t: Tables, low=None, high=None) -> DataFrame:
    return published(t, low, high).groupBy(X.year_key("published").alias("y")).agg(n_rows()).orderBy("y")


@view
def publications_yoy(t: Tables, low=None, high=None) -> DataFrame:
    ts = X.timestamp("published")
    return published(t, low, high).groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(n_rows()).where("year is not null").orderBy("year", "month")


@view
def publications_weekly(t: Tables, low=None, high=None) -> DataFrame:
    return published(t, low, high).groupBy(X.week_key("published").alias("yw")).agg(n_rows()).where("yw is not null").orderBy("yw")


@view
def cna_monthly(t: Tables, low=None, high=None, top_k: int = 10) -> DataFrame:
    c = published(t, low, high).where(X.not_blank("cna")).withColumn("cna", F.trim("cna"))
    best = top(c.groupBy("cna").agg(n_rows()), top_k, "n", "cna").select("cna")
    return c.join(F.broadcast(best), "cna", "left_semi").groupBy(X.month_key("published").alias("ym"), "cna").agg(n_rows()).where("ym is not null").orderBy("ym", "cna")


@view
def cvss_year_stats(t: Tables, low=None, high=None) -> DataFrame:
    j = published(t, low, high).join(cvss_max(t), "cve_id")
    return j.groupBy(X.year_key("published").alias("pub_year")).agg(F.avg("cvss_max").alias("avg_max_cvss"), n_rows("n_cves_with_cvss"), F.count_if(F.col("cvss_max") >= 9).alias("n_critical")).orderBy("pub_year")


@view
def kev_added_monthly(t: Tables, low=None, high=None) -> DataFrame:
    return of_published(t, "kev", low, high).where("listed").where(X.not_blank("date_added")).groupBy(F.date_format(X.day("date_added"), "yyyy-MM").alias("ym")).agg(n_rows()).where("ym is not null").orderBy("ym")


@view
def severity_monthly(t: Tables, low=None, high=None) -> DataFrame:
    j = published(t, low, high).join(cvss_max(t), "cve_id", "left")
    return j.groupBy(X.month_key("published").alias("ym"), X.severity_bucket("cvss_max").alias("severity")).agg(n_rows()).where("ym is not null").orderBy("ym", "severity")


@view
def in_the_wild_monthly(t: Tables, low=None, high=None) -> DataFrame:
    c = published(t, low, high).join(t["exploit"].where("in_the_wild").select("cve_id"), "cve_id")
    return c.groupBy(X.month_key("published").alias("ym")).agg(n_rows()).where("ym is not null").orderBy("ym")


# weaknesses and severity


@view
def cwe_totals(t: Tables, low=None, high=None, n: int = 12) -> DataFrame:
    return top(of_published(t, "cve_cwe", low, high).join(t["cwe"].select("cwe_id", F.col("name").alias("cwe_name")), "cwe_id").groupBy("cwe_id", "cwe_name").agg(n_rows()), n, "n", "cwe_id")


@view
def cwe_monthly(t: Tables, ids: list[str], low=None, high=None) -> DataFrame:
    j = published(t, low, high).join(t["cve_cwe"].where(F.col("cwe_id").isin(list(ids))), "cve_id").join(t["cwe"].select("cwe_id", F.col("name").alias("cwe_name")), "cwe_id")
    return j.groupBy(X.month_key("published").alias("ym"), "cwe_id", "cwe_name").agg(n_rows()).where("ym is not null").orderBy("ym", "cwe_id")


@view
def severity_distribution(t: Tables, low=None, high=None) -> DataFrame:
    out = published(t, low, high).join(cvss_max(t), "cve_id", "left").groupBy(X.severity_bucket("cvss_max").alias("severity")).agg(n_rows())
    return out.orderBy(F.array_position(F.array(*map(F.lit, X.SEVERITY_ORDER)), F.col("severity")))


@view
def cwe_severity_heatmap(t: Tables, low=None, high=None, top_m: int = 12) -> DataFrame:
    best = cwe_totals(t, low, high, top_m).select("cwe_id", "cwe_name")
    j = of_published(t, "cve_cwe", low, high).join(F.broadcast(best), "cwe_id").join(cvss_max(t), "cve_id", "left")
    return j.groupBy("cwe_id", "cwe_name", X.severity_bucket("cvss_max").alias("severity")).agg(n_rows())


@view
def subscore_sample(t: Tables, low=None, high=None, n: int = 5000, seed: int = 0) -> DataFrame:
    rows = of_published(t, "cvss", low, high).where("exploitability_score is not null and impact_score is not null")
    return sample(rows, n, seed, "cve_id", "id").select("cve_id", "exploitability_score", "impact_score", "score", X.severity_bucket("score").alias("severity"))


def sample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows in the order of a seeded hash of their keys: random, yet the same on every run."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)


# scores


@view
def epss_scores(t: Tables, low=None, high=None) -> DataFrame:
    return of_published(t, "intel", low, high).where("epss_score is not null").select("epss_score")


@view
def epss_histogram(t: Tables, low=None, high=None, bins: int = 60) -> DataFrame:
    b = F.least(F.width_bucket("epss_score", F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return epss_scores(t, low, high).groupBy(b.cast("bigint").alias("bin")).agg(n_rows()).orderBy("bin")


@view
def epss_cvss_sample(t: Tables, low=None, high=None, n: int = 3500, seed: int = 0) -> DataFrame:
    rows = of_published(t, "intel", low, high).where("epss_score is not null")
    return sample(rows, n, seed, "cve_id").select("cve_id", "epss_score").join(cvss_max(t), "cve_id", "left")


@view
def epss_by_severity(t: Tables, low=None, high=None, n: int = 12000, seed: int = 0) -> DataFrame:
    rows = of_published(t, "intel", low, high).where("epss_score is not null")
    return sample(rows, n, seed, "cve_id").join(cvss_max(t), "cve_id", "left").select(X.severity_bucket("cvss_max").alias("severity"), "epss_score")


def equal_width(x: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based bin of equal-width, right-closed bins over [low, high]; the lowest value is in bin 1."""
    width = (high - low) / bins
    return F.when(high <= low, F.lit(1)).otherwise(F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((x - low) / width)))).cast("bigint")


@view
def epss_density(t: Tables, low=None, high=None, pct_bins: int = 20, cvss_bins: int = 11) -> DataFrame:
    rows = of_published(t, "intel", low, high).where("epss_percentile is not null").join(cvss_max(t), "cve_id").where("cvss_max is not null").select("epss_percentile", "cvss_max")
    span = rows.agg(F.min("epss_percentile").alias("p0"), F.max("epss_percentile").alias("p1"), F.min("cvss_max").alias("c0"), F.max("cvss_max").alias("c1"))
    j = rows.crossJoin(F.broadcast(span))  # one row
    return j.groupBy(equal_width(F.col("epss_percentile"), F.col("p0"), F.col("p1"), pct_bins).alias("pct_bin"), equal_width(F.col("cvss_max"), F.col("c0"), F.col("c1"), cvss_bins).alias("cvss_bin")).agg(n_rows())


@view
def kev_share_by_decile(t: Tables, low=None, high=None) -> DataFrame:
    kev = t["kev"].where("listed").select("cve_id").distinct().withColumn("in_kev", F.lit(True))
    j = of_published(t, "intel", low, high).where("epss_percentile is not null").join(kev, "cve_id", "left")
    hit = F.col("in_kev").isNotNull()
    return j.groupBy(X.epss_decile("epss_percentile").cast("bigint").alias("decile")).agg(n_rows("n_total"), F.count_if(hit).alias("n_kev"), F.avg(hit.cast("double")).alias("kev_share")).orderBy("decile")


@view
def assigner_share(t: Tables, low=None, high=None, n: int = 24) -> DataFrame:
    c = published(t, low, high)
    total = c.agg(n_rows("total"))
    return top(c.where(X.not_blank("assigner_org_id")).groupBy(F.trim("assigner_org_id").alias("org")).agg(n_rows()), n, "n", "org").crossJoin(total).select("org", "n", (F.col("n") / F.nullif("total", F.lit(0))).alias("share"))


# exploits


@view
def maturity_distribution(t: Tables, low=None, high=None, group_on: str = "label") -> DataFrame:
    return label_counts(of_published(t, "exploit", low, high), "maturity", "NONE", "maturity", group_on)


@view
def exploit_flag_totals(t: Tables, low=None, high=None) -> DataFrame:
    flags = ("public_poc", "metasploit", "ransomware_usage", "in_the_wild")
    return of_published(t, "exploit", low, high).agg(n_rows("total"), *[F.count_if(F.col(f)).alias(f) for f in flags])


ARTEFACT_SOURCES = ("nuclei", "exploitdb", "metasploit")


@view
def artefact_totals(t: Tables, low=None, high=None, sources: tuple[str, ...] = ARTEFACT_SOURCES) -> DataFrame:
    return of_published(t, "exploit_artefact", low, high).agg(n_rows("total"), F.count_distinct("cve_id").alias("cves"), *[F.count_if(F.col("source") == s).alias(s) for s in sources])


@view
def artefact_sources(t: Tables, low=None, high=None) -> DataFrame:
    return of_published(t, "exploit_artefact", low, high).groupBy("source", "confidence").agg(n_rows())


@view
def top_artefact_cves(t: Tables, low=None, high=None, n: int = 20) -> DataFrame:
    j = t["exploit_artefact"].join(published(t, low, high).select("cve_id", "title"), "cve_id")
    return top(j.groupBy("cve_id", "title").agg(n_rows("artefacts"), F.count_distinct("source").alias("sources")), n, "artefacts", "cve_id")


@view
def exploit_vs_cvss(t: Tables, low=None, high=None, n: int = 8000, seed: int = 0) -> DataFrame:
    j = of_published(t, "exploit", low, high).join(cvss_max(t), "cve_id").where("cvss_max is not null")
    wild = j.where("in_the_wild").select(F.lit("In the wild").alias("grp"), "cvss_max")
    rest = sample(j.where("not in_the_wild"), n, seed, "cve_id").select(F.lit("Other").alias("grp"), "cvss_max")
    return wild.unionAll(rest)


@view
def vendor_wild_pressure(t: Tables, low=None, high=None, n: int = 24, min_cves: int = 25) -> DataFrame:
    wild = t["exploit"].where("in_the_wild").select("cve_id").distinct().withColumn("itw", F.lit(1))
    e = vendor_edges(t, low, high).join(wild, "cve_id", "left")
    agg = e.groupBy("vendor_name").agg(F.count_distinct("cve_id").alias("n_total"), F.count("itw").alias("n_itw"))
    return agg.where(F.col("n_total") >= min_cves).withColumn("share", F.col("n_itw") / F.nullif("n_total", F.lit(0))).orderBy(F.desc("share"), F.desc("n_total"), "vendor_name").limit(n)


# exploited-vulnerability catalogue


def _kev(t: Tables, low, high) -> DataFrame:
    return of_published(t, "kev", low, high).where("listed")


@view
def kev_source_split(t: Tables, low=None, high=None, group_on: str = "label") -> DataFrame:
    return label_counts(_kev(t, low, high), "source", "(unset)", "source", group_on)


def _kev_top(t: Tables, column: str, low, high, n: int) -> DataFrame:
    return top(_kev(t, low, high).where(X.not_blank(column)).groupBy(F.trim(column).alias(column)).agg(n_rows()), n, "n", column)


@view
def kev_top_vendor_project(t: Tables, low=None, high=None, n: int = 24) -> DataFrame:
    return _kev_top(t, "vendor_project", low, high, n)


@view
def kev_top_product_label(t: Tables, low=None, high=None, n: int = 24) -> DataFrame:
    return _kev_top(t, "product_label", low, high, n)


@view
def kev_top_required_action(t: Tables, low=None, high=None, n: int = 24) -> DataFrame:
    return _kev_top(t, "required_action", low, high, n)


@view
def kev_due_buckets(t: Tables, today: str, low=None, high=None) -> DataFrame:
    order = F.array(*map(F.lit, ("Overdue", "Due in 30 days", "Due in 90 days", "Due later", "No due date")))
    return _kev(t, low, high).groupBy(X.due_bucket("due_date", today).alias("bucket")).agg(n_rows()).orderBy(F.array_position(order, F.col("bucket")))


@view
def kev_remediation_span(t: Tables, low=None, high=None) -> DataFrame:
    d = F.datediff(X.day("due_date"), X.day("date_added"))
    return _kev(t, low, high).select("cve_id", d.alias("days")).where("days is not null")


@view
def kev_severity_mix(t: Tables, low=None, high=None) -> DataFrame:
    kev = t["kev"].where("listed").select("cve_id").distinct().withColumn("in_kev", F.lit(True))
    j = published(t, low, high).join(kev, "cve_id", "left").join(cvss_max(t), "cve_id", "left")
    return j.groupBy(F.when(F.col("in_kev"), "KEV").otherwise("non-KEV").alias("grp"), X.severity_bucket("cvss_max").alias("severity")).agg(n_rows())


# vectors


@view
def axis_distribution(t: Tables, low=None, high=None) -> DataFrame:
    """All eight axes from one pass over the score rows."""
    rows = of_published(t, "cvss", low, high)
    pairs = F.inline(F.array(*[F.struct(F.lit(a).alias("axis"), X.unset(a).alias("value")) for a in AXES]))
    return rows.select(pairs).groupBy("axis", "value").agg(n_rows())


@view
def vector_privilege_heatmap(t: Tables, low=None, high=None) -> DataFrame:
    return of_published(t, "cvss", low, high).groupBy(X.unset("attack_vector").alias("av"), X.unset("privileges_required").alias("pr")).agg(n_rows())


@view
def remote_funnel(t: Tables, low=None, high=None) -> DataFrame:
    """Six stages, each with the conditions of those before it, from one pass."""
    c = published(t, low, high).select("cve_id").join(t["cvss"].drop("id"), "cve_id", "left")
    conditions = [F.col("score").isNotNull(), F.upper("attack_vector") == "NETWORK", F.upper("privileges_required") == "NONE", F.upper("user_interaction") == "NONE", F.upper("integrity_impact") == "HIGH"]
    names = ("All", "Scored", "Remote", "No privileges", "No interaction", "High integrity impact")
    held, flags = F.lit(True), []
    for k, cond in enumerate(conditions, 1):
        held = held & cond
        flags.append(F.max(F.coalesce(held, F.lit(False))).alias(f"h{k}"))
    # flags per record first: counting distinct records per stage would expand every row six times
    per = c.groupBy("cve_id").agg(*flags)
    one = per.agg(n_rows("s0"), *[F.count_if(f"h{k}").alias(f"s{k}") for k in range(1, len(names))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("step"), F.lit(x).alias("stage"), F.col(f"s{k}").alias("n")) for k, x in enumerate(names)])))


# products, references, tags, intelligence


@view
def top_products(t: Tables, low=None, high=None, n: int = 24) -> DataFrame:
    v = named_vendors(t).select("vendor_id", F.col("name").alias("vendor_name"))
    p = t["product"].where(X.not_blank("name")).select("product_id", "vendor_id", F.col("name").alias("product_name")).join(v, "vendor_id")
    j = of_published(t, "affected_product", low, high).select("cve_id", "product_id").join(p, "product_id")
    return top(j.groupBy("vendor_name", "product_name").agg(F.count_distinct("cve_id").alias("n")), n, "n", "vendor_name", "product_name")


@view
def product_types(t: Tables, group_on: str = "label") -> DataFrame:
    return label_counts(t["product"], "product_type", "UNKNOWN", "product_type", group_on)


def _per_key_histogram(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("cve_id").agg(n_rows(name)).groupBy(name).agg(n_rows("cves")).orderBy(name)


@view
def cpe_per_cve(t: Tables, low=None, high=None) -> DataFrame:
    return _per_key_histogram(of_published(t, "cpe_match", low, high), "matches")


@view
def references_per_cve(t: Tables, low=None, high=None) -> DataFrame:
    return _per_key_histogram(of_published(t, "reference", low, high), "refs")


@view
def vendors_by_products(t: Tables, n: int = 24) -> DataFrame:
    j = t["product"].join(named_vendors(t).select("vendor_id", F.col("name").alias("vendor_name")), "vendor_id")
    return top(j.groupBy("vendor_name").agg(F.count_distinct("product_id").alias("n_products")), n, "n_products", "vendor_name")


@view
def top_reference_sources(t: Tables, low=None, high=None, n: int = 24, group_on: str = "label") -> DataFrame:
    return top(label_counts(of_published(t, "reference", low, high), "source", "(unset)", "source", group_on), n, "n", "source")


@view
def reference_trust(t: Tables, low=None, high=None, group_on: str = "label") -> DataFrame:
    return label_counts(of_published(t, "reference", low, high), "trust", "(unset)", "trust", group_on)


@view
def reference_tags(t: Tables, low=None, high=None, n: int = 24) -> DataFrame:
    j = of_published(t, "reference", low, high).select(F.col("id").alias("reference_id")).join(t["reference_tag"], "reference_id").where(X.not_blank("tag"))
    return top(j.groupBy(F.trim("tag").alias("tag")).agg(n_rows()), n, "n", "tag")


@view
def tag_coverage_yearly(t: Tables, tags: Sequence[str] = X.PATCH_TAGS, low=None, high=None) -> DataFrame:
    wanted = t["reference_tag"].where(F.lower(F.trim("tag")).isin([x.lower() for x in tags])).select("reference_id").distinct()
    tagged = t["reference"].join(wanted, F.col("id") == F.col("reference_id"), "left_semi").select("cve_id").distinct().withColumn("tagged", F.lit(1))
    j = published(t, low, high).join(tagged, "cve_id", "left")
    out = j.groupBy(X.year_key("published").alias("year")).agg(n_rows("n_total"), F.count("tagged").alias("n_tagged")).withColumn("share", F.col("n_tagged") / F.nullif("n_total", F.lit(0)))
    return out.orderBy("year") if tags else out.limit(0)


@view
def intel_kinds(t: Tables, low=None, high=None, group_on: str = "label") -> DataFrame:
    return label_counts(of_published(t, "intel_string_list", low, high), "kind", "(unset)", "kind", group_on)


@view
def top_intel_values(t: Tables, kind: str, low=None, high=None, n: int = 12) -> DataFrame:
    rows = of_published(t, "intel_string_list", low, high).where((F.col("kind") == kind) & X.not_blank("value"))
    return top(rows.groupBy(F.trim("value").alias("value")).agg(n_rows()), n, "n", "value")


# lags and status


def _lag(t: Tables, later: str, earlier: str, floor: str, low, high) -> DataFrame:
    c = published(t, low, high).where(X.not_blank("modified" if floor == "modified" else "discovered"))
    a, b, f = X.timestamp(later), X.timestamp(earlier), X.timestamp(floor)
    return c.where(f >= F.lit("1970-01-01").cast("timestamp")).select("cve_id", X.whole_days(a, b).alias("days")).where("days is not null")


@view
def modified_lag(t: Tables, low=None, high=None) -> DataFrame:
    return _lag(t, "modified", "published", "modified", low, high)


@view
def discovered_lag(t: Tables, low=None, high=None) -> DataFrame:
    return _lag(t, "published", "discovered", "discovered", low, high)


@view
def kev_listing_lag(t: Tables, low=None, high=None) -> DataFrame:
    j = t["kev"].where("listed").select("cve_id", "date_added").join(published(t, low, high).select("cve_id", "published"), "cve_id")
    return j.select("cve_id", F.datediff(X.day("date_added"), X.day("published")).alias("days")).where("days is not null")


@view
def status_distribution(t: Tables, low=None, high=None, group_on: str = "label") -> DataFrame:
    return label_counts(published(t, low, high), "vuln_status", "(unset)", "vuln_status", group_on)


@view
def status_by_year(t: Tables, low=None, high=None) -> DataFrame:
    return published(t, low, high).groupBy(X.year_key("published").alias("year"), X.unset("vuln_status").alias("vuln_status")).agg(n_rows())


@view
def recency_heatmap(t: Tables, low=None, high=None) -> DataFrame:
    return published(t, low, high).groupBy(X.year_key("modified").alias("mod_year"), X.year_key("published").alias("pub_year")).agg(n_rows()).where("mod_year is not null and pub_year is not null")


# operations on views


def present_missing(coverage: DataFrame) -> DataFrame:
    rows = F.inline(F.array(F.struct(F.lit("present").alias("state"), F.col("present").alias("n")), F.struct(F.lit("missing").alias("state"), (F.col("total") - F.col("present")).alias("n"))))
    return coverage.select("enrichment", F.round(F.col("share") * 100, 1).alias("share_pct"), rows)


def top_and_other(df: DataFrame, name: str, n: str, keep: int = 12) -> DataFrame:
    """The first `keep` by n, and the rest as one row "Other"; the ranked list is a top list, so it is small."""
    rn = F.row_number().over(Window.orderBy(F.desc(n), F.asc(name)))
    return df.withColumn("rn", rn).groupBy(F.when(F.col("rn") <= keep, F.col(name)).otherwise("Other").alias(name)).agg(F.sum(n).alias(n))


def rolling_mean(df: DataFrame, order: str, value: str, width: int, out: str = "rolling") -> DataFrame:
    """Mean over this and the width-1 rows before; one row per period, so one task sees only periods."""
    return df.withColumn(out, F.avg(value).over(Window.orderBy(order).rowsBetween(-(max(1, width) - 1), 0)))


def share_within(df: DataFrame, group: str, n: str, out: str = "share") -> DataFrame:
    return df.withColumn(out, F.col(n) / F.sum(n).over(Window.partitionBy(group)))


def clamp_tail(df: DataFrame, value: str, n: str, cap: int) -> DataFrame:
    """Histogram with all values from cap on in one bin named `cap+`."""
    v = F.least(F.col(value), F.lit(cap))
    return df.groupBy(v.alias(value)).agg(F.sum(n).alias(n)).withColumn("label", F.when(F.col(value) >= cap, F.concat(F.lit(str(cap)), F.lit("+"))).otherwise(F.col(value).cast("string")))


def last_years(df: DataFrame, year: str, k: int = 8) -> DataFrame:
    return df.withColumn("rk", F.dense_rank().over(Window.orderBy(F.desc(year)))).where(F.col("rk") <= k).drop("rk")


def wide(df: DataFrame, row: str, column: str, value: str, names: list) -> DataFrame:
    return df.groupBy(row).pivot(column, names).agg(F.sum(value)).na.fill(0)


def clip(df: DataFrame, c: str, low: int, high: int) -> DataFrame:
    return df.withColumn(c, F.greatest(F.lit(low), F.least(F.lit(high), F.col(c))))


def short_label(c: str, width: int = 90) -> Column:
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("…"))).otherwise(F.col(c))


def non_critical(df: DataFrame, total: str, critical: str, out: str = "non_critical") -> DataFrame:
    return df.withColumn(out, F.greatest(F.col(total) - F.col(critical), F.lit(0)))


def phase_age_days(runs: DataFrame, now: str) -> DataFrame:
    seconds = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(X.timestamp("last_completed_at"))
    return runs.withColumn("age_days", F.floor(seconds / 86400))

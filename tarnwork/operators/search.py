"""The query tools: structured search, listings, the full document, references and artefacts of a record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .lineage import cut, parts_of, stored
from .tables import CVE_CHILDREN, Tables
from .views import ROW_COUNT_TABLES, n_rows  # noqa: F401


def max_severity(t: Tables) -> DataFrame:
    """(cve_id, cvss_max, severity): severity of the row with the highest score; the highest id breaks ties."""
    return t["cvss"].groupBy("cve_id").agg(F.max("score").alias("cvss_max"), F.max_by("severity", F.struct("score", "id")).alias("severity"))


def _like(c: str, term: str) -> Column:
    return X.contains_ci(c, term, wildcards=True)


NAMES = (("vendor", "name"), ("product", "name"), ("product_cpe_vendor", "slug"), ("cve_cpe_vendor", "slug"))  # the columns that vendor_product_ids matches


def vendor_product_ids(t: Tables, vendor: str | None, product: str | None, values: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """cve_ids that match a vendor, a product, or both in one affected-product row.

    values: from a term to (value), the strings of NAMES that hold it, as a stored index of them gives; without it the names are scanned."""
    found = {x: cut(values(x).distinct()) for x in {vendor, product} if x and values}

    def matching(df: DataFrame, c: str, term: str) -> DataFrame:
        return df.join(found[term].select(F.col("value").alias(c)), c, "left_semi") if found else df.where(_like(c, term))

    def tagged(df: DataFrame, c: str, term: str, out: str) -> DataFrame:
        """df with the boolean column out: does c hold the term? A null does not."""
        if not found:
            return df.withColumn(out, F.coalesce(_like(c, term), F.lit(False)))
        return df.join(found[term].select(F.col("value").alias(c), F.lit(True).alias("__hit")), c, "left").withColumn(out, F.coalesce("__hit", F.lit(False))).drop("__hit")

    owner = t["vendor"].select("vendor_id", F.col("name").alias("owner"))
    products = t["product"].join(owner, "vendor_id", "left")
    by_edge = lambda: t["cve_vendor"].join(matching(t["vendor"], "name", vendor).select("vendor_id"), "vendor_id", "left_semi").select("cve_id")
    owned = lambda df: tagged(tagged(df, "name", vendor, "by_name"), "owner", vendor, "by_owner")
    if vendor and product:
        slugs = matching(t["product_cpe_vendor"], "slug", vendor).select("product_id").distinct().withColumn("by_slug", F.lit(True))
        p = owned(matching(products, "name", product)).join(slugs, "product_id", "left").select("product_id", (F.col("by_name") | F.col("by_owner") | F.coalesce("by_slug", F.lit(False))).alias("direct"))
        rows = t["affected_product"].select("cve_id", "product_id").join(p, "product_id")
        edge = by_edge().distinct().withColumn("by_edge", F.lit(True))
        return rows.join(edge, "cve_id", "left").where(F.col("direct") | F.coalesce("by_edge", F.lit(False))).select("cve_id").distinct()
    if product:
        p = matching(t["product"], "name", product).select("product_id")
        return t["affected_product"].join(p, "product_id", "left_semi").select("cve_id").distinct()
    ids = owned(products).where("by_name or by_owner").select("product_id").union(matching(t["product_cpe_vendor"], "slug", vendor).select("product_id")).distinct()
    routes = by_edge().union(t["affected_product"].join(ids, "product_id", "left_semi").select("cve_id")).union(matching(t["cve_cpe_vendor"], "slug", vendor).select("cve_id"))
    return routes.distinct()


def search_cves(t: Tables, vendor: str | None = None, product: str | None = None, cwe: str | None = None, kev_only: bool = False, min_cvss: float | None = None, min_epss: float | None = None, year: int | None = None, limit: int = 20) -> DataFrame:
    """Summaries of the records that satisfy all given conditions, newest first; ids break ties."""
    c = t["cve"]
    if vendor or product:
        c = c.join(vendor_product_ids(t, vendor, product), "cve_id", "left_semi")
    if cwe:
        c = c.join(t["cve_cwe"].where(F.upper("cwe_id") == X.canonical_id(cwe)), "cve_id", "left_semi")
    if kev_only:
        c = c.join(t["kev"].where("listed"), "cve_id", "left_semi")
    if min_cvss is not None:
        c = c.join(t["cvss"].where(F.col("score") >= min_cvss), "cve_id", "left_semi")
    if min_epss is not None:
        c = c.join(t["intel"].where(F.col("epss_score") >= min_epss), "cve_id", "left_semi")
    if year is not None:
        c = c.where(F.substring("published", 1, 4) == str(year))
    best = c.select("cve_id", "title", "published", F.substring("summary", 1, 500).alias("summary")).orderBy(F.desc("published"), "cve_id").limit(X.clamp_limit(limit))
    out = best.join(max_severity(t), "cve_id", "left").join(t["intel"].select("cve_id", "epss_score"), "cve_id", "left")
    listed = t["kev"].where("listed").select("cve_id").distinct().withColumn("k", F.lit(True))
    out = out.join(listed, "cve_id", "left").withColumn("kev", F.coalesce("k", F.lit(False)))
    return out.select("cve_id", "title", X.blank_to_null("published").alias("published"), "severity", "cvss_max", "epss_score", "kev", "summary").orderBy(F.desc("published"), "cve_id")


def list_vendors(t: Tables, query: str = "", limit: int = 50) -> DataFrame:
    v = t["vendor"].where(X.not_blank("name"))
    if query:
        v = v.where(_like("name", query))
    cves = t["cve_vendor"].groupBy("vendor_id").agg(F.count_distinct("cve_id").alias("cve_count"))
    products = t["product"].groupBy("vendor_id").agg(n_rows("product_count"))
    slugs = t["product_cpe_vendor"].join(t["product"].select("product_id", "vendor_id"), "product_id").groupBy("vendor_id", "slug").agg(F.sum("n").alias("n"))
    slugs = slugs.withColumn("rn", F.row_number().over(Window.partitionBy("vendor_id").orderBy(F.desc("n"), "slug"))).where("rn <= 5")
    slugs = slugs.groupBy("vendor_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "slug"))), lambda x: x["slug"]), ",").alias("cpe_vendors"))
    out = v.join(cves, "vendor_id", "left").join(products, "vendor_id", "left").join(slugs, "vendor_id", "left")
    return out.select("vendor_id", "name", F.coalesce("cve_count", F.lit(0)).alias("cve_count"), F.coalesce("product_count", F.lit(0)).alias("product_count"), "cpe_vendors").orderBy(F.desc("cve_count"), "name").limit(X.clamp_limit(limit))


def list_kev(t: Tables, since: str | None = None, limit: int = 50) -> DataFrame:
    k = t["kev"].where("listed")
    if since:
        k = k.where(F.substring("date_added", 1, 10) >= since)
    best = k.orderBy(F.desc("date_added"), "cve_id").limit(X.clamp_limit(limit))
    cols = ["cve_id", "vulnerability_name", "vendor_project", "product_label", "required_action", "source"]
    return best.select(*cols, X.blank_to_null("date_added").alias("date_added"), X.blank_to_null("due_date").alias("due_date")).orderBy(F.desc("date_added"), "cve_id")


def database_overview(t: Tables) -> DataFrame:
    cves = t["cve"].agg(n_rows("cves"), F.min(X.blank_to_null("published")).alias("first_published"), F.max(X.blank_to_null("published")).alias("last_published"))
    others = [t["vendor"].where(X.not_blank("name")).agg(n_rows("vendors")), t["product"].agg(n_rows("products")), t["kev"].agg(F.count_if("listed").alias("kev_listed")), t["exploit_artefact"].agg(n_rows("artefacts")), t["pipeline_run"].agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("phase", "last_completed_at")))).alias("phases"))]
    for o in others:  # one row each
        cves = cves.crossJoin(o)
    return cves


def exploits_for(t: Tables, cve_id: str) -> DataFrame:
    rows = t["exploit_artefact"].where(F.col("cve_id") == X.canonical_id(cve_id))
    return rows.select("source", "stable_id", "url", "artefact_type", "platform", "published_date", "confidence").orderBy("source", "stable_id")


def references_for(t: Tables, cve_id: str, tag: str | None = None) -> DataFrame:
    """References with all their tags; `tag` selects references, not tags."""
    refs = t["reference"].where(F.col("cve_id") == X.canonical_id(cve_id))
    if tag:
        refs = refs.join(t["reference_tag"].where(F.lower("tag") == tag.lower()), F.col("id") == F.col("reference_id"), "left_semi")
    tags = t["reference_tag"].groupBy("reference_id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    out = refs.join(tags, F.col("id") == F.col("reference_id"), "left")
    return out.select("id", "url", "source", "title", "trust", F.coalesce("tags", F.array().cast("array<string>")).alias("tags")).orderBy("id")


def candidates_for(t: Tables, cve_id: str) -> DataFrame:
    rows = t["product_candidate"].where(F.col("cve_id") == X.canonical_id(cve_id)).join(t["product"].select("product_id", "vendor_id", F.col("name").alias("product")), "product_id")
    return rows.join(t["vendor"].select("vendor_id", F.col("name").alias("vendor")), "vendor_id").select("vendor", "product", "matched_text").orderBy("vendor", "product")


def _nested(df: DataFrame, alias: str, order: str, *columns: str) -> DataFrame:
    body = F.struct(*[F.col(c) for c in columns])
    return df.groupBy("cve_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), body.alias("b")))), lambda x: x["b"]).alias(alias))


MAX_VENDORS = 500_000  # vendors whose names are broadcast; more meet their rows in shuffled joins


MAX_CODED = 50_000  # distinct combinations of columns that travel as codes


def _coded(df: DataFrame, deal: Callable[[DataFrame], DataFrame], *columns: str) -> DataFrame:
    """deal(df), where columns travel as a code, if they have few combinations: these are listed, and broadcast to put the columns back."""
    code = F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))]).alias("__code")
    if df.agg(F.approx_count_distinct(code)).first()[0] > MAX_CODED:
        return deal(df)
    known = stored(df.select(code, *columns).distinct(), "codes")
    if known.count() > min(2 * MAX_CODED, known.select("__code").distinct().count()):  # more than estimated, or two of one code
        return deal(df)
    dealt = deal(df.select(*[c for c in df.columns if c not in columns], code))
    return dealt.join(F.broadcast(known), "__code").select(*df.columns)


def documents(t: Tables, ids: DataFrame | None = None) -> DataFrame:
    """One nested document per record: every child table as a sorted array of structs.

    Rows are dealt by record once, as they are, all tables to as many partitions as the largest needs; there they are nested and joined
    without another shuffle. Texts of scores and platforms travel as codes, if they have few combinations. Links and weaknesses come dealt by record where they were made distinct, so the plan deals them if need be.
    Affected products meet their ranges and products on the way; vendors' names are broadcast, if they are few."""
    parts = max(parts_of(t.spark, *t[x].inputFiles()) for x in ("cve", *CVE_CHILDREN))
    pick = (lambda df: df.join(ids, "cve_id", "left_semi")) if ids is not None else (lambda df: df)
    deal = lambda df: df.repartition(parts, "cve_id")
    rows = lambda name, *columns: deal(pick(t[name]).select("cve_id", *columns))
    others = lambda name: [x for x in t[name].columns if x != "cve_id"]
    coded = lambda name, own, *columns: rows(name, *own, *columns) if ids is not None else _coded(t[name].select("cve_id", *own, *columns), deal, *columns)
    texts = [f.name for f in t["cvss"].schema if f.name != "cve_id" and f.dataType.typeName() == "string"]
    c = deal(pick(t["cve"])).withColumns({d: X.blank_to_null(d) for d in ("published", "modified", "discovered")})
    ranges = t["version_range"].groupBy("affected_product_id").agg(F.array_sort(F.collect_list(F.struct("id", "start_including", "start_excluding", "end_including", "end_excluding", "fixed_version", "raw_text"))).alias("versions")).withColumnRenamed("affected_product_id", "id")
    v = t["vendor"].select("vendor_id", F.col("name").alias("vendor"))
    products = t["product"].select("product_id", "vendor_id", F.col("name").alias("product"), "product_type")
    if few := v.limit(MAX_VENDORS + 1).count() <= MAX_VENDORS:
        v = F.broadcast(v)
    else:
        products = products.join(v, "vendor_id", "left").drop("vendor_id")
    affected = pick(t.by("affected_product", "id")).select("id", "cve_id", "product_id", "affected", "notes", "source").join(ranges, "id", "left")
    affected = deal(affected.join(products.repartition(parts, "product_id"), "product_id", "left").drop("product_id"))
    if few:
        affected = affected.join(v, "vendor_id", "left")
    tags = t["reference_tag"].groupBy("reference_id").agg(F.array_sort(F.collect_set("tag")).alias("tags")).withColumnRenamed("reference_id", "id")
    children = [
        _nested(pick(t["cve_vendor"]).join(v, "vendor_id", "left"), "vendors", "role", "role", "vendor", "vendor_id"),
        _nested(affected, "affected", "id", "vendor", "product", "product_type", "affected", "notes", "source", "versions"),
        _nested(pick(t["cve_cwe"]).join(t["cwe"], "cwe_id", "left"), "cwes", "cwe_id", "cwe_id", "name"),
        _nested(coded("cvss", [x for x in others("cvss") if x not in texts], *texts), "cvss", "id", *[x for x in others("cvss") if x != "id"]),
        _nested(coded("cpe_match", ["id"], "criteria", "match_criteria_id", "vulnerable"), "cpes", "id", "criteria", "match_criteria_id", "vulnerable"),
        _nested(deal(pick(t["reference"]).select("cve_id", "id", "url", "source", "title", "trust").join(tags, "id", "left")), "references", "id", "url", "source", "title", "trust", "tags"),
        _nested(deal(pick(t["cve_tag"]).join(t["tag"], F.col("tag_id") == F.col("id"), "left").select("cve_id", "name")), "tags", "name", "name"),
        _nested(rows("intel_string_list", "id", "kind", "value"), "intel_lists", "id", "kind", "value"),
        _nested(rows("exploit_artefact", *(artefact := ("source", "stable_id", "url", "artefact_type", "platform", "published_date", "confidence"))), "artefacts", "stable_id", *artefact),
        _nested(rows("product_candidate", "product_id", "matched_text"), "product_candidates", "product_id", "product_id", "matched_text"),
    ]
    one = lambda name, alias: rows(name, *others(name)).groupBy("cve_id").agg(F.first(F.struct(*others(name))).alias(alias))
    for child in [*children, one("exploit", "exploit"), one("kev", "kev"), one("intel", "intel")]:
        c = c.join(child, "cve_id", "left")
    return c


def get_cve(t: Tables, cve_id: str) -> DataFrame:
    ids = t.spark.createDataFrame([(X.canonical_id(cve_id),)], "cve_id string")
    return documents(t, ids)


def risk_flags(t: Tables) -> DataFrame:
    """Per record: highest score, its vector's meaning, and the derived booleans."""
    best = t["cvss"].groupBy("cve_id").agg(F.max_by(F.struct("score", "attack_vector", "privileges_required", "user_interaction", "integrity_impact"), F.struct("score", -F.col("id"))).alias("b"))
    is_ = lambda c, v: F.coalesce(F.upper(F.col(f"b.{c}")) == v, F.lit(False))
    j = t["cve"].select("cve_id").join(best, "cve_id", "left").join(t["kev"].groupBy("cve_id").agg(F.max("listed").alias("listed")), "cve_id", "left").join(t["exploit"].groupBy("cve_id").agg(F.max("in_the_wild").alias("itw")), "cve_id", "left")
    j = j.select("cve_id", F.col("b.score").alias("cvss_max"), X.severity_bucket("b.score").alias("severity"), (F.coalesce("listed", F.lit(False)) | F.coalesce("itw", F.lit(False))).alias("actively_exploited"), is_("attack_vector", "NETWORK").alias("remote"), (is_("privileges_required", "NONE") & is_("user_interaction", "NONE")).alias("unauthenticated"), is_("integrity_impact", "HIGH").alias("high_integrity"))
    j = j.withColumn("rce", F.col("high_integrity") & F.col("remote")).drop("high_integrity")
    return j.withColumn("internet_critical", F.col("remote") & F.col("unauthenticated") & F.col("rce"))

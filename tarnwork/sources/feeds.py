"""Enrichment feeds: scoring pages, the exploited-vulnerability catalogue, probability scores, package data, exploit corpora.

Each has a reader (landed files to rows) and a merge (rows into Tables). There is no network here.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators.merge import assign_ids, coalesce_merge, ensure_dimension, insert_ignore, keep_first, overwrite, replace_group, vendor_key, without
from ..operators.tables import Tables, conform
from .records import _BLOCK

# scoring pages

_METRIC = f"array<struct<source:string,type:string,cvssData:{_BLOCK.replace('struct<', 'struct<version:string,', 1)},exploitabilityScore:double,impactScore:double>>"
_NVD = (
    f"struct<id:string,vulnStatus:string,sourceIdentifier:string,lastModified:string,metrics:struct<cvssMetricV31:{_METRIC},cvssMetricV30:{_METRIC}>,"
    "weaknesses:array<struct<source:string,type:string,description:array<struct<lang:string,value:string>>>>,configurations:array<struct<nodes:array<struct<operator:string,negate:boolean,cpeMatch:array<struct<criteria:string,matchCriteriaId:string,vulnerable:boolean>>>>>>,"
    "references:array<struct<url:string,source:string,tags:array<string>>>,cisaExploitAdd:string,cisaActionDue:string,cisaRequiredAction:string,cisaVulnerabilityName:string>"
)
NVD_PAGE = f"totalResults int, resultsPerPage int, startIndex int, vulnerabilities array<struct<cve:{_NVD}>>"


def read_nvd(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all landed pages; of repeats the last modified counts."""
    pages = spark.read.schema(NVD_PAGE).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return latest_nvd(pages.select(F.explode("vulnerabilities").alias("v")).select("v.cve.*"))


def latest_nvd(rows: DataFrame) -> DataFrame:
    return keep_first(rows.withColumn("cve_id", F.upper(X.strip("id"))).where("cve_id <> ''"), ["cve_id"], F.coalesce("lastModified", F.lit("")), last=True)


def since(rows: DataFrame, watermark: str | None) -> DataFrame:
    """Rows modified at the watermark or later: some of its very moment may have landed since, and merging one again changes nothing."""
    return rows.where(F.col("lastModified") >= watermark) if watermark else rows


def date_windows(start: str, end: str, days: int = 119) -> list[tuple[str, str]]:
    """Contiguous windows of at most `days` days with shared ends; none if start is not before end."""
    a, b = (datetime.fromisoformat(x.replace("Z", "+00:00")) for x in (start, end))
    out = []
    while a < b:
        c = min(a + timedelta(days=days), b)
        out.append((a.isoformat(), c.isoformat()))
        a = c
    return out


def merge_nvd(t: Tables, rows: DataFrame) -> Tables:
    """Known records only. Status is overwritten, the modification date only moves on, scores and references are added by key, a non-empty identifier list replaces the old one."""
    rows = rows.join(t["cve"].select("cve_id"), "cve_id", "left_semi")
    new = rows.select("cve_id", F.col("vulnStatus").alias("st"), F.col("sourceIdentifier").alias("si"), X.strip("lastModified").alias("lm"))
    cve = t["cve"].join(new, "cve_id", "left").withColumns({
        "vuln_status": F.when(F.col("st").isNotNull(), F.col("st")).otherwise(F.col("vuln_status")), "source_identifier": F.when(F.col("si").isNotNull(), F.col("si")).otherwise(F.col("source_identifier")),
        "modified": F.when(F.col("lm") > F.coalesce("modified", F.lit("")), F.col("lm")).otherwise(F.col("modified")),
    }).select(*t["cve"].columns)
    empty = F.array().cast(_METRIC)
    m = rows.select("cve_id", F.posexplode(F.concat(F.coalesce("metrics.cvssMetricV31", empty), F.coalesce("metrics.cvssMetricV30", empty))).alias("k", "m")).where("m.cvssData is not null")
    b = F.col("m.cvssData")
    scores = m.select(
        "cve_id", "k", F.coalesce(b["version"], F.lit("")).alias("version"), F.coalesce(b["baseScore"], F.lit(0.0)).alias("score"), F.coalesce(b["vectorString"], F.lit("")).alias("vector"), X.severity_on_write(b["baseSeverity"], b["baseScore"]).alias("severity"),
        *[F.coalesce(b[k], F.lit("")).alias(n) for n, k in (("attack_vector", "attackVector"), ("attack_complexity", "attackComplexity"), ("privileges_required", "privilegesRequired"), ("user_interaction", "userInteraction"), ("scope", "scope"), ("confidentiality_impact", "confidentialityImpact"), ("integrity_impact", "integrityImpact"), ("availability_impact", "availabilityImpact"))],
        F.coalesce("m.source", F.lit("")).alias("metric_source"), F.coalesce("m.type", F.lit("")).alias("metric_type"), F.coalesce("m.exploitabilityScore", F.lit(0.0)).alias("exploitability_score"), F.coalesce("m.impactScore", F.lit(0.0)).alias("impact_score"),
    )
    key = ["cve_id", "vector", "metric_source", "metric_type"]
    fresh = without(keep_first(scores, key, "k"), t["cvss"], key)
    cvss = t["cvss"].unionByName(conform(assign_ids(fresh, t["cvss"], "id", *key), "cvss"))
    w = rows.select("cve_id", F.explode("weaknesses").alias("w")).select("cve_id", F.explode("w.description").alias("d")).where(F.lower(F.coalesce("d.lang", F.lit(""))).isin("", "en"))
    w = w.select("cve_id", F.upper(F.regexp_extract("d.value", r"(?i)CWE-\d+", 0)).alias("cwe_id")).where("cwe_id <> ''").distinct()
    cwe = insert_ignore(t["cwe"], w.select("cwe_id", F.lit("").alias("name"), F.lit("").alias("description")).distinct(), ["cwe_id"])
    nodes = rows.select("cve_id", F.explode("configurations").alias("c")).select("cve_id", F.explode("c.nodes").alias("n")).select("cve_id", F.posexplode("n.cpeMatch").alias("k", "x"))
    cpe = nodes.select("cve_id", "k", F.coalesce("x.criteria", F.lit("")).alias("criteria"), F.col("x.matchCriteriaId").alias("match_criteria_id"), F.coalesce("x.vulnerable", F.lit(True)).alias("vulnerable")).where("criteria <> ''")
    cpe = keep_first(cpe, ["cve_id", "criteria", "match_criteria_id"], "k")
    cpe_match = replace_group(t["cpe_match"], conform(assign_ids(cpe, t["cpe_match"], "id", "cve_id", "criteria", "match_criteria_id"), "cpe_match"), "cve_id")
    refs = rows.select("cve_id", F.posexplode("references").alias("k", "r")).select("cve_id", "k", X.strip("r.url").alias("url"), F.coalesce("r.source", F.lit("nvd")).alias("source"), F.coalesce("r.tags", F.array().cast("array<string>")).alias("tags")).where("url <> ''")
    out = _add_references(t, keep_first(refs, ["cve_id", "url"], "k").withColumn("trust", F.lit("COMMUNITY")))
    flagged = rows.where(F.col("cisaExploitAdd").isNotNull()).select("cve_id", F.lit(True).alias("listed"), F.coalesce(F.substring("cisaExploitAdd", 1, 10), F.lit("")).alias("date_added"), F.coalesce(F.substring("cisaActionDue", 1, 10), F.lit("")).alias("due_date"), F.col("cisaRequiredAction").alias("notes"), F.col("cisaVulnerabilityName").alias("vulnerability_name"), F.lit("nvd").alias("source"))
    flagged = without(flagged, t["kev"].where("source = 'cisa'"), ["cve_id"])
    kev = coalesce_merge(t["kev"], conform(flagged, "kev"), ["cve_id"])
    exploit = coalesce_merge(t["exploit"], conform(flagged.select("cve_id", F.lit(True).alias("in_the_wild")), "exploit"), ["cve_id"])
    return out.replaced(cve=cve, cvss=cvss, cwe=cwe, cve_cwe=insert_ignore(t["cve_cwe"], w, ["cve_id", "cwe_id"]), cpe_match=cpe_match, kev=kev, exploit=exploit)


def _add_references(t: Tables, refs: DataFrame) -> Tables:
    """refs: cve_id, url, source, trust, tags. Unseen urls are added with their tags."""
    fresh = assign_ids(without(refs, t["reference"], ["cve_id", "url"]), t["reference"], "id", "cve_id", "url")
    tags = fresh.select(F.col("id").alias("reference_id"), F.explode("tags").alias("tag")).where("tag is not null").distinct()
    return t.replaced(reference=t["reference"].unionByName(conform(fresh.withColumn("title", F.lit("")), "reference")), reference_tag=t["reference_tag"].unionByName(tags))


# exploited-vulnerability catalogue

KEV_SCHEMA = "catalogVersion string, vulnerabilities array<struct<cveID:string,vendorProject:string,product:string,vulnerabilityName:string,dateAdded:string,shortDescription:string,requiredAction:string,dueDate:string,knownRansomwareCampaignUse:string,notes:string,cwes:array<string>>>"


def read_kev(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.schema(KEV_SCHEMA).option("multiLine", True).json(path)
    return kev_rows(doc.select("catalogVersion", F.explode("vulnerabilities").alias("v")).select("catalogVersion", "v.*"))


def kev_rows(rows: DataFrame) -> DataFrame:
    return keep_first(rows.withColumn("cve_id", F.upper(X.strip("cveID"))).where("cve_id <> ''"), ["cve_id"], F.coalesce("dateAdded", F.lit("")), last=True)


def merge_kev(t: Tables, rows: DataFrame) -> Tables:
    """Missing records are created without dates; catalogue fields win; the empty primary vendor becomes the catalogue's."""
    stub = rows.select("cve_id", F.lit("").alias("title"), F.lit("").alias("summary"), F.lit("").alias("technical_details"), F.lit(0).alias("priority_score"), F.lit(1.0).alias("confidence"))
    t = t.replaced(cve=insert_ignore(t["cve"], conform(stub, "cve"), ["cve_id"]))
    n = rows.select("cve_id", X.blank_to_null("vulnerabilityName").alias("a"), X.blank_to_null("shortDescription").alias("b"), X.blank_to_null("notes").alias("c"))
    cve = t["cve"].join(n, "cve_id", "left").withColumns({"title": F.coalesce("a", "title"), "summary": F.coalesce("b", "summary"), "technical_details": F.coalesce("c", "technical_details")}).select(*t["cve"].columns)
    day = lambda c: F.coalesce(F.date_format(X.day(c), "yyyy-MM-dd"), F.lit(""))
    kev = rows.select("cve_id", F.lit(True).alias("listed"), day("dateAdded").alias("date_added"), day("dueDate").alias("due_date"), F.col("notes"), F.col("vulnerabilityName").alias("vulnerability_name"), F.col("requiredAction").alias("required_action"), F.col("vendorProject").alias("vendor_project"), F.col("product").alias("product_label"), F.col("shortDescription").alias("short_description"), F.lit("cisa").alias("source"))
    ransom = F.lower(X.strip("knownRansomwareCampaignUse")).isin("known", "yes")
    flags = rows.select("cve_id", F.coalesce(ransom, F.lit(False)).alias("ransomware_usage"), F.lit(True).alias("in_the_wild"))
    exploit = coalesce_merge(t["exploit"], conform(flags, "exploit"), ["cve_id"])
    w = rows.select("cve_id", F.explode("cwes").alias("cwe_id")).select("cve_id", F.upper(X.strip("cwe_id")).alias("cwe_id")).where("cwe_id <> ''").distinct()
    urls = F.filter(F.transform(F.split(F.regexp_replace(F.coalesce("notes", F.lit("")), "\n", ";"), ";"), lambda x: F.trim(x)), lambda x: x.startswith("http"))
    refs = rows.select("cve_id", F.explode(F.array_distinct(urls)).alias("url")).withColumns({"source": F.lit("cisa-kev"), "trust": F.lit("CISA"), "tags": F.array().cast("array<string>")})
    t = _add_references(t, refs)
    named = rows.where(X.not_blank("vendorProject")).select("cve_id", F.trim("vendorProject").alias("name"))
    vendor = ensure_dimension(t["vendor"], named.select("name", F.lit("").alias("website"), F.lit("").alias("country"), F.col("cve_id").alias("seq")), "vendor_id", vendor_key(), "seq")
    blank = t["vendor"].where(~X.not_blank("name")).select("vendor_id")
    edges = t["cve_vendor"].where("role = 'primary'")
    taken = edges.join(blank, "vendor_id", "left_anti").select("cve_id")
    ids = vendor.select("vendor_id", F.lower(F.trim("name")).alias("vk"))
    new = named.join(taken, "cve_id", "left_anti").withColumn("vk", F.lower("name")).join(ids, "vk").select("cve_id", "vendor_id", F.lit("primary").alias("role"))
    emptied = edges.join(blank, "vendor_id", "left_semi").join(new.select("cve_id"), "cve_id", "left_semi")
    cve_vendor = without(t["cve_vendor"], emptied, ["cve_id", "vendor_id", "role"]).unionByName(new)
    return t.replaced(cve=cve, kev=overwrite(t["kev"], conform(kev, "kev"), ["cve_id"]), exploit=exploit, cwe=insert_ignore(t["cwe"], w.select("cwe_id", F.lit("").alias("name"), F.lit("").alias("description")).distinct(), ["cwe_id"]), cve_cwe=insert_ignore(t["cve_cwe"], w, ["cve_id", "cwe_id"]), vendor=vendor, cve_vendor=cve_vendor)


# probability scores and packages


def read_epss(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.schema("data array<struct<cve:string,epss:string,percentile:string>>").option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return epss_rows(doc.select(F.explode("data").alias("d")).select("d.*"))


def epss_rows(rows: DataFrame) -> DataFrame:
    """Rows with both numbers; others say nothing."""
    number = lambda c: F.expr(f"try_cast({c} AS DOUBLE)")
    return rows.select(F.upper(X.strip("cve")).alias("cve_id"), number("epss").alias("epss_score"), number("percentile").alias("epss_percentile")).where("cve_id <> '' and epss_score is not null and epss_percentile is not null")


def merge_epss(t: Tables, rows: DataFrame) -> Tables:
    return t.replaced(intel=overwrite(t["intel"], rows.select("cve_id", "epss_score", "epss_percentile"), ["cve_id"], "epss_score", known=t["cve"]))


def read_osv(spark: SparkSession, path: str) -> DataFrame:
    """(cve_id, packages) of landed documents; the file name is the id."""
    doc = spark.read.schema("affected array<struct<package:struct<ecosystem:string,name:string>>>").option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return doc.select(F.upper(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)).alias("cve_id"), osv_packages(F.col("affected")).alias("packages"))


def osv_packages(affected):
    """Sorted distinct ecosystem:name, both non-empty."""
    ok = F.filter(F.coalesce(affected, F.array().cast("array<struct<package:struct<ecosystem:string,name:string>>>")), lambda a: (F.coalesce(a["package"]["ecosystem"], F.lit("")) != "") & (F.coalesce(a["package"]["name"], F.lit("")) != ""))
    return F.array_sort(F.array_distinct(F.transform(ok, lambda a: F.concat_ws(":", a["package"]["ecosystem"], a["package"]["name"]))))


def pending_osv(t: Tables) -> DataFrame:
    """Records without packages and without the marker that they were looked up."""
    done = t["intel_string_list"].where(F.col("kind").isin("osv_package", "osv_checked")).select("cve_id").distinct()
    return t["cve"].select("cve_id").join(done, "cve_id", "left_anti")


def pending_nvd(t: Tables) -> DataFrame:
    return t["cve"].where(~X.not_blank("vuln_status")).select("cve_id")


def pending_epss(t: Tables) -> DataFrame:
    return t["cve"].select("cve_id").join(t["intel"].where("epss_score is not null"), "cve_id", "left_anti")


def merge_osv(t: Tables, rows: DataFrame) -> Tables:
    """rows: cve_id, packages[, authoritative]. Known values are ignored; authoritative answers leave a marker."""
    if "authoritative" not in rows.columns:
        rows = rows.withColumn("authoritative", F.lit(True))
    rows = rows.join(t["cve"].select("cve_id"), "cve_id", "left_semi")
    values = rows.select("cve_id", F.lit("osv_package").alias("kind"), F.explode("packages").alias("value")).unionAll(rows.where("authoritative").select("cve_id", F.lit("osv_checked"), F.lit("1")))
    fresh = without(values.where(X.not_blank("value")).distinct(), t["intel_string_list"], ["cve_id", "kind", "value"])
    return t.replaced(intel_string_list=t["intel_string_list"].unionByName(conform(assign_ids(fresh, t["intel_string_list"], "id", "cve_id", "kind", "value"), "intel_string_list")))


# exploit corpora: all give cve_id, source, stable_id, url, artefact_type, platform, published_date, confidence

ARTEFACT = "cve_id string, source string, stable_id string, url string, artefact_type string, platform string, published_date string, confidence string"


def read_nuclei(spark: SparkSession, path: str, repo_url: str, ref: str) -> DataFrame:
    """Template files below an extracted corpus; files that are not YAML or name no record drop out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{yaml,yml}").load(path).select("path", F.decode("content", "utf-8").alias("text"))
    return nuclei_rows(files.select(F.regexp_replace("path", "^.*?" + path.rstrip("/").rpartition("/")[2] + "/", "").alias("path"), "text"), repo_url, ref)


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("id", "severity", "ids")]))
def _template(texts):
    import pandas as pd
    import yaml

    def one(text):
        try:
            doc = yaml.safe_load(text or "")
        except yaml.YAMLError:
            return None, None, None
        if not isinstance(doc, dict):
            return None, None, None
        info = doc.get("info") if isinstance(doc.get("info"), dict) else {}
        c = info.get("classification") if isinstance(info.get("classification"), dict) else {}
        ids = c.get("cve-id")
        return str(doc.get("id") or "").strip(), str(info.get("severity") or "").strip().lower(), " ".join(map(str, ids)) if isinstance(ids, list) else str(ids or "")

    return pd.DataFrame([one(x) for x in texts], columns=["id", "severity", "ids"])


def nuclei_rows(files: DataFrame, repo_url: str, ref: str) -> DataFrame:
    """files: path within the corpus, text."""
    d = files.select("path", _template("text").alias("y")).where("y.id <> ''")
    ids, own = X.extract_all("y.ids", X.CVE_ID), X.extract_all("y.id", X.CVE_ID)
    rows = d.select("path", "y", F.explode(F.when(F.size(ids) > 0, ids).otherwise(own)).alias("cve_id"))
    return rows.select("cve_id", F.lit("nuclei").alias("source"), F.col("y.id").alias("stable_id"), F.concat(F.lit(f"{repo_url}/{ref}/"), "path").alias("url"), F.col("y.severity").alias("artefact_type"), F.lit("").alias("platform"), F.lit("").alias("published_date"), F.lit("exact").alias("confidence"))


def read_exploitdb(spark: SparkSession, path: str, entry_url: str) -> DataFrame:
    return exploitdb_rows(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path), entry_url)


def exploitdb_rows(rows: DataFrame, entry_url: str) -> DataFrame:
    have = set(rows.columns)
    text = lambda c: F.coalesce(X.strip(c), F.lit("")) if c in have else F.lit("")
    date = F.coalesce(*[X.blank_to_null(c) for c in ("date_published", "date") if c in have], F.lit(""))
    r = rows.where(X.not_blank("id")).select(X.strip("id").alias("edb"), F.explode(X.extract_all("codes", X.CVE_ID)).alias("cve_id"), text("type").alias("artefact_type"), text("platform").alias("platform"), date.alias("published_date"))
    return r.select("cve_id", F.lit("exploitdb").alias("source"), F.concat(F.lit("EDB-"), "edb").alias("stable_id"), F.concat(F.lit(f"{entry_url}/"), "edb").alias("url"), "artefact_type", "platform", "published_date", F.lit("parsed").alias("confidence"))


def read_metasploit(spark: SparkSession, path: str, repo_url: str) -> DataFrame:
    return metasploit_rows(spark.read.text(path, wholetext=True), repo_url)


def metasploit_rows(docs: DataFrame, repo_url: str) -> DataFrame:
    """docs: value, a JSON object of modules by name. A platform may be text or a list."""
    module = "struct<fullname:string,type:string,platform:variant,disclosure_date:string,references:array<string>>"
    m = docs.select(F.explode(F.from_json("value", f"map<string,{module}>")).alias("key", "m")).where("m is not null")
    listed = F.expr("try_variant_get(m.platform, '$', 'array<string>')")
    platform = F.coalesce(F.array_join(listed, ", "), F.expr("try_variant_get(m.platform, '$', 'string')"), F.lit(""))
    path = F.coalesce(X.blank_to_null("m.fullname"), F.trim("key"))
    r = m.select(path.alias("path"), F.explode(X.extract_all(F.array_join("m.references", " "), X.CVE_ID)).alias("cve_id"), X.strip(platform).alias("platform"), F.coalesce(X.strip("m.type"), F.lit("")).alias("artefact_type"), F.coalesce(X.strip("m.disclosure_date"), F.lit("")).alias("published_date")).where("path <> ''")
    return r.select("cve_id", F.lit("metasploit").alias("source"), F.col("path").alias("stable_id"), F.concat(F.lit(f"{repo_url}/modules/"), "path", F.lit(".rb")).alias("url"), "artefact_type", "platform", "published_date", F.lit("exact").alias("confidence"))


def merge_artefacts(t: Tables, rows: DataFrame) -> Tables:
    """Known records only; by (record, source, stable id) the new row's fields win and the id stays."""
    key = ["cve_id", "source", "stable_id"]
    rows = keep_first(rows.join(t["cve"].select("cve_id"), "cve_id", "left_semi"), key, "url", last=True)
    ids = t["exploit_artefact"].select("id", *key)
    known = rows.join(ids, key)
    fresh = assign_ids(without(rows, ids, key), t["exploit_artefact"], "id", *key)
    kept = without(t["exploit_artefact"], rows, key)
    return t.replaced(exploit_artefact=kept.unionByName(conform(known, "exploit_artefact")).unionByName(conform(fresh, "exploit_artefact")))

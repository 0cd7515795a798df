"""Record documents (one JSON object per file) to relational rows.

Rows carry natural keys and a sequence (`seq`) in place of surrogate ids; `ingest` turns them into ids and merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.merge import assign_ids, ensure_dimension, keep_first, overwrite, product_key, replace_graph, vendor_key
from ..operators.tables import Tables, conform

_BLOCK = "struct<vectorString:string,baseScore:double,baseSeverity:string,attackVector:string,attackComplexity:string,privilegesRequired:string,userInteraction:string,scope:string,confidentialityImpact:string,integrityImpact:string,availabilityImpact:string>"
_CONTAINER = (
    "struct<title:string,datePublic:string,providerMetadata:struct<shortName:string>,descriptions:array<struct<lang:string,value:string>>,"
    "affected:array<struct<vendor:string,product:string,versions:array<struct<status:string,version:string,lessThan:string,lessThanOrEqual:string,changes:array<struct<at:string,status:string>>>>>>,"
    "problemTypes:array<struct<descriptions:array<struct<cweId:string,description:string,lang:string>>>>,references:array<struct<url:string,name:string,tags:array<string>>>,"
    f"metrics:array<struct<cvssV3_0:{_BLOCK},cvssV3_1:{_BLOCK},cvssV4_0:{_BLOCK}>>>"
)
SCHEMA = f"dataType string, dataVersion string, cveMetadata struct<cveId:string,state:string,assignerOrgId:string,assignerShortName:string,datePublished:string,dateUpdated:string>, containers struct<cna:{_CONTAINER},adp:array<{_CONTAINER}>>, _corrupt_record string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All record files below path; a malformed file is dropped, not fatal."""
    raw = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return raw.where("_corrupt_record is null").drop("_corrupt_record")


def _text(c: Column) -> Column:
    return F.coalesce(X.strip(c), F.lit(""))


def _cna(path: str) -> Column:
    return F.col(f"containers.cna.{path}")


def parse(records: DataFrame) -> dict[str, DataFrame]:
    """cve, affected, cwe, cvss, reference and tag rows; one record per id, the last by update date."""
    r = records.withColumn("cve_id", _text(F.col("cveMetadata.cveId"))).where("cve_id <> ''")
    r = keep_first(r, ["cve_id"], F.coalesce("cveMetadata.dateUpdated", F.lit("")), F.to_json("containers"), last=True)
    containers = F.concat(F.array("containers.cna"), F.coalesce("containers.adp", F.array().cast(f"array<{_CONTAINER}>")))
    r = r.withColumn("all", F.filter(containers, lambda c: c.isNotNull()))
    cna = F.coalesce(F.nullif("cveMetadata.assignerShortName", F.lit("")), _cna("providerMetadata.shortName"), F.lit(""))
    cve = r.select(
        "cve_id", _text(_cna("title")).alias("title"), cna.alias("cna"), X.first_english(_cna("descriptions")).alias("summary"), F.lit("").alias("technical_details"),
        *[_iso(c).alias(n) for n, c in (("published", F.col("cveMetadata.datePublished")), ("modified", F.col("cveMetadata.dateUpdated")), ("discovered", _cna("datePublic")))],
        F.lit(0).alias("priority_score"), F.lit(1.0).alias("confidence"), F.coalesce("dataVersion", F.lit("")).alias("data_version"), F.coalesce("dataType", F.lit("")).alias("data_type"), F.coalesce("cveMetadata.state", F.lit("")).alias("state"), F.coalesce("cveMetadata.assignerOrgId", F.lit("")).alias("assigner_org_id"),
    )
    a = r.select("cve_id", F.posexplode(_cna("affected")).alias("pos", "a"))
    primary = keep_first(a.where(~X.is_placeholder_vendor("a.vendor")).select("cve_id", "pos", _text(F.col("a.vendor")).alias("vendor")), ["cve_id"], "pos").select("cve_id", "vendor")
    primary = cve.select("cve_id").join(primary, "cve_id", "left").select("cve_id", F.coalesce("vendor", F.lit("")).alias("vendor"))
    known = F.when(X.is_placeholder_vendor("a.vendor"), F.lit("")).otherwise(_text(F.col("a.vendor")))
    affected = a.where(_text(F.col("a.product")) != "").select("cve_id", "pos", known.alias("vendor"), _text(F.col("a.product")).alias("product"), F.col("a.versions").alias("versions"))
    ranges = affected.select("cve_id", "pos", "vendor", "product", F.posexplode("versions").alias("vpos", "v")).select(
        "cve_id", "pos", "vpos", "vendor", "product",
        F.when(F.col("v.status") == "affected", F.col("v.version")).alias("start_including"), F.col("v.lessThan").alias("end_excluding"), F.col("v.lessThanOrEqual").alias("end_including"),
        F.when(F.col("v.status") == "unaffected", F.try_element_at("v.changes", F.lit(-1))["at"]).alias("fixed_version"), F.coalesce("v.version", F.lit("")).alias("raw_text"),
    )
    p = r.select("cve_id", F.posexplode(F.flatten(F.transform(_cna("problemTypes"), lambda x: x["descriptions"]))).alias("pos", "d"))
    named = F.coalesce(F.nullif(X.strip("d.cweId"), F.lit("")), F.nullif(F.regexp_extract("d.description", r"(CWE-\d+)", 1), F.lit("")))
    cwe = keep_first(p.select("cve_id", "pos", named.alias("cwe_id"), F.coalesce("d.description", F.lit("")).alias("name")).where("cwe_id is not null"), ["cve_id", "cwe_id"], "pos")
    m = r.select("cve_id", F.posexplode("all").alias("c", "box")).select("cve_id", "c", F.posexplode("box.metrics").alias("k", "m"))
    blocks = m.select("cve_id", "c", "k", F.inline(F.array(*[F.struct(F.lit(v).alias("version"), F.lit(i).alias("i"), F.col(f"m.{key}").alias("b")) for i, (v, key) in enumerate((("3.0", "cvssV3_0"), ("3.1", "cvssV3_1"), ("4.0", "cvssV4_0")))]))).where("b is not null")
    # rows with a vector are one per vector; rows without are all kept
    order = F.struct("c", "k", "i")
    blocks = keep_first(blocks.withColumn("seq", order).withColumn("same", F.coalesce(F.nullif("b.vectorString", F.lit("")), F.to_json("seq"))), ["cve_id", "same"], "seq")
    cvss = blocks.select(
        "cve_id", "seq", "version", F.coalesce("b.baseScore", F.lit(0.0)).alias("score"), F.coalesce("b.vectorString", F.lit("")).alias("vector"), X.severity_on_write("b.baseSeverity", "b.baseScore").alias("severity"),
        *[F.coalesce(f"b.{k}", F.lit("")).alias(n) for n, k in (("attack_vector", "attackVector"), ("attack_complexity", "attackComplexity"), ("privileges_required", "privilegesRequired"), ("user_interaction", "userInteraction"), ("scope", "scope"), ("confidentiality_impact", "confidentialityImpact"), ("integrity_impact", "integrityImpact"), ("availability_impact", "availabilityImpact"))],
    )
    refs = r.select("cve_id", F.posexplode("all").alias("c", "box")).select("cve_id", "c", F.posexplode("box.references").alias("k", "x"))
    refs = refs.select("cve_id", F.struct("c", "k").alias("seq"), _text(F.col("x.url")).alias("url"), _text(F.col("x.name")).alias("title"), F.filter(F.coalesce("x.tags", F.array().cast("array<string>")), lambda g: g.isNotNull()).alias("tags"))
    tag = refs.select("cve_id", F.explode("tags").alias("name")).distinct()
    source = F.regexp_replace(F.get(F.filter("tags", lambda g: g.startswith("x_refsource_")), F.lit(0)), "x_refsource_", "")
    reference = keep_first(refs.where("url <> ''"), ["cve_id", "url"], "seq").select("cve_id", "seq", "url", F.coalesce(source, F.lit("cna")).alias("source"), "title", F.when(F.array_contains("tags", "vendor-advisory"), "VENDOR").otherwise("COMMUNITY").alias("trust"), "tags")
    return {"cve": cve, "primary": primary, "affected": affected, "ranges": ranges, "cwe": cwe, "cvss": cvss, "reference": reference, "tag": tag}


def _iso(c: Column) -> Column:
    return F.date_format(X.timestamp(c), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def ingest(t: Tables, parsed: dict[str, DataFrame]) -> Tables:
    """Delete and rebuild the graph of every parsed record. Vendors and products keep their first spelling."""
    a = parsed["affected"]
    seq = F.concat_ws("|", "cve_id", F.lpad(F.col("pos").cast("string"), 9, "0"))
    names = a.select(F.col("vendor").alias("name"), seq.alias("seq")).unionAll(parsed["primary"].select(F.col("vendor").alias("name"), F.concat("cve_id", F.lit("|")).alias("seq")))
    vendor = ensure_dimension(t["vendor"], names.select("name", F.lit("").alias("website"), F.lit("").alias("country"), "seq"), "vendor_id", vendor_key(), "seq")
    ids = vendor.select("vendor_id", F.lower(F.trim("name")).alias("vk"))
    with_vendor = a.withColumn("vk", F.lower(F.trim("vendor"))).join(ids, "vk").drop("vk")
    rows = with_vendor.select(F.col("product").alias("name"), "vendor_id", F.lit("UNKNOWN").alias("product_type"), F.lit("").alias("family"), F.lit("").alias("component"), seq.alias("seq"))
    product = ensure_dimension(t["product"], rows, "product_id", product_key(), "seq")
    pids = product.where("trim(coalesce(component, '')) = ''").select("product_id", "vendor_id", F.lower(F.trim("name")).alias("pk"))
    held = with_vendor.withColumn("pk", F.lower(F.trim("product"))).join(pids, ["vendor_id", "pk"])
    ap = keep_first(held, ["cve_id", "product_id"], "pos").select("cve_id", "product_id", "vendor_id", F.lit(True).alias("affected"), F.lit("").alias("notes"), F.lit("cna").alias("source"))
    ap = assign_ids(ap, t["affected_product"], "id", "cve_id", "product_id")
    ranges = parsed["ranges"].join(held.select("cve_id", "pos", "product_id"), ["cve_id", "pos"]).join(ap.select("cve_id", "product_id", F.col("id").alias("affected_product_id")), ["cve_id", "product_id"])
    body = ["start_including", "end_including", "end_excluding", "fixed_version", "raw_text"]
    ranges = keep_first(ranges, ["affected_product_id", *body], "pos", "vpos").select("affected_product_id", *body)
    ranges = assign_ids(ranges, t["version_range"], "id", "affected_product_id", "raw_text", "start_including", "end_excluding", "end_including", "fixed_version")
    primary = parsed["primary"].withColumn("vk", F.lower(F.trim("vendor"))).join(ids, "vk").select("cve_id", "vendor_id", F.lit("primary").alias("role"))
    edges = ap.select("cve_id", "vendor_id").distinct().join(primary, ["cve_id", "vendor_id"], "left_anti").withColumn("role", F.lit("affected"))
    refs = assign_ids(parsed["reference"], t["reference"], "id", "cve_id", "url")
    tag = ensure_dimension(t["tag"], parsed["tag"].select("name", F.col("name").alias("seq")), "id", {"name": F.col("name")}, "seq")
    ids_only = parsed["cve"].select("cve_id")
    new = Tables(t.spark, {
        "cve": conform(parsed["cve"], "cve"), "cve_vendor": primary.unionByName(edges).select("cve_id", "vendor_id", "role"), "affected_product": conform(ap, "affected_product"), "version_range": conform(ranges, "version_range"),
        "cve_cwe": conform(parsed["cwe"], "cve_cwe"), "cvss": conform(assign_ids(parsed["cvss"], t["cvss"], "id", "cve_id", "seq").withColumns({"metric_source": F.lit("cna"), "metric_type": F.lit("")}), "cvss"),
        "exploit": conform(ids_only.withColumns({"maturity": F.lit("NONE"), "ransomware_usage": F.lit(False), "in_the_wild": F.lit(False), "notes": F.lit("")}), "exploit"), "kev": conform(ids_only.withColumn("listed", F.lit(False)), "kev"),
        "reference": conform(refs, "reference"), "reference_tag": refs.select(F.col("id").alias("reference_id"), F.explode("tags").alias("tag")).distinct(),
        "cve_tag": parsed["tag"].join(tag.select(F.col("id").alias("tag_id"), "name"), "name").select("cve_id", "tag_id"),
    })
    cwe = overwrite(t["cwe"], keep_first(parsed["cwe"], ["cwe_id"], "cve_id", "pos", last=True).select("cwe_id", "name", F.lit("").alias("description")), ["cwe_id"])
    return replace_graph(t.replaced(vendor=vendor, product=product, tag=tag, cwe=cwe), new)

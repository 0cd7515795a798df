from pyspark.sql import functions as F

from tarnwork.operators import fulltext as FT
from tarnwork.operators import search as S
from tarnwork.operators import views as V
from tarnwork.operators.tables import Tables, conform


def tables(spark, **data):
    return Tables(spark, {n: conform(spark.createDataFrame(rows, ddl), n) for n, (ddl, rows) in data.items()})


def ids(df):
    return sorted(r[0] for r in df.collect())


def model(spark):
    return tables(
        spark,
        cve=("cve_id string, title string, summary string, published string", [("CVE-1", "alpha", "s" * 600, "2020-05-01"), ("CVE-2", "beta", "", "2021-01-01"), ("CVE-3", "gamma", "", ""), ("CVE-4", "delta", "", "2020-07-01")]),
        vendor=("vendor_id bigint, name string", [(0, ""), (1, "Acme"), (2, "Other")]),
        cve_vendor=("cve_id string, vendor_id bigint, role string", [("CVE-1", 1, "primary"), ("CVE-1", 2, "affected"), ("CVE-2", 2, "primary"), ("CVE-3", 0, "primary"), ("CVE-4", 0, "primary")]),
        product=("product_id bigint, name string, vendor_id bigint, component string", [(1, "Rocket", 1, ""), (2, "acme tool", 0, ""), (3, "sled", 2, "")]),
        affected_product=("id bigint, cve_id string, product_id bigint", [(1, "CVE-1", 1), (2, "CVE-3", 2), (3, "CVE-2", 3)]),
        product_cpe_vendor=("product_id bigint, slug string, n bigint", [(3, "acme_soft", 5)]),
        cve_cpe_vendor=("cve_id string, slug string", [("CVE-4", "acme")]),
        cvss=("id bigint, cve_id string, score double, severity string", [(1, "CVE-1", 9.8, "CRITICAL"), (2, "CVE-1", 5.0, "MEDIUM"), (3, "CVE-2", 6.1, "MEDIUM")]),
        intel=("cve_id string, epss_score double", [("CVE-1", 0.94), ("CVE-2", None)]),
        kev=("cve_id string, listed boolean, date_added string", [("CVE-1", True, "2022-01-01"), ("CVE-2", False, "")]),
        cve_cwe=("cve_id string, cwe_id string", [("CVE-1", "CWE-79")]),
        reference=("id bigint, cve_id string, url string", [(1, "CVE-1", "u1"), (2, "CVE-1", "u2")]),
        reference_tag=("reference_id bigint, tag string", [(1, "Patch"), (1, "a"), (2, "x")]),
        exploit_artefact=("id bigint, cve_id string, source string, stable_id string", [(1, "CVE-1", "nuclei", "b"), (2, "CVE-1", "exploitdb", "a")]),
    )


def test_search_filters_and_vendor_routes(spark):
    t = model(spark)
    assert ids(S.search_cves(t, cwe="cwe-79")) == ids(S.search_cves(t, kev_only=True)) == ids(S.search_cves(t, min_epss=0.5)) == ids(S.search_cves(t, min_cvss=9)) == ["CVE-1"]
    assert ids(S.search_cves(t, year=2020)) == ["CVE-1", "CVE-4"]
    row = S.search_cves(t, cwe="CWE-79").first()
    assert (row.severity, row.cvss_max, row.kev, len(row.summary)) == ("CRITICAL", 9.8, True, 500)
    assert [r.cve_id for r in S.search_cves(t, limit=2).collect()] == ["CVE-2", "CVE-4"]
    assert ids(S.vendor_product_ids(t, "acme", None)) == ["CVE-1", "CVE-2", "CVE-3", "CVE-4"]
    assert ids(S.vendor_product_ids(t, "acme", "sled")) == ["CVE-2"] and ids(S.vendor_product_ids(t, "other", "rocket")) == ["CVE-1"] and ids(S.vendor_product_ids(t, None, "rocket")) == ["CVE-1"]


def test_listings_and_document(spark):
    t = model(spark)
    v = {r.name: (r.cve_count, r.product_count, r.cpe_vendors) for r in S.list_vendors(t).collect()}
    assert v == {"Acme": (1, 1, None), "Other": (2, 1, "acme_soft")}
    assert [r.cve_id for r in S.list_kev(t, "2022-01-01").collect()] == ["CVE-1"] and S.list_kev(t, "2022-01-02").count() == 0
    assert [(r.url, r.tags) for r in S.references_for(t, " cve-1", "patch").collect()] == [("u1", ["Patch", "a"])]
    assert [r.source for r in S.exploits_for(t, "CVE-1").collect()] == ["exploitdb", "nuclei"] and S.exploits_for(t, "CVE-9").count() == 0
    d = S.get_cve(t, "cve-1").first()
    assert [x.vendor for x in d.vendors] == ["Other", "Acme"] and [x.product for x in d.affected] == ["Rocket"] and len(d.cvss) == 2 and d.kev.listed
    assert S.get_cve(t, "CVE-3").first().published is None and S.get_cve(t, "CVE-9").count() == 0
    o = S.database_overview(t).first()
    assert (o.cves, o.vendors, o.products, o.kev_listed, o.first_published) == (4, 2, 3, 1, "2020-05-01")


def test_views_on_windows(spark):
    t = model(spark)
    assert {r.severity: r.n for r in V.severity_distribution(t).collect()} == {"CRITICAL": 1, "MEDIUM": 1, "UNKNOWN": 1}
    assert [r.severity for r in V.severity_distribution(t).collect()] == ["CRITICAL", "MEDIUM", "UNKNOWN"]
    o = V.overview(t, "2020-01-01", "2020-12-31").first()
    assert (o.cves_total, o.cves_in_window, o.cvss_rows, o.vendors) == (4, 2, 2, 2)
    assert [tuple(r) for r in V.cooccurrence_pairs(t).collect()] == [("Acme", "Other", 1)]
    assert V.cwe_monthly(t, []).count() == 0 and V.tag_coverage_yearly(t, []).count() == 0
    raw = t["cve"].withColumn("vuln_status", F.when(F.col("cve_id") == "CVE-1", " ").when(F.col("cve_id") == "CVE-2", ""))
    assert [(r.vuln_status, r.n) for r in V.status_distribution(t.replaced(cve=raw)).collect()] == [("(unset)", 3)]
    assert sorted((r.vuln_status, r.n) for r in V.status_distribution(t.replaced(cve=raw), group_on="raw").collect()) == [("(unset)", 1)] * 3
    empty = Tables(spark)
    for name in ("severity_monthly", "enrichment_coverage", "cooccurrence_pairs", "remote_funnel", "epss_density"):
        V.VIEWS[name](empty).collect()


def test_full_text(spark):
    docs = spark.createDataFrame([(1, "The relay was vulnerable", ""), (2, "relay3 overflow", "buffer overflows"), (3, "Relays and buffers, buffer overflow", ""), (4, None, "Überlauf im Puffer")], "cve_id long, title string, summary string")
    index = FT.postings(docs, "cve_id", "title", "summary")
    hits = lambda q: sorted(r.cve_id for r in FT.search(index, q).collect())
    assert hits("relay") == [1, 3] and hits("relay*") == [1, 2, 3] and hits("buffer overflow") == [2, 3] and hits('"buffer overflow"') == [2, 3]
    assert hits("overflow NOT relay") == [2] and hits("vulnerability OR uberlauf") == [1, 4] and hits("(relay OR puffer) vulnerable") == [1]
    for bad in ("", "AND", '"open', "a )", "(a", "a NOT"):
        try:
            FT.parse(bad)
            raise AssertionError(bad)
        except ValueError:
            pass


def test_distinct_model_tables_are_dealt_by_bytes_of_input_and_only_once(spark, monkeypatch):
    from tarnwork.operators import lineage
    from tarnwork.plans.model_map import model_tables

    monkeypatch.setattr(lineage, "PART_BYTES", 1 << 14)  # sf0.001 then needs more partitions than the session's 3
    t = model_tables(spark, "/root/testdata/sf0.001")
    assert t["cve_vendor"].rdd.getNumPartitions() == lineage.parts_of(spark, "/root/testdata/sf0.001/lineitem.parquet") > 3
    plan = V.top_vendor_ids(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1
    assert plan.count("Exchange hashpartitioning") == 2, plan  # rows by record, counts by vendor


def test_documents_deal_rows_by_record_once_and_to_equal_partitions(spark, monkeypatch):
    import re

    from tarnwork.operators import lineage
    from tarnwork.plans.model_map import model_tables

    monkeypatch.setattr(lineage, "PART_BYTES", 1 << 14)
    parts = lineage.parts_of(spark, "/root/testdata/sf0.001/lineitem.parquet")
    documents = S.documents(model_tables(spark, "/root/testdata/sf0.001"))
    plan = documents._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, (\d+)\), (\w+)", plan)
    assert {(n, why) for key, n, why in dealt if key == "cve_id"} == {(str(parts), "REPARTITION_BY_NUM")}
    versions = documents.selectExpr("cve_id", "inline(affected)").groupBy().agg(F.count("*"), F.count("product"), F.sum(F.size(F.coalesce("versions", F.array())))).first()
    t = model_tables(spark, "/root/testdata/sf0.001")
    assert tuple(versions) == (t["affected_product"].count(), t["affected_product"].join(t["product"].where("name is not null"), "product_id").count(), t["affected_product"].join(t["version_range"], F.col("affected_product_id") == t["affected_product"]["id"], "left_semi").count())


def test_all_vendors_are_paired_and_large_records_in_blocks(spark, monkeypatch):
    import itertools

    held = {"CVE-1": range(1, 71), "CVE-2": (3, 69), "CVE-4": (3, 70, 99), "CVE-9": (1, 2)}  # 99 has no name, CVE-9 is no record
    t = model(spark).replaced(
        vendor=spark.createDataFrame([(i, f"v{i}") for i in range(1, 71)] + [(99, " ")], "vendor_id bigint, name string"),
        cve_vendor=spark.createDataFrame([(c, v, role) for c, vs in held.items() for v in vs for role in ("primary", "affected")], "cve_id string, vendor_id bigint, role string"),
    )
    want = {(f"v{a}", f"v{b}"): 1 for a, b in itertools.combinations(range(1, 71), 2)} | {("v3", "v69"): 2, ("v3", "v70"): 2}
    for members in (V.MEMBERS, 70, 69, 8, 1):
        monkeypatch.setattr(V, "MEMBERS", members)
        rows = V.cooccurrence_pairs(t).collect()
        assert len(rows) == len(want) == 2415 and {(r.vendor_a, r.vendor_b): r.shared_cves for r in rows} == want
    assert [tuple(r) for r in rows[:2]] == [("v3", "v69", 2), ("v3", "v70", 2)]
    monkeypatch.setattr(V, "MAX_NAMES", 0)
    assert {(r.vendor_a, r.vendor_b): r.shared_cves for r in V.cooccurrence_pairs(t).collect()} == want
    assert V.cooccurrence_pairs(t, top_k=3).count() == 3 and V.cooccurrence_pairs(t, max_pairs=5).count() == 5


def test_documents_are_the_same_whether_texts_travel_as_codes(spark, monkeypatch):
    from tarnwork.plans.model_map import model_tables

    t = model_tables(spark, "/root/testdata/sf0.001")
    odd = t["cvss"].where("id % 3 = 0").withColumn("scope", F.when(F.col("id") % 2 == 0, F.col("attack_vector"))).withColumn("attack_vector", F.when(F.col("id") % 2 == 1, F.col("attack_vector")))
    t = t.replaced(cvss=odd)  # the same text now in one column, now in the next, the other null
    coded = S.documents(t).select("cve_id", "cvss", "cpes")
    assert "__code" in coded._jdf.queryExecution().optimizedPlan().toString()
    got = {r.cve_id: (r.cvss, r.cpes) for r in coded.collect()}
    monkeypatch.setattr(S, "MAX_CODED", 0)
    plain = S.documents(t).select("cve_id", "cvss", "cpes")
    assert "__code" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert got == {r.cve_id: (r.cvss, r.cpes) for r in plain.collect()} and sum(len(c or []) for c, _ in got.values()) == odd.count() > 0

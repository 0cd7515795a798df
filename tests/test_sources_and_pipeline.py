import json

import pytest
from pyspark.sql import functions as F

from tarnwork.operators.tables import Tables, conform
from tarnwork.plans.gather import run_pipeline
from tarnwork.plans.store import Store, stamp, state
from tarnwork.sources import feeds, records
from tarnwork.streaming.incremental import merge_stream


def record(cve, **cna):
    body = {
        "title": " A title ", "descriptions": [{"lang": "fr", "value": "non"}, {"lang": "EN", "value": "Acme Rocket flaw"}],
        "affected": [{"vendor": "n/a", "product": "n/a"}, {"vendor": "Acme", "product": "Rocket", "versions": [{"status": "affected", "version": "1", "lessThan": "2"}, {"status": "unaffected", "version": "3", "changes": [{"at": "3.1", "status": "affected"}, {"at": "3.2", "status": "affected"}]}]}, {"vendor": "ACME ", "product": "rocket", "versions": [{"status": "affected", "version": "1", "lessThan": "2"}]}],
        "problemTypes": [{"descriptions": [{"cweId": "CWE-79", "description": "xss"}, {"description": "see CWE-80 here"}, {"cweId": "CWE-79", "description": "again"}]}],
        "references": [{"url": "http://a", "name": "x", "tags": ["x_refsource_MISC", "vendor-advisory"]}, {"url": "http://a", "tags": ["exploit"]}, {"url": ""}],
        "metrics": [{"cvssV3_1": {"vectorString": "V1", "baseScore": 9.8, "baseSeverity": "critical"}}, {"cvssV3_1": {"vectorString": "V1", "baseScore": 1.0}}, {"cvssV4_0": {"vectorString": "", "baseScore": 5.0}}, {"cvssV4_0": {"vectorString": "", "baseScore": 5.0}}],
    } | cna
    return {"dataType": "R", "dataVersion": "5", "cveMetadata": {"cveId": cve, "assignerShortName": "org", "datePublished": "2020-01-02T03:04:05.000Z", "dateUpdated": "junk"}, "containers": {"cna": body, "adp": [{"references": [{"url": "http://b", "tags": ["Patch"]}]}]}}


@pytest.fixture
def landed(tmp_path):
    d = tmp_path / "cves" / "2020"
    d.mkdir(parents=True)
    for c in ("CVE-2020-0001", "CVE-2020-0002"):
        (d / f"{c}.json").write_text(json.dumps(record(c)))
    (d / "CVE-2020-0003.json").write_text(json.dumps(record("CVE-2020-0003", affected=[{"vendor": "n/a", "product": "n/a"}])))
    (d / "bad.json").write_text("{ not json")
    page = {"vulnerabilities": [{"cve": {"id": "CVE-2020-0003", "vulnStatus": "Analyzed", "lastModified": "2022-01-01T00:00:00", "metrics": {"cvssMetricV31": [{"source": "n", "type": "Primary", "cvssData": {"version": "3.1", "vectorString": "V", "baseScore": 7.5}, "exploitabilityScore": 3.9}]}, "weaknesses": [{"description": [{"lang": "en", "value": "cwe-22"}]}], "configurations": [{"nodes": [{"cpeMatch": [{"criteria": "cpe:2.3:a:new_co:gadget:1", "matchCriteriaId": "m"}, {"criteria": "cpe:2.3:o:os:os:1", "vulnerable": False}]}]}], "references": [{"url": "http://n", "tags": ["Exploit"]}], "cisaExploitAdd": "2022-02-02"}}, {"cve": {"id": "CVE-9999-0001"}}]}
    (tmp_path / "nvd").mkdir()
    (tmp_path / "nvd" / "p.json").write_text(json.dumps(page))
    (tmp_path / "kev.json").write_text(json.dumps({"catalogVersion": "1", "vulnerabilities": [{"cveID": "CVE-2020-0001", "vendorProject": "Acme", "vulnerabilityName": "KEV name", "dateAdded": "2021-03-04", "dueDate": "bad", "knownRansomwareCampaignUse": "Known", "notes": "see http://k ; https://l\nhttp://m", "cwes": ["CWE-1"]}, {"cveID": "CVE-2021-7777", "vendorProject": "Else", "dateAdded": "2021-05-06"}]}))
    (tmp_path / "epss.json").write_text(json.dumps({"data": [{"cve": "CVE-2020-0001", "epss": "0.5", "percentile": "0.9"}, {"cve": "CVE-2020-0002", "epss": None, "percentile": "0.1"}, {"cve": "CVE-1", "epss": "1", "percentile": "1"}]}))
    (tmp_path / "nuclei").mkdir()
    (tmp_path / "nuclei" / "a.yaml").write_text("id: tmpl\ninfo:\n  severity: High\n  classification:\n    cve-id: [CVE-2020-0001, CVE-1999-0001]\n")
    (tmp_path / "nuclei" / "b.yaml").write_text("id: CVE-2020-0002\ninfo: {severity: low}\n")
    (tmp_path / "nuclei" / "c.yaml").write_text("id: [unclosed\n")
    (tmp_path / "edb.csv").write_text('id,type,platform,date_published,codes\n7,remote,linux,2020-01-01,"CVE-2020-0001;OSVDB-1"\n8,dos,,2020-01-01,\n7,remote,linux,2020-01-01,"CVE-2020-0001;OSVDB-1"\n')
    (tmp_path / "msf.json").write_text(json.dumps({"m/x": {"fullname": "exploit/x", "type": "exploit", "platform": ["Linux", "Windows"], "references": ["CVE-2020-0002"]}, "m/y": {"platform": "Linux", "references": ["URL-x"]}}))
    return tmp_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_record_parsing(spark, landed):
    p = records.parse(records.read_records(spark, f"{landed}/cves"))
    one = "cve_id = 'CVE-2020-0001'"
    c = p["cve"].where(one).first()
    assert (c.title, c.summary, c.cna, c.published, c.modified) == ("A title", "Acme Rocket flaw", "org", "2020-01-02T03:04:05+00:00", None) and p["cve"].count() == 3
    assert rows(p["affected"].where(one).select("vendor", "product")) == [("", "n/a"), ("ACME", "rocket"), ("Acme", "Rocket")]
    assert rows(p["cwe"].where(one).select("cwe_id", "name")) == [("CWE-79", "xss"), ("CWE-80", "see CWE-80 here")]
    assert rows(p["cvss"].where(one).select("vector", "score", "severity")) == [("", 5.0, "MEDIUM"), ("", 5.0, "MEDIUM"), ("V1", 9.8, "CRITICAL")]
    assert rows(p["reference"].where(one).select("url", "source", "trust")) == [("http://a", "MISC", "VENDOR"), ("http://b", "cna", "COMMUNITY")]
    assert [r[0] for r in rows(p["tag"].where(one).select("name"))] == ["Patch", "exploit", "vendor-advisory", "x_refsource_MISC"]


def test_pipeline_end_to_end(spark, landed, tmp_path):
    inputs = {"ingest": f"{landed}/cves", "nvd": f"{landed}/nvd", "kev": f"{landed}/kev.json", "epss": f"{landed}/epss.json", "nuclei": f"{landed}/nuclei", "exploitdb": f"{landed}/edb.csv", "metasploit": f"{landed}/msf.json"}
    store = Store(spark, f"{tmp_path}/store")
    t = run_pipeline(store, inputs, now="2024-01-01T00:00:00+00:00")
    named = t["affected_product"].join(t["product"], "product_id").select("cve_id", "name", "source")
    assert rows(named.where("cve_id in ('CVE-2020-0001', 'CVE-2020-0003')")) == [("CVE-2020-0001", "Rocket", "cna"), ("CVE-2020-0001", "n/a", "cna"), ("CVE-2020-0003", "gadget", "cpe")]
    assert t["version_range"].where("fixed_version = '3.2'").count() == 2 and t["version_range"].count() == 4
    kev = {r.cve_id: r for r in t["kev"].where("listed").collect()}
    assert set(kev) == {"CVE-2020-0001", "CVE-2021-7777", "CVE-2020-0003"} and kev["CVE-2020-0001"].due_date == "" and kev["CVE-2020-0003"].source == "nvd"
    assert rows(t["intel"].select("cve_id", "epss_score")) == [("CVE-2020-0001", 0.5)]
    flags = {r.cve_id: (r.public_poc, r.metasploit) for r in t["exploit"].collect()}
    assert flags["CVE-2020-0001"] == (True, False) and flags["CVE-2020-0002"] == (True, True) and flags["CVE-2020-0003"] == (False, False)
    assert rows(t["exploit_artefact"].select("cve_id", "source", "stable_id")) == [("CVE-2020-0001", "exploitdb", "EDB-7"), ("CVE-2020-0001", "nuclei", "tmpl"), ("CVE-2020-0002", "metasploit", "exploit/x"), ("CVE-2020-0002", "nuclei", "CVE-2020-0002")]
    assert t["cve"].where("cve_id = 'CVE-2020-0003'").first().vuln_status == "Analyzed" and state(t, "nvd") == ("2024-01-01T00:00:00+00:00", "2022-01-01T00:00:00")
    assert rows(t["cve_cpe_vendor"]) == [("CVE-2020-0003", "new_co")] and "http://m" in {r.url for r in t["reference"].collect()}


def test_merges_are_idempotent(spark, landed):
    cve = conform(spark.createDataFrame([("CVE-2020-0001",), ("CVE-2020-0003",)], "cve_id string"), "cve")
    t = Tables(spark, {"cve": cve})
    for merge, data in ((feeds.merge_nvd, feeds.read_nvd(spark, f"{landed}/nvd")), (feeds.merge_kev, feeds.read_kev(spark, f"{landed}/kev.json")), (feeds.merge_epss, feeds.read_epss(spark, f"{landed}/epss.json"))):
        once = merge(t, data)
        twice = merge(once, data)
        for name in once:
            drop = ["id"] if name == "cpe_match" else []  # a replaced list gets new ids
            assert rows(twice[name].drop(*drop)) == rows(once[name].drop(*drop)), (merge.__name__, name)
    osv = spark.createDataFrame([("CVE-2020-0001", ["npm:x"], True), ("CVE-2020-0003", [], False), ("CVE-0", ["npm:y"], True)], "cve_id string, packages array<string>, authoritative boolean")
    once = feeds.merge_osv(t, osv)
    assert rows(once["intel_string_list"].select("cve_id", "kind", "value")) == [("CVE-2020-0001", "osv_checked", "1"), ("CVE-2020-0001", "osv_package", "npm:x")]
    assert rows(feeds.merge_osv(once, osv)["intel_string_list"]) == rows(once["intel_string_list"]) and rows(feeds.pending_osv(once)) == [("CVE-2020-0003",)]


def test_date_windows():
    assert feeds.date_windows("2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z") == []
    w = feeds.date_windows("2024-01-01T00:00:00Z", "2025-01-01T00:00:00Z")
    assert len(w) == 4 and w[0][0].startswith("2024-01-01") and w[-1][1].startswith("2025-01-01") and all(a[1] == b[0] for a, b in zip(w, w[1:]))


def test_incremental_stream_merges_each_file_once(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    store.commit(Tables(spark, {"cve": conform(spark.createDataFrame([("CVE-1",), ("CVE-2",)], "cve_id string"), "cve")}))
    (tmp_path / "in").mkdir()
    schema = "cve string, epss string, percentile string"
    merge = lambda t, df: feeds.merge_epss(t, feeds.epss_rows(df))
    for k, (cve, score) in enumerate([("CVE-1", "0.1"), ("CVE-1", "0.3"), ("CVE-9", "0.9")]):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"cve": cve, "epss": score, "percentile": "0.5"}))
        t = merge_stream(store, f"{tmp_path}/in", schema, f"{tmp_path}/ck", merge)
    assert rows(t["intel"].select("cve_id", "epss_score")) == [("CVE-1", 0.3)]
    assert rows(merge_stream(store, f"{tmp_path}/in", schema, f"{tmp_path}/ck", merge)["intel"]) == rows(t["intel"])


def test_store_swaps_whole_models(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    assert store.load() == {}
    t = store.commit(Tables(spark, {"vendor": conform(spark.createDataFrame([(1, "a")], "vendor_id bigint, name string"), "vendor")}))
    t2 = store.commit(stamp(t, "x", "2024"), ["pipeline_run"])
    assert t2["vendor"].count() == 1 and state(t2, "x") == ("2024", None) and t2["cve"].where(F.lit(True)).count() == 0


def test_a_lost_race_fails(spark, tmp_path, monkeypatch):
    one, two = Store(spark, f"{tmp_path}/race"), Store(spark, f"{tmp_path}/race")
    t = stamp(one.load(), "nvd", "2024-01-01")
    one.commit(t, ["pipeline_run"])
    stale = two._manifest()
    one.commit(t, ["pipeline_run"])
    monkeypatch.setattr(two, "_manifest", lambda name=None: stale)
    with pytest.raises(RuntimeError):
        two.commit(stamp(t, "kev", "2024-01-02"), ["pipeline_run"])
    assert one._manifest()[0] == 2 and state(one.load(), "kev") == (None, None)

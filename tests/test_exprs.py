import datetime as dt

from pyspark.sql import functions as F

from tarnwork.functions import exprs as X
from tarnwork.functions.stemming import stem


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_severity_read_and_write_differ_at_zero(spark):
    rows = [(None,), (0.0,), (3.9,), (4.0,), (7.0,), (9.0,)]
    got = values(spark, rows, "s double", X.severity_bucket("s"), X.severity_on_write(F.lit(""), "s"))
    assert [g[0] for g in got] == ["UNKNOWN", "NONE", "LOW", "MEDIUM", "HIGH", "CRITICAL"]
    assert [g[1] for g in got] == ["UNKNOWN", "UNKNOWN", "LOW", "MEDIUM", "HIGH", "CRITICAL"]
    assert values(spark, [("high ", 1.0)], "d string, s double", X.severity_on_write("d", "s")) == [("HIGH",)]


def test_window_excludes_blank_and_is_inclusive(spark):
    rows = [(None,), ("",), ("  ",), ("2020-01-01T00:00:00+00:00",), ("2020-12-31",), ("2021-01-01",)]
    assert [v[0] for v in values(spark, rows, "p string", X.in_window("p", "2020-01-01", "2020-12-31"))] == [False, False, False, True, True, False]


def test_dates_tolerate_junk(spark):
    rows = [("junk",), ("2020-02-30",), ("2020-02-03T10:00:00Z",), (None,), ("2020-02-03 extra",)]
    got = values(spark, rows, "x string", X.day("x"), X.month_key("x"))
    assert got == [(None, None), (None, None), (dt.date(2020, 2, 3), "2020-02"), (None, None), (dt.date(2020, 2, 3), None)]


def test_week_key_is_monday_based_from_zero(spark):
    days = [dt.date(y, m, d) for y in (2000, 2015, 2020, 2024) for m, d in ((1, 1), (1, 5), (1, 6), (2, 29 if y != 2015 else 28), (12, 31))]
    got = values(spark, [(d.isoformat(),) for d in days], "x string", X.week_key("x"))
    assert [g[0] for g in got] == [d.strftime("%Y-%W") for d in days]


def test_cpe(spark):
    rows = [(r"cpe:2.3:a:ve\:n:p\+\+x:1:*",), ("cpe:2.3:a:Acme_Corp:Thing:1",), ("cpe:2.3:a:*:p:1",), ("cpe:2.3",), ("cpe:2.3:a:n/a:p:1",)]
    got = values(spark, rows, "c string", X.cpe_slug("c"), X.cpe_parts("c"))
    assert [g[0] for g in got] == ["ve\\", "Acme_Corp", "*", "", "n/a"]
    assert got[0][1] == ("ve:n", "p++x") and got[1][1] == ("acme_corp", "thing") and got[2][1] is None and got[3][1] is None and got[4][1] is None


def test_names_and_ids(spark):
    assert values(spark, [("Acme_Web  Server-2",)], "n string", X.humanise("n"), X.norm_key("n")) == [("Acme Web Server-2", "acmewebserver2")]
    assert values(spark, [("see cve-2020-1234, CVE-2020-1234 and CVE-2019-99999",)], "t string", X.extract_all("t", X.CVE_ID)) == [(["CVE-2019-99999", "CVE-2020-1234"],)]
    assert [v[0] for v in values(spark, [("N/A ",), (None,), ("acme",)], "v string", X.is_placeholder_vendor("v"))] == [True, True, False]
    assert X.clamp_limit(0) == 1 and X.clamp_limit(1000) == 100 and X.canonical_id(" cve-1 ") == "CVE-1"


def test_first_english(spark):
    ddl = "d array<struct<lang:string,value:string>>"
    rows = [([("fr", "a"), ("EN", "b")],), ([("en-US", "c"), ("de", "d")],), ([],), (None,)]
    assert [v[0] for v in values(spark, rows, ddl, X.first_english(F.col("d")))] == ["b", "c", "", ""]


def test_buckets(spark):
    rows = [("2024-01-01",), ("2024-01-31",), ("2024-03-31",), ("2024-05-01",), ("2023-12-31",), ("",), (None,)]
    assert [v[0] for v in values(spark, rows, "d string", X.due_bucket("d", "2024-01-01"))] == ["Due in 30 days", "Due in 30 days", "Due in 90 days", "Due later", "Overdue", "No due date", "No due date"]
    assert [v[0] for v in values(spark, [(1.2,), (-0.1,), (0.99,), (0.1,)], "p double", X.epss_decile("p"))] == [9, 0, 9, 1]


def test_stemmer():
    want = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "hopping": "hop", "happy": "happi", "relational": "relat", "vulnerabilities": "vulner", "sky": "sky", "controlling": "control"}
    assert {w: stem(w) for w in want} == want

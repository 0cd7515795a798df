"""Kept aggregates against those made anew; which buckets a refresh reads."""

from pyspark.sql import functions as F

from tarnwork.operators import merge as M
from tarnwork.operators.tables import Tables, conform
from tarnwork.plans.partials import Partials
from tarnwork.plans.store import Store

VALUES = {"total": "sum", "least": "min", "most": "max"}


def scored(t):
    score = F.col("epss_score")
    return t["cve"].join(t["intel"], "cve_id", "left").select("cve_id", F.col("title").alias("month"), score.alias("total"), score.alias("least"), score.alias("most"))


def rows(df):
    return sorted((r["month"], r["n"], round(r["total"], 9), r["least"], r["most"]) for r in df.collect())


def anew(store):
    return rows(scored(store.load()).groupBy("month").agg(F.count("*").alias("n"), *[getattr(F, how)(c).alias(c) for c, how in VALUES.items()]))


def test_a_refresh_reads_changed_buckets_only(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", buckets=8)
    ids = spark.range(200).select(F.concat(F.lit("CVE-"), F.col("id").cast("string")).alias("cve_id"), (F.col("id") % 5).cast("string").alias("title"), (F.col("id") / 1000).alias("epss_score"))
    store.commit(Tables(spark, {"cve": conform(ids, "cve"), "intel": conform(ids, "intel")}))
    kept = Partials(store, "months", ["cve", "intel"], scored, ["month"], VALUES)
    assert kept.result().count() == 0
    assert kept.refresh() == list(range(8)) and kept.refresh() == []
    assert rows(kept.result()) == anew(store)
    new = spark.createDataFrame([("CVE-3", 0.9, 0.5), ("CVE-4", 0.0, 0.5)], "cve_id string, epss_score double, epss_percentile double")
    touched = store.merge(new, lambda t: M.upsert_scores(t, new))
    assert kept.refresh() == touched and len(touched) <= 2
    assert rows(kept.result()) == anew(store)
    gone = store.load(touched[:1])["cve"].select("cve_id")
    store.merge(gone, lambda t: M.cascade_delete(t, gone))  # a bucket that empties, extremes that go
    assert kept.refresh() == []
    assert rows(kept.result()) == anew(store)
    assert rows(Partials(Store(spark, store.root), "months", ["cve", "intel"], scored, ["month"], VALUES).result()) == anew(store)

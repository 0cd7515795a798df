"""The bucketed store: what a merge of a few records reads and writes, lost races, pruning."""

import pytest
from pyspark.sql import functions as F

from tarnwork.operators import merge as M
from tarnwork.operators.tables import Tables, conform
from tarnwork.plans.store import WHOLE, Store


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def model(spark, n=400):
    ids = spark.range(n).select(F.concat(F.lit("CVE-"), F.col("id").cast("string")).alias("cve_id"), "id")
    return Tables(spark, {
        "cve": conform(ids.withColumn("title", F.lit("t")), "cve"), "intel": conform(ids.withColumn("epss_score", F.col("id") / 1000), "intel"),
        "vendor": conform(spark.createDataFrame([(1, "Acme")], "vendor_id bigint, name string"), "vendor"),
    })


def scores(spark, *keys):
    return spark.createDataFrame([(f"CVE-{k}", 0.9, 0.8) for k in keys], "cve_id string, epss_score double, epss_percentile double")


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store", buckets=8)
    s.commit(model(spark))
    return s


def test_merge_reads_and_writes_touched_buckets_only(spark, store):
    _, before = store._manifest()
    whole = M.upsert_scores(store.load(), scores(spark, 3, 5, 10_000))
    expected = rows(whole["intel"])
    read = []

    def make(t):
        read.extend(t["intel"].inputFiles())
        return M.upsert_scores(t, scores(spark, 3, 5, 10_000))

    buckets = store.merge(scores(spark, 3, 5, 10_000), make)
    version, after = store._manifest()
    assert version == 2 and 1 <= len(buckets) <= 3
    assert rows(store.load()["intel"]) == expected
    changed = {k for k in after if after[k] != before.get(k)}
    assert changed == {("intel", b) for b in buckets}
    of = {b: p for (n, b), p in before.items() if n == "intel"}
    assert all(any(f.startswith(of[b].removeprefix("file://")) or of[b].removeprefix("file://") in f for b in buckets) for f in read)
    size = lambda files: sum(len(open(f.removeprefix("file://"), "rb").read()) for f in files)  # noqa: E731, SIM115
    everything = store.load()["intel"].inputFiles()
    assert 0 < size(read) < 0.6 * size(everything)


def test_same_records_share_a_bucket(store):
    _, entries = store._manifest()
    t = store.load([0, 3])
    assert rows(t["cve"].select("cve_id")) == rows(t["intel"].select("cve_id"))
    assert t["vendor"].count() == 1 and ("vendor", WHOLE) in entries
    assert store.load([]).get("cve") is None


def test_rows_outside_the_buckets_are_refused(spark, store):
    few = store.touched(scores(spark, 3))
    t = store.load(few)
    stray = t.replaced(intel=t["intel"].unionByName(conform(spark.range(50).select(F.concat(F.lit("X-"), F.col("id").cast("string")).alias("cve_id")), "intel")))
    with pytest.raises(ValueError, match="outside"):
        store.commit(stray, ["intel"], few)
    assert store._manifest()[0] == 1


def test_a_bucket_that_empties_and_a_second_writer(spark, store, monkeypatch):
    few = store.touched(scores(spark, 3))
    gone = store.load(few)["cve"].select("cve_id")
    n = gone.count()
    store.merge(gone, lambda t: M.cascade_delete(t, gone))
    assert store.load()["cve"].count() == 400 - n == store.load()["intel"].count()
    other = Store(spark, store.root)
    stale = other._manifest()
    store.merge(scores(spark, 7), lambda t: M.upsert_scores(t, scores(spark, 7)))
    monkeypatch.setattr(other, "_manifest", lambda name=None: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        other.commit(Tables(spark, {"vendor": model(spark)["vendor"]}))


def test_prune_keeps_what_the_latest_versions_name(spark, store):
    for k in (1, 2, 3):
        store.merge(scores(spark, k), lambda t, k=k: M.upsert_scores(t, scores(spark, k)))
    before = rows(store.load()["intel"])
    assert store.prune(keep=1) >= 3
    assert len(store._versions()) == 1 and rows(store.load()["intel"]) == before and store.prune(keep=1) == 0
    assert Store(spark, store.root).touched(scores(spark, 1)) == store.touched(scores(spark, 1))  # the number of buckets is stored

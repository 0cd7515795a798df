"""Old snapshots read as new ones; each migration runs once."""

import json

import pytest

from tarnwork.operators.tables import Tables, conform
from tarnwork.plans.migrations import MIGRATIONS, Migration, migrate, open_store
from tarnwork.plans.store import WHOLE, Store


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_an_old_snapshot_reads_as_a_new_one(spark, tmp_path):
    """A manifest without buckets and migrations, tables without some columns."""
    root = f"file://{tmp_path}/old"
    spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.5, 0.1)], "cve_id string, epss_score double, epss_percentile double").write.parquet(f"{root}/data/intel/1")
    spark.createDataFrame([("A", False), ("B", True)], "cve_id string, public_poc boolean").write.parquet(f"{root}/data/exploit/1")
    spark.createDataFrame([(1, ""), (2, "Acme")], "vendor_id bigint, name string").write.parquet(f"{root}/data/vendor/1")
    (tmp_path / "old/manifest").mkdir()
    (tmp_path / "old/manifest/00000001.json").write_text("".join(json.dumps({"version": 1, "name": n, "path": f"{root}/data/{n}/1"}) + "\n" for n in ("intel", "exploit", "vendor")))
    store = open_store(spark, root, 4)
    t = store.load()
    assert rows(t["intel"]) == [("A", None, None), ("B", 0.5, 0.1)]
    assert rows(t["exploit"].select("cve_id", "public_poc", "metasploit")) == [("A", None, None), ("B", True, None)]
    assert rows(t["vendor"].select("vendor_id")) == [(2,)]
    version, entries = store._manifest()
    assert store.migrated() == MIGRATIONS[-1].number and ("intel", WHOLE) not in entries and store.buckets == 4
    assert migrate(store) == [] and store._manifest()[0] == version == 2
    store.merge(t["intel"].where("cve_id = 'B'"), lambda t: t.replaced(intel=t["intel"]))
    assert store.migrated() == MIGRATIONS[-1].number  # kept by later commits


def test_a_later_migration_runs_alone_and_a_failed_one_leaves_the_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s", 2)
    assert migrate(store) == []  # nothing stored
    store.commit(Tables(spark, {"intel": conform(spark.createDataFrame([("A", 0.0, 0.0)], "cve_id string, epss_score double, epss_percentile double"), "intel")}))
    ran = []
    note = lambda n: Migration(n, f"m{n}", lambda t: ran.append(n) or t)
    assert migrate(store, (note(1),)) == ["m1"]

    def fail(t):
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError):
        migrate(store, (note(1), note(2), Migration(3, "m3", fail)))
    assert store.migrated() == 1
    assert migrate(store, (note(3), note(2), note(1))) == ["m2", "m3"] and ran == [1, 2, 2, 3]
    assert rows(store.load()["intel"]) == [("A", 0.0, 0.0)]

from pyspark.sql import functions as F

from tarnwork.operators import merge as M
from tarnwork.operators.tables import Tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_policies_and_idempotence(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None)], "k int, s string, x double")
    new = spark.createDataFrame([(2, "c", 2.0), (3, "d", None), (3, "e", None)], "k int, s string, x double")
    once = M.overwrite(old, new, ["k"], "s")
    assert rows(once) == [(1, "a", 1.0), (2, "c", 2.0), (3, "e", None)]
    assert rows(M.overwrite(once, new, ["k"], "s")) == rows(once)
    ignored = M.insert_ignore(old, new, ["k"], "s")
    assert rows(ignored) == [(1, "a", 1.0), (2, "b", None), (3, "d", None)] and rows(M.insert_ignore(ignored, new, ["k"], "s")) == rows(ignored)
    assert rows(M.coalesce_merge(old, new.limit(1), ["k"]))[1] == (2, "c", 2.0)
    assert rows(M.coalesce_merge(old, spark.createDataFrame([(1, None, None)], old.schema), ["k"]))[0] == (1, "a", 1.0)
    known = spark.createDataFrame([(2,)], "k int")
    assert rows(M.overwrite(old, new, ["k"], "s", known=known)) == [(1, "a", 1.0), (2, "c", 2.0)]


def test_null_keys_are_values(spark):
    old = spark.createDataFrame([(None, "a")], "k int, s string")
    new = spark.createDataFrame([(None, "b")], "k int, s string")
    assert rows(M.overwrite(old, new, ["k"])) == [(None, "b")]
    assert rows(M.insert_ignore(old, new, ["k"])) == [(None, "a")]


def test_ids_continue_in_natural_order(spark):
    have = spark.createDataFrame([(7,)], "id bigint")
    new = spark.createDataFrame([(x,) for x in "hgfedcba"], "n string")
    got = rows(M.assign_ids(new, have, "id", "n").select("n", "id"))
    assert got == [(c, 8 + i) for i, c in enumerate("abcdefgh")]


def test_first_spelling_wins_in_dimensions(spark):
    have = spark.createDataFrame([(1, "Acme", "", "")], "vendor_id bigint, name string, website string, country string")
    new = spark.createDataFrame([("ACME ", "1"), ("Zeta", "3"), ("zeta", "2")], "name string, seq string").selectExpr("name", "'' website", "'' country", "seq")
    assert rows(M.ensure_dimension(have, new, "vendor_id", M.vendor_key(), "seq").select("vendor_id", "name")) == [(1, "Acme"), (2, "zeta")]


def test_dedupe_products_repoints_and_collapses(spark):
    t = Tables(spark, {
        "product": spark.createDataFrame([(1, "Foo", 1, None, None, ""), (2, "foo ", 1, None, None, None), (3, "bar", 1, None, None, "")], "product_id bigint, name string, vendor_id bigint, product_type string, family string, component string"),
        "affected_product": spark.createDataFrame([(10, "C", 1), (11, "C", 2), (12, "D", 2), (13, "D", 3)], "id bigint, cve_id string, product_id bigint"),
        "version_range": spark.createDataFrame([(1, 10), (2, 11)], "id bigint, affected_product_id bigint"),
    })
    out = M.dedupe_products(t)
    assert rows(out["product"].select("product_id")) == [(1,), (3,)]
    assert rows(out["affected_product"]) == [(10, "C", 1), (12, "D", 1), (13, "D", 3)] or rows(out["affected_product"].select("id", "cve_id", "product_id")) == [(10, "C", 1), (12, "D", 1), (13, "D", 3)]
    assert rows(out["version_range"].select("id")) == [(1,)]


def test_unscored_and_tri_state(spark):
    intel = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.1, 0.0), ("c", None, None)], "cve_id string, epss_score double, epss_percentile double")
    assert rows(M.null_unscored(intel)) == [("a", None, None), ("b", 0.1, 0.0), ("c", None, None)]
    x = spark.createDataFrame([("a", 0, 1)], "cve_id string, public_poc int, metasploit int")
    assert rows(M.tri_state(x)) == [("a", None, True)]


def test_graph_replacement_and_score_upsert(spark):
    from tarnwork.operators.tables import conform

    make = lambda name, ddl, data: conform(spark.createDataFrame(data, ddl), name)
    t = Tables(spark, {"cve": make("cve", "cve_id string, title string", [("A", "old"), ("B", "old")]), "cve_cwe": make("cve_cwe", "cve_id string, cwe_id string", [("A", "1"), ("B", "1")]), "intel": make("intel", "cve_id string, epss_score double", [("A", 0.1), ("B", 0.2)])})
    new = Tables(spark, {"cve": make("cve", "cve_id string, title string", [("A", "new"), ("C", "new")]), "cve_cwe": make("cve_cwe", "cve_id string, cwe_id string", [("A", "2"), ("C", "3")])})
    out = M.replace_graph(t, new)
    assert rows(out["cve"].select("cve_id", "title")) == [("A", "new"), ("B", "old"), ("C", "new")]
    assert rows(out["cve_cwe"]) == [("A", "2"), ("B", "1"), ("C", "3")] and rows(out["intel"].select("cve_id")) == [("B",)]
    assert rows(M.replace_graph(out, new)["cve_cwe"]) == rows(out["cve_cwe"])
    assert rows(M.replace_graph(t, new, steps=())["cve_cwe"]) == [("B", "1")]
    scores = spark.createDataFrame([("B", None, 0.5), ("Z", 0.9, 0.9)], "cve_id string, epss_score double, epss_percentile double")
    assert rows(M.upsert_scores(t, scores)["intel"]) == [("A", 0.1, None), ("B", 0.2, 0.5)]


def test_repeated_new_keys_are_folded(spark):
    old = spark.createDataFrame([("A", 0.1, 0.2), ("B", 0.3, None)], "cve_id string, epss_score double, epss_percentile double")
    new = spark.createDataFrame([("A", 0.5, None), ("A", 0.7, None), ("A", None, 0.9), ("C", None, 0.4), ("C", 0.2, None), (None, 0.1, None), (None, 0.2, None)], "cve_id string, epss_score double, epss_percentile double")
    got = sorted((tuple(r) for r in M.coalesce_merge(old, new, ["cve_id"]).collect()), key=str)
    assert got == sorted([("A", 0.7, 0.9), ("B", 0.3, None), ("C", 0.2, 0.4), (None, 0.2, None)], key=str)
    dated = new.where("cve_id = 'A'").withColumn("day", F.expr("case when epss_score = 0.5 then 2 else 1 end"))
    [row] = M.fold(dated, ["cve_id"], "day").collect()
    assert (row.epss_score, row.epss_percentile) == (0.5, 0.9)
    tables = Tables(spark).replaced(cve=spark.createDataFrame([("A",), ("B",)], "cve_id string"), intel=old)
    assert M.upsert_scores(tables, new)["intel"].groupBy("cve_id").count().where("count > 1").count() == 0


def test_duplicates_are_found_in_partitions_by_bytes_of_input(spark, tmp_path, monkeypatch):
    from tarnwork.operators import lineage

    monkeypatch.setattr(lineage, "PART_BYTES", 256)
    spark.range(1000).selectExpr("id", "'c' || id % 10 as cve_id", "'k' || id % 7 as criteria", "cast(null as string) as match_criteria_id").write.parquet(f"{tmp_path}/cpe")
    rows = spark.read.parquet(f"{tmp_path}/cpe")
    kept = M.dedupe_cpe(Tables(spark, {"cpe_match": rows}))["cpe_match"]
    assert f", {lineage.parts_of_rows(rows)}), REPARTITION_BY_NUM" in kept._jdf.queryExecution().executedPlan().toString()
    assert lineage.parts_of_rows(rows) > 3
    assert sorted(r["id"] for r in kept.collect()) == list(range(70))

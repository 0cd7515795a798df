import random

from pyspark.sql import functions as F

from tarnwork.operators import identity as I
from tarnwork.operators.tables import Tables, conform
from tarnwork.operators.token_automaton import TokenAutomaton


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, name, ddl, data):
    return conform(spark.createDataFrame(data, ddl), name)


def base(spark, products, vendors, ap, cpe, cve_vendor=()):
    return Tables(spark, {
        "vendor": table(spark, "vendor", "vendor_id bigint, name string", vendors),
        "product": table(spark, "product", "product_id bigint, name string, vendor_id bigint", products),
        "affected_product": table(spark, "affected_product", "id bigint, cve_id string, product_id bigint, source string", ap),
        "cpe_match": table(spark, "cpe_match", "id bigint, cve_id string, criteria string, vulnerable boolean", cpe),
        "cve_vendor": table(spark, "cve_vendor", "cve_id string, vendor_id bigint, role string", list(cve_vendor)),
    })


def cpe(i, cve, vendor, product, vulnerable=True):
    return (i, cve, f"cpe:2.3:a:{vendor}:{product}:1", vulnerable)


def test_rare_slugs_are_noise(spark):
    ap = [(i, f"C{i}", 1, "cna") for i in range(5)]
    cpes = [cpe(100 * i + k, f"C{i}", "own", "p") for i in range(5) for k in range(25)] + [cpe(1000 + i, f"C{i}", f"other{i}", "os", False) for i in range(5)]
    t = base(spark, [(1, "p", 1)], [(1, "Own")], ap, cpes)
    assert rows(I.product_cpe_vendor(t)) == [(1, "own", 125)]


def test_own_rows_guard_fanned_out_evidence(spark):
    ap = [(i, f"C{i}", 1, "cpe") for i in range(12)]
    cpes = [cpe(100 * i + k, f"C{i}", "my_vendor", "p") for i in range(12) for k in range(3)] + [cpe(5000 + 100 * i + k, f"C{i}", f"foreign{i}", "q") for i in range(12) for k in range(3)]
    t = base(spark, [(1, "p", 1)], [(1, "My Vendor")], ap, cpes)
    assert rows(I.product_cpe_vendor(t)) == [(1, "my_vendor", 36)]


def test_platform_never_names_a_record(spark):
    t = base(spark, [], [], [], [cpe(1, "A", "v", "p"), cpe(2, "A", "os", "o", False), cpe(3, "B", "*", "p")])
    assert rows(I.cve_cpe_vendor(t)) == [("A", "v")]


def test_dominance_on_both_sides_of_the_threshold(spark):
    products = [(1, "at", 1), (2, "below", 1), (3, "sole", 1), (4, "tie", 1), (5, "owned", 2), (6, "n/a", 1)]
    shares = {1: {"zeta": 8, "acme": 2}, 2: {"acme": 7, "zeta": 2}, 3: {"mid": 3}, 4: {"acme": 2, "zeta": 2}, 5: {"acme": 9}, 6: {"acme": 9}}
    cpes = [cpe(1000 * p + 100 * j + k, f"C{p}", slug, "p") for p, tally in shares.items() for j, (slug, n) in enumerate(tally.items()) for k in range(n)]
    t = base(spark, products, [(1, ""), (2, "Acme")], [(p, f"C{p}", p, "cna") for p in shares], cpes)
    assert rows(I.dominant_slug(t)) == [(1, "zeta"), (3, "mid")]


def test_repoint_moves_merges_and_stays(spark):
    vendors = [(1, ""), (2, "Acme"), (3, "big corp")]
    products = [(10, "solo", 1), (11, "under", 1), (12, "torn", 1), (13, "nobody", 1), (14, "twin", 1), (20, "Twin", 2)]
    ap = [(i, f"C{p}", p, "cna") for i, p in enumerate((10, 11, 12, 13, 14))] + [(50, "C14", 20, "cna"), (51, "Z", 14, "cna")]
    cpes = [cpe(i, c, v, "p") for i, (c, v) in enumerate([("C10", "acme")] * 3 + [("C11", "big_corp")] * 3 + [("C12", "acme")] * 2 + [("C12", "big_corp")] * 2 + [("C13", "nosuch")] * 3 + [("C14", "acme")] * 3)]
    out = I.build_vendor_index(base(spark, products, vendors, ap, cpes))
    owner = {r.product_id: r.vendor_id for r in out["product"].collect()}
    assert owner == {10: 2, 11: 3, 12: 1, 13: 1, 20: 2}
    assert rows(out["affected_product"].where("product_id = 20").select("id", "cve_id")) == [(50, "C14"), (51, "Z")]
    again = I.build_vendor_index(out)
    assert rows(again["product"]) == rows(out["product"]) and rows(again["product_cpe_vendor"]) == rows(out["product_cpe_vendor"])


def test_placeholders_resolve_once(spark):
    vendors = [(1, ""), (2, "Acme Inc")]
    products = [(1, "n/a", 1), (2, "rocket", 2)]
    ap = [(1, "A", 1, "cna"), (2, "B", 1, "cna"), (3, "C", 1, "cna"), (4, "D", 1, "cna"), (5, "E", 1, "cna"), (6, "E", 2, "cna")]
    cpes = [cpe(1, "A", "acme_inc", "rocket"), cpe(2, "B", "new_vendor", "tool_one"), cpe(3, "B", "new_vendor", "tool_two"), cpe(4, "C", "os_maker", "os", False), cpe(5, "D", "o1", "x", False), cpe(6, "D", "o2", "y", False), cpe(7, "E", "acme_inc", "rocket")]
    out = I.resolve_placeholders(base(spark, products, vendors, ap, cpes, [("A", 2, "primary")]))
    named = out["affected_product"].join(out["product"].select("product_id", F.col("name").alias("p")), "product_id")
    assert rows(named.where("cve_id in ('A', 'B', 'C', 'D', 'E')").select("cve_id", "p")) == rows(spark.createDataFrame([("A", "rocket"), ("B", "tool one"), ("B", "tool two"), ("C", "os"), ("D", "n/a"), ("E", "n/a"), ("E", "rocket")], "a string, b string"))
    assert out["affected_product"].where("id = 1").first().product_id == 2
    assert out["cve_vendor"].where("cve_id = 'A' and role = 'affected'").count() == 0
    again = I.resolve_placeholders(out)
    assert rows(again["affected_product"]) == rows(out["affected_product"]) and rows(again["vendor"]) == rows(out["vendor"]) and rows(again["cve_vendor"]) == rows(out["cve_vendor"])


def test_candidates_need_adjacent_names(spark):
    vendors = [(1, "Acme"), (2, "Widget")]
    products = [(10, "Rocket Launcher", 1), (11, "Widget", 2), (12, "Acme Shield", 1), (99, "n/a", 1)]
    texts = {"yes": "In Acme Rocket Launcher there is", "tail": "acme rocket launcher2.0.1 has", "word": "acme rocket launcherX", "no_vendor": "the rocket launcher", "apart": "acme and rocket launcher", "self": "widget widget", "own": "found in Acme Shield 3", "folded": "ACME Rocket-Launcher"}
    t = base(spark, products, vendors, [(i, k, 99, "cna") for i, k in enumerate(texts)], []).replaced(cve=conform(spark.createDataFrame([(k, v) for k, v in texts.items()], "cve_id string, title string"), "cve"))
    got = {(r.cve_id, r.product_id): r.matched_text for r in I.product_candidates(t).collect()}
    assert got == {("yes", 10): "Acme Rocket Launcher", ("tail", 10): "acme rocket launcher2.0.1", ("own", 12): "Acme Shield"}


def test_automaton_equals_the_join(spark, monkeypatch):
    """Overlapping names, names that start with their vendor, tails of digits, repeated tokens, null and empty texts."""
    rng = random.Random(4)
    word = lambda: rng.choice(["a1", "b", "b2", "c", "abc", "Abc3.1", "c-c"])
    texts = [(str(i), " ".join(word() for _ in range(rng.randint(0, 40)))) for i in range(60)] + [("null", None)]
    folded = lambda: rng.choice(["a1", "b", "b2", "c", "abc", "cc"])
    names = []
    for i in range(60):
        v, p = [folded() for _ in range(rng.randint(1, 2))], [folded() for _ in range(rng.randint(1, 3))]
        names.append((i, v, v + p if rng.random() < 0.3 else p, v[0]))
    d = spark.createDataFrame(names, "product_id bigint, v array<string>, p array<string>, first string")
    t = spark.createDataFrame(texts, "cve_id string, text string")
    walked = rows(I.find_candidates(t, d))
    assert len(walked) > 100 and walked == rows(I.join_candidates(t, d))
    monkeypatch.setattr(I, "MAX_NAMES", 10)
    assert rows(I.find_candidates(t, d)) == walked


def test_automaton_falls_back_over_links():
    a = TokenAutomaton([(1, 0, ["x", "y", "x", "z"]), (2, 0, ["y", "x", "w"]), (3, 0, ["x"]), (3, 1, ["y"])])
    assert a.first_hits("x y x w".split()) == {3: (0, 1, 0), 2: (1, 3, 0)}
    assert a.first_hits("x y x y x z9".split()) == {3: (0, 1, 0), 1: (2, 4, 0)}


def test_flags_stay_unknown_until_all_phases_ran(spark):
    t = Tables(spark, {"exploit": conform(spark.createDataFrame([("A",), ("B",)], "cve_id string"), "exploit"), "exploit_artefact": conform(spark.createDataFrame([(1, "A", "nuclei")], "id bigint, cve_id string, source string"), "exploit_artefact")})
    runs = lambda *p: conform(spark.createDataFrame([(x, "2024") for x in p], "phase string, last_completed_at string"), "pipeline_run")
    flags = lambda t: rows(I.write_exploit_flags(t).select("cve_id", "public_poc", "metasploit"))
    assert flags(t.replaced(pipeline_run=runs("nuclei"))) == [("A", None, None), ("B", None, None)]
    assert flags(t.replaced(pipeline_run=runs("nuclei", "exploitdb"))) == [("A", True, None), ("B", False, None)]
    assert flags(t.replaced(pipeline_run=runs("nuclei", "exploitdb", "metasploit"))) == [("A", True, False), ("B", False, False)]

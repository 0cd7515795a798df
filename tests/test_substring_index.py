"""Substring searches through stored trigrams against plain scans."""

import pytest

from tarnwork.functions import exprs as X
from tarnwork.operators import search
from tarnwork.plans.substring_index import SubstringIndex, needed, pieces

SCHEMA = "id long, body string"
DOCS = [(1, "The Quick brown fox"), (2, "a QUICKER ox"), (3, "qui ick"), (4, ""), (5, "ab"), (6, None), (None, "quick"), (7, "naïve 😀😁 ÜBER quick_ly 50% off"), (8, "a\\b%c"), (1, "the quick brown fox again"), (9, "x" * 200_000 + "needle")]
TERMS = ("quick", "QUICK", "ick", "fox a", "ab", "", "zzz", "😀😁 ü", "quick_ly", "50% off", "a\\b", "needle", "quickest")
PATTERNS = ("qu%ck", "q_ick", "quick\\_ly", "%", "50\\% off", "ab", "brown%again", "__", "a\\\\b")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.fixture
def index(spark, tmp_path):
    i = SubstringIndex(spark, f"file://{tmp_path}/grams", "bigint")
    i.update(spark.createDataFrame(DOCS, SCHEMA), "id", "body")
    return i


def test_pieces_and_needed_trigrams():
    assert pieces("Ab%c_d\\%e", True) == ["ab", "c", "d%e"] and pieces("a%b", False) == ["a%b"]
    assert needed("abcd") == ["abc", "bcd"] and needed("ab%cd", True) == [] and needed("aaaa") == ["aaa"]


def test_rows_equal_a_scan_through_updates_deletions_and_compaction(spark, index):
    def same(rows):
        docs = spark.createDataFrame(rows, SCHEMA)
        keyed = docs.where("id is not null").persist()
        for terms, wild in ((TERMS, False), (PATTERNS, True)):
            for term in terms:
                assert ids(index.search_in(docs, "id", "body", term, wild)) == ids(keyed.where(X.contains_ci("body", term, wild))), term
        keyed.unpersist()

    same(DOCS)
    new = [(2, "no more of that"), (10, "quick as well")]
    index.update(spark.createDataFrame(new, SCHEMA), "id", "body")
    index.delete(spark.createDataFrame([(7,), (99,)], "id long"), "id")
    rows = [d for d in DOCS if d[0] not in (2, 7)] + new
    same(rows)
    index.compact()
    assert len(index._state()[1]) == 1
    assert ids(index.search_in(spark.createDataFrame(rows, SCHEMA), "id", "body", "quick")) == [1, 1, 10]


def test_few_rows_reach_verification(spark, tmp_path):
    i = SubstringIndex(spark, f"file://{tmp_path}/many", "bigint")
    docs = spark.range(5000).selectExpr("id", "concat('common words of all rows ', id, if(id % 1000 = 7, ' splendid', '')) AS body")
    i.update(docs, "id", "body")
    assert i.candidates("splendid").count() == 5  # just the matches
    assert i.candidates("words splendid").count() == 0  # a trigram that no text holds ends the search
    assert 1 <= i.candidates("rows 4321").count() <= 50  # held apart: trigrams of the number, verified afterwards
    assert ids(i.search_in(docs, "id", "body", "rows 4321")) == [4321]
    plan = i.postings("term = 'spl'")._jdf.queryExecution().toString()
    assert "EqualTo(term,spl)" in plan


def test_an_empty_index_finds_nothing(spark, tmp_path):
    i = SubstringIndex(spark, f"file://{tmp_path}/none")
    docs = spark.createDataFrame([("a", "text")], "id string, body string")
    assert ids(i.search_in(docs, "id", "body", "text")) == [] == ids(i.search_in(docs, "id", "body", "t"))
    i.update(docs.limit(0), "id", "body")
    assert ids(i.search_in(docs, "id", "body", "text")) == []


def test_values_are_added_once(spark, tmp_path):
    i = SubstringIndex(spark, f"file://{tmp_path}/values")
    names = lambda *v: spark.createDataFrame([(x,) for x in v], "name string")
    i.update_values(names("Acme Corp", "acme", "xy", None, "acme"), "name")
    i.update_values(names("Acme Corp", "Acme Labs"), "name")
    assert i.postings("term = ''").count() == 4
    found = lambda t: sorted(r[0] for r in i.values(t).collect())
    assert found("ACME") == ["Acme Corp", "Acme Labs", "acme"] and found("x") == ["xy"] and found("c%l_bs") == ["Acme Labs"] and found("none") == []


def test_vendor_search_by_values_equals_the_scan(spark, tmp_path):
    from tarnwork.operators.tables import Tables
    from tarnwork.plans.model_map import model_tables

    t = model_tables(spark, "/root/testdata/sf0.001")
    assert isinstance(t, Tables)
    t = t.replaced(product_cpe_vendor=t["product"].selectExpr("product_id", "concat('slug_', product_id % 9) AS slug", "1L AS n"), cve_cpe_vendor=t["cve"].selectExpr("cve_id", "concat('slug_', length(title) % 9) AS slug"))
    i = SubstringIndex(spark, f"file://{tmp_path}/names")
    for table, column in search.NAMES:
        i.update_values(t[table], column)
    for vendor, product in (("slug_3", None), ("000000005", "blue"), (None, "blue"), ("_3", None)):
        plain, by_values = search.vendor_product_ids(t, vendor, product), search.vendor_product_ids(t, vendor, product, i.values)
        a, b = sorted(r[0] for r in plain.collect()), sorted(r[0] for r in by_values.collect())
        assert a == b and (a or vendor == "000000005")


def test_vendor_search_makes_the_slug_tables_once(spark, monkeypatch):
    """Their rows are made in one job each: neither the four additions to the index nor the search make them again."""
    from tarnwork.operators import identity
    from tarnwork.plans import catalogue_more
    from tarnwork.plans.model_map import model_tables

    t = model_tables(spark, "/root/testdata/sf0.001")
    made = spark.sparkContext.accumulator(0)

    def counted(it):
        for b in it:
            made.add(b.num_rows)
            yield b

    slugs = {x: f(t).mapInArrow(counted, f(t).schema) for x, f in (("product_cpe_vendor", identity.product_cpe_vendor), ("cve_cpe_vendor", identity.cve_cpe_vendor))}
    once = sum(f(t).count() for f in (identity.product_cpe_vendor, identity.cve_cpe_vendor))
    assert catalogue_more._vendor_by_grams(t.replaced(**slugs), "slug_3").count() > 0
    assert made.value == once


def test_lists_of_slices_and_pieces_equal_the_trigrams_of_each_text(monkeypatch):
    import pyarrow as pa

    from tarnwork.plans import substring_index as si

    texts = ["", "ab", "abc", "a\0\0\0b", "😀😁 ü", "abcdefghij" * 7, "aaaaaaa", "abc\0"]
    want = {(t, k) for k, x in enumerate(texts) for t in ["", *(x[i : i + 3] for i in range(len(x) - 2))]}
    for piece, size in ((1 << 20, 1 << 22), (4, 9), (1, 1), (4, 1 << 22)):
        monkeypatch.setattr(si, "PIECE", piece)
        monkeypatch.setattr(si, "SLICE", size)
        out = list(si.lists([pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["key", "text"])]))
        got = [(r["term"], k) for b in out for r in b.to_pylist() for k in r["keys"]]
        assert set(got) == want and sum(t == "" for t, _ in got) == len(texts)


def test_stored_rows_are_lists_of_keys(spark, tmp_path):
    i = SubstringIndex(spark, f"file://{tmp_path}/lists", "bigint")
    i.update(spark.range(0, 1000, 1, 2).selectExpr("id", "'same words in all of them' AS body"), "id", "body")
    stored = spark.read.parquet(i._state()[1][0]["postings"]).count()
    trigrams = len(needed("same words in all of them")) + 1
    assert stored <= 2 * trigrams and i.postings().count() == 1000 * trigrams

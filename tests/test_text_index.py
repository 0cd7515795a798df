"""The stored index against one made anew, after updates, deletions and compaction."""

import pytest

from tarnwork.operators import fulltext
from tarnwork.plans.text_index import TextIndex

SCHEMA = "id string, title string, body string"
DOCS = [("a", "Running rockets", "a rocket runs fast"), ("b", "Fast cars", "cars and rockets run"), ("c", None, "nothing here"), ("d", "", None), (None, "rockets", "lost"), ("e", "Rocket fuel", "fuel of rockets rockets")]


def scores(df):
    return [(r[0], round(r[1], 9)) for r in df.collect()]


def anew(spark, docs, query):
    index = fulltext.postings(spark.createDataFrame([d for d in docs if d[0]], SCHEMA), "id", "title", "body")
    return scores(fulltext.search(index, query, "id", None))


@pytest.fixture
def index(spark, tmp_path):
    i = TextIndex(spark, f"file://{tmp_path}/text")
    i.update(spark.createDataFrame(DOCS, SCHEMA), "id", "title", "body")
    return i


def test_updates_deletions_and_compaction(spark, index):
    now = {d[0]: d for d in DOCS}
    queries = ("rockets run", "fuel OR car NOT fast", '"fast cars"', "rock*")
    assert all(scores(index.search(q, None, "id")) == anew(spark, now.values(), q) for q in queries)
    new = [("b", "Slow cars", "no more of that"), ("f", "Rockets", "run, rocket, run")]
    index.update(spark.createDataFrame(new, SCHEMA), "id", "title", "body")
    index.delete(spark.createDataFrame([("e",), ("zz",)], "id string"), "id")
    now |= {d[0]: d for d in new}
    del now["e"]
    assert all(scores(index.search(q, None, "id")) == anew(spark, now.values(), q) for q in queries)
    index.compact()
    assert len(index._state()[1]) == 1
    assert all(scores(index.search(q, None, "id")) == anew(spark, now.values(), q) for q in queries[:2])


def test_a_query_reads_its_terms_only(spark, index):
    plan = index.postings(fulltext.wanted(fulltext.parse("rockets")))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(term, [rocket])]" in plan or "EqualTo(term,rocket)" in plan or "In(term" in plan
    assert {r["term"] for r in index.postings(fulltext.wanted(fulltext.parse("rockets"))).collect()} == {"rocket"}


def test_empty_index_and_stems_of_distinct_words(spark, tmp_path):
    i = TextIndex(spark, f"file://{tmp_path}/none")
    assert scores(i.search("rocket", None, "id")) == []
    i.delete(spark.createDataFrame([("a",)], "id string"), "id")
    i.update(spark.createDataFrame(DOCS[:1], SCHEMA), "id", "title", "body")
    assert [k for k, _ in scores(i.search("rocket", None, "id"))] == ["a"]
    words = spark.createDataFrame([(["running", "runs", "the"],), ([],), (["cars"],), (["running"],)], "w array<string>")
    assert [r[0] for r in words.coalesce(1).select(fulltext._stems("w")).collect()] == [["run", "run", "the"], [], ["car"], ["run"]]


def test_stored_queries_stem_the_words_of_their_sql_only(spark, tmp_path):
    """Porter's rules take erontier and ofed for forms of eronti and of; the SQL of the stored queries does not."""
    import duckdb

    from tarnwork.plans import catalogue

    rows = [(1, "en", "erontier hend one"), (2, "en", "eronties and hended"), (3, "fr", "the erontioued"), (4, "en", "of the ofed ofes"), (5, "en", "ofed the"), (6, "es", "eronti"), (7, "en", "nothing of the kind"), (8, None, None), (9, "en", "x y z"), (10, "en", "q r s t")]
    spark.createDataFrame(rows, "doc_id bigint, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("fts_stored_bm25", "fts_stored_phrase", "fts_bm25"):
        build, sql = catalogue.REGISTRY[name]
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert sorted(map(tuple, build(spark, f"file://{tmp_path}").select("doc_id", "score").collect())) == sorted(con.sql(f"SELECT doc_id, score FROM ({sql})").fetchall())


def test_lengths_without_a_row_per_word(spark):
    docs = spark.createDataFrame([d for d in DOCS if d[0]] + [("a", "again", "x")], SCHEMA)
    index = fulltext.postings(docs, "id", "title", "body")
    lengths = fulltext.lengths_of(docs, "id", "title", "body")
    assert sorted(lengths.collect()) == sorted(index.groupBy("id").count().collect())
    assert "Generate" not in lengths._jdf.queryExecution().toString()
    assert scores(fulltext.search(index, "rockets run", "id", None, lengths)) == scores(fulltext.search(index, "rockets run", "id", None)) != []


def test_words_are_listed_by_slices_not_a_row_for_each_word(spark, index, monkeypatch):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from tarnwork.plans import text_index

    texts = {"k": ["the", "of", "the"], "l": [], "m": ["of"], "n": ["thes", "the", "of", "x"]}
    more = {"k": ["of"], "l": [], "m": [], "n": ["x"]}
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()), pa.list_(pa.string())), pa.array(list(more.values()), pa.list_(pa.string()))], names=["key", "a", "b"])
    want, gap = {}, fulltext.GAP
    for k in texts:
        for p, w in [*enumerate(texts[k]), *((gap + p, w) for p, w in enumerate(more[k]))]:
            want.setdefault(("the" if w == "thes" else w, k), []).append(p)
    for size in (text_index.SLICE, 3, 1):
        monkeypatch.setattr(text_index, "SLICE", size)
        rows = [r for b in text_index.lists(lambda w: "the" if w == "thes" else w)(iter([batch])) for r in b.to_pylist()]
        got = {(r["term"], k): r["positions"][a:b] for r in rows if r["term"] for k, a, b in zip(r["keys"], [0, *r["ends"]], r["ends"])}
        assert got == want
        assert {k: n for r in rows if not r["term"] for k, n in zip(r["keys"], r["dls"])} == {"k": 4, "m": 1, "n": 5}
    monkeypatch.undo()
    listed = index._listed(spark.createDataFrame([d for d in DOCS if d[0]], SCHEMA).coalesce(1).toDF("key", "text0", "text1"), ["text0", "text1"])
    assert listed.groupBy("term").count().where("count > 1").isEmpty() and "Exchange" not in listed._jdf.queryExecution().toString()
    assert "EqualTo(term,)" in index._documents()._jdf.queryExecution().toString(), "documents are listed without reading the postings"
    assert index._documents().count() == 4 and index.postings(F.col("term") == "rocket").count() == 3


def test_rows_of_equal_keys_count_as_one_document(spark, tmp_path):
    docs = [*DOCS, ("b", "rockets again", "run"), ("d", None, "a car"), ("g", "run", ""), ("g", None, "")]
    i = TextIndex(spark, f"file://{tmp_path}/text")
    for _ in range(2):
        i.update(spark.createDataFrame(docs, SCHEMA), "id", "title", "body")
        assert all(scores(i.search(q, None, "id")) == anew(spark, docs, q) != [] for q in ("rockets run", "fuel OR car", '"again"', "run NOT fast"))
        i.compact()
        assert all(scores(i.search(q, None, "id")) == anew(spark, docs, q) != [] for q in ("rockets run", '"rockets again"', "fuel OR car"))

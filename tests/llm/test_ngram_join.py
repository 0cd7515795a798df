import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import ngram_join as N
from tarnwork.llm.flatwords import FlatWords

from .test_quality import thue_morse


def grams(text):
    w = re.findall(r"[0-9a-z_\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    g = [grams(t) for _, t in docs]
    inverse, parent, links = {}, list(range(len(docs))), [0] * len(docs)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(g):
        for x in s:
            inverse.setdefault(x, []).append(k)
    for k, s in enumerate(g):
        for j, n in Counter(j for x in s for j in inverse[x] if j != k).items():
            if n / (len(s) + len(g[j]) - n) >= 0.8 - 1e-9:
                links[k] += 1
                parent[find(j)] = find(k)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((docs[k][0], least.get(find(k)), links[k]) for k in range(len(docs)))


def corpus():
    r = random.Random(2)
    base = [f"w{r.randint(0, 300)}" for _ in range(120)]
    docs = []
    for k in range(90):
        w = base[:]
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"q{r.randint(0, 999)}"
        docs.append((100 + k, " ".join(w)))
    docs += [(k, " ".join(f"u{r.randint(0, 10**6)}" for _ in range(r.randint(1, 60)))) for k in range(40)]
    return docs + [(900, None), (901, ""), (902, " \n"), (908, "?! -- ..."), (909, docs[1][1].replace(" ", ", ", 9).upper() + "!"), (903, "one two"), (904, "ONE  two"), (905, "one"), (906, docs[0][1]), (906, docs[0][1]), (907, docs[0][1])]


@pytest.mark.parametrize("members", [1024, 16])
def test_equals_brute_force_whole_and_in_blocks(spark, monkeypatch, members):
    monkeypatch.setattr(N, "UNIT_MEMBERS", members)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in N.join_classes(df).collect())
    assert got == brute(docs)


def test_texts_that_cancel_in_a_polynomial_stay_different(spark):
    letters = ["".join(x) for x in thue_morse("a", "b")]
    words = [" ".join(x) for x in thue_morse("ab", "cd")]
    df = spark.createDataFrame(list(enumerate(letters + words)), "doc_id long, text string")
    f = {(r.doc_id, r.class_id) for r in N.join_classes(df).collect()}
    assert {i for i, c in f if i in (0, 1) and c == i} == {0, 1}
    signed = [FlatWords(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])) for t in words]
    assert len({w.text_hashes(w.word_hashes())[0][0] for w in signed}) == len({w.text_hashes(w.word_hashes())[1][0] for w in signed}) == 2


def test_a_chain_of_dissimilar_texts_stays_linear(spark, monkeypatch):
    """5,000 texts, each sharing buckets with its neighbours only: one component, unit rows in proportion, no link but the planted ones."""
    word = lambda i: f"w{i * 2654435761 % 4294967291:x}"
    docs = [(k, " ".join(word(10 * k + i) for i in range(60))) for k in range(5000)] + [(9000, " ".join(word(70 + i) for i in range(59)) + " tail")]
    seen, real = [], N.place

    def watched(members):
        placed, several = real(members)
        seen.append((members.count(), members.select("comp").distinct().count(), placed.agg(F.sum(F.size("units"))).first()[0]))
        return placed, several

    monkeypatch.setattr(N, "place", watched)
    got = {r.doc_id: (r.class_id, r.n_links) for r in N.join_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: ((7, 1) if i in (7, 9000) else (i, 0)) for i, _ in docs}
    [(members, components, rows)] = seen
    assert members > 4000 and components < 200 and rows <= 24 * members


def test_unit_rows_of_chains_and_of_near_copies(spark):
    chain = [(k, k, 1, 50, [k // 2 * 2 * 100 + 1, (k + 1) // 2 * 2 * 100 + 2] + [10**6 + 100 * k + j for j in range(22)], 0) for k in range(6000)]
    copies = [(10_000 + k, k, 1, 50, [7 if (k * 31 + j) % 5 else 10**9 + 100 * k + j for j in range(24)], 10_000) for k in range(3000)]
    df = spark.createDataFrame(chain + copies, "rep long, f1 long, copies long, n_grams long, bands array<long>, comp long")
    placed, several = N.place(df)
    rows = {r.comp: r.n for r in placed.groupBy("comp").agg(F.sum(F.size("units")).alias("n")).collect()}
    assert several and rows[0] <= 2 * 6000 and rows[10_000] == 3 * 3000


@pytest.mark.parametrize("members", [4])
def test_both_ways_of_splitting_count_alike(spark, monkeypatch, members):
    """Near copies in chains: split into buckets, they have the links of their neighbours."""
    monkeypatch.setattr(N, "UNIT_MEMBERS", members)
    word = lambda i: f"w{i * 2654435761 % 4294967291:x}"
    docs = [(k, " ".join(word(6 * k + i) for i in range(60))) for k in range(16)]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in N.join_classes(spark.createDataFrame(docs, "doc_id long, text string"), threshold=0.7).collect())
    assert got == Counter((k, 0, (k > 0) + (k < 15)) for k in range(16))


def test_keep_one_and_clashing_columns(spark):
    docs = [(5, "a b c d e f", 1, "x"), (3, "A b c d e f", 1, "x"), (9, "other words here", 1, "x"), (7, None, 1, "x"), (None, "a b c d e f", 1, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, class_id int, rep string")
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 3), (False, 7), (False, 9), (True, 0)]
    assert N.join_classes(df.limit(0)).count() == 0


def test_banding_reaches_its_recall():
    bands, rows = N.banding()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= N.MAX_HASHES


def test_intersections_of_frequent_and_rare_values():
    r = random.Random(1)
    sets = [set(r.sample(range(60), r.randint(1, 40))) | {1000 + i // 2} for i in range(70)]
    values = np.array([v for s in sets for v in sorted(s)])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    m = N.intersections(values, owner, len(sets))
    assert all(m[i, j] == (len(sets[i] & sets[j]) if i != j else 0) for i in range(len(sets)) for j in range(len(sets)))

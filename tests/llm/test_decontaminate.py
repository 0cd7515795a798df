import math
import random
import re
from collections import Counter

import pytest

from tarnwork.llm import decontaminate as D

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def grams(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])


def brute(docs, items):
    words = [(i, WORDS.findall((t or "").lower())) for i, t in items]
    words = [x for x in words if x[1]]
    df = Counter(g for _, w in words for g in set(grams(w)))
    weight = lambda g: math.log(1 + len(words) / max(1, df[g]))
    out = {}
    for d, t in docs:
        w = WORDS.findall((t or "").lower())
        if not w:
            continue
        for i, iw in words:
            b = Counter(grams(iw))
            for s in range(max(1, len(w) - len(iw) + 1)):
                a = Counter(grams(w[s : s + len(iw)]))
                shared = sum(weight(g) * min(n, b[g]) for g, n in a.items())
                sim = shared / sum(weight(g) * max(a[g], b[g]) for g in a.keys() | b.keys())
                if sim >= 0.8:
                    out[d, i] = max(out.get((d, i), 0), sim)
    return out


def data():
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(12, 40)))) for i in range(25)] + [(90, "just three words"), (91, None), (92, ""), (93, "Same Words As Another Item Here Now"), (93, "same words as another item here now")]
    docs = []
    for k in range(60):
        w = (r.choice(items[:25])[1]).split()
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = "zzz"
        if k % 7 == 0:
            w.insert(r.randrange(len(w)), "extra")
        docs.append((k, " ".join(["foo"] * r.randint(0, 9) + w + ["bar"] * r.randint(0, 9))))
    docs += [(100, None), (101, ""), (102, "some just three words there"), (103, "clean text without any of it at all"), (104, "SAME words as another item here now"), (104, "SAME words as another item here now"), (None, items[0][1])]
    return docs, items


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_equals_brute_force(spark, monkeypatch, broadcast):
    for bound in ("MAX_GRAMS", "MAX_ENTRIES", "MAX_KEYS"):
        monkeypatch.setattr(D, bound, broadcast)
    monkeypatch.setattr(D, "SEGMENT", 128 if broadcast else 16)
    docs, items = data()
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, words string, t1 int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.find_leaks(df, bench).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in rows}
    want = brute(docs, items)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-5 for k in want)
    kept = D.drop_leaky(df, bench)
    assert kept.columns == df.columns
    # rows go by their text, null ids too
    gone = {t for d, t in docs if t is not None and any(k[0] == d for k in want)}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t in docs if t not in gone) and (None, items[0][1]) in docs and items[0][1] in gone
    plan = D.find_leaks(df, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_a_row_with_a_null_id_goes_alone(spark):
    item = "one two three four five six seven eight"
    df = spark.createDataFrame([(1, "other words that no item holds at all"), (None, item), (None, None), (2, item + " tail"), (2, "clean text of the same id")], "doc_id long, text string")
    kept = D.drop_leaky(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, "other words that no item holds at all"), (None, None), (2, "clean text of the same id")])


def test_very_long_text_and_item_and_the_first_of_equal_windows(spark):
    r = random.Random(8)
    item = " ".join(f"i{r.randint(0, 9999)}" for _ in range(1500))
    short = "alpha beta gamma delta epsilon zeta eta"
    filler = lambda n: " ".join(f"f{r.randint(0, 999)}" for _ in range(n))
    docs = [(1, f"{filler(30_000)} {item} {filler(5)} {short} {filler(3000)} {short}"), (2, filler(50_000))]
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item), (2, short)], "item_id long, text string")).collect()
    assert sorted((x.doc_id, x.item_id, x.start, x.similarity) for x in got) == [(1, 1, 30_000, 1.0), (1, 2, 31_505, 1.0)]


def test_empty_tables(spark):
    docs, items = data()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert D.find_leaks(df.limit(0), bench).count() == 0 and D.find_leaks(df, bench.limit(0)).count() == 0
    assert D.drop_leaky(df, bench.limit(0)).count() == len(docs)


def test_blocks_cover_the_radius():
    r, plan = random.Random(1), D.block_plan()
    assert sorted(first + i for first, bits, _ in plan for i in range(bits)) == list(range(D.BITS))
    assert sum(own for *_, own in plan) + len(plan) == D.RADIUS + 1
    for _ in range(2000):
        far = sum(1 << i for i in r.sample(range(D.BITS), D.RADIUS))
        assert any(((far >> first) & ((1 << bits) - 1)).bit_count() <= own for first, bits, own in plan)
    assert all(len(set(D.flips(bits, own))) == D.ball(bits, own) for _, bits, own in plan)


def test_running_sums_give_the_windows_own_prints(spark):
    """The fingerprint from running sums is the SimHash of the window's votes, bit by bit."""
    docs, items = data()
    found = D.Index(spark.createDataFrame(items, "item_id long, text string"), 0.8, "item_id", "text")
    votes = {x.h: x.pull for x in found.weights.collect()}
    texts = D.candidate_texts(spark.createDataFrame(docs, "doc_id long, text string"), found, 0.8, "doc_id", "text")
    grams_of = {(x.doc_id, x.t1, x.size): list(x.grams) for x in texts.collect()}
    windows = D.window_prints(texts, found, 0.8).collect()
    assert len(windows) > 100
    default = round(math.sqrt(math.log(1 + found.n)) * D.SCALE)
    for x in windows[:200]:
        part = grams_of[x.doc_id, x.t1, x.size][x.start : x.start + x.n]
        for b in range(D.BITS):
            bit = b // D.LANE * D.LANE + D.LANE - 1 - b % D.LANE
            assert (x.print >> bit & 1) == (sum(votes.get(h, default) * (1 if h >> b & 1 else -1) for h in part) <= 0)


def test_no_leak_is_lost_where_weights_differ(spark):
    """Items of one passage that many share and a few rare words: what differs outweighs, n-gram by n-gram, what agrees."""
    r = random.Random(6)
    own = lambda n: [f"own{r.randrange(10**9)}" for _ in range(n)]
    docs, items = [], []
    for k, (shared, rare, n_items, n_docs) in enumerate([(200, 3, 200, 10), (90, 1, 30, 10), (60, 0, 40, 4)]):
        passage = [f"p{k}x{i}" for i in range(shared)]
        items += [(1000 * k + i, " ".join(passage + own(rare))) for i in range(n_items)]
        docs += [(1000 * k + i, " ".join(passage + own(rare))) for i in range(n_docs)]
    got = {(x.doc_id, x.item_id) for x in D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set(brute(docs, items))
    assert len(want) > 2000 and not got - want
    assert len(want - got) <= 0.005 * len(want)

"""Near-copies against all pairs by brute force; groups, chains, odd rows, the parts of the join."""

import itertools
import random
import re

import numpy as np

from tarnwork.llm import near_dedup as nd

SCHEMA = "doc_id long, text string"


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def plain(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i, (d, _) in enumerate(rows):
        c = min((x for x in groups[find(i)] if x is not None), default=None)
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def varied(rng, words, share, vocabulary=5000):
    return [w if rng.random() > share else f"v{rng.randrange(vocabulary)}" for w in words]


def corpus(seed, n=150):
    rng = random.Random(seed)
    boiler = [f"b{i}" for i in range(16)]
    rows = []
    while len(rows) < n:
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([1, 3, 4, 30, 120, 300]))]
        if rng.random() < 0.5:
            base += boiler
        for _ in range(rng.choice([1, 1, 2, 5])):
            rows.append(" ".join(varied(rng, base, rng.choice([0, 0.01, 0.03, 0.06]))))
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def test_equals_brute_force(spark):
    rows = corpus(1, 250)
    assert got(nd.near_copies(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_groups_of_near_copies_in_blocks(spark, monkeypatch):
    """Groups near the threshold, where one pivot does not reach all, cut into several blocks after one pivot."""
    monkeypatch.setattr(nd, "UNIT_MEMBERS", 16)
    rng = random.Random(5)
    rows = []
    for share in (0.02, 0.035, 0.08):
        base = [f"g{share}x{i}" for i in range(150)]
        rows += [" ".join(varied(rng, base, share)) for _ in range(50)]
    rows = list(enumerate(rows))
    assert got(nd.near_copies(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_chain(spark):
    """Each text is near its neighbours only; the ends share nothing."""
    rows = [(i, " ".join(f"c{j}" for j in range(i * 10, i * 10 + 120))) for i in range(16)]
    out = got(nd.near_copies(spark.createDataFrame(rows, SCHEMA)))
    assert out == plain(rows)
    assert {r[2] for r in out} == {0}


def test_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows, equal ids, null ids, further columns, an empty table."""
    long = " ".join(f"L{i % 70_000}" for i in range(200_000))
    rows = [
        (5, "A b C d e"), (4, "a B c D e"), (4, "a B c D e"), (9, None), (8, ""), (8, " \t\n"), (7, "one"), (6, "ONE"), (6, "other words here now then"), (None, "a b c d e"), (None, "null only text here ok"), (None, "null only text here ok"),
        (20, long), (21, long + " end"), (30, "x y z"), (31, "X Y z"), (32, "É a b c"), (33, "é a b c"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", f1 int").withColumnRenamed("f1", "Rep")
    expected = [(d, n, c, (d == c)) for d, n, c, _ in plain(rows)]
    assert got(nd.near_copies(df)) == sorted(expected, key=str)
    assert got(nd.near_copies(spark.createDataFrame([], SCHEMA))) == []


def test_parameters_of_the_prefix():
    t = nd.matches_at()
    assert 36 <= t <= 42
    rng = np.random.default_rng(1)
    assert (rng.binomial(64, 0.8, 200_000) < t).mean() < 2e-4


def test_counting_leaves_only_hopeless_pairs():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 3, (500, 64)).astype(np.uint32)
    b = np.where(rng.random((500, 64)) < rng.random((500, 1)), a, rng.integers(0, 3, (500, 64))).astype(np.uint32)
    for t in (1, 20, 39, 64):
        assert (nd.enough(a, b, t) == ((a == b).sum(1) >= t)).all()


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    other = np.append(base[:356], rng.integers(0, 2**63, 44, dtype=np.uint64))
    sig = nd.signatures(np.concatenate([base, other]), np.array([0, 400]), 2000)
    assert abs((sig[0] == sig[1]).mean() - 356 / 444) < 0.03

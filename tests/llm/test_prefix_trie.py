"""The trie of conversations against a plain version, open stacks over many partitions, and odd rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tarnwork.llm import prefix_trie
from tarnwork.llm.prefix_trie import adjacent_lcp, conversation_trie, stack_sweep, subtree_sums, trie_nodes, turn_arrays

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Every node by definition. rows: (conv_id, turn, role, text)."""
    own = {}
    for c, t, r, x in sorted(((c, (t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c is not None), key=lambda r: (r[0], r[1], r[2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest())):
        own.setdefault(c, []).append((r, x))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]  # remainders as in SQL
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = sorted(c for c in convs if len(built[c]) == len(prefix))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(convs), len(prefix), parent, len(convs), sum(len(p) == len(prefix) + 1 for p in below), len(childless), saved, sha))
    return sorted(out, key=lambda r: r[:2])


def got(df):
    return sorted((tuple(r) for r in df.select(*prefix_trie.RESULT).collect()), key=lambda r: r[:2])


def conversations(seed, n, words=3, most=6):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, most)):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice(["a", "b", "c d"]) for _ in range(rng.randint(0, words)))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,words,most", [(1, 60, 1, 4), (2, 120, 0, 3), (3, 80, 3, 6)])
def test_equals_the_plain_version(spark, seed, n, words, most):
    rows = conversations(seed, n, words, most)
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_stacks_over_partition_bounds(spark, monkeypatch, parts):
    """Deep shared paths, and ids that end at one node in several partitions and pieces."""
    rows = [(c, t, "user", f"turn {t}" if t < 9 or c % 7 else f"own {c}") for c in range(0, 120) for t in range(4 + c % 9)]
    monkeypatch.setattr(prefix_trie, "PART_TURNS", max(1, len(rows) // parts))
    monkeypatch.setattr(prefix_trie, "PIECE", 24)
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_odd_rows(spark):
    """Nulls anywhere, empty and very long texts, equal turns, repeated rows, absent bases, conversations without turns of their own, clashing names."""
    rows = [
        (0, None, "user", "first"), (0, 0, None, None), (0, 0, None, None), (1, 5, "user", ""), (1, 5, "user", "tie"), (1, 5, "assistant", "tie"), (2, 0, "user", "x " * 200_000), (3, 0, "user", "only"),
        (45, 1, "user", "no base"), (46, 0, "user", "\t\v words\n of  it "), (None, 0, "user", "lost"), (19, 0, "user", "y"), (18, 0, "user", "y"), (-3, 0, "user", "z"),
    ]
    df = spark.createDataFrame([(*r, "e") for r in rows], SCHEMA + ", keys string").withColumnRenamed("keys", "Digest")
    assert got(conversation_trie(df)) == plain(rows)
    assert got(conversation_trie(spark.createDataFrame([], SCHEMA))) == []


def test_equal_conversations_are_one_path(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(0, 4000, 20) for t in range(3)]
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_sweep_of_lcps():
    keys = np.array(list("abcabdbb"), "S1")
    offs = np.array([0, 3, 6, 7, 8])  # abc, abd, b, b
    lcp = adjacent_lcp(keys, offs)
    assert lcp.tolist() == [0, 2, 0, 1]
    end, parent, ends_at = stack_sweep(lcp, np.array([4, 1, 1, 0]))
    assert end.tolist() == [3, 1, 1, 0, 1, 3]  # root, a, ab, abc, abd, b
    assert parent.tolist() == [-1, 0, 1, 2, 2, 0]
    assert ends_at.tolist() == [3, 4, 5, 5]


def test_sums_over_long_paths(spark):
    n = 70
    nodes = spark.createDataFrame([(bytes([i]), bytes([i - 1]) if i else None, i, 1) for i in range(n)], "digest binary, parent_digest binary, depth long, v long")
    assert {r["digest"][0]: r["v"] for r in subtree_sums(nodes, "v").collect()} == {i: n - i for i in range(n)}


def test_any_arrays_make_a_trie(spark):
    arrays = turn_arrays(spark.createDataFrame([(7, 0, "a", "x"), (8, 0, "a", "x"), (8, 1, "b", "y z")], SCHEMA))
    assert [r[:7] for r in got(trie_nodes(arrays))] == [(7, 0, None, 2, 1, 1, 1), (7, 1, 7, 2, 1, 1, 1), (8, 2, 7, 1, 0, 1, 0)]

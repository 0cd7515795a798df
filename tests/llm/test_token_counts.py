import random

import public_tokenizers as P

from tarnwork.llm import token_counts as C

MODEL = P.path("piece_bpe_32k.model")


def greedy(word, vocabulary, longest):
    word, i, n = "▁" + word, 0, 0
    while i < len(word):
        for k in range(min(longest, len(word) - i), 0, -1):
            if word[i : i + k] in vocabulary:
                break
        else:
            return 1
        i, n = i + k, n + 1
    return n


def test_counts_equal_greedy_segmentation():
    r = random.Random(1)
    c, v = C.counter(MODEL), set(C.piece_vocabulary(MODEL))
    words = ["".join(r.choice("abcdetionhABC.12éß😀中▁") for _ in range(r.randint(1, 25))) for _ in range(4000)]
    assert all(c.word(w) == greedy(w, v, 16) for w in words)


def test_dead_ends_and_unknown_characters():
    v = ["▁", "a", "abcd", "b", "bc", "▁ab", "x"]
    c, r = C.LongestMatchCounter(v), random.Random(2)
    words = ["".join(r.choice("abcdxq") for _ in range(r.randint(1, 8))) for _ in range(4000)]
    assert all(c.word(w) == greedy(w, set(v), 4) for w in words)


def test_table_cases(spark):
    rows = [(1, None, "x", 9), (2, "", "x", 9), (3, " \t\n", "x", 9), (4, "the cat", "x", 9), (4, "the cat", "x", 9), (None, "the", "x", 9), (5, "a" * 200_000, "x", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, lang int")
    got = C.count_tokens(df, MODEL, keep=["doc_id"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_words, r.n_tokens))
    assert len(got) == 7 and by[1] == by[2] == by[3] == [(0, 0)] and by[4] == [(2, 2)] * 2 and by[None] == [(1, 1)] and by[5][0][0] == 1
    assert C.count_tokens(df.limit(0), MODEL, keep=["doc_id"]).collect() == []

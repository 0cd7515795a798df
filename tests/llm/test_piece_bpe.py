import hashlib
import random

import public_tokenizers as P
import pytest

from tarnwork.llm import piece_bpe as B

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def samples():
    r = random.Random(3)
    alphabet = " ▁ab\n\t1.éß😀中\u0001aaa the "
    out = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    return out + ["a" * n for n in range(1, 60)] + [" " * n for n in range(1, 50)] + ["ab" * 200, "x" + " " * 33 + "y", "the" * 50, "▁", "=-" * 100, "😀" * 30, "<s></s><0x41><unk>", "0" * 50, "word " * 3000, "a" * 20_000]


def test_encode_and_decode_equal_the_library(library):
    m = B.model(PATH)
    for t in samples():
        ids = library.encode(t)
        assert m.encode(t) == ids
        assert m.decode_ids(ids) == library.decode(ids)


def test_decode_of_any_ids(library):
    m, r = B.model(PATH), random.Random(4)
    for _ in range(1500):
        ids = [r.randrange(32000) if r.random() < 0.5 else r.randrange(3, 259) for _ in range(r.randint(0, 8))]
        assert m.decode_ids(ids) == library.decode(ids)


def test_table_cases(spark, library):
    rows = [(1, None, 0), (2, "", 0), (3, "the cat sat", 0), (3, "the cat sat", 0), (None, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = B.encode_texts(df, PATH, keep=["doc_id"], outputs=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == 5
    for r in got:
        text = {1: "", 2: "", 3: "the cat sat", None: "x"}[r.doc_id]
        ids = library.encode(text)
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert [r.decoded for r in B.decode_texts(spark.createDataFrame([([], ), (library.encode("a b"),), (None,)], "ids array<int>"), PATH).collect()] == ["", "a b", ""]
    assert B.encode_texts(df.limit(0), PATH, keep=["doc_id"]).count() == 0

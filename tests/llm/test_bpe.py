import hashlib
import random

import numpy as np
import pytest
import tiktoken

from tallyforge.llm import bpe
from tallyforge.llm.queries import QUERIES, tokenizers

NAMES = tokenizers()
PATH = NAMES.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), NAMES.PATTERN)


@pytest.fixture(scope="module")
def known():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=NAMES.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(codec, text):
    return np.frombuffer(next(codec.encode([text])), "<u4").tolist()


def test_every_code_point_splits_as_the_library_does(codec, known):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 4096):
        text = "".join(f"a{p}1{p} {p}{p}b" for p in points[k : k + 4096])
        if ids(codec, text) != known.encode_ordinary(text):
            bad = [p for p in points[k : k + 4096] if ids(codec, t := f"a{p}1{p} {p}{p}b") != known.encode_ordinary(t)]
            assert not bad, [hex(ord(p)) for p in bad[:20]]


def test_random_and_long_texts(codec, known):
    rng = random.Random(4)
    alphabet = "abcdeéèñß  \n\t'sl0129!?—日本🙂"
    for n in (0, 1, 2, 5, 63, 64, 65, 66, 300, 5000):
        for _ in range(8):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert ids(codec, text) == known.encode_ordinary(text)
    for text in ("a" * 20000, "ab" * 9000, " " * 5000 + "x", "thequickbrownfox" * 700, "日本語" * 3000, "!" * 3001):
        assert ids(codec, text) == known.encode_ordinary(text)


def test_rows_and_single_pieces_merge_alike(codec):
    rng = random.Random(9)
    pieces = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 64))).encode() for _ in range(500)]
    rows = codec._merge_rows(pieces, 64)
    assert rows == [codec._merge_one(p) for p in pieces]


def test_forgetting_changes_nothing(codec, monkeypatch):
    text = "Un texte qui revient, un texte qui reste."
    first = ids(codec, text)
    monkeypatch.setattr(bpe, "REMEMBERED", 0)
    assert ids(codec, text) == first


def test_nulls_repeats_extra_columns_and_empty(spark, known):
    rows = [(1, "hé hé", "x"), (None, None, "y"), (1, "hé hé", "x"), (2, "", None), (3, "w " * 30000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.round_trip(df, PATH, NAMES.PATTERN).collect()
    assert len(out) == 5
    by_id = {r["doc_id"]: r for r in out}
    for doc_id, text, _ in rows:
        want = known.encode_ordinary(text or "")
        assert by_id[doc_id]["n_tokens"] == len(want)
        assert by_id[doc_id]["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert by_id[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(df.limit(0), PATH, NAMES.PATTERN).count() == 0
    back = bpe.decode(bpe.encode(df, PATH, NAMES.PATTERN), PATH, NAMES.PATTERN)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back.collect())


def test_bad_ids_are_an_error(spark):
    df = spark.createDataFrame([([1, 99999999],)], "ids array<int>")
    with pytest.raises(Exception, match="outside the rank table"):
        bpe.decode(df, PATH, NAMES.PATTERN).collect()


def test_query_matches_the_library_on_the_whole_table(spark, known):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = QUERIES["op1_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(docs)
    for r in out:
        want = known.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == r["text_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()

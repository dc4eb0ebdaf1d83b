import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyforge.llm import align
from tallyforge.llm.queries import QUERIES, tokenizers

NAMES = tokenizers()
PATHS = NAMES.path("byte_bpe_50k.json"), NAMES.path("piece_bpe_32k.model")


def spans(tokens, text):
    """(id, start, end) of tokens given as (id, bytes), or None where they do not join to the text."""
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out if b"".join(raw for _, raw in tokens) == b" " + text.encode() else None


def brute(rows):
    """Token by token, every pair of tokens of a text compared."""
    a_tool = Tokenizer.from_file(PATHS[0])
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    chars = align.byte_of_char()
    assert sorted(chars.values()) == list(range(256)) and len(chars) == 256
    every, counts = [], Counter()
    for doc, text in rows:
        a = b = None
        if text:
            a = spans([(i, bytes(chars[c] for c in a_tool.id_to_token(i))) for i in a_tool.encode(" " + text, add_special_tokens=False).ids], text)
            spelt = [(i, b_tool.id_to_piece(i)) for i in b_tool.encode(text)]
            b = spans([(i, bytes([int(p[3:5], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode()) for i, p in spelt], text)
        if not a or not b:
            every.append((doc, [], [], [], ""))
            continue
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        counts.update(links)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for start, end in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (a, b)))
        every.append((doc, a, b, links, ";".join(groups)))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return sorted(
        (
            (doc, len(a), len(b), len(shown.split(";")) if shown else 0, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if shown else "")
            for doc, a, b, links, shown in every
        ),
        key=str,
    )


TEXTS = [
    "hello world", "Hello  world\n\ttabs", "naïve façade — 漢字 かな 🙂🙃  x", "<|endoftext|> and </s> <unk> <0x41>", " leading", "trailing ", "   ", "\n", "a", "▁odd ▁",
    "\x00\x01 control \x7f", "é and é", "hello world", "hello world", "ﬁ ligature ½ Ⅷ", "مرحبا بالعالم", "the the the the", "tokenization tokenizers",
]


def run(spark, rows, limit=align.BROADCAST):
    df = spark.createDataFrame([(d, t, 1, "k", 2) for d, t in rows], "doc_id long, text string, n long, key string, links int").repartition(3)
    return sorted((tuple(r) for r in align.measure(df, *PATHS, NAMES.PATTERN, limit).collect()), key=str)


@pytest.mark.parametrize("limit", [align.BROADCAST, 0])
def test_against_brute_force(spark, limit):
    rows = [*enumerate(TEXTS), (100, None), (101, ""), (None, "hello world"), (0, "hello world"), (0, "other"), (7, None)]
    assert run(spark, rows, limit) == brute(rows)


def test_very_long_text_and_a_hot_one(spark):
    long = "".join(f"word{i % 977} und {i}; " for i in range(40_000))
    rows = [(1, long), *[(i, "hot text of many rows") for i in range(2, 60)]]
    got = run(spark, rows)
    assert len(got) == 59 and len({g[1:] for g in got}) == 2
    one = next(g for g in got if g[0] == 1)
    assert one[4] == one[1] + one[2] - one[3] and one[1] > 100_000


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_on_whole_texts(spark):
    at = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    small = sorted(rows, key=lambda r: len(r[1] or ""))[:60]
    assert run(spark, small) == brute(small)
    out = QUERIES["op11_token_alignment"](spark, at).collect()
    assert sorted(r.doc_id for r in out) == sorted(d for d, _ in rows)
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups for r in out)


def test_both_engines_of_the_first_tokenizer_agree():
    """On every character that lets a text take the faster engine, in all kinds of company."""
    encode, known = align.byte_level(PATHS[0], NAMES.PATTERN)
    tool = Tokenizer.from_file(PATHS[0])
    tool.encode_special_tokens = True
    texts = [pre + chr(c) + post for c in range(0x250) for pre in ("", "a", "1", "!", " ", "  ", "'") for post in ("", "b", "2", "?", " ", " x", "s")]
    texts += ["<|endoftext|> plain", "it's they'll I'D   end  ", "\r\n\t x"]
    assert [x.tolist() for x in encode(texts)] == [tool.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert encode(["漢字"])[0].tolist() == tool.encode(" 漢字", add_special_tokens=False).ids

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import tiktoken
from test_jaccard import brute
from test_mixing import size, targets

import corpus_pipeline as pipeline
from tallyforge.llm import bpe
from tallyforge.llm.queries import tokenizers

AT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{AT}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, AT).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_stage_columns(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns == pipeline.COLUMNS


def test_quality_and_language_keep_clean_documents(spark, steps):
    bad = {r.doc_id for r in spark.read.parquet(f"{AT}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{AT}/labels.parquet").where("quality = 1").collect()}
    kept = {r.doc_id for r in steps[0][1].collect()}
    assert len(bad & kept) <= 0.1 * len(bad) and len(good - kept) <= 0.02 * len(good)
    before, after = (t.count() for t in steps[1])
    assert 0 <= before - after <= 0.01 * before


def test_language_stage_drops_planted_foreign_documents(spark):
    """Documents in languages that the corpus does not name go, the corpus's own stay."""
    docs = spark.read.parquet(f"{AT}/documents.parquet")
    syllables = {"x": "kwa mba nde zu tso ngi rhu qala vho xi".split(), "y": "ölü yüz çığ şim güz dağ kır ğan bül ıra".split()}
    rng = random.Random(9)
    rows = [(-1 - i, " ".join("".join(rng.choice(syllables[k]) for _ in range(rng.randint(1, 4))) for _ in range(120)) + ".", None, "web", 0) for i, k in enumerate("xy" * 20)]
    planted = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in pipeline.keep_language(spark, planted, AT).select("doc_id").collect()}
    own = {r.doc_id for r in docs.where("text is not null").select("doc_id").collect()}
    assert not any(i < 0 for i in kept) and len(own - kept) <= 0.01 * len(own)


def test_near_copies_against_brute_force(steps):
    before, after = steps[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = sorted(d for d, _, least in brute(rows, pipeline.SHINGLE, pipeline.PERCENT) if d == least)
    assert sorted(r.doc_id for r in after.collect()) == want


def test_mix_against_brute_force(steps):
    before, after = steps[3]
    sums, took, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before.collect():
        sums[r.source] += size(r.text)
        most[r.source] = max(most[r.source], size(r.text))
    for r in after.collect():
        took[r.source] += size(r.text)
    for source, target in targets(sums, [3, 1, 2], 1.5, 2.0).items():
        assert abs(took[source] - target) <= most[source] / 2 + 1


def test_encoding_against_the_library(steps):
    before, after = steps[4]
    names = tokenizers()
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(names.path("byte_bpe_multi_50k.tiktoken")))}
    known = tiktoken.Encoding("own", pat_str=names.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, hashlib.sha256(np.array(known.encode_ordinary(r.text), "<u4").tobytes()).hexdigest()) for r in before.collect())
    got = after.collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in got) == want
    assert all(r.decoded_sha256 == r.text_sha256 for r in got)


def test_repeated_rows_nulls_extra_columns_and_empty(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (1, text), (1, "other words here now and then"), (2, text.upper()), (3, None), (3, None), (4, ""), (None, text), (None, None), (None, None), (5, "x y z")]
    docs = spark.createDataFrame([(d, t, "en", "s", None, 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, node int")
    got = pipeline.drop_near_copies(spark, docs, AT)
    assert got.columns == pipeline.COLUMNS
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    want = [(1, text), (1, "other words here now and then"), (3, None), (3, None), (4, ""), (5, "x y z"), (None, None), (None, None)]
    assert kept == sorted(want, key=str)
    named = docs.where("doc_id is null").unionByName(docs.where("doc_id is null and text is not null"))
    assert sorted(r.text or "" for r in pipeline.drop_near_copies(spark, named, AT).collect()) == ["", "", text]
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, AT).count() == 0


def test_run(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 50 and re.fullmatch("[0-9a-f]{64}", out.first().ids_sha256)

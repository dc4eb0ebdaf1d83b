import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import langid
from tallyforge.llm.queries import QUERIES

AT = "/root/testdata/sf0.1"


def kneser_ney(text, discount_of):
    """The textbook recursion over strings, for one text as corpus."""
    pad = "\0" * (langid.ORDER - 1)
    cell = "".join(chr(c) for c in langid.cells(text).tolist())[1:]
    whole = pad + cell
    counts = {langid.ORDER: Counter(whole[i : i + langid.ORDER] for i in range(len(cell)))}
    for n in range(langid.ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / 256
        c = counts[n]
        d = discount_of(c)
        after = {g: v for g, v in c.items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return p(gram[1:])
        return max(c[gram] - d, 0) / total + d * len(after) / total * p(gram[1:])

    return p


def discount(c):
    once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.1


def models_of(**texts):
    grams = {lang: langid._unique(langid.runs(langid.cells(t)[1:])) for lang, t in texts.items()}
    return langid.Models(sorted(texts), grams)


def test_smoothing_against_the_recursion():
    a, b = "the cat and the hat that sat on a mat and then left", "le chat et le rat qui est sur le tapis"
    models = models_of(a=a, b=b)
    for i, text in enumerate((a, b)):
        p = kneser_ney(text, discount)
        for asked in ("the cat", "le tapis", "xyz qq", "that then sat"):
            cell = "".join(chr(c) for c in langid.cells(asked).tolist())[1:]
            whole = "\0" * (langid.ORDER - 1) + cell
            want = -sum(math.log(p(whole[k : k + langid.ORDER])) for k in range(len(cell))) / len(cell)
            n, got = models.entropies(asked)
            assert n == len(cell) and got[i] == pytest.approx(want, rel=1e-5)


def test_probabilities_sum_to_one():
    models = models_of(a="abracadabra a cab")
    letters = [0, *map(ord, "abrcd")]
    context = langid.runs(langid.cells("abra")[1:-1])[-1] << np.uint64(langid.BITS)
    total = sum(math.exp(models.log_probability(np.array([(context | np.uint64(c)) & np.uint64((1 << 60) - 1)]))[0, 0]) for c in letters)
    assert 0.9 < total < 1.001


def test_cells():
    assert langid.cells(None).size == langid.cells("12 !?").size == 0
    assert (langid.cells("Ab  c1d") == langid.cells("ab, C d")).all()


def test_nulls_short_long_and_foreign_texts(spark):
    en, fr = "the quick brown fox jumps over the lazy dog and then it rests ", "le renard brun saute par dessus le chien qui dort encore "
    rows = [(i, (en if i % 2 else fr) * (1 + i % 4), "en" if i % 2 else "fr") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.train(df)
    cases = [(1, None), (2, ""), (3, "123 !"), (4, en), (5, fr * 3000), (5, fr * 3000), (None, "zzxq kkwv qqxz jjkv " * 9)]
    asked = spark.createDataFrame([(*c, "clash") for c in cases], "doc_id long, text string, score string")
    got = [(r.lang_pred, r.rejected, r.score) for r in sorted(langid.predict(asked, models).collect(), key=lambda r: r.doc_id or 9)]
    assert [g[:2] for g in got] == [("und", True)] * 3 + [("en", False), ("fr", False), ("fr", False), (got[-1][0], True)]
    assert all(0 <= g[2] <= 1 for g in got)
    empty = langid.train(df.limit(0))
    assert {r.lang_pred for r in langid.predict(asked, empty).collect()} == {"und"}
    assert langid.predict(asked.limit(0), models).count() == 0


def test_few_texts_calibrate_too():
    rng = np.random.default_rng(3)
    known = {"en": "the quick brown fox jumps over lazy dog and then it rests in shade".split(), "fr": "le renard brun saute par dessus chien qui dort encore sous un arbre".split()}
    texts = {lang: [" ".join(rng.choice(w, 12)) for _ in range(50 if lang == "en" else 20)] for lang, w in known.items()}
    models = models_of(**{lang: " ".join(t[len(t) // 5 :]) for lang, t in texts.items()})
    models.calibrate([(lang, *models.entropies(t)) for lang, ts in texts.items() for t in ts[: len(ts) // 5]])
    assert np.isfinite(models.limits).all()
    letters = ["".join(rng.choice(list("bcdfghjkqvwxz "), 300)) for _ in range(20)]
    assert all(models.predict(t)[2] for t in letters)
    assert not any(models.predict(t)[2] for ts in texts.values() for t in ts)


def test_held_out_accuracy_on_the_whole_table(spark):
    langs = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{AT}/documents.parquet").collect()}
    got = QUERIES["op3_language_id"](spark, AT).collect()
    assert len(got) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id][0] for r in held) / len(held) > 0.99
    assert sum(r.rejected for r in got) / len(got) < 0.01


def test_texts_of_a_left_out_language_go(spark):
    """Models of three of the four languages: the fourth is rejected from 128 letters on, own texts stay."""
    by_lang = {}
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text is not null and lang is not null").orderBy(F.md5("text")).select("lang", F.substring("text", 1, 4000).alias("text")).collect():
        by_lang.setdefault(r.lang, []).append(r.text)
    for left in by_lang:
        known = {lang: texts for lang, texts in by_lang.items() if lang != left}
        models = models_of(**{lang: " ".join(texts[:300]) for lang, texts in known.items()})
        models.calibrate([(lang, *models.entropies(t)) for lang, texts in known.items() for t in texts[300:375]])
        long = [t for t in by_lang[left] if len(langid.cells(t)) > 130][:300]
        assert sum(models.predict(t)[2] for t in long) >= 0.9 * len(long), left
        own = [models.predict(t)[2] for texts in known.values() for t in texts[375:875] if len(langid.cells(t))]
        assert sum(own) < 0.005 * len(own), left

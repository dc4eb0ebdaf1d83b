"""Licence scans: find licence statements in texts and name their family.

A text is cut into sentences: at blank lines (lines without a letter or digit too) and after full stops. A
single line of a sentence may be a statement of its own, and so may up to ``WRAP`` neighbouring lines
together, so a hard-wrapped licence text is met whole, also behind comment signs. Words are compared without
case, digits, versions and ``the``; ``licence``, ``licenses`` are ``license``.

A template is a name, a lead with a short name (``SPDX-License-Identifier: MIT``) or a text. A line or group
of lines is looked at if it has enough of some template's word pairs. A multinomial logistic regression over
hashed word n-grams (those of one to three words that the statements have) gives it a family or ``unknown``. It is
trained on statements that a rule builds from the templates and, as ``unknown``, on three quarters of all paragraphs of
the corpus itself, folded to one weighted row for each set of n-grams. The least probability a family needs is
calibrated on the other quarter. A prediction counts when a template of its family confirms it. ``All rights reserved`` right before a licence's own text belongs to that licence's copyright
line and does not count as ``proprietary``.

Sentences without any word of ``STEMS`` are set aside by a pattern before anything costly. The pattern is
derived from the templates: without these words no template has enough pairs. All steps are DataFrame
expressions and Spark's own regression.

Defined cases: null and empty texts have no paragraph and give no row; a repeated row gives its statements
again; of equal probabilities the family first in the alphabet wins; an empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.staging import compute_once
from tallyforge.llm.common import plain
from tallyforge.operators.ordering import running_totals
from tallyforge.session import settle

UNKNOWN = "unknown"
FEATURES = 1 << 13
#: What all ordinary paragraphs together weigh in training, as a multiple of the statements.
ORDINARY = 10
#: Share of a template's word pairs that confirms it.
LEAST = 0.6
#: Lines that are compared together at most; groups overlap by half.
WRAP = 8

#: Names and opening words of public licences, by family.
NAMES = {
    "agpl": ["GNU Affero General Public License, version 3", "AGPL-3.0 license"],
    "apache": ["Apache License, Version 2.0", "Apache-2.0 license", "Apache Software License"],
    "bsd": ["BSD 2-Clause License", "BSD 3-Clause License", "BSD license"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["CC0 1.0", "CC0 1.0 Universal Public Domain Dedication license"],
    "gpl": ["GNU General Public License, version 3", "GNU GPL version 2", "GPL-3.0 license"],
    "isc": ["ISC License", "ISC-style license"],
    "lgpl": ["GNU Lesser General Public License, version 2.1", "LGPL-2.1 license"],
    "mit": ["MIT License", "MIT/X11 license"],
    "mpl": ["Mozilla Public License, version 2.0", "MPL-2.0 license"],
}
#: Short names, as in SPDX identifiers.
SHORT = {
    "agpl": ["AGPL"],
    "apache": ["Apache"],
    "bsd": ["BSD", "BSD-2-Clause", "0BSD"],
    "cc-by": ["CC BY", "Creative Commons Attribution"],
    "cc-by-nc": ["CC BY-NC", "Creative Commons Attribution-NonCommercial"],
    "cc-by-sa": ["CC BY-SA", "Creative Commons Attribution-ShareAlike"],
    "cc0": ["CC0"],
    "gpl": ["GPL"],
    "isc": ["ISC"],
    "lgpl": ["LGPL"],
    "mit": ["MIT"],
    "mpl": ["MPL"],
}
FORMS = ["License: {}", "License {}", "{} license", "Identifier: {}", "SPDX-License-Identifier: {}", "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {} licence", "Distributed under {}", "Available under {}"]
PATHS = {
    "apache": ["apache.org/licenses/LICENSE"],
    "cc-by": ["creativecommons.org/licenses/by/"],
    "cc-by-nc": ["creativecommons.org/licenses/by-nc/"],
    "cc-by-sa": ["creativecommons.org/licenses/by-sa/"],
    "cc0": ["creativecommons.org/publicdomain/zero/"],
    "mpl": ["mozilla.org/MPL"],
}
TEXTS = {
    "apache": ["you may not use this file except in compliance with the License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "gpl": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License"],
    "proprietary": ["All rights reserved", "Copyright, all rights reserved, no part may be reproduced without permission"],
}
LEADS = ["Licensed under {}", "Licensed under the {}", "Released under the {}", "This work is licensed under the {}", "This work is licensed under {}", "Distributed under the terms of the {}", "This program is free software under the {}", "License: {}", "See the {} license"]
#: Uses of the stems that name no licence.
DECOYS = ["He lost his driving license", "A license plate was found", "The copyright office is closed", "Ask for permission first", "licensed doctors and nurses", "license", "copyright", "permission", "The poet takes artistic license", "a fishing license costs money", "public domain", "under license", "The license was revoked in version 3"]


def statements() -> list[tuple[str, str]]:
    """(family, statement): every name with every lead, every short name in every form, paths and texts."""
    out = [(family, lead.format(name)) for family, names in NAMES.items() for name in names for lead in LEADS]
    out += [(family, form.format(name)) for family, names in SHORT.items() for name in names for form in FORMS]
    out += [(family, path) for family, paths in PATHS.items() for path in paths for _ in range(4)]
    return out + [(family, text) for family, texts in TEXTS.items() for text in texts for _ in range(4)]


#: Replacements, one after the other, in lower-cased text; the result is cut at blanks.
FOLDS = [(r"\bcc[ -]?(0|zero)\b", "cc zero"), (r"\blicen[sc]es?\b", "license"), (r"\blicenced\b", "licensed"), (r"\b([al]?gpl|mpl)v?(?=\d)", "$1 "), (r"[^\p{L}]+", " ")]
#: Words that say nothing of the family.
SILENT = ["", "the", "version", "v"]


def words(paragraph: Column) -> Column:
    folded = F.lower(paragraph)
    for pattern, by in FOLDS:
        folded = F.regexp_replace(folded, pattern, by)
    return F.filter(F.split(folded, " "), lambda w: ~w.isin(SILENT))


def _words(text: str) -> list[str]:
    """``words`` of a fixed text of this module."""
    text = text.lower()
    for pattern, by in FOLDS:
        text = re.sub(pattern.replace(r"\p{L}", r"a-z"), by.replace("$1", r"\1"), text)
    return [w for w in text.split(" ") if w not in SILENT]


def _templates() -> dict[str, list[list[tuple[str, str]]]]:
    """Per family the distinct word pairs of each template."""
    listed: dict[str, list[str]] = {}
    for source in (NAMES, PATHS, TEXTS):
        for family, texts in source.items():
            listed.setdefault(family, []).extend(texts)
    for family, names in SHORT.items():
        # the whole SPDX lead is shared by all families, its last word is enough
        listed.setdefault(family, []).extend(form.format(n) for form in FORMS if "SPDX" not in form for n in names)
    cut = {family: [tuple(dict.fromkeys(zip(w, w[1:]))) for w in map(_words, texts)] for family, texts in listed.items()}
    return {family: [list(pairs) for pairs in dict.fromkeys(cut[family]) if pairs] for family in sorted(cut)}


TEMPLATES = _templates()


#: Words of templates that ordinary text is full of.
COMMON = {"this", "is", "of", "to", "in", "and", "or", "with", "without", "for", "any", "you", "may", "not", "use", "under", "by", "org", "it", "as", "are", "that", "no", "be", "can", "file", "free", "person", "part", "hereby", "public", "general", "all", "fee", "purpose", "charge", "met", "copy", "published", "mit"}


def _stems() -> str:
    """Words of which each text with ``LEAST`` of a template's pairs has one, as a pattern over raw text."""
    chosen: set[str] = set()
    often: dict[str, int] = {}
    for pairs in (p for listed in TEMPLATES.values() for p in listed):
        for w in {w for pair in pairs for w in pair}:
            often[w] = often.get(w, 0) + (len(w) > 3)
    for pairs in (p for listed in TEMPLATES.values() for p in listed):
        while sum(not chosen & set(pair) for pair in pairs) >= math.ceil(LEAST * len(pairs) - 1e-9):
            left = [w for pair in pairs if not chosen & set(pair) for w in pair]
            chosen.add(max(left, key=lambda w: (w not in COMMON, left.count(w), often[w], len(w), w)))
    raw = {"license": r"licen[sc]es?", "licensed": r"licen[sc]ed"} | {w: f"{w}v?" for w in ("agpl", "gpl", "lgpl", "mpl")}
    return r"(?i)(?<![a-z])(?:" + "|".join(raw.get(w, w) for w in sorted(chosen)) + ")(?![a-z])"


STEMS = _stems()


def grams(word: Column, n: int) -> Column:
    """Runs of ``n`` words; none if there are fewer."""
    last = F.size(word) - F.lit(n)
    runs = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.array_join(F.slice(word, i, n), " "))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<string>"))


def _known() -> list[str]:
    """The runs of one to three words that the rule-built statements and the decoys have."""
    texts = [w for _, text in statements() for w in [_words(text)]] + [_words(d) for d in DECOYS]
    return sorted({" ".join(w[i : i + n]) for w in texts for n in (1, 2, 3) for i in range(len(w) - n + 1)})


KNOWN = _known()


def known_grams(df: DataFrame, paragraph: str) -> DataFrame:
    """``df`` with ``_grams``: which of the ``KNOWN`` runs of words a paragraph has, each once, in order."""
    listed = compute_once(df, {"_words": words(F.col(paragraph))})
    runs = F.concat("_words", grams(F.col("_words"), 2), grams(F.col("_words"), 3))
    return listed.withColumn("_grams", F.array_sort(F.array_distinct(F.filter(runs, lambda g: g.isin(KNOWN))))).drop("_words")


def featured(listed: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=FEATURES, inputCol="_grams", outputCol="features", binary=True).transform(listed)


def paragraphs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, paragraph_no, paragraph): single lines and sentences within them."""
    source = plain(docs, doc_id, text).where(F.col(text).isNotNull())
    cut = source.select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split(text, PIECE)).alias("paragraph_no", "paragraph"))
    return cut.where("trim(paragraph) <> ''")


PIECE = r"\r?\n|(?<=[.!?])\s+"
#: Between a piece's number and its text; where pieces, each on a line of its own, are cut into sentences.
MARK = "\x01"
BREAK = rf"(?<=[.!?])\n|(?:^|\n)\d+{MARK}[^\p{{L}}\p{{N}}\n]*(?=\n|$)"


def spots(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, paragraph_no, paragraph, likes): the lines and groups of lines that meet a template.

    ``likes``: per family the likeness, 0 if the family is met better by one of the lines, or by the group.
    """
    source = plain(docs, doc_id, text).where(F.col(text).rlike(STEMS))
    numbered = F.transform(F.split(F.translate(text, MARK, " "), PIECE), lambda p, i: F.concat(i.cast("string"), F.lit(MARK), p))
    cut = source.select(F.col(doc_id).alias("doc_id"), F.split(F.array_join(numbered, "\n"), BREAK).alias("_runs"))
    cut = compute_once(cut, {"_runs": F.col("_runs")})
    # a sentence with the two after it, where only these tell what it means
    near = lambda r, i: F.when(r.rlike(r"(?i)\breserved\b"), F.array_join(F.slice("_runs", i + 1, 3), " "))
    held = F.filter(F.transform("_runs", lambda r, i: F.struct(r.alias("run"), near(r, i).alias("near"))), lambda r: r["run"].rlike(STEMS))
    cut = cut.select("doc_id", F.explode(held).alias("_run"))
    lines = F.filter(F.split("_run.run", "\n"), lambda p: p.contains(MARK))
    cut = compute_once(cut.select("doc_id", "_run.near", lines.alias("_lines")), {"_lines": F.col("_lines")})
    half = WRAP // 2
    last = F.ceil(F.greatest(F.size("_lines") - WRAP, F.lit(0)) / half).cast("int")
    groups = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(k.alias("k"), (k == last).alias("last"), F.slice("_lines", k * half + 1, WRAP).alias("lines")))
    group = cut.where(F.size("_lines") > 0).select("doc_id", "near", F.explode(F.filter(groups, lambda g: F.array_join(g["lines"], " ").rlike(STEMS))).alias("_g")).select("doc_id", "near", "_g.*")
    bare = F.transform("lines", lambda p: F.substring_index(p, MARK, -1))
    group = compute_once(group, {"no": F.transform("lines", lambda p: F.substring_index(p, MARK, 1).cast("int")), "lines": bare})
    group = compute_once(group, {"_all": likes(words(F.array_join("lines", " ")))}).where(F.array_max("_all") >= LEAST)
    single = F.transform("lines", lambda p: likes(words(p)))
    twice = F.when(F.col("k") > 0, likes(words(F.array_join(F.slice("lines", 1, half), " "))))
    group = compute_once(group, {"_each": single, "_twice": twice, "_near": F.when(F.col("near").isNotNull(), granted(words(F.col("near"))))})
    best = F.aggregate("_each", F.array_repeat(F.lit(0.0), len(TEMPLATES)), lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y)))
    top = F.array_max("_all")
    own = lambda each: F.zip_with(each, F.col("_all"), lambda x, y: F.when((x >= LEAST) & (x >= y) & ((x > 0.99) | (x >= top)), x).otherwise(0.0))
    old = F.coalesce("_twice", F.array_repeat(F.lit(-1.0), len(TEMPLATES)))
    joint = F.zip_with(F.zip_with("_all", best, lambda x, y: F.when((x >= LEAST) & (x > y), x).otherwise(0.0)), old, lambda x, y: F.when(x > y, x).otherwise(0.0))
    mine = F.transform(F.slice("lines", 1, F.when(F.col("last"), WRAP).otherwise(half)), lambda p, i: F.struct(F.get("no", i).alias("paragraph_no"), p.alias("paragraph"), own(F.get("_each", i)).alias("likes")))
    whole = F.struct(F.get("no", F.lit(0)).alias("paragraph_no"), F.array_join("lines", "\n").alias("paragraph"), joint.alias("likes"))
    # kept rights stand in many copyright lines; before a grant they are no licence
    found = group.select("doc_id", "_near", F.explode(F.concat(mine, F.array(whole))).alias("_s")).select("doc_id", "_near", "_s.*")
    spared = F.transform("likes", lambda x, i: F.when((i == list(TEMPLATES).index("proprietary")) & F.coalesce("_near", F.lit(False)), 0.0).otherwise(x))
    return compute_once(found, {"likes": spared}).where(F.array_max("likes") > 0).drop("_near")


class Model:
    def __init__(self, model: LogisticRegressionModel, families: list[str], least: float):
        self.model, self.families, self.least = model, families, least


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on the rule-built statements and, as ``unknown``, on the paragraphs of all documents.

    Of these paragraphs (those without a stem) three quarters train, and one quarter sets the least
    probability: so high that at most one in a thousand of them would pass. Paragraphs with the same known runs of
    words are one row with their number as its weight; all together weigh ``ORDINARY`` times the statements.
    """
    spark = docs.sparkSession
    own = plain(docs, doc_id, text).where(F.col(text).isNotNull())
    ordinary = paragraphs(own, doc_id, text).where(~F.col("paragraph").rlike(STEMS))
    aside = (F.pmod(F.xxhash64("doc_id", "paragraph_no"), F.lit(4)) == 0).cast("long")
    folded = known_grams(ordinary.select("paragraph", aside.alias("aside")), "paragraph").groupBy("_grams")
    folded = settle(folded.agg(F.sum(1 - F.col("aside")).alias("n"), F.sum("aside").alias("aside")))
    sums = folded.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("aside"), F.lit(0)).alias("aside")).first()
    rows = statements() + [(UNKNOWN, d) for d in DECOYS for _ in range(4)]
    families = sorted({f for f, _ in rows})
    number = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    given = known_grams(spark.createDataFrame(rows, "family string, paragraph string").coalesce(1), "paragraph")
    share = ORDINARY * len(rows) / max(sums["n"], 1)
    unknown = folded.where("n > 0").select(F.lit(UNKNOWN).alias("family"), "_grams", (F.col("n") * share).alias("weight"))
    training = given.select("family", "_grams", F.lit(1.0).alias("weight")).unionByName(unknown)
    training = featured(training).withColumn("label", number.cast("double")).select("label", "weight", "features")
    fit = LogisticRegression(family="multinomial", maxIter=40, regParam=1e-3, weightCol="weight").fit(training)
    model = Model(fit, families, 0.5)
    taken = classified(folded.where("aside > 0"), model).where(F.col("family") != UNKNOWN).select("probability", "aside")
    # the first probability from above, with which more than one in a thousand would pass
    most = sums["aside"] // 1000
    ranked = running_totals(taken, [], "probability", {"n": F.col("aside")})
    above = F.col("n_all") - F.col("n_before") - F.col("n")
    over = ranked.where((above <= most) & (above + F.col("n") > most)).select("probability").collect()
    model.least = max(0.5, over[0]["probability"] if over else 0.5)
    return model


def predicted(found: DataFrame, model: Model) -> DataFrame:
    """``found`` with family (best class) and probability."""
    return classified(known_grams(found, "paragraph"), model)


def classified(listed: DataFrame, model: Model) -> DataFrame:
    """The same from the known runs of words."""
    scored = model.model.setProbabilityCol("_p").transform(featured(listed))
    listed = scored.withColumn("_p", vector_to_array("_p"))
    best = F.array_max(F.zip_with("_p", F.array(*[F.lit(-i) for i in range(len(model.families))]), lambda p, i: F.struct(p.alias("p"), i.alias("i"))))
    # later filters would otherwise repeat the whole model for every use of its result
    kept = listed.drop("_grams", "features", "rawPrediction", "prediction").withColumn("_best", best).drop("_p")
    kept = compute_once(kept, {"_best": F.col("_best")})
    named = F.element_at(F.array(*[F.lit(f) for f in model.families]), F.lit(1) - F.col("_best.i"))
    return kept.withColumn("probability", F.col("_best.p")).withColumn("family", named).drop("_best")


def _shares(word: Column, families: list[list[list[tuple[str, str]]]]) -> Column:
    """Per family the largest share of a template's word pairs that ``word`` has."""
    pairs = F.array(*[F.array(*[F.array(*[F.lit(" ".join(p)) for p in t]) for t in listed]) for listed in families])
    shares = lambda own: F.transform(pairs, lambda listed: F.array_max(F.transform(listed, lambda t: F.size(F.array_intersect(t, own)) / F.size(t))))
    # arrays of one bind the words and their pairs, which would be made anew for every use
    return F.get(F.transform(F.transform(F.array(word), lambda w: grams(w, 2)), shares), F.lit(0))


def likes(word: Column) -> Column:
    """Likeness to each family, in the order of ``TEMPLATES``."""
    return _shares(word, list(TEMPLATES.values()))


def granted(word: Column) -> Column:
    """Whether ``word`` holds a licence's own text."""
    texts = [[list(dict.fromkeys(zip(w, w[1:]))) for w in map(_words, listed)] for family, listed in TEXTS.items() if family != "proprietary"]
    return F.array_max(_shares(word, texts)) >= LEAST


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least_likeness: float = LEAST) -> DataFrame:
    """One row per confirmed statement: doc_id, paragraph_no (its first line's), family, probability, likeness, paragraph."""
    best = predicted(spots(docs, doc_id, text), model)
    known = best.where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.least))
    at = F.array_position(F.array(*[F.lit(f) for f in TEMPLATES]), F.col("family")).cast("int")
    compared = known.withColumn("likeness", F.element_at("likes", at))
    return compared.where(F.col("likeness") >= least_likeness).select("doc_id", "paragraph_no", "family", "probability", "likeness", "paragraph")

import re

import pytest

from tallyforge.llm import license
from tallyforge.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, family string"
PLAIN = ["The fox ran over hills and slept.", "Ouwhea the of rend and threlyes.", "Le chien de la maison.", "Nothing 4 to see | here"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "\n".join(PLAIN[(i + k) % 4] + f" {i} {k}" for k in range(5)), None) for i in range(40)]
    return license.train(spark.createDataFrame(rows, SCHEMA))


def test_every_template_has_a_stem():
    for _, statement in license.statements():
        assert re.search(license.STEMS, statement), statement


def test_statements_in_running_text(spark, model):
    cases = {
        "Licensed under the Apache License, Version 2.0.": "apache",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "This work is licensed under the GNU General Public License, version 2.": "gpl",
        "Released under the MIT License. Ouwhea the of rend.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under CC BY 4.0.": "cc-by",
        "Some words.\nDistributed under the terms of the Mozilla Public License, version 2.0": "mpl",
        "This program is free software under the GNU Lesser General Public License, version 2.1": "lgpl",
    }
    clean = ["His driving license is new.", "license", "the copyright of Tuesday", "x " * 30000, "", None, "A license plate, a fishing license."]
    rows = [(i, t, "clash") for i, t in enumerate([*cases, *clean])] + [(None, "Released under the MIT License.", None)] * 2
    got = license.scan(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert sorted((r.doc_id, r.family) for r in got if r.doc_id is not None) == list(enumerate(cases.values()))
    assert [r.family for r in got if r.doc_id is None] == ["mit", "mit"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert license.scan(empty, license.train(empty)).count() == 0


def test_query_finds_every_planted_line_and_no_other(spark):
    at = "/root/testdata/sf0.01"
    line = re.compile(r"^(Licensed under|Released under the|This work is licensed under the)[^.]*[Ll]icense|CC BY-NC|All rights reserved", re.M)
    docs = spark.read.parquet(f"{at}/documents.parquet").collect()
    want = {d.doc_id for d in docs if line.search(d.text or "")}
    df = QUERIES["op10_license_scan"](spark, at)
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    assert {r.doc_id for r in df.collect()} == want


WRAPPED = {
    "Permission is hereby granted, free of charge,\nto any person obtaining a copy of this software\nand associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell": "mit",
    " * Copyright (c) 2020, The Regents\n * All rights reserved.\n *\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:\n *\n * 1. Redistributions of source code must retain the above": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any\r\npurpose with or without fee is hereby granted, provided that the above\r\nnotice appears in all copies.": "isc",
    "# Licensed under the Apache\n# License, Version 2.0 (the \"License\");": "apache",
    "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n    the Free Software Foundation, either version 3 of the License": "gpl",
    "You should find it here under the terms of the GNU Lesser\nGeneral Public License as published by": "lgpl",
}
SPELLED = {
    "SPDX-License-Identifier: MIT": "mit",
    "SPDX-License-Identifier: Apache-2.0": "apache",
    "// SPDX-License-Identifier: GPL-2.0-or-later": "gpl",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd",
    "License: MIT": "mit",
    "Licensed under MIT.": "mit",
    "Released under the MIT licence.": "mit",
    "Licensed under the Apache License 2.0": "apache",
    "The ISC License": "isc",
    "licence: GPLv3": "gpl",
    "Text under Creative Commons Attribution-ShareAlike 4.0 International.": "cc-by-sa",
    "see https://creativecommons.org/licenses/by-nc/4.0/": "cc-by-nc",
}


def found(spark, model, texts):
    rows = [(i, t, None) for i, t in enumerate(texts)]
    return sorted((r.doc_id, r.family) for r in license.scan(spark.createDataFrame(rows, SCHEMA), model).collect())


def test_wrapped_texts(spark, model):
    padded = [f"Ouwhea the of rend and threlyes\n\n{t}\n\nNothing 4 to see" for t in WRAPPED]
    assert found(spark, model, padded) == list(enumerate(WRAPPED.values()))
    run = "\n".join(["ouwhea the of rend"] * 13 + [next(iter(WRAPPED))] + ["ouwhea the of rend"] * 13)
    assert found(spark, model, [run]) == [(0, "mit")]


def test_identifiers_and_other_spellings(spark, model):
    assert found(spark, model, SPELLED) == list(enumerate(SPELLED.values()))
    assert found(spark, model, ["License: MIT\nLicense: Apache-2.0"]) == [(0, "apache"), (0, "mit")]


def test_stems_hold_for_parts_of_templates():
    for pairs in (p for listed in license.TEMPLATES.values() for p in listed):
        left = [p for p in pairs if not re.search(license.STEMS, " ".join(p))]
        assert len(left) < license.LEAST * len(pairs), pairs


def test_model_and_threshold_come_from_all_documents(spark, monkeypatch):
    """One document's paragraphs among thousands count, in training and, as the thousandth part, in the least probability."""
    rows = [(i, PLAIN[i % 4], None) for i in range(2000)]
    odd = "\n".join(f"the public domain dedication of apache helicopters {k}" for k in range(400))
    at = lambda docs: license.classified(license.known_grams(spark.createDataFrame([("general public apache",)], "paragraph string"), "paragraph"), license.train(spark.createDataFrame(docs, SCHEMA))).first()
    monkeypatch.setattr(license, "STEMS", r"(?i)(?<![a-z])licen[sc]e")  # or these paragraphs would be set aside
    for doc_id in (7001, 7002, 7003):
        assert at([*rows, (doc_id, odd, None)]).probability != at(rows).probability

"""Quality rules, licences and mixing against plain versions and on odd tables."""

from __future__ import annotations

import random
import re
import textwrap
from collections import Counter

import pytest
from odd import documents, empty, rows, words
from pyspark.sql import functions as F

from readloom.llm import licenses, mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    repeated = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated)


def test_quality_rules(spark):
    lines = "\n".join(["same line here", "same line here", "", "other", " ", "other"] * 9) + " " + words(60, 5)
    df = documents(spark)
    df = df.unionByName(df.where("doc_id = 3").withColumn("doc_id", F.lit(99).cast("long")).withColumn("text", F.lit(lines)))
    found = quality_rules.judge(df, measures=NAMES).collect()
    assert {r["place"] for r in found} == {"old place"}
    assert Counter((r["doc_id"], *[r[n] for n in NAMES]) for r in found) == Counter((r[0], *measures(r[1])) for r in [*rows(), (99, lines)])
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    names = [x.name for x in quality_rules.RULES]
    for order in (names, names[::-1]):
        assert Counter((r["doc_id"], r["kept"]) for r in quality_rules.judge(df, order=order).collect()) == Counter((r["doc_id"], r["kept"]) for r in found)
    assert quality_rules.judge(empty(spark)).count() == 0


def test_the_cascade_asks_the_best_rule_first(spark):
    rules = (
        quality_rules.Rule("never", lambda m: False), quality_rules.Rule("dear", lambda m: sum(range(20_000)) > 0 and "zx" in m.text),
        quality_rules.Rule("cheap", lambda m: "zx" in m.text), quality_rules.Rule("short", lambda m: m.n_words < 50), quality_rules.Rule("some", lambda m: sum(range(2000)) > 0 and "zy" in m.text),
    )
    texts = [words(60, i) + (" zx", "", " zy")[i % 3] for i in range(90)] + ["few words"] * 500
    order = quality_rules.rule_order(spark.createDataFrame([(t,) for t in texts], "text string"), rules)
    assert order[:2] == ["cheap", "some"] and order[-1] == "dear"  # what "dear" rejects has gone by then, and "short" only rejects what fails the base
    assert quality_rules.rule_order(spark.createDataFrame([("few words",)], "text string"), rules) == [r.name for r in rules]


def test_licences(spark):
    mit = licenses.SENTENCES[5].replace("software and associated", "Software and\nassociated") + ".\n" + licenses.SENTENCES[6] + "."
    cases = {
        "a": ("Text before\nLicensed under the Apache License, Version 2.0.\nafter", "Apache-2.0", "1"),
        "b": ("Good. Released under the MIT License. Bye", "MIT", "4"),
        "c": (mit, "MIT", "5,6"),
        "d": ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0", "15"),
        "e": ("This is about a license in general.", None, ""),
        "f": ("Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only", "4,8"),
        "g": (None, None, ""),
        "h": ("", None, ""),
    }
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in cases.items()], "doc_id string, text string").withColumn("lines_", F.lit(1))
    assert {r["doc_id"]: (r["license"], r["known_sentences"]) for r in licenses.recognise(df).collect()} == {k: v[1:] for k, v in cases.items()}
    assert all(any(h in s for h in licenses.HINTS) for s in licenses.SENTENCES.values())
    assert licenses.recognise(documents(spark)).count() == len(rows()) and licenses.recognise(empty(spark)).count() == 0


def test_licence_hints_see_what_sentences_see(spark):
    cases = {
        "All  rights reserved": "32", "ALL-RIGHTS RESERVED": "32", "All\r\nrights reserved": "32", "All\u00a0rights reserved": "32",
        "This is free and unencumbered software released into the public\n * domain.": "30", "This work is dedicated to the public--domain under CC0 1.0": "31",
    }
    found = licenses.recognise(spark.createDataFrame([(t,) for t in cases], "text string").withColumn("doc_id", F.col("text"))).collect()
    assert {r["doc_id"]: r["known_sentences"] for r in found} == cases and all(r["license"] for r in found)


# The notices as they are published, each with the licence that it is of.
NOTICES = {
    "MIT": """Copyright (c) 2020 A B

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "BSD-3-Clause": """Copyright (c) 2020, A B
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "GPL-3.0-or-later": """A program
Copyright (C) 2020 A B

This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "Apache-2.0": """Copyright 2020 A B

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "ISC": """Copyright (c) 2020 A B

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}
NOTICES["BSD-2-Clause"] = NOTICES["BSD-3-Clause"].split("\n\n3.")[0]
NOTICES["GPL-2.0-or-later"] = NOTICES["GPL-3.0-or-later"].replace("software:", "software;").replace("version 3", "version 2")
NOTICES["LGPL-2.1-or-later"] = NOTICES["GPL-2.0-or-later"].replace("This program is free", "This library is free").replace("General", "Lesser General").replace("version 2", "version 2.1")


def test_licences_as_published(spark):
    cases = []
    for name, notice in NOTICES.items():
        for width in (40, 68, 76, 10_000):
            for lead in ("", "# ", " * ", "// "):
                lines = [line for part in notice.split("\n") for line in textwrap.wrap(part, width) or [""]]
                cases += [(name, "\n".join((lead + line).rstrip() for line in lines)), (name, "\r\n".join(lead + line for line in lines))]
        cases += [(name, " ".join(notice.split())) for _ in [0] if name.startswith("BSD")]
    for name in ("BSD-2-Clause", "BSD-3-Clause"):
        for mark in (r"(\1) ", r"\1) ", "* ", "- "):
            cases += [(name, re.sub(r"(?m)^(\d)\. ", mark, NOTICES[name])), (name, re.sub(r"(?m)^(\d)\. ", mark, NOTICES[name]).replace("\n\n", "\n"))]
        cases += [(name, NOTICES[name].replace("\n\n", "\n * "))]
    found = licenses.recognise(spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(cases)], "doc_id long, name string, text string")).collect()
    assert [(cases[r["doc_id"]], r["license"]) for r in found if r["license"] != r["name"]] == []
    assert len(found) == len(cases)


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in rest) for s in order}
        if not (over := [s for s in rest if target[s] > cap * sizes[s] + 1e-9]):
            return target
        capped |= set(over)


@pytest.mark.parametrize("seed", range(3))
def test_mix_targets(spark, seed):
    r = random.Random(seed)
    docs = [(i, r.choice(["a", "b", "Z", "é", None, "hot", "hot"]), r.choice([0, 3, 50, 400])) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n long").withColumn("mix_size", F.lit("x")).withColumn("size", F.lit("y"))
    found = mixing.mix(df, size=F.col("n")).collect()
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n
    asked, taken = plain_targets(sizes), Counter()
    for x in found:
        assert x["mix_target"] == pytest.approx(asked[x["source"]]) and x["mix_source_size"] == sizes[x["source"]] and 0 <= x["mix_copies"] <= 2
        taken[x["source"]] += x["mix_size"] * x["mix_copies"]
    assert len(found) == 400 and all(abs(taken[s] - asked[s]) <= 0.35 * asked[s] + 800 for s in sizes)
    again = mixing.mix(df.repartition(5), size=F.col("n")).collect()
    assert Counter((x["doc_id"], x["mix_copies"]) for x in again) == Counter((x["doc_id"], x["mix_copies"]) for x in found)
    assert mixing.emit(mixing.mix(df, size=F.col("n"))).count() == sum(x["mix_copies"] for x in found)


def test_rows_of_one_id_draw_apart(spark):
    """A source whose rows share an id, or all else too, meets its target; reruns agree."""
    docs = [(None, "abc"[i % 3], words(5, i)) for i in range(3000)] + [(7, "d", words(5, 1))] * 3000
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("mix_key", F.lit("kept"))
    found = mixing.mix(df.repartition(7)).collect()
    assert len(found) == 6000 and {x["mix_key"] for x in found} == {"kept"}
    for source in "abcd":
        own = [x for x in found if x["source"] == source]
        assert sum(x["mix_size"] * x["mix_copies"] for x in own) == pytest.approx(own[0]["mix_target"], rel=0.05)
    again = mixing.mix(df.repartition(3)).collect()
    assert Counter((x["source"], x["text"], x["mix_copies"]) for x in again) == Counter((x["source"], x["text"], x["mix_copies"]) for x in found)


def test_mix_of_odd_documents(spark):
    found = mixing.mix(documents(spark)).collect()
    assert len(found) == len(rows()) and all(x["mix_size"] == len(WORD.findall(x["text"] or "")) for x in found)
    assert mixing.mix(empty(spark)).count() == 0
    assert {x["mix_copies"] for x in mixing.mix(documents(spark).where("text is null")).collect()} == {0}

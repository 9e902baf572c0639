"""Licence recognition by sentences, with DataFrame functions only.

Texts are cut into sentences, normalised sentences are looked up among known licence sentences, and the sequence of
their identifiers is matched against licence rules in order.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, normalised (lower case, runs of other characters than
# a-z and 0-9 as one blank).
SENTENCES = {
    1: "licensed under the apache license version 2 0",
    2: "licensed under the apache license version 2 0 the license",
    3: "you may not use this file except in compliance with the license",
    4: "released under the mit license",
    5: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    6: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    7: "licensed under the mit license",
    8: "this work is licensed under the gnu general public license version 3",
    9: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    10: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    11: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    12: "see the gnu general public license for more details",
    13: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    14: "see the gnu lesser general public license for more details",
    15: "licensed under cc by nc 4 0",
    16: "licensed under cc by 4 0",
    17: "licensed under cc by sa 4 0",
    18: "licensed under cc by nc sa 4 0",
    19: "licensed under cc by nc nd 4 0",
    20: "licensed under cc by nd 4 0",
    21: "this work is licensed under a creative commons attribution 4 0 international license",
    22: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    23: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    24: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    25: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    26: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    27: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    28: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    29: "this source code form is subject to the terms of the mozilla public license v 2 0",
    30: "this is free and unencumbered software released into the public domain",
    31: "this work is dedicated to the public domain under cc0 1 0",
    32: "all rights reserved",
}
# Rules in order, the first that matches names the licence. A rule is a run of sentence identifiers.
RULES = (
    ("MIT", (5, 6)),
    ("BSD-3-Clause", (24, 25, 26, 27)),
    ("BSD-2-Clause", (24, 25, 26)),
    ("GPL-3.0-or-later", (9, 11, 12)),
    ("GPL-2.0-or-later", (10, 11, 12)),
    ("LGPL-2.1-or-later", (13,)),
    ("GPL-3.0-or-later", (9,)),
    ("GPL-2.0-or-later", (10,)),
    ("GPL-3.0-only", (8,)),
    ("Apache-2.0", (2, 3)),
    ("Apache-2.0", (2,)),
    ("Apache-2.0", (1,)),
    ("MIT", (5,)),
    ("MIT", (4,)),
    ("MIT", (7,)),
    ("ISC", (28,)),
    ("MPL-2.0", (29,)),
    ("CC-BY-NC-SA-4.0", (18,)),
    ("CC-BY-NC-ND-4.0", (19,)),
    ("CC-BY-NC-4.0", (15,)),
    ("CC-BY-NC-4.0", (23,)),
    ("CC-BY-SA-4.0", (17,)),
    ("CC-BY-SA-4.0", (22,)),
    ("CC-BY-ND-4.0", (20,)),
    ("CC-BY-4.0", (16,)),
    ("CC-BY-4.0", (21,)),
    ("Unlicense", (30,)),
    ("CC0-1.0", (31,)),
    ("Proprietary", (32,)),
)
#: Every known sentence has one of these; a text without any has no known sentence.
HINTS = ("licen", "permi", "redistribut", "warranty", "contributors", "public domain", "all rights")

_END = r"[.!?]+([\x09-\x0D\x20]|\z)"
#: A list's mark: a number, a letter or a small Roman number.
_MARK = r"(?:[0-9]{1,3}|[ivx]{1,4}|[a-z])"
#: Ends in notices: also colons at line ends (not within "free software: you can"), those before a list's mark, and
#: "(the License);".
_NOTICE_END = r"[.!?]+(?:[\x09-\x0D\x20]|\z)|(?<!software):(?=[\x09\x20]*\n)|[:;](?=[\x09-\x0D\x20]+\(?" + _MARK + r"[.)][\x09-\x0D\x20])|(?<=\));(?=[\x09-\x0D\x20])"


def sentences(text: Column, wrapped: bool) -> Column:
    """Normalised sentences in order. They end at a full stop, exclamation or question mark before white space, and
    at line ends or, with wrapped, at blank lines only."""
    t = F.lower(text)
    if wrapped:
        t = F.regexp_replace(F.regexp_replace(t, r"\n[\x09\x0D\x20]*\n", ". "), r"\n", " ")
    t = F.regexp_replace(F.regexp_replace(t, _END, "\n"), r"[^a-z0-9\n]+", " ")
    return F.filter(F.transform(F.split(t, "\n"), lambda s: F.trim(s)), lambda s: s != "")


def notice_sentences(text: Column) -> Column:
    """Normalised sentences of a notice as it is published: comment leaders and bullets at line starts count as blank,
    lines are wrapped, numbers and letters of lists aren't part of a sentence nor one of their own, and the stop in
    "v. 2.0" ends none."""
    t = F.regexp_replace(F.regexp_replace(F.lower(text), r"\r\n?", "\n"), r"(?m)^[^a-z0-9\n]+", "")
    t = F.regexp_replace(t, r"\b(v|ver)\.[\x09-\x0D\x20]+(?=[0-9])", "$1 ")
    t = F.regexp_replace(F.regexp_replace(t, r"\n{2,}", ". "), _NOTICE_END, "\u0000")
    t = F.regexp_replace(F.translate(t, "\n\u0000", " \n"), r"(?m)^[^a-z0-9\n]*" + _MARK + r"[\x09\x20]*[^a-z0-9\x09\x20\n][^a-z0-9\n]*", "")
    parts = F.transform(F.split(F.regexp_replace(t, r"[^a-z0-9\n]+", " "), "\n"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: (s != "") & ~s.rlike("^" + _MARK + "$"))


def identifiers(parts: Column, known: dict[int, str] = SENTENCES) -> Column:
    """The identifier of each sentence, 0 for others."""
    table = F.create_map(*chain.from_iterable((F.lit(s), F.lit(i)) for i, s in known.items()))
    return F.transform(parts, lambda s: F.coalesce(F.try_element_at(table, s), F.lit(0)))


def recognise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without text_col, and known_sentences (identifiers in order, of lines and, where they have more, of wrapped
    text or the notice), license (of the first rule that matches) and licenses (of all, in the order of rules), null if
    none match.

    Texts are read with line ends as sentence ends, with lines wrapped, and as notices, and a rule matches a run of
    consecutive sentences in any. Null and empty text match nothing; repeated rows match alike; columns of the
    names above are replaced and others pass through; an empty table gives an empty table.
    """
    made = ("known_sentences", "license", "licenses", "lines_", "joined_", "notice_", text_col)
    rest = [F.col(c) for c in docs.columns if c not in made]
    text = F.coalesce(F.col(text_col), F.lit(""))
    may = F.lower(text).rlike("|".join(HINTS).replace(" ", "[^a-z0-9]+"))

    def ids(parts: Column) -> Column:
        return F.when(may, identifiers(parts)).otherwise(F.array().cast("array<int>"))

    seen = lambda c: F.concat(F.lit(","), F.array_join(F.col(c), ","), F.lit(","))
    some = lambda c: F.filter(F.col(c), lambda i: i > 0)

    def matches(run: tuple[int, ...]) -> Column:
        text = "," + ",".join(map(str, run)) + ","
        return seen("lines_").contains(text) | seen("joined_").contains(text) | seen("notice_").contains(text)

    found = docs.select(*rest, ids(sentences(text, False)).alias("lines_"), ids(sentences(text, True)).alias("joined_"), ids(notice_sentences(text)).alias("notice_"))
    more = lambda a, b: F.when(F.size(b) > F.size(a), b).otherwise(a)
    hits = F.array_distinct(F.array_compact(F.array(*[F.when(matches(run), F.lit(name)) for name, run in RULES])))
    return found.select(
        *rest,
        F.array_join(more(more(some("lines_"), some("joined_")), some("notice_")), ",").alias("known_sentences"),
        F.try_element_at(hits, F.lit(1)).alias("license"),
        F.when(F.size(hits) > 0, F.array_join(hits, ",")).alias("licenses"),
    )


def _sql_ids(wrapped: bool) -> str:
    t = "lower(text)"
    if wrapped:
        t = rf"replace(regexp_replace({t}, '\n[\x09\x0D\x20]*\n', '. ', 'g'), chr(10), ' ')"
    t = rf"regexp_replace(regexp_replace({t}, '{_END}', chr(10), 'g'), '[^a-z0-9\n]+', ' ', 'g')"
    parts = f"list_filter(list_transform(string_split({t}, chr(10)), lambda s: trim(s)), lambda s: s <> '')"
    case = " ".join(f"when s = '{s}' then {i}" for i, s in SENTENCES.items())
    return f"list_transform({parts}, lambda s: case {case} else 0 end)"


def oracle() -> str:
    hits = ", ".join(
        f"case when contains(a, ',{','.join(map(str, run))},') or contains(b, ',{','.join(map(str, run))},') then {k} end"
        for k, (_, run) in enumerate(RULES)
    )
    names = "[" + ", ".join(f"'{n}'" for n, _ in RULES) + "]"
    return f"""
with ids as (select doc_id, {_sql_ids(False)} as l, {_sql_ids(True)} as j from (select doc_id, coalesce(text, '') as text from documents)),
seen as (
  select doc_id, ',' || array_to_string(l, ',') || ',' as a, ',' || array_to_string(j, ',') || ',' as b,
         list_filter(l, lambda i: i > 0) as lk, list_filter(j, lambda i: i > 0) as jk
  from ids),
hit as (select *, list_transform(list_filter([{hits}], lambda k: k is not null), lambda k: {names}[k + 1]) as h from seen)
select doc_id, array_to_string(case when len(jk) > len(lk) then jk else lk end, ',') as known_sentences, h[1] as license,
       case when len(h) > 0 then (select string_agg(x, ',' order by p) from (select x, min(p) as p from (select unnest(h) as x, generate_subscripts(h, 1) as p) group by x)) end as licenses
from hit
"""

"""Licence scan by sentence rules: a document's sentences are normalised,
looked up among known licence sentences, and the sequence of their identifiers
is matched against ordered rules.

A text is cut into sentences twice: with line ends as boundaries (notices
without a full stop) and with line ends as spaces (wrapped licence texts). In
either sequence a rule matches where its identifiers follow one another in
order, with at most ``gap`` other sentences between two of them. Rules are
tried on both; a longer rule hides the shorter ones of the same licence.

Edges: null and empty text find nothing; every whole text is scanned, at any
length; repeated notices count each time in ``sentence_ids``, once in
``licenses``. A text without any marker word can't hold a known sentence (each
known sentence has one, checked on import) and is not cut up.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import let

# Sentences of public licences and notices, normalised as
# ``normalise`` does (lower case, letters and digits only, single spaces).
SENTENCES = {
    "all-rights": "all rights reserved",
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-2": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is-mit": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-2": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl2-notice": "this work is licensed under the gnu general public license version 2",
    "lgpl3-notice": "this work is licensed under the gnu lesser general public license version 3",
    "agpl3-notice": "this work is licensed under the gnu affero general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "cc-by-nd-notice": "licensed under cc by nd 4 0",
    "cc-by-full": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-full": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-full": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0-notice": "licensed under cc0 1 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "boost-notice": "distributed under the boost software license version 1 0",
}

# Licence -> ordered rules of sentence identifiers.
RULES = {
    "MIT": [["mit-notice"], ["mit-notice-2"], ["mit-title", "mit-grant"], ["mit-title-2", "mit-grant"],
            ["mit-grant", "mit-keep"], ["mit-grant", "mit-keep", "as-is-mit"]],
    "Apache-2.0": [["apache-notice"], ["apache-notice-2"], ["apache-notice-2", "apache-comply", "apache-as-is"]],
    "GPL-3.0": [["gpl3-notice"], ["gpl-free"], ["gpl-free", "gpl-warranty", "gpl-copy"]],
    "GPL-2.0": [["gpl2-notice"], ["gpl2-free"], ["gpl2-free", "gpl-warranty", "gpl-copy"]],
    "LGPL-3.0": [["lgpl3-notice"]],
    "AGPL-3.0": [["agpl3-notice"]],
    "CC-BY-4.0": [["cc-by-notice"], ["cc-by-full"]],
    "CC-BY-SA-4.0": [["cc-by-sa-notice"], ["cc-by-sa-full"]],
    "CC-BY-NC-4.0": [["cc-by-nc-notice"], ["cc-by-nc-full"]],
    "CC-BY-ND-4.0": [["cc-by-nd-notice"]],
    "CC0-1.0": [["cc0-notice"]],
    "BSD-2-Clause": [["bsd-grant", "bsd-source", "bsd-binary"]],
    "BSD-3-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]],
    "ISC": [["isc-grant"]],
    "MPL-2.0": [["mpl-notice"], ["mpl-notice", "mpl-copy"]],
    "Unlicense": [["unlicense"]],
    "BSL-1.0": [["boost-notice"]],
    "all-rights-reserved": [["all-rights"]],
}

#: Every known sentence holds one of these.
MARKERS = "licens|rights|permission|software|warrant|redistribut|copyright|mpl"
assert all(any(m in s for m in MARKERS.split("|")) for s in SENTENCES.values())
GAP = 3
#: A stop with the signs that cling to it, then white space.
_END = "[.!?:;]+[^\\p{L}\\p{N}\\s]*\\s+"
_LINE_END = _END + "|[\\r\\n]+"
# The same cuts for a matcher that backtracks: a run of signs is taken whole,
# from its start on, once. Signs before the stop count nothing in a sentence.
_SIGN, _STOPS = "[^\\p{L}\\p{N}\\s]", ".!?:;"
_ONCE = f"(?<!{_SIGN})[^\\p{{L}}\\p{{N}}\\s{_STOPS}]*+[{_STOPS}]{_SIGN}*+\\s++"
_LINE_ONCE = _ONCE + "|[\\r\\n]++"


def normalise(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^\\p{L}\\p{N}]+", " "))


def _ids(text: Column, end: str) -> Column:
    """Array of (position of the sentence, its identifier)."""
    known = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (s, i)])
    found = F.transform(F.split(text, end), lambda s, i: F.struct(
        i.alias("at"), known[normalise(s)].alias("id")))
    return F.filter(found, lambda x: x["id"].isNotNull())


def _matches(seq: Column, rule: list[str]) -> Column:
    """Whether the rule's identifiers follow one another in ``seq``."""
    if len(rule) == 1:
        return F.exists(seq, lambda x: x["id"] == rule[0])
    # The state is the set of positions where the rule's first k sentences
    # end; each step looks for the next identifier within the gap.
    state = F.transform(F.filter(seq, lambda x: x["id"] == rule[0]), lambda x: x["at"])
    def step(name: str, ends: Column) -> Column:
        return F.transform(
            F.filter(seq, lambda x: (x["id"] == name) & F.exists(
                ends, lambda e: (x["at"] > e) & (x["at"] <= e + 1 + GAP))),
            lambda x: x["at"])

    for name in rule[1:]:
        state = let(state, partial(step, name))
    return F.size(state) > 0


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus ``sentence_ids`` (array, in order of the text),
    ``licenses`` (sorted array of licence names) and ``rules`` (array of the
    longest rule matched for each)."""
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<at:int,id:string>>")
    marked = F.lower(t).rlike(MARKERS)
    out = df.withColumns({
        "_lines": F.when(marked, _ids(t, _LINE_ONCE)).otherwise(none),
        "_wrapped": F.when(marked, _ids(F.regexp_replace(t, "[\\r\\n]+", " "), _ONCE)).otherwise(none)})
    any_rule = lambda rule: _matches(F.col("_lines"), rule) | _matches(F.col("_wrapped"), rule)
    best = []
    for name, rules in RULES.items():
        pick = F.lit(None).cast("string")
        for rule in sorted(rules, key=len):  # the longest that matches wins
            pick = F.coalesce(F.when(any_rule(rule), F.lit(" > ".join(rule))), pick)
        best.append(F.struct(F.lit(name).alias("license"), pick.alias("rule")))
    found = F.when((F.size("_lines") > 0) | (F.size("_wrapped") > 0),
                   F.filter(F.array(*best), lambda x: x["rule"].isNotNull()))
    found = F.coalesce(found, F.array().cast("array<struct<license:string,rule:string>>"))
    more = F.when(F.size("_lines") >= F.size("_wrapped"), F.col("_lines")).otherwise(F.col("_wrapped"))
    return (out.withColumn("_found", found)
            .withColumns({
                "sentence_ids": F.transform(more, lambda x: x["id"]),
                "licenses": F.array_sort(F.transform("_found", lambda x: x["license"])),
                "rules": F.transform("_found", lambda x: x["rule"])})
            .drop("_lines", "_wrapped", "_found"))

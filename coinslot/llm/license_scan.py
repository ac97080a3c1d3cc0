"""Licence recognition by sentences: known sentences become identifiers, rules are sequences of them.

A known sentence begins and ends at a sentence's or a line's end and may be wrapped over lines between.
Row by row with built-in functions only: no shuffle, no Python, no join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences (normalised: lower case, one space between runs of letters and digits). Fixed values.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the apache license version 2 0",
    3: "this work is licensed under the gnu general public license version 3",
    4: "licensed under cc by nc 4 0",
    5: "licensed under the mit license",
    6: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    7: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    8: "the software is provided as is without warranty of any kind express or implied",
    9: "you may not use this file except in compliance with the license",
    10: "you may obtain a copy of the license at http www apache org licenses license 2 0",
    11: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    12: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    13: "this program is distributed in the hope that it will be useful but without any warranty",
    14: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    15: "this software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed",
    16: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    17: "this source code form is subject to the terms of the mozilla public license v 2 0",
    18: "this work is licensed under a creative commons attribution 4 0 international license",
    19: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
}
#: Licences by the sentences they consist of, in order. Fixed values.
RULES = {
    "MIT": [(1,), (5,), (6, 7), (6, 7, 8)],
    "Apache-2.0": [(2,), (2, 9), (9, 10), (9, 10, 11)],
    "GPL-3.0": [(3,), (12, 13)],
    "CC-BY-NC-4.0": [(4,)],
    "BSD-2-Clause": [(14, 15)],
    "BSD-3-Clause": [(14, 16, 15)],
    "MPL-2.0": [(17,)],
    "CC-BY-4.0": [(18,)],
    "CC-BY-SA-4.0": [(19,)],
}
#: Every known sentence has one of these within a word, so texts without them need no splitting.
ANCHORS = ("licen", "permission", "warrant", "permitted")

#: Standard sentences in full and in their usual forms, by the identifier they count as. Fixed values.
VARIANTS = {
    2: ["licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"],
    6: [
        SENTENCES[6] + " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    ],
    7: ["the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"],
    8: [
        SENTENCES[8] + " including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
        SENTENCES[8] + " including but not limited to the warranties of merchantability fitness for a particular purpose and non infringement",
    ],
    10: [
        "you may obtain a copy of the license at https www apache org licenses license 2 0",
        "http www apache org licenses license 2 0",
        "https www apache org licenses license 2 0",
    ],
    12: [
        f"{SENTENCES[12]} {version}"
        for version in (
            "either version 3 of the license or at your option any later version", "either version 3 of the license or any later version",
            "either version 3 of the license", "version 3 of the license", "version 3",
        )
    ],
    13: [
        SENTENCES[13] + " without even the implied warranty of merchantability or fitness for a particular purpose",
    ],
    14: ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1"],
    15: [
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ],
}
#: Licences' names by identifier, as they follow "released under" and "licensed under" without an article. Fixed values.
NAMES = {
    1: ["mit", "mit license"],
    2: ["apache license version 2 0", "apache license 2 0", "apache 2 0", "apache 2 0 license", "apache 2 license"],
    3: [
        gpl + version
        for gpl in ("gnu general public license", "gnu gpl", "gpl")
        for version in (" version 3", " version 3 0", " 3 0", " v3", " v3 0", " version 3 or later", " v3 or later")
    ] + ["gplv3", "gnu gplv3"],
    4: ["cc by nc 4 0", "cc by nc 4 0 license", "creative commons attribution noncommercial 4 0 international license"],
    17: ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0"],
    18: ["cc by 4 0", "cc by 4 0 license", "creative commons attribution 4 0 international license"],
    19: ["cc by sa 4 0", "cc by sa 4 0 license", "creative commons attribution sharealike 4 0 international license"],
    20: ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    21: ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"],
}
#: The same as SPDX marks. Fixed values.
SPDX = {
    1: ["mit"], 2: ["apache 2 0"], 3: ["gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later"], 4: ["cc by nc 4 0"], 17: ["mpl 2 0"],
    18: ["cc by 4 0"], 19: ["cc by sa 4 0"], 20: ["bsd 2 clause"], 21: ["bsd 3 clause"],
}
#: Rules besides those above, for identifiers that only the names have.
NAMED_RULES = {"BSD-2-Clause": [(20,)], "BSD-3-Clause": [(21,)]}
#: Openings of a sentence that say the same, and the form that is known. Applied in this order.
FORMS = [
    (
        "(?:(?:this|the) (?:project|software|work|code|source code|program|library|package|repository|file|module|document) is )?"
        "(?:also |hereby )?(released|licensed) under (?:the terms of )?(?:(?:the|a|an) )?", "$1 under ",
    ),
    (
        "(?:(?:this|the) (?:project|software|work|code|source code|program|library|package|repository|file|module|document) is )?"
        "(?:distributed|available|made available|published|provided) under (?:the terms of )?(?:(?:the|a|an) )?", "licensed under ",
    ),
    (
        "neither the name of [a-z0-9][a-z0-9 \\n]{0,200}? nor the names of (?:its|their|his|her|any) contributors ",
        "neither the name of the copyright holder nor the names of its contributors ",
    ),
    (
        "this software is provided by [a-z0-9][a-z0-9 \\n]{0,200}? as is and any express ",
        "this software is provided by the copyright holders and contributors as is and any express ",
    ),
    ("[a-z0-9][a-z0-9 ]{0,60}? is free software you can redistribute ", "this program is free software you can redistribute "),
    ("[a-z0-9][a-z0-9 ]{0,60}? is distributed in the hope that ", "this program is distributed in the hope that "),
]
#: A point after these may or may not end a sentence. Fixed values.
ABBREVIATIONS = ("v", "ver", "vers", "no", "nr", "sec", "art", "inc", "ltd", "co", "corp", "e.g", "i.e", "etc", "cf", "vs")


def _known() -> dict[str, int]:
    """Identifiers by sentence, in the known forms."""
    named = {f"{verb} under {name}": n for n, names in NAMES.items() for name in names for verb in ("released", "licensed")}
    marked = {f"spdx license identifier {mark}": n for n, marks in SPDX.items() for mark in marks}
    full = {sentence: n for n, sentences in VARIANTS.items() for sentence in sentences}
    fixed = {re.sub(f"^{FORMS[0][0]}", r"\1 under ", sentence): n for n, sentence in SENTENCES.items()}
    return named | marked | full | fixed


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _pattern(sentences: list[str]) -> str:
    """Matches each of the sentences between two borders; words share their beginnings, the longest match is tried first."""
    tree: dict = {}
    for sentence in sentences:
        at = tree
        for word in sentence.split(" "):
            at = at.setdefault(word, {})
        at[""] = {}

    def written(node: dict) -> str:
        after = ["[ \\n]" * (node is not tree) + word + written(rest) for word, rest in node.items() if word]
        end = ["(?![^\\n|])"] if "" in node else []
        return after[0] if len(after) == 1 and not end else "(?:" + "|".join(after + end) + ")" if after else end[0]

    return "(?<![^\\n|])" + written(tree)


def _wrapped(words: str) -> str:
    """The pattern with each blank outside of brackets as a blank or a line end."""
    return re.sub(r" (?![^\[\]]*\])", r"[ \\n]", words)


def _borders(text: Column) -> Column:
    """Lower-case words with one blank between; | where a sentence ends for sure, a line end where one may."""
    lower = F.regexp_replace(F.translate(text, UPPER + "|", LOWER + " "), "\r\n?", "\n")
    lower = F.regexp_replace(lower, "\\n[^a-z0-9]*\\n", "|")
    short = "|".join(re.escape(a) for a in ABBREVIATIONS)
    lower = F.regexp_replace(lower, f"(?<=(?<![a-z0-9])(?:{short}))[.][ \\t\\n]+|:[ \\t]+", "\n")
    lower = F.regexp_replace(lower, "[.!?][\"')\\]]*[ \\t\\n]+", "|")
    plain = F.regexp_replace(F.concat(F.lit("|"), lower, F.lit("|")), "[^a-z0-9\\n|]+", " ")
    return F.regexp_replace(F.regexp_replace(plain, " ?([\\n|]) ?", "$1"), "\\n*[|][\\n|]*", "|")


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order.

    Sentences end at . ! ? before white space and at empty lines, and may end at any line end, colon and
    abbreviation: known sentences go on there or stop there.
    """
    borders, known = _borders(text), _known()
    for opening, form in FORMS:
        borders = F.regexp_replace(borders, "(?<![^\\n|])" + _wrapped(opening), form)
    numbers = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = F.regexp_extract_all(borders, F.lit(_pattern(list(known))), F.lit(0))
    ids = F.transform(found, lambda s: F.try_element_at(numbers, F.translate(s, "\n", " ")))
    return F.when(_any_anchor(F.translate(text, UPPER, LOWER)), ids).otherwise(F.lit(None).cast("array<int>"))


def _any_anchor(text: Column) -> Column:
    found = text.contains("under")
    for anchor in ANCHORS:
        found = found | text.contains(anchor)
    return found


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``sentence_ids`` (comma-joined, in order) and ``licenses`` (comma-joined, by name).

    A rule holds where its sentences follow each other among the text's known sentences. Null and empty
    texts, and texts without known sentences, have two empty strings. Rows that repeat stay.
    """
    ids = F.coalesce(sentence_ids(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.array().cast("array<int>"))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.concat_ws(",", ids.cast("array<string>")).alias("sentence_ids"))
    fenced = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    names = []
    for name in sorted(RULES):
        holds = F.lit(False)
        for rule in RULES[name] + NAMED_RULES.get(name, []):
            holds = holds | fenced.contains("," + ",".join(map(str, rule)) + ",")
        names.append(F.when(holds, F.lit(name)))
    return rows.select("doc_id", "sentence_ids", F.concat_ws(",", *names).alias("licenses"))

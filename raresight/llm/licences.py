"""Licence recognition by sentence rules.

Texts are cut into sentences: at . ! ? before white space and at lines without a letter or digit, but not at other
line ends (licence texts are wrapped at some column, with or without comment signs before each line).  Each
sentence is normalised (lower case, letters and digits only) and mapped to the known licence sentences that it
holds as whole words, with any head ("this project is ...") and tail.  The identifiers found, in text order, are matched against
ordered rules: a rule names identifiers that must follow each other in this order (others may lie between).  Of
two rules that match, one whose identifiers are part of the other's gives way.  Everything is a
DataFrame expression over one row; nothing is shuffled.

Null or empty text has no sentences and no licence.  Repeated sentences count each time and change
no verdict.  Rows are independent, other columns are passed by, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# SPDX identifiers that a tag line may name, and the versions of the GNU licences.
TAGGED = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0",
          "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib"]
GNU = [("GPL", "general", ["2", "3"]), ("LGPL", "lesser general", ["2 1", "3"]), ("AGPL", "affero general", ["3"])]

# Sentences of well-known licences and of common references to them, normalised.
# An identifier is <licence family>.<sentence>.
SENTENCES: dict[str, str] = {
    "mit.released": "released under the mit license",
    "mit.licensed": "licensed under the mit license",
    "mit.terms": "under the terms of the mit license",
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit.notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit.warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache.title": "apache license version 2 0 january 2004",
    "apache.reference": "licensed under the apache license version 2 0",
    "apache.short": "licensed under the apache 2 0 license",
    "apache.grant": "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license",
    "apache.comply": "you may not use this file except in compliance with the license",
    "apache.copy": "you may obtain a copy of the license at",
    "apache.asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl.hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd.grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd.binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd.name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd.names": "may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd.reference2": "licensed under the bsd 2 clause license",
    "bsd.reference3": "licensed under the bsd 3 clause license",
    "isc.grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc.notice": "provided that the above copyright notice and this permission notice appear in all copies",
    "isc.licensed": "licensed under the isc license",
    "mpl.subject": "subject to the terms of the mozilla public license v",
    "mpl.copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl.copys": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mpl.reference": "licensed under the mozilla public license version 2 0",
    "epl.terms": "made available under the terms of the eclipse public license 2 0",
    "epl.terms2": "made available under the terms of the eclipse public license v 2 0",
    "unlicense.free": "this is free and unencumbered software released into the public domain",
    "bsl.grant": "distributed under the boost software license version 1 0",
    "bsl.title": "boost software license version 1 0 august 17th 2003",
    "zlib.asis": "this software is provided as is without any express or implied warranty",
    "zlib.origin": "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
    "cc.by_nc_4": "licensed under cc by nc 4 0",
    "cc.by_4": "licensed under cc by 4 0",
    "cc.by_sa_4": "licensed under cc by sa 4 0",
    "cc.by_4_long": "licensed under a creative commons attribution 4 0 international license",
    "cc.by_sa_4_long": "licensed under a creative commons attribution sharealike 4 0 international license",
    "cc.by_nc_4_long": "licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc.zero": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
}
# Licence (and how it was met) -> identifiers that must follow each other in this order.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache.title"]),
    ("Apache-2.0", ["apache.reference"]),
    ("Apache-2.0", ["apache.short"]),
    ("Apache-2.0", ["apache.grant"]),
    ("Apache-2.0", ["apache.comply", "apache.asis"]),
    ("BSD-2-Clause", ["bsd.grant", "bsd.source", "bsd.binary"]),
    ("BSD-2-Clause", ["bsd.reference2"]),
    ("BSD-3-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "bsd.names"]),
    ("BSD-3-Clause", ["bsd.reference3"]),
    ("BSL-1.0", ["bsl.grant"]),
    ("BSL-1.0", ["bsl.title"]),
    ("CC-BY-4.0", ["cc.by_4"]),
    ("CC-BY-4.0", ["cc.by_4_long"]),
    ("CC-BY-NC-4.0", ["cc.by_nc_4"]),
    ("CC-BY-NC-4.0", ["cc.by_nc_4_long"]),
    ("CC-BY-SA-4.0", ["cc.by_sa_4"]),
    ("CC-BY-SA-4.0", ["cc.by_sa_4_long"]),
    ("CC0-1.0", ["cc.zero"]),
    ("EPL-2.0", ["epl.terms"]),
    ("EPL-2.0", ["epl.terms2"]),
    ("ISC", ["isc.grant", "isc.notice"]),
    ("ISC", ["isc.licensed"]),
    ("MIT", ["mit.released"]),
    ("MIT", ["mit.licensed"]),
    ("MIT", ["mit.terms"]),
    ("MIT", ["mit.grant", "mit.notice", "mit.warranty"]),
    ("MPL-2.0", ["mpl.subject", "mpl.copy"]),
    ("MPL-2.0", ["mpl.subject", "mpl.copys"]),
    ("MPL-2.0", ["mpl.reference"]),
    ("Unlicense", ["unlicense.free"]),
    ("Zlib", ["zlib.asis", "zlib.origin"]),
]
for _id in TAGGED:
    SENTENCES[f"spdx.{_id}"] = "spdx license identifier " + _id.lower().replace("-", " ").replace(".", " ")
    RULES.append((_id, [f"spdx.{_id}"]))
for _name, _words, _versions in GNU:
    _licence = f"gnu {_words} public license"
    SENTENCES[f"{_name}.free"] = f"redistribute it and or modify it under the terms of the {_licence} as published by the free software foundation"
    SENTENCES[f"{_name}.copy"] = f"you should have received a copy of the {_licence}"
    for _v in _versions:
        _spdx = f"{_name}-{_v.replace(' ', '.')}" + ("" if " " in _v else ".0")
        SENTENCES[f"{_spdx}.reference"] = f"licensed under the {_licence} version {_v}"
        SENTENCES[f"{_spdx}.v_reference"] = f"licensed under the {_licence} v{_v}"
        SENTENCES[f"{_spdx}.exact"] = f"under the terms of the {_licence} version {_v} as published by the free software foundation"
        SENTENCES.setdefault(f"gnu.version {_v}", f"either version {_v} of the license or")
        SENTENCES.setdefault(f"gnu.later {_v}", f"either version {_v} of the license or at your option any later version")
        RULES += [(f"{_spdx}", [f"{_spdx}.reference"]), (f"{_spdx}", [f"{_spdx}.v_reference"]), (f"{_spdx}-only", [f"{_spdx}.exact"]),
                  (f"{_spdx}", [f"{_name}.free", f"gnu.version {_v}"]), (f"{_spdx}-or-later", [f"{_name}.free", f"gnu.version {_v}", f"gnu.later {_v}"])]

#: Signs at a line's start that are also marks; the others go when a sentence is normalised.
SIGNS = r"(^|\n)[\x20\t]*[;!:]+"
BLANK = r"\n[^A-Za-z0-9\n]*\n"  # a line without a letter or digit
MARK = r"[.!?][.!?;:]*([\x20\x09-\x0D]|\z)"
CUT = "\x01"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every known sentence has one of these, so texts without any are done with one look.
ANCHORS = ["licens", "software", "warrant", "copyright", "redistribut", "copy of the mpl"]


def longer_rules(rules: Sequence[tuple[str, Sequence[str]]]) -> list[list[int]]:
    """Per rule: the rules whose identifiers hold all of its own, in order, and more."""
    def holds(long: Sequence[str], short: Sequence[str]) -> bool:
        rest = iter(long)
        return len(long) > len(short) and all(x in rest for x in short)
    return [[j for j, (_, b) in enumerate(rules) if holds(b, a)] for _, a in rules]


def spans(text: F.Column) -> F.Column:
    """The normalised sentences, none of them empty."""
    signs = F.regexp_replace(F.coalesce(text, F.lit("")), SIGNS, "$1")
    cut = F.regexp_replace(F.regexp_replace(signs, BLANK, CUT), MARK, CUT)
    return F.filter(F.transform(F.split(cut, CUT), lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " "))), lambda s: s != "")


def scan(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", sentences: dict[str, str] | None = None,
         rules: Sequence[tuple[str, Sequence[str]]] | None = None) -> DataFrame:
    """``keep`` columns, n_sentences, sentence_ids (identifiers in text order), first_sentence (number of the first
    sentence with a known one, from 0) and licences (sorted, each once).  ``sentences`` and ``rules`` replace the known ones."""
    own = sentences is not None
    sentences, rules = sentences or SENTENCES, rules or RULES
    number = {name: i for i, name in enumerate(sentences)}
    cut, flat = F.col("__spans"), F.col("__flat")
    known = [F.struct(F.lit(i).alias("id"), F.lit(f" {s} ").alias("s")) for i, s in enumerate(sentences.values())]
    # few texts hold a known sentence at all; only there are the sentences looked at one by one
    held = F.filter(F.array(*[F.when(flat.contains(f" {s} "), known[i]) for i, s in enumerate(sentences.values())]), lambda k: k.isNotNull())
    if not own:
        some = F.lit(False)
        for anchor in ANCHORS:
            some = some | flat.contains(anchor)
        held = F.when(some, held)

    def ids_in(span: F.Column) -> F.Column:
        padded = F.concat(F.lit(" "), span, F.lit(" "))
        at = F.transform("__held", lambda k: F.struct(F.instr(padded, k["s"]).alias("at"), k["id"].alias("id")))
        return F.transform(F.array_sort(F.filter(at, lambda x: x["at"] > 0)), lambda x: x["id"])

    found = F.when(F.size("__held") > 0, F.transform(cut, ids_in)).otherwise(F.array().cast("array<array<int>>"))
    first = F.array_position(F.transform("__ids", lambda x: F.size(x) > 0), True)  # from 1; 0 if there is none
    path = F.concat(F.lit(" "), F.array_join(F.col("__found").cast("array<string>"), "  "), F.lit(" "))
    met = F.array(*[F.col("__path").rlike(".*".join(f" {number[i]} " for i in sequence)) for _, sequence in rules])
    names = F.create_map(*[x for name, i in number.items() for x in (F.lit(i), F.lit(name))])

    def stands(i: int) -> F.Column:
        out = F.col("__met")[i]
        for j in longer_rules(rules)[i]:
            out = out & ~F.col("__met")[j]
        return out

    licences = F.array(*[F.when(stands(i), F.lit(licence)) for i, (licence, _) in enumerate(rules)])
    return (docs.select(*keep, spans(docs[text]).alias("__spans"))
            .withColumn("__flat", F.concat(F.lit(" "), F.array_join(cut, " . "), F.lit(" ")))
            .withColumn("__held", held)
            .select(*keep, "__spans", found.alias("__ids"))
            .withColumns({"__found": F.flatten("__ids"), "__first": first})
            .withColumn("__path", path)
            .withColumn("__met", F.when(F.size("__found") > 0, met))
            .select(*keep, F.size(cut).cast("long").alias("n_sentences"),
                    F.transform("__found", lambda i: names[i]).alias("sentence_ids"),
                    F.when(F.col("__first") > 0, F.col("__first") - 1).cast("long").alias("first_sentence"),
                    F.coalesce(F.array_sort(F.array_distinct(F.filter(licences, lambda x: x.isNotNull()))), F.array().cast("array<string>")).alias("licences")))

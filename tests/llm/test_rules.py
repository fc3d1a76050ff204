"""URL filter and licence scan: SQL equivalents on the given tables, and edge cases by hand."""

import pytest

import oracle_check as oc
from raresight.llm import licences, queries, urls


@pytest.mark.parametrize("name", ["op3_url_filter", "op6_licences"])
def test_matches_sql(spark, name):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        r = oc.compare(spark, oc.duck(sf), name, queries.QUERIES[name], queries.ORACLE[name], sf)
        assert r["status"] == "exact" and "types" not in r, r


def pages(spark, values):
    return spark.createDataFrame([(i, u, "clash", "clash", None) for i, u in enumerate(values)], "page_id long, url string, template string, host string, n string").repartition(3)


def test_url_parts_and_rules(spark):
    cases = [
        (None, "", "", None), ("", "", "", None), ("no scheme/net/", "", "", None),
        ("http://A.NET/x?y#z", "a.net", "/x", "net/"), ("http://a.net", "a.net", "", None), ("http://a.net?x=/", "a.net", "", None),
        ("http://example.net/en/1", "example.net", "/en/1", "example.net/en/"), ("http://b.example.net/en", "b.example.net", "/en", "net/"),
        ("http://notexample.com/de/1", "notexample.com", "/de/1", None), ("http://x.example.com/de/", "x.example.com", "/de/", "example.com/de/"),
        ("x://É.ORG/fr/a://b", "É.org", "/fr/a://b", "org/fr/"), ("://org/fr/", "org", "/fr/", "org/fr/"), ("http://u@h.net:80/\n?", "u@h.net:80", "/\n", None),
    ]
    out = {r.page_id: r for r in urls.filter_urls(pages(spark, [c[0] for c in cases]), queries.URL_RULES).collect()}
    for i, (_, host, path, rule) in enumerate(cases):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule), cases[i]
        if rule:
            assert out[i].verdict == dict((r, v) for v, r in queries.URL_RULES)[rule]
    assert urls.filter_urls(pages(spark, ["x"]).limit(0), queries.URL_RULES).count() == 0


def test_templates_merge_and_reject(spark):
    """Pages /spam/N are labelled bad, /news/N good, /win/N bad; unlabelled pages follow their template."""
    from pyspark.sql import functions as F

    values = [f"http://h.com/{kind}/{i}" for kind in ("spam", "win", "news") for i in range(40)]
    values += ["http://h.com/spam/999999", "http://h.com/news/999999", "http://h.com/odd/999999", "http://h.com/win/999999.html", "http://other.com/spam/999999"]
    label = F.when(F.col("page_id") < 80, 1).when(F.col("page_id") < 120, 0)
    out = {r.page_id: r for r in urls.filter_urls(pages(spark, values), [], label=label).collect()}
    assert [out[i].verdict for i in range(120, 125)] == ["block", "allow", "allow", "allow", "allow"]
    assert out[120].template == "/spam/*" and out[123].template == "/win/*.html"


def test_wide_levels_become_wildcards(spark):
    values = [f"http://h.com/user{chr(97 + i // 26)}{chr(97 + i % 26)}/home" for i in range(60)] + ["http://h.com/"] * 3
    out = {r.page_id: r.template for r in urls.filter_urls(pages(spark, values), []).collect()}
    assert {out[i] for i in range(60)} == {"/*/home"} and out[60] == "/"


def test_licences(spark):
    mit = licences.SENTENCES
    cases = [
        (None, []), ("", []), ("Released under the MIT License.", ["MIT"]), ("x\nreleased UNDER the MIT-License!\ny", ["MIT"]),
        ("Released under the MIT License today.", ["MIT"]), ("Released under the. MIT License", []), ("unreleased under the MIT Licenses", []),
        (". ".join([mit["mit.grant"], mit["mit.notice"], "other", mit["mit.warranty"]]) + ".", ["MIT"]),
        (". ".join([mit["mit.warranty"], mit["mit.notice"], mit["mit.grant"]]), []),  # the order counts
        ("\n".join([mit["bsd.grant"], mit["bsd.source"], mit["bsd.binary"], mit["bsd.name"]]), ["BSD-3-Clause"]),
        ("Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.", ["Apache-2.0", "CC-BY-NC-4.0"]),
        ("word " * 100_000 + ". Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ]
    rows = spark.createDataFrame([(i, t, "clash", 1) for i, (t, _) in enumerate(cases)] + [(2, cases[2][0], "x", 2)], "doc_id long, text string, licences string, n_sentences int")
    out = licences.scan(rows).collect()
    assert len(out) == len(cases) + 1
    for r in out:
        assert r.licences == cases[r.doc_id][1], cases[r.doc_id]
        assert (r.first_sentence is None) == (not r.sentence_ids)
    assert licences.scan(rows.limit(0)).count() == 0


MIT = """MIT License
Copyright (c) 2020 A B

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE."""
APACHE = """Copyright 2020 A B
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
ZERO = "To the extent possible under law, the author has waived all copyright and\nrelated or neighboring rights to this work."


@pytest.mark.parametrize("sign", ["", "# ", "// ", " * ", ";; ", "! ", "\t"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_licence_texts(spark, sign, end):
    cases = [(MIT, ["MIT"]), (APACHE, ["Apache-2.0"]), (GPL, ["GPL-3.0-or-later"]), (BSD, ["BSD-2-Clause"]), (ZERO, ["CC0-1.0"]),
             (MIT.replace("copy\nof", "copy\n\nof"), []), (MIT.replace("copy\nof", "copy.\nof"), []), (ZERO + " today", ["CC0-1.0"]), (ZERO[:-1] + " today", ["CC0-1.0"]),
             ("code\n" * 3 + ZERO + "\ncode", ["CC0-1.0"])]
    rows = [(i, "".join(sign + line + end for line in t.split("\n"))) for i, (t, _) in enumerate(cases)]
    out = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i].licences for i in range(len(cases))] == [want for _, want in cases]
    assert out[4].first_sentence == 0 and out[4].n_sentences == 1 and out[9].n_sentences == 2


# references and notices as they stand in the wild, with the licences they name
NOTICES = [
    ("This project is licensed under the MIT License.", ["MIT"]),
    ("This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"]),
    ("// SPDX-License-Identifier: MIT\nint main() {}", ["MIT"]),
    ("# SPDX-License-Identifier: GPL-2.0-or-later\n", ["GPL-2.0-or-later"]),
    (GPL.replace("version 3", "version 2"), ["GPL-2.0-or-later"]),
    (GPL.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"), ["LGPL-2.1-or-later"]),
    (GPL.replace("GNU General", "GNU Affero General"), ["AGPL-3.0-or-later"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.", ["MPL-2.0"]),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", ["ISC"]),
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/", ["Apache-2.0"]),
    ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("The licence of this software is not stated.", []),
]


def test_notices(spark, tmp_path):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string")
    assert [r.licences for r in sorted(licences.scan(rows).collect(), key=lambda r: r.doc_id)] == [want for _, want in NOTICES]


def test_wrapped_texts_match_sql(spark, tmp_path):
    texts = [t for t, _ in NOTICES] + [sign + line for sign in ("", "# ", ";; ", "! ") for line in (MIT, APACHE, GPL, BSD, ZERO)] + [
        "".join(sign + line + "\n" for line in t.split("\n")) for sign in ("# ", "! ", ";; ") for t in (MIT, APACHE, GPL, BSD)] + [None, "", "\n\n\n", "a.\n\n\n#\n#\nb!? c"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    (part,) = (tmp_path / "d").glob("*.parquet")
    (tmp_path / "documents.parquet").symlink_to(part)
    r = oc.compare(spark, oc.duck(str(tmp_path)), "op6", queries.QUERIES["op6_licences"], queries.ORACLE["op6_licences"], str(tmp_path))
    assert r["status"] == "exact", r


def test_known_sentences_have_anchors():
    assert all(any(a in s for a in licences.ANCHORS) for s in licences.SENTENCES.values())

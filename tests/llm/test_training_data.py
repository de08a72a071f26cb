"""Each operator against a brute-force version, on the smallest tables and on awkward rows."""

import collections
import hashlib
import html
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldseries.llm import decontamination, html_text, language_id, license_scan, ngram_join, packing, quality_model, quality_rules, suffix_dedup, toxicity
from fieldseries.llm.common import table
from fieldseries.llm.fm_index import FMIndex
from fieldseries.llm.induced_sort import sort_suffixes

SF = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i}x{i * i % 97}" for i in range(20_000))
PASSAGE = " ".join(f"p{i}q{i * 7 % 31}" for i in range(60))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, cls long, row string, score double, spans string, part int"


def rows():
    texts = [None, "", " \n\t", "one", "One two", LONG, LONG + " end", PASSAGE, "a " + PASSAGE + " b", "x " + PASSAGE, "é" * 150 + "ü" * 150, "z" + "é" * 150 + "ü" * 150, "ab" * 300, PASSAGE, "Released under the MIT License."]
    out = [(i, t, None if i % 5 == 0 else "en", None, None, "i", 1, "r", 0.5, None, 3) for i, t in enumerate(texts)]
    return out + [out[7], (None, PASSAGE, None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None), (3, "one two three", "en", "s", 13, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(UP))


# --- op1


def test_licences(spark, odd, empty):
    text = '// Permission is hereby granted, free of charge, to any person obtaining a copy of this software: x\n// The above copyright notice and this permission notice shall be included in all copies.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, y. Licensed under the Apache License, Version 2.0. A licensed thing.'
    df = spark.createDataFrame([(1, text), (2, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."), (3, "nothing")], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.n_unknown) for r in license_scan.scan(df).collect()}
    assert got == {1: (["Apache-2.0", "MIT"], 1), 2: (["CC-BY-NC-4.0"], 0), 3: ([], 0)}
    assert {r.doc_id for r in license_scan.op1(odd).filter("licenses = 'MIT'").collect()} == {14}
    assert license_scan.op1(odd).count() == odd.count() and license_scan.op1(empty).count() == 0


def brute_licences(ids):
    """Each rule tried again and again on what is left, by plain search."""
    left, found = list(ids), {x[5:] for x in ids if x.startswith("SPDX-")}
    for name, need in license_scan.RULES:
        while True:
            at, claim = 0, []
            for x in need:
                if x not in left[at:]:
                    break
                at = left.index(x, at) + 1
                claim.append(at - 1)
            if len(claim) < len(need):
                break
            found.add(name)
            left = [x for i, x in enumerate(left) if i not in claim]
    return sorted(found), sum(not x.startswith("SPDX-") for x in left)


def test_licence_rules_claim_sequences():
    rng = np.random.default_rng(3)
    known = sorted({x for _, need in license_scan.RULES for x in need}) + ["UNKNOWN", "SPDX-MIT"]
    for n in (0, 1, 5, 40, 200):
        for _ in range(30):
            ids = [known[i] for i in rng.integers(0, rng.integers(2, len(known) + 1), n)]
            assert license_scan.match(ids) == brute_licences(ids)
    assert license_scan.match(["GPLgrant"] + ["AllRights"] * 300_000) == ([], 300_001)


def test_licence_rules_by_hand(docs):
    """The stated sentences and rules applied to each text in plain Python."""
    for (_, text), r in zip(sorted(texts(docs)), license_scan.op1(docs).orderBy("doc_id").collect(), strict=True):
        ids = []
        for s in re.split(license_scan.BREAK, text or ""):
            n = re.sub(r"[^a-z0-9]+", " ", s.lower()).strip()
            name = next((i for p, i in license_scan.SENTENCES if re.search(p, n)), None)
            if name or re.search(license_scan.LICENCE_WORDS, s.lower()):
                ids.append(name or "UNKNOWN")
        assert r.license_sentences == ",".join(ids)
        assert (r.licenses.split(",") if r.licenses else [], r.n_unknown) == brute_licences(ids)


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer.
3. Neither the name of Foo Inc. nor the names of its
   contributors may be used to endorse or promote products derived from it."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with it.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
FITNESS FOR A PARTICULAR PURPOSE."""


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE."""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software.
2. Altered source versions must be plainly marked as such.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means."""


def test_standard_notices(spark):
    """As they are usually written: wrapped, behind comment marks, or on one line."""
    bsd2 = BSD[: BSD.index("3. ")]
    library, lesser = GPL.replace("program", "library"), "GNU Lesser General"
    more = {"LGPL-2.1-or-later": library.replace("GNU General", lesser).replace("version 3", "version 2.1"), "LGPL-3.0-or-later": library.replace("GNU General", lesser), "AGPL-3.0-or-later": GPL.replace("GNU General", "GNU Affero General"), "ISC": ISC, "Zlib": ZLIB, "Unlicense": UNLICENSE}
    notices = more | {"MIT": MIT, "BSD-3-Clause": BSD, "BSD-2-Clause": bsd2, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL, "GPL-2.0-or-later": GPL.replace("version 3", "version 2").replace("software:", "software;")}
    rows, expected = [], []
    for name, notice in notices.items():
        for form in (notice, notice.replace("\n", "\r\n"), "\n".join(f"// {x}" for x in notice.split("\n")), "/*\n" + "\n".join(f" * {x}".rstrip() for x in notice.split("\n")) + "\n */\nint main()", " ".join(notice.split()), notice.replace("1. ", "(a) ").replace("2. ", "(b) ").replace("3. ", "c) ")):
            rows.append((len(rows), form))
            expected.append(([name], 0))
    tags = {"MIT": ["MIT"], "mit": ["MIT"], "GPL-2.0-or-later WITH Classpath-exception-2.0": ["GPL-2.0-or-later"], "(ISC OR Apache-2.0) AND 0BSD": ["0BSD", "Apache-2.0", "ISC"], "LGPL-2.1+": ["LGPL-2.1+"]}
    for tag, names in tags.items():
        for form in (f"// SPDX-License-Identifier: {tag}\nint x;", f"<!-- SPDX-License-Identifier: {tag} -->", f"/* x SPDX-License-Identifier:{tag} */"):
            rows.append((len(rows), form))
            expected.append((names, 0))
    rows += [(len(rows), "Released under the\nMIT License.\nmore"), (len(rows) + 1, "Released under the MIT License\nmore"), (len(rows) + 2, "Released under the MIT License or another one")]
    expected += [(["MIT"], 0), (["MIT"], 0), ([], 1)]
    rows += [(len(rows) + k, x) for k, x in enumerate(("\n" * 200_000, "-" * 200_000, GPL[:40] + " a-\n" * 100_000, "All rights reserved.\n" * 50_000))]  # in time in proportion
    expected += [([], 0)] * 3 + [([], 50_000)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    for (_, text), r, e in zip(rows, got, expected, strict=True):
        assert (r.licenses, r.n_unknown) == e, (text, r.sentences)


GPL3_TEXT = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Some Foundation\n Everyone is permitted to copy and distribute verbatim copies.\n\n  How to Apply These Terms\n\n" + GPL


def test_licences_by_name_and_by_text(spark):
    """Every named licence, every text by its first sentence, exceptions beside their licence; 60 licences and more."""
    shown = {"MPL-2.0": "the Mozilla Public License, version 2.0", "EPL-1.0": "the EPL v1.0", "CDDL-1.0": "the Common Development and Distribution License (CDDL) Version 1.0", "Artistic-2.0": "the Artistic License 2.0", "PSF-2.0": "the PSF License Agreement Version 2", "OpenSSL": "the OpenSSL License", "WTFPL": "the WTFPL", "GFDL-1.3-only": "the GNU Free Documentation License, Version 1.3", "EUPL-1.2": "the EUPL v1.2", "SSPL-1.0": "the Server Side Public License, v 1", "OFL-1.1": "the SIL Open Font License, Version 1.1", "CC-BY-NC-SA-4.0": "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC-BY-3.0": "CC BY 3.0", "CC-BY-4.0": "a Creative Commons Attribution 4.0 International License", "Zlib": "the zlib license", "Unlicense": "the Unlicense", "X11": "the X11 License", "ODbL-1.0": "the Open Database License", "LPPL-1.3c": "the LaTeX Project Public License, version 1.3c"}
    rows, want = [], []
    for name, phrase in shown.items():
        for form in (f"This software is licensed under {phrase}.", f"# Distributed under the terms of {phrase}\nprint(1)", f"Released under {phrase}. See the manual."):
            rows.append(form)
            want.append([name])
    for name, text in license_scan.TEXTS:
        rows.append("/* " + text.replace("(public license )?", "").capitalize() + " and so on. */")
        want.append([name])
    rows += [GPL3_TEXT, GPL, "Licensed under the Apache License, Version 2.0.\n\nLLVM Exceptions to the Apache 2.0 License\n\nAs an exception, you may.", "Available under the moon.", "The WTFPL is short."]
    want += [["GPL-3.0-only"], ["GPL-3.0-or-later"], ["Apache-2.0", "LLVM-exception"], [], []]
    got = license_scan.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(t, r.licenses) for t, r in zip(rows, got, strict=True)] == list(zip(rows, want, strict=True))
    assert len({n for n, _ in license_scan.RULES}) >= 75


# --- op2


def test_pages(spark):
    pages = table(spark, SF, "pages")
    got = {r.page_id: r.text for r in html_text.op2(pages).collect()}
    for p in pages.collect():
        body = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>|<br>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[p.page_id] == "\n\n".join(x for x in parts if x)


def test_unmarked_pages_lose_what_their_host_repeats(spark):
    note = "this site uses words that every page repeats in full"
    rows = [(k, f"http://h.example/{k}", f"<div><p>{note}</p><p>unique text of page number {k} with words {k * k} {k + 1} {k + 2}</p></div>", "x") for k in range(5)]
    rows += [(9, None, None, None), (10, "nonsense", "", None), (11, "http://one.example", "<p>a&lt;b <i>c</i>d<p>e", None), (12, "http://h.example/x", f"<article><p>{note}</p><aside>no</aside><div class='comments'>no</div></article><p>no</p>", None)]
    copy = "two rows of one page are no reason to take its text away from it"
    rows += [(k, "http://copy.example/", f"<p>{copy}</p>", None) for k in (20, 21, 22)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    expected = {**{k: f"unique text of page number {k} with words {k * k} {k + 1} {k + 2}" for k in range(5)}, 9: "", 10: "", 11: "a<b cd\n\ne", 12: note, 20: copy, 21: copy, 22: copy}
    for shard in (1, 300, 2 << 20):  # also when the repeats lie in different shards
        assert {r.page_id: r.text for r in html_text.main_text(df, shard_bytes=shard).collect()} == expected
    assert html_text.op2(df.limit(0)).count() == 0


def brute_main_text(pages, least, least_pages):
    """Every window of every page counted in sets."""
    host = lambda u: (m := re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#\s]*)", u or "")) and m[1].lower() or ""
    cut = {h: html_text.page_blocks(h) for _, _, h in pages}
    tokens = lambda part: part.split(" ")
    windows = lambda t: [tuple(t[i : i + least]) for i in range(len(t) - least + 1)]
    on, all_pages = collections.defaultdict(set), collections.defaultdict(set)
    for _, u, h in pages:
        if h is not None:
            all_pages[host(u)].add(h)
            for part in cut[h][1]:
                for w in windows(tokens(part)):
                    on[host(u), w].add(h)
    out = {}
    for k, u, h in pages:
        marked, parts = cut[h]
        n, flags = len(all_pages[host(u)]), []
        for part in parts:
            f = [False] * len(tokens(part))
            for i, w in enumerate(windows(tokens(part))):
                if len(on[host(u), w]) >= least_pages and 2 * len(on[host(u), w]) > n:
                    f[i : i + least] = [True] * least
            flags.append(f)
        if marked and 2 * sum(map(sum, flags)) > sum(map(len, flags)):
            flags = [[False] * len(f) for f in flags]
        left = [" ".join(t for t, gone in zip(tokens(p), f, strict=True) if not gone) for p, f in zip(parts, flags, strict=True)]
        out[k] = "\n\n".join(x for x in left if x)
    return out


def test_host_runs_against_brute_force(spark):
    pages = [(r.page_id, r.url, r.html) for r in table(spark, SF, "pages").collect()]
    frame = lambda k: f"<p>read more of this site each day in spring</p><p>{k % 3 and 'the second frame of the site stands on two pages of three'}</p>"
    bare = [(k, f"http://h{k % 4}.example/{k}", re.sub(r"</?(?:article|nav|footer)>", "", h).replace("<body>", "<body>" + frame(k))) for k, (_, _, h) in enumerate(pages)]
    framed = [(len(bare) + k, f"http://m{k % 4}.example/{k}", h.replace("<article>", "<article>" + frame(k))) for k, (_, _, h) in enumerate(pages)]
    rows = bare + framed + [(-1, *bare[0][1:])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    expected = brute_main_text(rows, 6, 3)
    assert not any("read more of this site" in t for k, t in expected.items() if k < len(bare))
    for shard in (5_000, 2 << 20):
        assert {r.page_id: r.text for r in html_text.main_text(df, shard_bytes=shard).collect()} == expected


def test_names_do_not_drop_the_article(spark):
    long = "the main text of this page is longer than what stands around it and must stay whole"
    pages = [
        f'<div class="wrapper no-sidebar"><p>{long}</p></div><div class="site-footer">foot</div>',
        f'<div class="content has-sidebar"><p>{long}</p><div class="ad">buy</div></div>',
        f'<article class="post share"><p>{long}</p><div class="comments">no <p>no</p></div></article><p>out</p>',
        f'<main id="search"><p>{long}</p></main>',
        f'<div id="search"><p>{long}</p></div><div class="menu-box">menu</div>',
        f'<div class="widget"><article>{long}</article></div><div class="promo-list">no</div>',
        f'<div><p>{long}</p></div><article class="card">teaser</article>',
        f'<p>{long} <span class="ad">buy</span> end</p>',
    ]
    pages.append(f'<article><h2 class="section-header">head</h2><p class="social-history">{long}</p><div class="table-form">rows</div><p class="search-results">found</p><p id="alert">note</p><div class="share">no</div></article>')
    expected = [long] * 6 + [f"{long}\n\nteaser", f"{long} end", f"head\n\n{long}\n\nrows\n\nfound\n\nnote"]
    df = spark.createDataFrame([(k, f"http://h{k}.example/", x) for k, x in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.op2(df).collect()}
    assert got == dict(enumerate(expected))


#: Page shapes, each with its main text, written down without the code under test.  @ stands for a long passage.
SHAPES = [
    ("<html><head><meta charset=utf8><title>t</title><body><div><p>@</p></div>", "@"),  # end tag of head left out
    ("<html><head><title>t</title><link rel=x><p>@<p>two", "@\n\ntwo"),  # and start tag of body
    ("<!doctype html><title>t</title><p>@", "@"),  # no head, no body
    ('<body><form action=x method=post><div id=top class=menu>menu</div><div><p>@</p><input value=v><p>two</p></div></form></body>', "@\n\ntwo"),  # a page in a form
    ("<article><p>@</p><form><p>your name</p><input></form><p>end</p></article>", "@\n\nend"),  # a form in an article goes
    ("<article><header><h1>Title</h1><p>by line</p></header><p>@</p></article>", "Title\n\n@"),
    ("<header><h1>Site</h1></header><article><p>@</p></article>", "@"),  # a page's header goes with its heading
    ("<article><h1>Title</h1><p>@</p><h3>Reader comments</h3><p>first!</p><div>second</div></article>", "Title\n\n@"),
    ("<article><p>@</p><h2>3 Comments (3)</h2><p>x</p><h4>why</h4><p>y</p><h2>Notes</h2><p>end</p></article>", "@\n\nNotes\n\nend"),
    ("<article><h2>Comments on style</h2><p>@</p></article>", "Comments on style\n\n@"),
    ('<div class="cc-window"><p>we use cookies</p></div><div><p>@</p></div>', "@"),
    ("<article><ul><li>one<li>two @<li>three</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\n\ntwo @\n\nthree\n\na\n\nb\n\nc"),  # optional end tags
    ("<article><p>a < b &amp; c&nbsp;&#x41; &lt;i&gt; @</p><!-- x <p>no</p> --><p>tail", "a < b & c A <i> @\n\ntail"),
    ("<article><p>@ <b>bold <i>both</b> still</i> end</p></section></article>", "@ bold both still end"),  # crossed and stray tags
    ("<article><script>if (a < b) { '<p>no</p>' }</script><style>p {}</style><p>@</p><noscript><p>no</p></noscript></article>", "@"),
    ("<ARTICLE><P>@</P><ASIDE>no</ASIDE></ARTICLE><FOOTER>no</FOOTER>", "@"),
]
PASSAGE_OF_PAGE = "the main passage of a page goes on for longer than anything that stands around it does"


def test_page_shapes(spark):
    long = PASSAGE_OF_PAGE
    rows = [(k, f"http://h{k}.example/", h.replace("@", long)) for k, (h, _) in enumerate(SHAPES)]
    rows += [(100, "http://long.example/", "<article>" + "<p>words of a very long page &amp; more</p>" * 60_000 + "</article>"), (101, "http://deep.example/", "<div>" * 3_000 + long + "</div>" * 3_000), (102, "http://b.example/", "<p" * 20_000 + "<article><p>x")]
    got = {r.page_id: r.text for r in html_text.op2(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k: got[k] for k in range(len(SHAPES))} == {k: t.replace("@", long) for k, (_, t) in enumerate(SHAPES)}
    assert got[100] == "\n\n".join(["words of a very long page & more"] * 60_000) and got[101] == long


def test_a_page_crawled_very_often_fills_no_shard(spark):
    note = "this site uses words that every page repeats in full"
    rows = [(k, "http://h.example/", f"<p>{note}</p><p>own text of page {min(k, 5)} and {min(k, 5) ** 3} more</p>") for k in range(2_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.op2(df).collect()}
    assert got == {k: f"own text of page {min(k, 5)} and {min(k, 5) ** 3} more" for k in range(2_000)}


# --- op3


def brute_ranges(items, length=200):
    """The merged repeated stretches of each text, by counting every window."""
    raw = [(t or "").encode() for _, t in items]
    seen = collections.Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        m = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                m[i] += 1
                m[i + length] -= 1
        hit = np.cumsum(m[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(int)))
        out.append([(int(a), int(b)) for a, b in edge.reshape(-1, 2)])
    return out


def brute_spans(items, length=200):
    out = []
    for (_, t), spans in zip(items, brute_ranges(items, length), strict=True):
        raw = (t or "").encode()
        out.append((len(raw), sum(b - a for a, b in spans), len(spans), hashlib.sha256(suffix_dedup.kept(raw, spans)).hexdigest()))
    return out


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_repeated_strings(which, request):
    df = request.getfixturevalue(which)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op3(df).collect())
    items = texts(df)
    assert got == collections.Counter((k, *b) for (k, _), b in zip(items, brute_spans(items), strict=True))


def test_repeats_of_texts_without_an_id(spark):
    """Texts that only rows with a null id hold, some of them several times, share a passage in other surroundings."""
    alone = [f"{c * 150} {PASSAGE} {c.upper() * 150}" for c in "stuvw"]
    rows = [(None, alone[0]), (None, alone[1]), (None, alone[1]), (7, alone[2]), (None, alone[3] + LONG[:5000]), (8, alone[4] + LONG[2000:9000])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op3(df).collect())
    assert got == collections.Counter((k, *b) for (k, _), b in zip(rows, brute_spans(rows), strict=True))


def test_hot_anchors_and_anchors_of_hash_zero(spark, monkeypatch):
    """A string that many texts share in other surroundings, which goes to no shard, and anchors whose hash is 0."""
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared, passage = word(150), word(260)
    rows = [(i, word(120) + shared + word(120)) for i in range(40)] + [(100 + i, word(60) + passage[i : i + 210 + i] + word(60)) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, text string")
    expected = brute_ranges(rows)
    digest = lambda t: tuple(np.frombuffer(hashlib.md5(t.encode()).digest(), "<i8").tolist())
    want = {digest(t): s for (_, t), s in zip(rows, expected, strict=True) if s}
    for limit in (1, 5, 4_000):
        got = {(r.d0, r.d1): [(s.a, s.b) for s in r.spans] for r in suffix_dedup.repeated_spans(df, shard_contexts=limit).collect()}
        assert got == want
    raw = np.frombuffer((passage + "|" + passage).encode(), np.uint8)
    bounds = np.array([0, 260, 261, 521])
    plain = suffix_dedup.anchors(raw, bounds, 200, 100)
    monkeypatch.setattr(suffix_dedup, "mix", lambda x: np.zeros_like(x))
    zero = suffix_dedup.anchors(raw, bounds, 200, 100)
    reach = lambda f: [sorted({int(p) + o for p, b, a in zip(f[3][f[2] == d], f[4][f[2] == d], f[5][f[2] == d], strict=True) for o in range(-int(b), 100 + int(a))}) for d in (0, 2)]
    assert reach(zero) == reach(plain) and len(reach(zero)[0]) == 260


def test_repeated_strings_are_cut_from_rows(odd, empty):
    out = suffix_dedup.cut_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    cut = {r.doc_id: (r.text, r.n_chars, r.id) for r in out.filter("doc_id is not null").collect()}
    assert cut[0] == (None, None, "i") and cut[7][0] == "" and cut[8] == ("a b", 3, "i") and cut[11][0] == "z"
    assert suffix_dedup.cut_repeats(empty).count() == suffix_dedup.op3(empty).count() == 0


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_induced_sorting(tmp_path, limit):
    from fieldseries.llm import induced_sort

    rng = np.random.default_rng(1)
    old = induced_sort.BucketQueue.__init__.__defaults__
    induced_sort.BucketQueue.__init__.__defaults__ = (limit,)
    try:
        for _ in range(60):
            t = np.append(rng.integers(1, rng.integers(2, 5), rng.integers(1, 60)), 0)
            sa = np.concatenate([*sort_suffixes(t, str(tmp_path), int(rng.choice([1, 3, 100])))][::-1])
            assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
            cap = int(rng.choice([1, 2, 5, 200]))
            both = np.concatenate([*induced_sort.sort_with_prefixes(t, str(tmp_path), int(rng.choice([1, 3, 100])), cap)][::-1])
            assert both["at"].tolist() == sa.tolist()
            alike = lambda a, b: next((k for k, (x, y) in enumerate(zip(t[a:], t[b:])) if x != y), 0)  # noqa: B023, B905, E731
            assert both["common"].tolist() == [0, *[min(alike(a, b), cap) for a, b in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True)]]
    finally:
        induced_sort.BucketQueue.__init__.__defaults__ = old


def test_common_prefixes_of_long_repeats(tmp_path):
    """Repeats longer than the cap, runs of one symbol and copies next to each other, with most tuples on disk."""
    from fieldseries.llm import induced_sort

    rng = np.random.default_rng(4)
    some = rng.integers(1, 6, 700)
    t = np.concatenate([some, some[:450], np.full(300, 3), some[100:], np.full(280, 3), some[:450], [0]])
    text = t.astype(np.uint8).tobytes()
    for limit, in_memory in ((50, 5), (10_000, 1_000_000)):
        old = induced_sort.BucketQueue.__init__.__defaults__
        induced_sort.BucketQueue.__init__.__defaults__ = (limit,)
        try:
            both = np.concatenate([*induced_sort.sort_with_prefixes(t, str(tmp_path), in_memory, 200)][::-1])
        finally:
            induced_sort.BucketQueue.__init__.__defaults__ = old
        sa = sorted(range(len(t)), key=lambda i: text[i:])
        assert both["at"].tolist() == sa
        for a, b, n in zip(sa[:-1], sa[1:], both["common"][1:].tolist(), strict=True):
            assert text[a : a + n] == text[b : b + n] and (n == 200 or text[a + n : a + n + 1] != text[b + n : b + n + 1])


# --- op4, op6, op7


def test_models_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    known = lab.toPandas().drop_duplicates("doc_id").set_index("doc_id")
    q = quality_model.op4(d, lab).toPandas().set_index("doc_id").join(known, how="inner")
    assert (q[q.held_out].predicted == q[q.held_out].quality).mean() > 0.95
    t = toxicity.op7(d, lab).toPandas().set_index("doc_id").join(known, how="inner")
    held = t[t.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9 and not ((held.predicted == 1) & (held.toxic == 0)).any()
    la = language_id.op6(d).toPandas().merge(d.select("doc_id", "lang").toPandas())
    assert (la[la.held_out].lang_pred == la[la.held_out].lang).mean() > 0.98
    assert (la.held_out == la.doc_id.map(lambda k: zlib.crc32(str(k).encode()) % 4 == 2)).all()


def test_models_on_awkward_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lab = spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(13)] + [(1, None, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, lab):
        for df in (odd, empty):
            for out in (quality_model.op4(df, labels), toxicity.op7(df, labels), language_id.op6(df)):
                r = out.toPandas()
                assert len(r) == df.count() and r.score.between(0, 1).all()
    got = {r.doc_id: r.lang_pred for r in language_id.op6(odd).collect()}
    assert got[0] == got[1] == got[2] == "und" and got[5] == "en"


def test_folding_and_exceptions():
    m = toxicity.Model((("idiot", 3.0), ("moron*", 2.0)), ("not an idiot",))
    hit = lambda t: toxicity.measure(m, t)
    assert hit("You IDIOT!!") == (3.0, 1)
    assert hit("1d10t") == hit("ıd​iоt") == (3.0, 1)
    assert hit("idiotic") == hit("he is not an idiot") == (0, 0)
    assert hit("morons, 172.0.0.1 moronic") == (4.0, 2)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality_model.fit(x[:2000], y[:2000], rounds=60)
    assert ((quality_model.score(m, x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.9


# --- op5


def brute_components(items, size, percent):
    sets = []
    for _, t in items:
        w = words(t)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= percent * (len(a) + len(b) - n):
                    parent[find(i)] = find(j)
    return sets, [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_components(which, request):
    df = request.getfixturevalue(which)
    items = texts(df)
    sets, root = brute_components(items, 4, 85)
    least = {}
    for (k, _), r, s in zip(items, root, sets, strict=True):
        if s and k is not None:
            least[r] = min(k, least.get(r, k))
    expected = collections.Counter((k, len(s), least.get(r) if s else k) for (k, _), s, r in zip(items, sets, root, strict=True))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.op5(df).collect()) == expected


def test_one_of_each_group_stays(odd, docs, empty):
    for df in (odd, docs):
        items = texts(df)
        sets, root = brute_components(items, 5, 80)
        out = ngram_join.keep_one(df)
        assert out.columns == df.columns
        groups = len({r for r, s in zip(root, sets, strict=True) if s}) + sum(not s for s in sets)
        assert out.count() == groups
    assert ngram_join.keep_one(empty).count() == ngram_join.op5(empty).count() == 0


# --- op8


def brute_contamination(items, bench):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = collections.defaultdict(set)
    for k, t in bench:
        w = words(t, pattern)
        if w:
            n = min(13, len(w))
            for i in range(len(w) - n + 1):
                windows[tuple(w[i : i + n])].add(None if k is None else str(k))
    sizes = {len(k) for k in windows}
    for k, t in items:
        w, hit, found = words(t, pattern), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])] - {None}
        yield k, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


def test_classes_that_agree_in_half_their_names_share_shingles():
    """Two classes whose upper 32 bits are equal are two all the same."""
    token, who = np.array([7, 7, 9, 9], np.uint64), np.array([1 << 40, (1 << 40) + 1, 5, 5])
    assert ngram_join.levels_of(token, who).tolist() == [1, 1, 0, 0]
    at = np.array([7, 7, 262], np.uint16)
    assert ngram_join._documents(ngram_join._steps(at)).tolist() == at.tolist()
    assert ngram_join._classes_of(at, who[:2].astype(np.int64).tobytes()).tolist() == [1 << 40, 1 << 40, (1 << 40) + 1]


@pytest.mark.parametrize("limit", [decontamination.BLOCK_BYTES, 1000])
@pytest.mark.parametrize("which", ["odd", "docs"])
def test_decontamination(spark, which, limit, request, monkeypatch):
    df = request.getfixturevalue(which)
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()][: 6 if limit == 1000 else None]
    bench += [(900, "one"), (901, PASSAGE), (901, "Two"), (None, "one"), (None, "One two"), (None, PASSAGE[:90]), (902, None), (903, "..."), (901, PASSAGE)]
    b = spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit(1))
    monkeypatch.setattr(decontamination.blocks, "__defaults__", (limit,))
    got = collections.Counter(tuple(r) for r in decontamination.op8(df, b).drop("spans").collect())
    assert got == collections.Counter(brute_contamination(texts(df), bench))


def test_items_without_an_id_hit_words(spark):
    """One item without an id, alone in its block or not: its words are hit, and no name stands for it."""
    df = spark.createDataFrame([(1, "x " + PASSAGE), (2, "other text")], "doc_id long, text string")
    b = spark.createDataFrame([(None, PASSAGE)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontamination.op8(df, b).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == {1: (60, 0, nothing, True), 2: (0, 0, nothing, False)}


def test_contaminated_documents_go(spark, odd, empty):
    b = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    out = decontamination.drop_contaminated(odd, b)
    assert out.columns == odd.columns and out.count() == odd.count() - 6
    assert decontamination.drop_contaminated(odd, b.limit(0)).count() == odd.count()
    assert decontamination.op8(empty, b).count() == decontamination.drop_contaminated(empty, b).count() == 0


def test_fm_index():
    rng = np.random.default_rng(2)
    seq = rng.integers(0, 5, 400)
    index = FMIndex(seq, 5)
    phrases = np.stack([seq[i : i + 3] for i in range(0, 390, 7)])
    lo, hi = index.search(phrases, np.full(len(phrases), 3))
    for p, a, b in zip(phrases, lo, hi, strict=True):
        assert sorted(index.locate(np.arange(a, b))) == [i for i in range(398) if (seq[i : i + 3] == p).all()]


# --- op9


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_rules(which, request):
    df = request.getfixturevalue(which)
    expected = collections.Counter()
    for k, t in texts(df):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tri = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {i + j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected[(k, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w))] += 1
    got = quality_rules.op9(df).collect()
    assert collections.Counter(tuple(r)[:7] for r in got) == expected
    assert not any(r.base_failed and r.kept for r in got)


def test_policies_and_ablation(docs, empty):
    led = quality_rules.ledger(quality_rules.measure(docs)).cache()
    p = quality_rules.POLICIES[2]
    kept = quality_rules.apply_policy(led, p).filter("kept").count()
    for r in quality_rules.ablation(led, p).collect():
        less = quality_rules.Policy(9, p.hard & ~(1 << r.bit), p.soft & ~(1 << r.bit), p.soft_limit)
        assert r.n_failed == led.filter(F.col("failures").bitwiseAND(F.lit(1 << r.bit)) != 0).count()
        assert led.filter(~quality_rules.rejects(less, F.col("failures"))).count() - led.filter(~quality_rules.rejects(p, F.col("failures"))).count() == r.n_only
    assert kept > 0 and quality_rules.op9(empty).count() == 0
    assert {r.n_failed for r in quality_rules.ablation(quality_rules.ledger(quality_rules.measure(empty)), p).collect()} == {0}


# --- op10


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_packing(which, request):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.op10(df).toPandas()
    expected = collections.Counter()
    for k, t in texts(df):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            expected[(k, p, a, len(part), zlib.crc32(part.tobytes()))] += 1
    rows = got[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object).where(got.doc_id.notna(), other=got[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object))
    assert collections.Counter((None if pd.isna(r[0]) else int(r[0]), *map(int, r[1:])) for r in rows.itertuples(index=False)) == expected
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.r_[0, np.cumsum(g.length)[:-1]]).all() and g.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1


def test_unusual_texts_are_encoded_as_by_the_tokenizer():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer, encode = Tokenizer.from_file(path), packing.Encoder(path)
    assert encode.split
    for t in ("İstanbul ŉa ²x½ ΣΑΣ it's <|endoftext|>x a\x1cb q\x85w été …’tis '''s 'S", "日本語 𝔘 ½", "", " \n", "naïve—“q” ﬁne ſharp ẞ ﷺ́ é ́x"):
        assert encode(t.encode()) == np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()


def test_bounds_and_best_fit():
    rng = np.random.default_rng(3)
    assert packing.dual_feasible_bound(np.array([60, 60, 60]), 100) == 3
    assert packing.dual_feasible_bound(np.array([34] * 5), 100) == 3
    for _ in range(50):
        x = rng.integers(1, 101, rng.integers(1, 60))
        bins, made = packing.best_fit_decreasing(x, 100)
        assert np.bincount(bins, weights=x).max() <= 100 and made == bins.max() + 1
        assert packing.dual_feasible_bound(x, 100) <= made


def test_exchange_keeps_every_piece(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(int(k), int(v)) for k, v in enumerate(rng.integers(1, 2049, 3000))], "row long, length long")
    out = packing.pack(df, 2048, part_pieces=300).toPandas()
    assert sorted(out.row) == list(range(3000))
    assert packing.pack(df.limit(0), 2048).count() == 0

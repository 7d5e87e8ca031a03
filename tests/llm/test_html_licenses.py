import random
import re

import pytest

from salesflow.llm import html_text, licenses

from .conftest import prose


@pytest.mark.parametrize("page,text", [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
    ("<div>a<div>b</div>c</div>d", "a\nb\nc\nd"), ("<h1>T</h1><p>x</p>", "T\n\nx"),
    ("a<!-- hidden <p> -->b", "ab"), ("a <b>bold</b><i>er</i> c", "a bolder c"), ("x &lt;p&gt; &amp;amp; &copy;", "x <p> &amp; ©"),
    ("<script>var t='</p>';</script>ok<style>p{}</style>", "ok"), ("<title>no</title><p>yes", "yes"),
    ("<p hidden>no</p><p style=\"color:red; display : none\">no<p>yes", "yes"), ("<div data-hidden-x=1>yes</div>", "yes"), ("<span style='visibility:hidden'>no</span>a", "a"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e", "- a\n- b\n  3. c\n  4. d\n\ne"),
    ("<pre>\n  x\n    y</pre>z", "  x\n    y\n\nz"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>kiwi fruit<td>10</table>end", "Name        Qty\napple       3\nkiwi fruit  10\n\nend"),
    ("<table><td>a<td>b<br>c</table>", "a  b\n   c"), ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("</p></div>a</b>", "a"), ("<a href='x>y'>l</a>", "l"), ("<p>unclosed <b", "unclosed"), ("a < b and 3 <4", "a < b and 3 <4"), ("<textarea>shown</textarea><br>yes", "shown\nyes"),
    ("<li>alone", "- alone"), ("<td>cell", "cell"), ("<p>a</table></p>b", "a\n\nb")])
def test_rendering(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page,text", [
    ("<div title=\"the hidden door\">a</div><p data-label='show hidden files'>b<a href=/hidden/valley>c</a><i class=\"md:block hidden lg:flex\">d</i>", "a\n\nbcd"),
    ("<p title=\"style='display:none'\" data-style=\"display:none\">a<b alt='x type=hidden'>b</b>", "ab"), ("<p style='background:url(\"a;display:none\")'>a", "a"),
    ("<p style='display:none;display:block'>a", "a"), ("<p style='display:none!important;display:block'>no", ""), ("<p style='--display:none'>a", "a"),
    ("<p HIDDEN=''>no<p a=1 hidden/>no<p style=display:none>no<p class=x STYLE=\"Visibility: Hidden\">no<p>a", "a"),
    ("Size <select name=s><option>S<option selected>M<option>L</select>left", "Size M left"), ("<select><option disabled>no<option>a<option>no</select>", "a"),
    ("<select><optgroup disabled><option>no</optgroup><optgroup><option label='A'>b</select>c", "A c"), ("<select><option selected hidden>Choose<option>no</select>", "Choose"),
    ("<select multiple><option>a<option hidden>no<option>b</select>c", "a\nb\nc"), ("<p hidden><select><option>no</select>no</p>a", "a"),
    ("<table><tr><td><select><option>a<td>b</table>", "a  b"), ("<div><select><option>a</div>b", "a\nb"), ("<datalist><option>no</datalist>a", "a")])
def test_only_the_attributes_themselves_hide(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>T</title><h1>A</h1><p>text", "A\n\ntext"), ("<head><meta charset=x><link rel=y><base href=z>\n <style>p{}</style>text", "text"),
    ("<head><html lang=en><head><script>no</script><noscript>no</noscript><template><p>no</p>no</template><p>a", "a"),
    ("<head><title>no</title><br>a<title>no</title>", "a"), ("<head>\n<!-- no --><title>no</title>\n</head>\n<p>a", "a"), ("a<head>b", "ab"),
    ("<head><title>no</title><body hidden>no", ""), ("<head><title>no", "")])
def test_an_open_head_ends_where_the_body_begins(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page,text", [
    ("<p class=x\">Hello world</p><p>More text here</p>", "Hello world\n\nMore text here"), ("<p>First.</p><img src=a.png alt=5\" width=3><p>Second", "First.\n\nSecond"),
    ("<p data-x=it's>Hello</p>", "Hello"), ("<p 'a' \"b>c\">d", "c\">d"), ("<p a='x>y' b=\"u>v\">z", "z"), ("<p a = 'x>' >z", "z"), ("<p a=>z", "z"), ("<p =a='>'>z", "z"),
    ("<p a='>no", ""), ("<a/b='>'/>c", "c"), ("</p a='>'>b", "b"), ("<p hidden=\"a\"b>no<p>c", "c"), ("<p title='a'hidden>no<p>c", "c")])
def test_a_quote_opens_a_value_only_after_an_equals_sign(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page,text", [
    ("&#" + "9" * 5000 + ";a", "\ufffda"), ("&#x" + "f" * 5000 + ";a", "\ufffda"), ("&#" + "0" * 5000 + "65;", "A"), ("&#x" + "0" * 50 + "41 b", "A b"), ("&#0;&#1114112;", "\ufffd\ufffd"),
    ("<select size=" + "9" * 5000 + "><option>a<option>b</select>", "a\nb"), ("<select size=00001><option>a<option>b</select>", "a"), ("<select size=²><option>a<option>b</select>", "a"),
    ("<ol start=" + "9" * 5000 + "><li>a", "999999999. a"), ("<table><tr><td colspan=" + "9" * 5000 + ">a<td rowspan=²>b</table>", "a  b")])
def test_long_numbers(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page,text", [
    ("<table><tr><th colspan=2>Heading of two<th>Next<tr><td>a<td>b<td>c</table>", "Heading of two  Next\na  b            c"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"), ("<table><tr><td>x<td rowspan=3>y<td>z<tr><td>u<td>v<tr><td>s<td>t</table>", "x  y  z\nu     v\ns     t"),
    ("<table><tr><td>" + "w" * 100 + "<td>b<tr><td>c<td>d</table>", "w" * 100 + "  b\nc  d"),
    ("<div style='visibility:hidden'>no<p style='visibility:visible'>yes</p>no</div>", "yes"), ("<p style='visibility:hidden'>no<b>no</b></p>a", "a"),
    ("<div style='display:none'>no<p style='visibility:visible'>no</p></div>a", "a"), ("<textarea>\na &lt;b&gt; <p></textarea>", "a <b> <p>")])
def test_spans_and_visibility(page, text):
    assert html_text.render(page) == text


def test_nesting_takes_linear_time_and_pages_bound_their_text():
    import time

    def spent(page):
        start = time.perf_counter()
        html_text.render(page)
        return time.perf_counter() - start

    for opening in ("<div>", "<ul><li>a", "<p><b>", "<blockquote>a", "<table><tr><td>", "<p><button><div>", "<dl><dt>a<dd>b"):
        few, many = min(spent(opening * 2000) for _ in range(3)), spent(opening * 16_000)
        assert many < 40 * few + 0.5, (opening, few, many)
    for page in ("<table><tr><td>" + "x" * 20_000 + "</tr>" + "<tr><td><td>y" * 2000 + "</table>", "<blockquote>a" * 5000, "<ul><li>a" * 5000,
                 "<table><tr>" + "<td>a" * 3000 + "</tr>" + "<tr><td colspan=2999><td>b" * 3000 + "</table>"):
        assert len(html_text.render(page)) < 20 * len(page)
    start = time.perf_counter()
    html_text.render("word " * 200_000)
    html_text.render("<table>" + "<tr>" + "<td colspan=1000 rowspan=9>a" * 3000 + "<tr><td>" * 3000)
    assert time.perf_counter() - start < 20


def test_deep_and_long_pages():
    assert html_text.render("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    assert html_text.render("<b>" * 20_000 + "x") == "x"
    assert len(html_text.render("<p>word " * 50_000).split()) == 50_000
    html_text.render("<" * 50_000 + "a" + "'" * 5000)


def test_all_words_of_visible_paragraphs_survive():
    r = random.Random(1)
    for case in range(50):
        words, page = [], []
        for i in range(30):
            w = f"w{case}x{i}"
            words.append(w)
            page.append(r.choice(["<p>{}</p>", "<li>{}", "<td>{}</td>", "<div><span>{}</span></div>", "{} ", "<tr><td>{}", "<h2>{}</h2>", "<ul><li>{}</ul>", "<table><tr><td>{}</table>"]).format(w))
        assert sorted(re.findall(r"w\d+x\d+", html_text.render("".join(page)))) == sorted(words)


def test_pages_table(spark):
    schema = "page_id long, url string, html string, text string, n_lines string"
    rows = [(1, "u", "<p>a<p>b", "clash", "clash"), (2, None, None, None, None), (3, "u", "", None, None), (1, "u", "<p>a<p>b", None, None)]
    out = sorted(map(tuple, html_text.extract(spark.createDataFrame(rows, schema)).collect()))
    assert out == [(1, "u", "a\n\nb", 4, 3), (1, "u", "a\n\nb", 4, 3), (2, None, None, 0, 0), (3, "u", "", 0, 0)]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


@pytest.fixture(scope="module")
def noticed(spark):
    r, rows = random.Random(3), []
    notices = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts]
    for i in range(300):
        family, notice = notices[i % len(notices)] if i % 2 else (None, None)
        lines = [prose(i, 30).replace("\n", " "), prose(i + 999, 12).replace("\n", " "), "the licence of the work under public terms is not this version" if i % 10 == 0 else "x"]
        if notice:
            lines.insert(r.randrange(3), notice.upper() if i % 7 == 0 else notice)
        rows.append((i, "\n".join(lines), family, notice))
    return spark.createDataFrame(rows, "doc_id long, text string, family string, notice string"), rows


def test_families_are_found_and_other_paragraphs_are_unknown(noticed):
    df, rows = noticed
    scanner = licenses.train(df)
    out = {r["doc_id"]: r for r in licenses.scan(df, scanner).collect()}
    for i, text, family, notice in rows:
        r = out[i]
        assert r["licence"] == family, (text, r)
        if family:
            assert r["n_notices"] == 1 and r["template_share"] >= 0.6
            a, b = map(int, r["spans"].split(":")[1:])
            assert text[a:b].lower() == notice.lower()
        else:
            assert r["spans"] == "" and r["n_notices"] == 0


_GPL = ("    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n"
        "    the Free Software Foundation, either version 3 of the License, or\n    (at your option) any later version.")
_BSD = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:")
_APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.")
_CC = "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License."


@pytest.mark.parametrize("family,notice,lines", [
    ("gpl", _GPL, 2), ("bsd", _BSD, 3), ("apache", _APACHE, 2), ("cc-by-nc", _CC, 2), ("mit", "Released under\nthe MIT License.", 2),
    ("gpl", re.sub("(?m)^ *", " * ", _GPL), 2), ("bsd", re.sub("(?m)^", "// ", _BSD), 3)])
def test_notices_over_several_lines(spark, noticed, family, notice, lines):
    df, _ = noticed
    scanner = licenses.train(df)
    texts = [f"{before}{notice}{after}" for before, after in (("", ""), ("é alpha beta gamma\n", "\ndelta of the eta"), ("alpha\n\n", "\n\nbeta"))]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), scanner).collect()
    want = "\n".join(notice.split("\n")[:lines])
    for r in rows:
        assert (r["licence"], r["n_notices"]) == (family, 1), r
        a, b = map(int, r["spans"].split(":")[1:])
        assert texts[r["doc_id"]][a:b] == want


def test_a_notice_ends_with_its_paragraph_and_document(spark, noticed):
    df, _ = noticed
    rows = [(1, "Permission is hereby granted, free of charge, to\n\nany person obtaining a copy of this software"), (2, "Released under"), (3, "the MIT License."),
            (4, "Released under the MIT License.\nLicensed under CC BY 4.0.")]
    out = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), licenses.train(df)).orderBy("doc_id").collect()
    assert [r["spans"] for r in out if r["doc_id"] != 3] == ["", "", "mit:0:31,cc-by:32:57"]


def test_license_edge_cases(spark, docs, no_docs, cluttered):
    scanner = licenses.train(docs)
    out = licenses.scan(cluttered, scanner).collect()
    assert len(out) == docs.count() and all(r["licence"] is None for r in out)
    assert licenses.scan(no_docs, licenses.train(no_docs)).count() == 0
    wide = spark.createDataFrame([(1, "é日本\nAll rights reserved.\nReleased under the MIT License.\n")] * 2, "doc_id long, text string")
    rows = licenses.scan(wide, scanner).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0]["spans"] == "proprietary:4:24,mit:25:56" and rows[0]["n_notices"] == 2


@pytest.mark.parametrize("notice,family", [
    ("SPDX-License-Identifier: GPL-2.0-only", "gpl"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "gpl"), ("# SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl"),
    ("SPDX-License-Identifier: AGPL-3.0-only", "agpl"), ("# SPDX-License-Identifier: ISC", "isc"), ("SPDX-License-Identifier: WTFPL", None), ("SPDX-License-Identifier: OFL-1.1", None),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the FSF.", "lgpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published", "agpl"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published", "gpl"),
    ("Unless stated otherwise, all pages are licensed under CC BY-ND 4.0.", "cc-by-nd"), ("All pages are licensed under CC BY-NC-ND 4.0.", None), ("Text licensed under CC BY 4.0, sa maison.", "cc-by"),
    ("This work is in the public domain debate of the city.", None), ("The hotel has all rights reserved for guests.", None), ("This work is in the public domain.", "public-domain"),
    ("(c) 2020 Example Corp. All rights reserved.", "proprietary"), ("Copyright 2020 Example. All rights reserved by Example Corp.", "proprietary"),
    ("The code is released under the MIT License, see the file.", "mit"), ("Distributed under the Boost Software License, Version 1.0.", None)])
def test_siblings_and_sentences_that_sound_alike(scanner, spark, notice, family):
    lead, tail = prose(5, 12).replace("\n", " "), prose(6, 12).replace("\n", " ")
    out = licenses.scan(spark.createDataFrame([(1, f"{lead}\n{notice}\n{tail}")], "doc_id long, text string"), scanner).first()
    assert out["licence"] == family, out


@pytest.fixture(scope="module")
def scanner(noticed):
    return licenses.train(noticed[0])


def test_scores_equal_a_plain_regression(scanner):
    """The sparse scores against a sum over each paragraph's words and pairs, one by one."""
    import numpy as np
    cell = {int(h): i for i, h in enumerate(scanner.vocabulary)}
    for text in [*licenses.OTHERS, prose(3, 30), "MIT", "Licensed under the MIT License and the Apache License, Version 2.0"]:
        h = licenses._hashes(text)
        z = np.array(scanner.bias, float)
        for x in [*h.tolist(), *licenses._bigrams(h).tolist()]:
            if x in cell:
                z += scanner.weight[cell[x]] / len(h) ** 0.5
        known = sum(int(x) in cell for x in h)
        z += (1 - known / len(h)) * scanner.weight[-2] + np.log1p(len(h)) * scanner.weight[-1]
        have = {*h.tolist(), *licenses._bigrams(h).tolist()}
        z[[k > 0 and not scanner.allowed(k, have) for k in range(len(z))]] = -np.inf
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(scanner.score(h, np.zeros(len(h), np.int64), 1)[0], p, atol=1e-5)

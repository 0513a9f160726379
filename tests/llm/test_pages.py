"""HTML extraction, URL filters and WARC bundles."""

from __future__ import annotations

import base64
import hashlib
import html
import random

import pytest
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from sensorflow.llm import html_template, url_filter, warc

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var a="</p><article>x";</script></head><body>
<header><a href="/">Site</a> slogan</header><nav><ul><li><a href="/a">Menu {n}</a><li><a>Other</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="wrap"><{tag}><h1>Title&nbsp;{n} &amp; more</h1>
<p>First   para {n}<br>of <b>it<p>Second &lt;para&gt; {n}</p><!-- no --><div class="ad">Buy {n}</div><form><p>Your mail</p><input></form>
<p>Third{n}</p><div id="comments"><p>A reader says {n}</p></div></{tag}><aside class="sidebar">Side {n}</aside></div>
<footer>&copy; site {n}</footer></body></html>"""
WANT = "Title {n} & more\nFirst para {n} of it\nSecond <para> {n}\nThird{n}"


def _pages(spark, tag, hosts=3, pages=6):
    rows, k = [], 0
    for h in range(hosts):
        for _ in range(pages):
            rows.append((k, f"https://h{h}.org/{k}", PAGE.format(n=f"{k}x", tag=tag)))
            k += 1
    return rows


@pytest.mark.parametrize("tag", ["article", "main", 'div class="post-content"'])
def test_main_text(spark, tag):
    rows = [(i, u, h.replace("</div class=\"post-content\">", "</div>")) for i, u, h in _pages(spark, tag)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in html_template.main_text(df).collect()}
    assert got == {i: WANT.format(n=f"{i}x") for i, _, _ in rows}


def test_frame_of_a_host_without_telling_names(spark):
    page = "<html><body><div><a href=x>one {n}</a><a href=y>two {n}</a></div><div><div><p>Long story {n} with many words in it.<p>And more {n} of it.</div></div><div>same line</div></body></html>"
    df = spark.createDataFrame([(i, "http://z.org/", page.format(n=i)) for i in range(8)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_template.main_text(df).collect()}
    assert all(f"Long story {i} with many words in it.\nAnd more {i} of it." in t for i, t in got.items())


def test_text_that_repeats_over_the_pages_is_template(spark):
    page = ("<html><body><div><div><p>Read our terms.<p>Long story {n} with many words in it.<p>And more {n} of it.</div></div>"
            "<div>same line</div></body></html>")
    copy = page.format(n="copied")
    rows = [(i, "http://z.org/", page.format(n=i)) for i in range(8)] + [(8 + i, "http://y.org/", copy if i < 7 else page.format(n=i)) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_template.main_text(df).collect()}
    assert {i: got[i] for i in range(8)} == {i: f"Long story {i} with many words in it.\nAnd more {i} of it." for i in range(8)}
    assert all(got[8 + i] == "Long story {0} with many words in it.\nAnd more {0} of it.".format("copied" if i < 7 else i) for i in range(9))


def test_main_text_of_odd_rows(spark):
    rows = [(None, None, None), (1, "http://a.org", ""), (2, "x", "plain text"), (3, "http://a.org", "<p>a<p>b < c"), (3, "http://a.org", "<p>a<p>b < c"),
            (4, "http://b.org", "<article>" + "<p>" + "word " * 40000 + "</article>"), (5, "http://c.org", "<nav>only menu</nav><script>x"),
            (6, "http://c.org", "<div \"><'>broken"), (7, "u", "<article></article><p>outside")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r["page_id"], r["text"]) for r in html_template.main_text(df).collect()]
    assert len(got) == len(rows)
    d = dict(got)
    assert d[None] == "" and d[1] == "" and d[2] == "plain text" and d[3] == "a\nb < c" and len(d[4]) == 40000 * 5 - 1 and d[5] == ""
    assert html_template.main_text(df.limit(0)).count() == 0


def test_blocks_decode_and_break():
    page = "<ul><li>a<li>b &amp;amp; c</ul><table><tr><td>1<td>2</table>x<b>y</b>z &#x41;&eacute;"
    assert [t for _, t in html_template.blocks(page)] == ["a", "b &amp; c", "1", "2", "xyz Aé"]
    assert html.unescape("&amp;amp;") == "&amp;"


def test_equivalence_classes_share_vectors():
    import pandas as pd

    rows = pd.DataFrame([("html", 0, 5, 5, 1, 0), ("html>nav", 0, 5, 5, 1, 1), ("html>nav>a", 0, 5, 9, 2, 2), ("html>p", 0, 4, 4, 3, 3), ("html>x", 0, 1, 1, 4, 4)],
                        columns=["path", "token", "df", "total", "fp", "place"])
    assert html_template.frames(rows, 5) == [[("html",), ("html", "nav")], [("html", "p")]]


# -- urls -------------------------------------------------------------------------------

def test_url_rules_and_parts(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?y", "https://example.net", "http://net/x", "http://xnet/", "http://a.b.net/", "http://example.com/de/",
            "ftp://u@EXAMPLE.com:80/de/x", "http://x.org/fr/#f", "http://x.org?/fr/", "http://É.org/fr/", "a://b://c/d", "http://spam-farm.org/x", "http://myspam.org/x", "x\n://h.org/p\nq"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("Host", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[4] == ("example.net", "", None, "allow")
    assert got[5][2:] == ("net/", "block") and got[6][2] is None and got[7][2:] == ("net/", "block")
    assert got[8][2:] == ("example.com/de/", "block") and got[9] == ("u@example.com:80", "/de/x", None, "allow")
    assert got[10] == ("x.org", "/fr/", "org/fr/", "allow") and got[11] == ("x.org", "", None, "allow")
    assert got[12][0] == "É.org" and got[13] == ("b:", "//c/d", None, "allow")
    assert got[14][3] == "block" and got[15][3] == "allow" and got[16][:2] == ("h.org", "/p\nq")
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_long_lists_are_cascades_in_groups(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"http://h{i % 50}.{'spam' if i % 3 else 'ok'}.org/x") for i in range(300)] + [(300, None)],
                               "page_id long, url string").selectExpr("*", "1 as _fit", "2 as _listed", "3 as hit", "4 as row", "5 as fit")
    want = sorted(tuple(r) for r in url_filter.judge_urls(df).collect())
    monkeypatch.setattr(url_filter, "MAX_LEVEL_BITS", 128)
    for passes in (32, 2):
        monkeypatch.setattr(url_filter, "PASS_GROUPS", passes)
        assert sorted(tuple(r) for r in url_filter.judge_urls(df).collect()) == want
    assert len(url_filter.build_cascades(df, "url", F.col("url").contains("spam"))) > 4
    assert {r[-1] for r in want} == {"allow", "block"} and want[7][2:7] == (1, 2, 3, 4, 5)


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 2)  # many false positives, so many levels
    monkeypatch.setattr(url_filter, "HASHES", 1)
    df = spark.range(3000).selectExpr("cast(id as string) as key", "id % 7 = 0 as yes")
    cascade = url_filter.build_cascade(df, "key", F.col("yes"))
    assert len(cascade.levels) > 2
    assert df.where(cascade.has(F.col("key")) != F.col("yes")).count() == 0
    assert spark.range(1).select(cascade.has(F.lit(None).cast("string"))).first()[0] is False


# -- warc -------------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 3000)
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}\r\ninjected: 1", "".join(rng.choice("abcé<>\r\n") for _ in range(rng.randrange(900)))) for i in range(40)]
    rows += [(100 + i, None, None) for i in range(3)] + [(50 + i, "u", "same é") for i in range(30)] + [(None, "n", "same é"), (200, "r", "rep"), (200, "r", "rep"), (201, "r", "rep"), (300, "l", "long " * 200000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit("clash")).repartition(3)
    index = warc.write_warc(df, tmp)
    got = warc.read_warc(index).collect()
    assert len(got) == len(rows) == index.count()
    first: dict = {}
    for i, _, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(h or "", i)
    for r in got:
        body = next(h or "" for i, _, h in rows if i == r["page_id"])
        data = body.encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        own = r["page_id"] is None or first[body] == r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if own else ("revisit", first[body]))
        assert bytes(r["content"]) == (data if own else b"")
    # one record by its frame and offset
    some = index.where("page_id = 7").first()
    with pafs.LocalFileSystem().open_input_file(some["bundle"].removeprefix("file://").removeprefix("file:")) as f:
        head, body = warc.BundleReader(f).record(some["frame"], some["offset"])
    assert head["WARC-Record-ID"] == "<urn:page:7>" and body.decode() == rows[7][2]
    assert index.select("bundle").distinct().count() > 3


def test_warc_min_bytes_and_empty(spark, tmp):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r["page_id"]: r["refers_to"] for r in warc.read_warc(warc.write_warc(df, tmp, min_bytes=3)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}
    assert warc.read_warc(warc.write_warc(df.limit(0), tmp)).count() == 0


def test_frames_are_plain_zstandard():
    import zstandard

    w = warc.BundleWriter()
    w.add(1, warc.record_bytes(1, "u", "response", b"x", 1, warc.digest(b"x"), None))
    out = zstandard.ZstdDecompressor().decompressobj().decompress(w.close())
    assert out.startswith(b"WARC/1.1\r\n")

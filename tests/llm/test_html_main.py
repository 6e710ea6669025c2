"""Blocks and rules on small pages, and the pages of the tables against their article."""

import html
import re

import duckdb
from helpers import SF

from ledgerlens.llm import html_main
from ledgerlens.llm.catalog import LLM_QUERIES

LONG = ("This is the main text of the page, and it is long enough to be decided by the rules "
        "of the first pass on its own.")


def test_furniture_goes():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a></ul></nav>
      <div class="cookieNotice">We use cookies on this site and you agree to that.</div>
      <main><h1>Head</h1><p>{LONG}<p>Short.<div id="comments"><p>{LONG}</div>
      <form>Name <input name=q> <button>Go</button></form>
      <aside>{LONG}</aside><script>var a="</p>" + 1 < 2;</script></main>
      <!-- <p>{LONG}</p> --><div class='ad banner'><div>x</div>{LONG}</div>
      <footer>{LONG}</footer></body></html>"""
    assert html_main.main_text(page) == f"Head\n{LONG}\nShort."


def test_short_blocks_follow_their_neighbours():
    page = f"<div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><p>Imprint</p><nav>n</nav><p>Top</p>"
    assert html_main.main_text(page) == f"{LONG}\nYes.\n{LONG}\nImprint"


def test_link_lists_go_and_linked_words_stay():
    page = (f"<p>{LONG} <a href=x>more</a></p><ul><li><a href=1>One of many links to other pages"
            f" that stand in a list</a></li></ul>")
    assert html_main.main_text(page) == f"{LONG} more"


def test_references_and_white_space():
    page = "<article><p>a&nbsp;&lt;b&gt; &amp;amp; &am; &#233;<br>x\n\t y<b>z</b></p></article>"
    assert html_main.main_text(page) == "a <b> &amp; &am; é x yz"


def test_broken_markup():
    for page in (None, "", "<", "<p", "<p>", "</p></div>", "<!--", "<script>x", "a < b",
                 "<article><p>x", "<p class='a>b", "<" * 5000, "<p>" * 5000):
        assert isinstance(html_main.main_text(page), str)
    assert html_main.main_text("<article><p>x <p class='cut") == "x"
    assert html_main.main_text("<article>a < b and 1 <2</article>") == "a < b and 1 <2"


SLOVENE = ["Kmetje v dolini pravijo, da letos že tretjič zapored čakajo predolgo, dokler reka ne "
           "upade; šele potem lahko zasejejo spodnje njive.", "Reka se umika.",
           "Občina je obljubila nov nasip, vendar denarja zanj še vedno manjka, zato bodo gradili "
           "šele prihodnje poletje, če bo vreme dovolj ugodno."]
CHINESE = ["山谷里的农民说，今年已经是连续第三年，他们要等河水退去才能播种低处的田地。", "河水正在退去。",
           "镇政府答应修建新的堤坝，但是资金仍然不足，所以要等到明年夏天才能开工建设。"]


def plain(paragraphs, title, lead="", tail=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f"<html><body><div class=topbar>Menu</div><nav><a href=/>Home</a></nav>{lead}"
            f"<div class=content><h1>{title}</h1><div>{body}</div></div>{tail}"
            f"<ul><li><a href=1>{title} one more link</a><li><a href=2>and another</a></ul>"
            f"<footer>(c) 2024</footer></body></html>")


def test_pages_without_article_elements():
    """Languages with and without a stop list, in scripts with and without spaces."""
    english = [LONG, "Yes, it is.", LONG.replace("main", "other")]
    for paragraphs in (english, SLOVENE, CHINESE):
        page = plain(paragraphs, "Title")
        got = html_main.main_text(page).split("\n")
        assert [x for x in got if x != "Title"] == paragraphs
    # a short notice in a listed language does not make the others unreadable
    page = plain(CHINESE, "标题", tail=f"<p class=notice>{LONG}</p>")
    assert [x for x in html_main.main_text(page).split("\n") if x != "标题"] == CHINESE
    assert html_main.main_text(f"<div><a href=1>{SLOVENE[0]}</a></div>") == ""


def test_outside_an_article_long_blocks_go():
    page = f"<article><h1>T</h1><p>{LONG}</p></article><div>{SLOVENE[0]}</div><div>{CHINESE[0]}</div>"
    assert html_main.main_text(page) == f"T\n{LONG}"


def test_wrappers_are_not_furniture():
    inner = f"<nav><a href=/>Home</a></nav><div><h1>Head</h1><p>{LONG}</p><p>Short.</p></div>"
    for wrap in ("<form id=aspnetForm>{}</form>", "<div class='has-sidebar page'>{}</div>",
                 "<div id=search-page>{}</div>", "<form><div class=modal>{}</div></form>"):
        page = "<body>" + wrap.format(inner) + "<footer>(c) 2024</footer></body>"
        assert html_main.main_text(page) in (f"Head\n{LONG}\nShort.", f"{LONG}\nShort."), wrap
    assert html_main.main_text(f"<p class='no-login'>{LONG}</p>") == LONG
    # a form without parts of a page, and comments, stay out however long
    assert html_main.main_text(f"<p>{LONG}</p><form>{LONG * 9}</form>") == LONG
    comments = f"<div class=comments><h1>Comments</h1>{f'<p>{LONG}</p>' * 30}</div>"
    assert html_main.main_text(f"<p>{LONG}</p>{comments}") == LONG


def test_time_grows_with_the_page():
    import time
    began = time.time()
    cells = html_main.main_text("<table>" + "<tr><td>a cell</td></tr>" * 100_000 + "</table>")
    assert cells == ""
    text = html_main.main_text("<article>" + "<p>a cell</p>" * 100_000 + "</article>")
    assert text.count("\n") == 99_999
    assert time.time() - began < 20


def test_sweeps_equal_a_walk():
    """Labels of open blocks against a search for the nearest decided ones."""
    import random
    rng = random.Random(3)
    kinds = [f"<p>{LONG}</p>", "<p>short</p>", "<h2>head</h2>", f"<p><a href=1>{LONG}</a></p>"]
    for _ in range(200):
        page = "".join(rng.choice([*kinds, "<p>short</p>", "<article>", "</article>"])
                       for _ in range(rng.randint(1, 25)))
        found = html_main.blocks(page)
        decided = [html_main.first_pass(b) for b in found]
        if not any(decided):
            continue
        got = html_main.labels(found)
        for i, b in enumerate(found):
            if decided[i] is not None:
                assert got[i] == decided[i]
                continue
            sides = []
            for step in (-1, 1):
                j = i + step
                while 0 <= j < len(found) and found[j].region == b.region and decided[j] is None:
                    j += step
                inside = 0 <= j < len(found) and found[j].region == b.region
                sides.append((abs(j - i), decided[j] if inside else b.region > 0))
            (near, left), (far, right) = sides
            assert got[i] == (left if left == right else left if near < far
                              else right if far < near else True)


def test_query_gives_the_article_of_every_page(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    want = {}
    for i, page in pages:
        body = re.search(r"(?s)<article>(.*?)(</article>|\Z)", page)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split())
                 for x in re.split(r"</?(?:p|h1)>", body)]
        want[i] = "\n".join(x for x in parts if x)
    rows = LLM_QUERIES["op4_html"](spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_awkward_and_empty(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "", None),
            (2, "u", f"<p>{LONG}</p>" * 2000, "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_main.extract(df).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 0, 2000 * len(LONG) + 1999]
    assert html_main.extract(df.filter("false")).count() == 0

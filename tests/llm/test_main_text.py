from __future__ import annotations

import re
import time

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import table
from hypothesis import given, settings
from hypothesis import strategies as st

from docketworks.llm import main_text
from docketworks.llm.markup import ARTICLE, CHROME, PLAIN, blocks
from docketworks.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, host string, text string"


def lines(page, zone=ARTICLE):
    return [" ".join(words) for z, words in blocks(page) if z == zone]


def test_blocks_and_white_space():
    page = "<article><h1> A \n title </h1><p>one<b>two</b> three<br>four<p>five&amp;six &lt;x&gt; a < b</p>tail</article>after"
    assert lines(page) == ["A title", "onetwo three four", "five&six <x> a < b", "tail"]
    assert lines(page, PLAIN) == ["after"]


@pytest.mark.parametrize("part", [
    "<nav>no</nav>", "<footer>no</footer>", "<aside>no</aside>", "<form>no</form>", "<script>no <p>no</script>",
    "<style>p{no}</style>", "<!-- no <p>no -->", "<div class='ad'>no</div>", '<div id="cookie-notice">no</div>',
    "<div role=navigation>no</div>", "<section class='comments'><article>no</article></section>", "<p hidden>no</p>",
    "<div class=sidebar><div>no</div></div>", "<template>no</template>", "<div style='display: none'>no</div>",
    "<noscript>no</noscript>", "<ul class='menu'><li>no<li>no</ul>", '<button title="a > b">no</button>',
])
def test_what_is_not_main_text(part):
    assert lines(f"<body>{part}<article><p>yes</p>{part}<p>yes</p></article>{part}</body>") == ["yes", "yes"]


def test_headers_of_the_site_and_of_an_article():
    assert lines("<header><p>site</p></header><article><header><h1>t</h1></header><p>x</p></article>") == ["t", "x"]


def test_unclosed_elements():
    assert lines("<div class=ad>buy<article><p>a<p>b<footer>no") == ["a", "b"]
    assert lines("<article><p>a<!-- never closed <p>b") == ["a"]
    assert lines("<article>a<script>var x") == ["a"]
    assert lines(None) == lines("") == lines("plain <") == []
    assert lines("plain < text", PLAIN) == ["plain < text"]


@settings(max_examples=60, deadline=None)
@given(pages=st.lists(st.lists(st.integers(0, 3), max_size=14), min_size=1, max_size=5), run=st.sampled_from([1, 2, 4]))
def test_repeated_runs_are_those_of_brute_force(pages, run):
    symbols, page, places = [], [], []
    for i, words in enumerate(pages):
        for k in range(len(words) - run + 1):
            places.append((len(symbols) + k, i, tuple(words[k:k + run])))
        symbols += words + [-1 - i]
        page += [i] * (len(words) + 1)
    found = main_text.repeated(np.array(symbols), np.array(page), run)
    expected = {at for at, i, w in places if any(j != i and v == w for _, j, v in places)}
    assert set(found.tolist()) == expected


def test_suffixes_are_sorted():
    symbols = np.array([2, 1, 3, 1, 3, 1, 0, 2, 1, 3])
    order, _ = main_text.suffix_order(symbols, 16)
    assert [symbols[i:].tolist() for i in order] == sorted(symbols[i:].tolist() for i in range(10))


def test_articles_of_the_tables(spark):
    rows = {r["page_id"]: r for r in QUERIES["op5_main_text"](spark, SF_DIR).collect()}
    source = table(SF_DIR, "pages", "page_id", "html")
    assert len(rows) == len(source)
    for page_id, page in source:
        article = re.search(r"<article>(.*?)(?:</article>|<footer>)", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " ").replace("<b>", ""))
        import html

        expected = "\n".join(t for p in parts if (t := " ".join(html.unescape(p).split())))
        assert rows[page_id]["text"] == expected and rows[page_id]["n_chars"] == len(expected)


NOTE = "this site uses cookies to keep you signed in for a while"
SHARED = "a passage that several articles share and that is text of each of them"


def host_pages():
    rows = []
    for i in range(40):
        own = " ".join(f"word{i}x{k}" for k in range(12))
        rows.append((i, f"http://Host.example/{i}", f"<p>{NOTE}</p><p>{own}</p>", "h", "t"))
        rows.append((100 + i, f"http://host.example:80/{i}", f"<p>{NOTE}</p><article><p>{own.replace('w', 'v')}</p><p>{SHARED}</p></article>", "", ""))
    return rows


@pytest.mark.parametrize("per_group", [256, 9])
def test_runs_decide_outside_articles_only(spark, scratch, per_group):
    rows = host_pages() + [(500, "http://other.example/", f"<p>{NOTE}</p>", "", "")]
    frame = spark.createDataFrame(rows, PAGES).repartition(5)
    found = {r["page_id"]: r["text"] for r in main_text.extract(frame, pages_per_group=per_group).collect()}
    for i in range(40):
        own = " ".join(f"word{i}x{k}" for k in range(12))
        assert found[i] == own
        assert found[100 + i] == f"{own.replace('w', 'v')}\n{SHARED}"
    assert found[500] == NOTE  # no other page of its host has it


def test_awkward_pages(spark, scratch):
    long = "<article>" + "<p>again and again the same words in one page</p>" * 3000 + "</article>"
    copy = "<p>copies of one page do not empty each other at all, not even here</p>"
    rows = [(1, None, None, None, None), (2, "no url", "", "", ""), (3, "http://a/", long, "", ""), (4, "http://a/", copy, "", ""),
            (4, "http://a/", copy, "", ""), (None, "http://a/", copy, "", "")]
    frame = spark.createDataFrame(rows, PAGES)
    found = [(r["page_id"], r["text"]) for r in main_text.extract(frame).collect()]
    assert sorted(found, key=lambda r: (r[0] or 0, r[1])) == sorted(
        [(1, ""), (2, ""), (3, "\n".join(["again and again the same words in one page"] * 3000)),
         *[(i, re.sub("<.?p>", "", copy)) for i in (4, 4, None)]], key=lambda r: (r[0] or 0, r[1]))
    assert main_text.extract(frame.limit(0)).collect() == []
    assert {z for z, _ in blocks("<nav>x</nav>")} == {CHROME}


@pytest.mark.parametrize("page", [
    "<div class='content-sidebar-wrap'><main><p>yes</p></main><div class='sidebar'>no</div></div>",
    "<div class='has-sidebar'><article><p>yes</p></article></div>",
    "<div id='page' class='comments-open'><article><p>yes</p></article></div>",
    "<form id='aspnetForm'><div><article><p>yes</p></article></div></form>",
    "<div class='menu'><main class='sidebar left'><p>yes</p></main></div>",
    "<div data-hidden='false' title='hidden gems'><article><p>yes</p></article></div>",
    "<main><div class='content-sidebar-wrap'><article><p>yes</p></article><nav>no</nav></div></main>",
    "<article data-class='comments'><p title='class=ad role=menu'>yes</p></article>",
    "<main><p style='x-display:none-such'>yes</p></main>",
])
def test_containers_of_a_loose_name_do_not_lose_the_article(page):
    assert lines(f"<body>{page}</body>") == ["yes"]


@pytest.mark.parametrize("page", [
    "<ol class='comment-list'><li><article>no</article></ol>", "<div id=comments class='comments-area'><main>no</main></div>",
    "<footer><article>no</article></footer>", "<div hidden><article>no</article></div>",
    "<div class=ad><nav><article>no</article></nav></div>", "<article class='comment even'>no</article>",
    "<article class=related>no</article>", "<dialog><article>no</article></dialog>", "<div role=navigation><article>no</article></div>",
])
def test_comments_and_hidden_elements_keep_their_articles(page):
    assert lines(page) == []
    assert lines(f"<article>yes<div class='related-posts'><article>no</article></div>{page}</article>") == ["yes"]


def test_a_form_around_the_page_is_no_chrome():
    page = "<form id=aspnetForm><nav>no</nav><div>text</div><form class=search>no</form></form><form><div>no</div></form>"
    assert lines(page, PLAIN) == ["text"]


@pytest.mark.parametrize("per_group", [256, 1])
def test_runs_across_the_border_of_an_article_count_in_any_group(spark, scratch, per_group):
    end, tail = "this is how every article of ours ends", "share it with friends"
    start, head = "all of our articles begin like this one", "from the desk"
    rows = [(i, f"http://h/{i}", f"<p>{head}</p><article>{start} w{i} {end}</article><div>{tail}</div>", "", "")
            for i in range(6)]
    frame = spark.createDataFrame(rows, PAGES)
    found = {r["page_id"]: r["text"] for r in main_text.extract(frame, pages_per_group=per_group).collect()}
    assert found == {i: f"{start} w{i} {end}" for i in range(6)}


MENU = "<div class='menu'><p>home news sport weather travel help shop login {}</p></div>"


def site(spark, count=6):
    rows = [(i, f"http://site/{i}", MENU.format(f"unique{i}") + f"<article><p>article number {i} says so</p></article>")
            for i in range(count)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_a_container_goes_as_a_whole_with_its_unique_rest(spark):
    for by_markup in (True, False):
        rows = main_text.extract(site(spark), by_markup=by_markup).collect()
        assert {r["text"] for r in rows} == {f"article number {i} says so" for i in range(6)}
        assert {(r["run_words"], r["markup_words"]) for r in rows} == {(9, 0)}
    # without evidence the markup decides, or nothing
    for frame, run in ((site(spark, 1), 8), (site(spark), 16)):
        assert {r["markup_words"] for r in main_text.extract(frame, run=run).collect()} == {9}
        assert all("login unique" in r["text"] for r in main_text.extract(frame, run=run, by_markup=False).collect())
    # a container that runs cover to less than the share is left to its markup
    kept = main_text.extract(site(spark), share=0.95, by_markup=False).collect()
    assert {r["text"].split("\n")[0] for r in kept} == {f"unique{i}" for i in range(6)}


def test_the_length_of_runs_changes_texts_of_the_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    texts = [
        {r["page_id"]: r["text"] for r in main_text.extract(pages, run=run, by_markup=False).collect()}
        for run in (4, 8, 32)
    ]
    assert texts[0] != texts[1] != texts[2]


def test_groups_are_bounded_by_bytes_too(spark, monkeypatch):
    expected = sorted(tuple(r) for r in main_text.extract(site(spark, 12), by_markup=False).collect())
    monkeypatch.setattr(main_text, "GROUP_BYTES", 600)
    found = sorted(tuple(r) for r in main_text.extract(site(spark, 12), by_markup=False).collect())
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert sum(a == b for a, b in zip(found, expected)) >= 6  # a page alone in its group has no run


@pytest.mark.parametrize("tag", ["svg", "math", "object", "iframe", "noscript", "select", "template"])
def test_unclosed_embedded_elements_lose_no_text(tag):
    page = f"<article><p>before</p><{tag} data=x><p>after</p></article>"
    assert [w for _, words in blocks(page) for w in words] == ["before", "after"]
    closed = f"<article><p>before</p><{tag}>hidden</{tag.upper()} ><p>after</p></article>"
    assert [w for _, words in blocks(closed) for w in words] == ["before", "after"]


@pytest.mark.parametrize("tag", ["script", "style", "textarea", "title"])
def test_unclosed_raw_elements_run_to_the_end(tag):
    assert [w for _, words in blocks(f"<p>before</p><{tag}><p>after</p>") for w in words] == ["before"]


@pytest.mark.parametrize("page", [
    '<a "' * 262_144, '<a "' * 262_144 + ">", "<a '\"" * 200_000 + ">", "<div>" * 200_000 + "x" + "</div>" * 10_000,
    "<svg>" * 200_000 + "x", "</p>" * 250_000, "<form><main>" * 80_000 + "x", "<" * 1_000_000, "<!--" * 250_000,
    "<p>" * 300_000 + "x", "<script " * 120_000, "<li><ul>" * 120_000 + "x",
])
def test_hostile_pages_take_linear_time(page):
    begin = time.process_time()
    for _ in blocks(page):
        pass
    assert time.process_time() - begin < 5

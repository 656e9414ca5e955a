"""Pages that wrap the article in odd parts, and pages of any depth."""

import resource
import time

import pytest

from changefeed.llm import htmltext

ODD = ["with-sidebar", "site-content has-sidebar", "post comments-open", "social-media-story", "page-header", "widget-area"]


@pytest.mark.parametrize("name", ODD)
def test_an_article_in_an_oddly_named_wrapper_is_found(name):
    body = ("<nav>menu</nav><a href=#c>Skip</a><div class='{}'><div class=sidebar><p>side</p></div><article><h1>Head</h1>"
            "<p>Long enough text</p><div class=share>share me</div></article><div class='comments'><article>"
            "<p>a reader comment that is longer than all of the text</p></article></div></div><footer>foot</footer>")
    assert htmltext.article(f"<body>{body.format(name)}</body>") == "Head\nLong enough text"
    assert htmltext.article(f"<body><article class='{name}'><h1>H</h1><p>Text</p></article></body>") == "H\nText"


def test_forms_round_the_page():
    assert htmltext.article("<body><form id=aspnet><nav>n</nav><article><p>A</p><form>ask</form></article></form></body>") == "A"
    assert htmltext.article("<body><form><div><h1>H</h1><p>Text</p></div><aside>x</aside></form></body>") == "H\nText"
    assert htmltext.article("<body><p>Text</p><form>Your name <input></form></body>") == "Text"


def test_comments_are_never_taken_for_the_article():
    page = "<body><div><p>Text</p></div><div class='{}'><article><p>a much longer reader comment</p></article></div></body>"
    for name in ("comments", "comment-list", "respond", "related-posts", "x replies"):
        assert htmltext.article(page.format(name)) == "Text"
    assert htmltext.article("<body><div class=comments><article><p>only a comment</p></article></div></body>") == ""
    assert htmltext.article("<body><div class=sidebar><article>teaser</article></div><article><p>T</p></article></body>") == "T"


@pytest.mark.parametrize("page", [
    "<div>t" * 100_000, "<b>" * 100_000 + "</i>" * 100_000 + "t", "<div>t" * 50_000 + "</section>" * 100_000,
    "<div class=sidebar><article>" * 50_000 + "t", "<ul><li>a" * 50_000 + "</p>" * 50_000, "<span><p>x" * 50_000,
    "<table><tr><td>c" * 40_000, "<" * 200_000, "&amp;" * 100_000, "<a b='" * 50_000])
def test_cost_grows_with_the_length_whatever_the_depth(page):
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    began = time.perf_counter()
    htmltext.article(page)
    htmltext.page_tokens(page)
    assert time.perf_counter() - began < 15
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000  # KB


def test_the_template_drops_what_a_host_repeats(spark):
    page = ("<body><div class=x><p>Read our terms {n}</p></div><section><p>Text {i} of the page, long enough</p>"
            "<p>By A. Writer</p></section><div><p>All rights reserved</p></div></body>")
    rows = [(i, "http://a.com/", page.replace("{n}", "").replace("{i}", str(i))) for i in range(20)]
    rows += [(100 + i, f"http://b{i}.com/", page.replace("{n}", "").replace("{i}", str(i))) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    on = {r["page_id"]: r["text"] for r in htmltext.extract(df).collect()}
    off = {r["page_id"]: r["text"] for r in htmltext.extract(df, min_pages=1000).collect()}
    for i in range(20):
        assert on[i] == f"Text {i} of the page, long enough\nBy A. Writer"
        assert off[i] == f"Read our terms\nText {i} of the page, long enough\nBy A. Writer\nAll rights reserved"
    assert all(on[100 + i] == off[100 + i] for i in range(5))


def _rows(host, page, n, first=0):
    return [(first + i, f"http://{host}/{i}", page(i)) for i in range(n)]


def test_the_article_is_the_slots_of_a_template_element(spark):
    long = " ".join(f"w{i}" for i in range(120))
    teaser = "<section><article><p>Also read number {0} here</p></article></section>"
    page = lambda i: (f"<body>{teaser.format(i)}<div><div><h1>Head {i}</h1><p>By A. Writer</p></div><ul><li>{long} {i}</li>"  # noqa: E731
                      f"{'<li>more</li>' * (i % 3)}</ul></div><p>Seen {i} times</p></body>")
    df = spark.createDataFrame(_rows("a.com", page, 20) + _rows("few.com", page, 5, 100), "page_id long, url string, html string")
    on = {r["page_id"]: r["text"] for r in htmltext.extract(df).collect()}
    off = {r["page_id"]: r["text"] for r in htmltext.extract(df, min_pages=1000).collect()}
    for i in range(20):
        assert on[i] == f"Head {i}\nBy A. Writer\n{long} {i}" + "\nmore" * (i % 3)
        assert off[i] == f"Also read number {i} here"
    assert all(on[100 + i] == off[100 + i] for i in range(5))


def test_article_elements_widen_and_narrow_the_slots(spark):
    long = " ".join(f"w{i}" for i in range(60))
    inner = lambda i: f"<body><article><p>Note {i}</p><div><p>{long} {i}</p></div></article></body>"
    outer = lambda i: f"<body><div><p>Note {i}</p><article><p>{long} {i}</p></article><article>b</article></div></body>"
    other = lambda i: outer(i) if i else "<body><blockquote>Another form</blockquote></body>"
    rows = _rows("a.com", inner, 20) + _rows("b.com", outer, 20, 100) + _rows("c.com", other, 20, 200)
    got = {r["page_id"]: r["text"] for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):
        assert got[i] == f"Note {i}\n{long} {i}"
        assert got[100 + i] == f"{long} {i}\nb"
        assert got[200 + i] == (f"{long} {i}\nb" if i else "Another form")


def _plain_template(pages, min_share=htmltext.MIN_SHARE):
    """The valid classes of one host by dictionaries: members -> (parent's members, slot)."""
    seqs = [htmltext.page_tokens(p)[0] for p in pages]
    vectors = {}
    for t in {t for s in seqs for t in s}:
        v = tuple(s.count(t) for s in seqs)
        if sum(map(bool, v)) >= max(min_share * len(pages), htmltext.MIN_PAGES):
            first = [s.index(t) for s in seqs if t in s]
            vectors.setdefault(v, []).append((sum(first) / len(first), t))
    groups = [(sum(map(bool, v)), tuple(t for _, t in sorted(m))) for v, m in vectors.items()
              if len(m) > 1 and any(t & 3 != htmltext._TEXT for _, t in m)]
    out = {}
    for n, m in groups:
        good, places = 0, []
        for s in seqs:
            mine = [i for i, t in enumerate(s) if t in m]
            if not mine:
                continue
            around, ok = [], [s[i] for i in mine] == list(m) * (len(mine) // len(m))
            for k, o in groups:
                theirs = [i for i, t in enumerate(s) if t in o]
                if o == m or not theirs:
                    continue
                inside = {sum(j < i for j in theirs) for i in mine}
                if len(inside) == 1:
                    slot = inside.pop()
                    if 0 < slot < len(theirs):
                        around.append((theirs[0], o, slot))
                elif len({sum(j < i for j in mine) for i in theirs}) > 1 and k >= n:
                    ok = False
            good += ok
            places.append(max(around)[1:] if ok and around else (None, 0))
        if good >= min_share * n:
            out[m] = max(set(places), key=places.count)
    return out


def test_templates_equal_plain_python(spark):
    from pyspark.sql import functions as F

    page = lambda i: (f"<html><body><nav><ul>{'<li><a>menu</a></li>' * 4}</ul></nav><div><h1>Title {i}</h1>"
                      + ("<aside><b>ad</b><i>sponsor</i></aside>" if i % 10 else "")
                      + f"<p>text {i} " + "<em>x</em><p>y" * (i % 4) + "</div><footer><p>(c)</p><hr></footer></body></html>")
    # Two tokens of equal vectors whose order changes are no valid class.
    swapped = lambda i: "".join(["<dl><dt>a</dt></dl>", "<ol><li>b</li></ol>"][::1 if i % 2 else -1]) + f"<p>{i}"
    for make in (page, swapped):
        pages = [make(i) for i in range(30)]
        df = spark.createDataFrame([("h", p, str(n)) for n, p in enumerate(pages)], "host string, html string, mark string")
        rows = htmltext.templates(df).collect()
        members = {r["class_id"]: tuple(r["members"]) for r in rows} | {0: None}
        assert {tuple(r["members"]): (members[r["parent"]], r["slot"]) for r in rows} == _plain_template(pages)
        codes = htmltext.page_tokens(pages[0])[0]
        names = dict(zip([t for t in codes if t & 3 != htmltext._TEXT], htmltext.Page(pages[0]).names))
        if make is page:
            assert len(rows) == 3 and {names[r["main"]] for r in rows} == {"div"}
        else:
            assert not rows
    empty = htmltext.templates(df.where(F.lit(False)))
    assert empty.count() == 0

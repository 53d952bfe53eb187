"""Main text of pages: parsing, the labels on pages of the tables, on other templates, gradients, and edge cases."""

import html as references
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import main_text as M

SF = "/root/testdata/sf0.01"
P1 = "In innt the ation on ther her ereal words of some kind here, long enough to be a paragraph of prose."
P2 = "Another paragraph follows, with more of it and a full stop at the end of it all."
P3 = "Third one closes the text; short."
WANT = ["Some heading here", P1, P2, "first point", "second point", P3]
MENU = "<ul class=main-menu><li><a href=a>Home</a></li><li><a href=b>News</a></li><li><a href=c>About</a></li></ul>"


def page(before, start, end, after, amid=""):
    body = f"<h1>Some heading here</h1><p>{P1}</p>{amid}<p>{P2}</p><ul><li>first point</li><li>second point</li></ul><p>{P3}</p>"
    return f"<html><body>{before}{start}{body}{end}{after}</body></html>"


OTHER = {
    "article": page("<nav><a href=a>Home</a></nav>", "<article>", "</article>", "<footer>c 2020</footer>"),
    "main": page("<header><h2>My Site</h2><nav><ul><li><a href=x>Home</a></ul></nav></header>", "<main><article>", "</article></main>", "<aside><h3>Related</h3><ul><li><a href=q>Other story</a></li></ul></aside><footer><p>Copyright.</p></footer>"),
    "comments after": page(MENU, "<main><article>", f"</article><section class='comments'><h3>Comments</h3><p>{P1}</p><p>{P2}</p></section></main>", "<footer>x</footer>"),
    "comments inside": page(MENU, "<article class='post'><div class='entry-content'>", f"</div><div id='comments'><ol class='comment-list'><li><p>{P1}</p></li></ol></div></article>", "<footer>x</footer>"),
    "other names": page(MENU, "<div class='td-post-content'>", "</div>", f"<div class='comments-area'><p>{P1}</p><p>{P2}</p></div><div class='site-footer'><p>c</p></div>"),
    "notice": page(f"<div id='cookie-law-info-bar'><p>{P2}</p></div>{MENU}", "<div id='content'>", "</div>", f"<div class='widget-area'><h4>Popular</h4><p>{P3}</p></div>"),
    "advert amid": page(MENU, "<article>", "</article>", "<footer>c</footer>", f"<aside class='advertisement'><p>Buy this now, {P3}</p></aside>"),
    "form": page("<form action=s><label>Search</label><input></form>", "<article>", "</article>", "<form class='newsletter'><p>Subscribe to our newsletter for more.</p><button>Go</button></form>"),
    "dialog": page("<dialog open><p>We value your privacy.</p></dialog>", "<div role='main'>", "</div>", f"<div class='sponsored'><p>{P1}</p></div>"),
}


def article(page_):
    """The text of the one article of a generated page, by cutting its source at its block tags."""
    source = page_[page_.index("<article>") + 9 : page_.index("</article>")]
    parts = (" ".join(references.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", source))
    return "\n\n".join(x for x in parts if x)


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def model(pages):
    return M.fit(pages[::2])


def text_of(model, source):
    found = M.blocks(source)
    return [t for (_, t, _), yes in zip(found, M.label(model, [found], {})[0]) if yes]


def test_pages_not_learned_from(model, pages):
    for source in pages[1::2]:
        assert "\n\n".join(text_of(model, source)) == article(source)


@pytest.mark.parametrize("name", OTHER)
def test_other_templates(model, name):
    assert text_of(model, OTHER[name]) == WANT


def test_context_decides(model):
    """The same block with the same path is labelled by what stands around it in the page."""
    found = M.blocks(OTHER["article"])
    one = M.Labeller(3)
    far = [list(found), [*found[:-1], (found[-1][0], "entirely other words", 1.0)]]
    first, second = (one.scores(M.Inputs([f]))[0] for f in far)
    assert first != second


def test_blocks_of_bad_markup():
    texts = lambda source: [t for _, t, _ in M.blocks(source)]
    assert texts("<p>a<p>b<b>c</p>d</b> e") == ["a", "bc", "d e"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><th>c</table>d") == ["a", "b", "c", "d"]
    assert texts('a<script>var t="</p>x";</script>b<style>p{}</style><!-- c <p> -->d') == ["abd"]
    assert texts("x &amp;&lt;p&gt; &eacute;&#233;&#x1F600; a&nbsp;&nbsp;b\t\n c<br>d") == ["x &<p> éé\U0001f600 a b c d"]
    assert texts("1 < 2 <a title='a>b'>c</a> <unclosed") == ["1 < 2 c <unclosed"]
    assert texts("<script>never ended <p>x") == [] and texts("<!-- never ended <p>x") == [] and texts("") == []
    assert texts("<title>t</title><select><option>o</select><noscript>n</noscript><textarea><p>q</textarea>y") == ["y"]
    assert [x for _, _, x in M.blocks("<p><a href=x>abcd</a>efgh</p><p>z</p>")] == [0.5, 0.0]
    deep = "<div>" * 3000 + "x" + "</div>" * 3000 + "<p>y"
    assert texts(deep) == ["x", "y"] and all(len(path) <= 2 * M.PATH_ENDS for path, _, _ in M.blocks(deep))


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    some = [M.blocks(OTHER["article"])[:5], M.blocks(OTHER["notice"])[:3]]
    model, x = M.Labeller(2), M.Inputs(some)
    model.p = {k: v.astype(np.float64) + (rng.standard_normal(v.shape) * 0.3 if k[0] in "xhgo" else 0) for k, v in model.p.items()}
    labels, weight = np.array([1, 0, 1, 1, 0, 1, 0, 1], float), np.array([1, 1, 0, 1, 1, 1, 1, 1], float)
    kept = {}
    model._adam = lambda grads, rate: kept.update(grads)
    loss = lambda: model.learn(x, labels, weight, 0.0)
    loss()
    grads = dict(kept)
    for name, where in [("xf", (3, 7)), ("xb", (30, 60)), ("hf", (2, 30)), ("hb", (5, 3)), ("gf", (40,)), ("gb", (1,)), ("out", (10,)), ("out", (60,)), ("bias", (0,)), ("path", (int(x.path_ids[0]), 3)), ("word", (int(x.word_ids[0]), 2))]:
        start, by = model.p[name][where], 1e-3
        model.p[name][where] = start + by
        up = loss()
        model.p[name][where] = start - by
        down = loss()
        model.p[name][where] = start
        assert abs((up - down) / (2 * by) - grads[name][where]) < 2e-4, name


def test_tables_with_odd_rows(spark, model):
    schema = "page_id long, url string, html string, main_text string, path string"
    long = page("<nav><a href=a>Home</a></nav>", "<article>" + f"<p>{P1}</p>" * 5000, "</article>", "<footer>c</footer>")
    rows = [(1, "u", None, "own", "own"), (2, None, "", None, None), (None, "u", OTHER["article"], "x", "y"), (3, "u", long, "", ""), (4, "u", " <p> ", "", ""), (5, "u", OTHER["main"], "", ""), (5, "u", OTHER["main"], "", "")]
    got = M.main_text(spark.createDataFrame(rows, schema), model=model)
    assert got.columns == ["page_id", "url", "path", "main_text"]
    found = sorted(((r.page_id, r.url, r.path, r.main_text) for r in got.collect()), key=str)
    text = "\n\n".join(WANT)
    want = [(1, "u", "own", ""), (2, None, None, ""), (None, "u", "y", text), (3, "u", "", "\n\n".join([P1] * 5000) + "\n\n" + text), (4, "u", "", ""), (5, "u", "", text), (5, "u", "", text)]
    assert found == sorted(want, key=str)
    empty = spark.createDataFrame([], "page_id long, html string")
    assert M.main_text(empty).collect() == [] and M.sample(empty) == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "page_id long, html string")
    assert [r.main_text for r in M.main_text(nothing).collect()] == ["", ""]


def test_query_over_the_whole_table(spark, pages):
    from panelforge.llm.queries import QUERIES

    got = QUERIES["op13_main_text"](spark, SF)
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    rows = got.orderBy("page_id").collect()
    assert [r.text for r in rows] == [article(p) for p in pages] and all(r.n_chars == len(r.text) for r in rows)
    assert got.where(F.col("n_chars") == 0).count() == 0

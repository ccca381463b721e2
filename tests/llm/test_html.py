import numpy as np
import pytest
from pyspark.sql import functions as F

from granero.llm import site_templates as site


def text_of(html):
    return "\n".join(block for block, _ in site.parse(html)[2])


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &amp; text", "plain & text"),
        ("<p>a<p>b <b>c</b>  d<br>e</p> tail<ul><li>x<li>y</ul>", "a\nb c d e\ntail\nx\ny"),
        ("<nav>menu</nav><article><h1>T</h1><p>in</p><aside>no</aside><form>no</form></article><p>out</p><footer>f", "T\nin"),
        ("<div class='post-comments'><p>no</p></div><div class=ad>no</div><p>yes &eacute;&#8212;</p>", "yes é—"),
        ("<header>site</header><main><header><h1>T</h1></header>body</main>", "T\nbody"),
        ("<script>if(a<b){'</p>'}</script><style>p{}</style>x<!-- c -->", "x"),
        ("<p>un<b>closed<p>next</p></article></div>", "unclosed\nnext"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_parse(html, text):
    assert text_of(html) == text


BODY = "<p>A body that is much longer than all the teasers are.</p><p>It goes on and on for a while.</p>"
BODY_TEXT = "A body that is much longer than all the teasers are.\nIt goes on and on for a while."


@pytest.mark.parametrize(
    "html, text",
    [
        *((f"<div class='{name}'><article>{BODY}</article></div>", BODY_TEXT) for name in (
            "layout has-sidebar", "no-sidebar", "content comments-open", "post has-comments", "wrap sticky-nav")),
        *((f"<div class='{name}'>{BODY}</div>", BODY_TEXT) for name in ("no-sidebar", "post has-comments", "wrap sticky-nav")),
        (f"<form id=aspnetForm><div class=menu>no</div>{BODY}</form>", BODY_TEXT),
        (f"<div>{BODY}</div><article>Teaser</article><article>Other</article>", f"{BODY_TEXT}\nTeaser\nOther"),
        (f"<article>Short but all.</article><div class=comments>{BODY}</div>", "Short but all."),
        (f"<article>{BODY}</article><div class=related><article>Teaser</article></div>", BODY_TEXT),
        (f"<div class=sidebar>no</div><div>{BODY}</div><form>no</form>", BODY_TEXT),
    ],
)
def test_wrappers_keep_what_they_hold(html, text):
    assert text_of(html) == text


def pages(spark, rows):
    return spark.createDataFrame([(*row, "clash") for row in rows], "page_id bigint, url string, html string, text string")


def test_subtrees_that_recur_on_a_host_go(spark):
    body = "<html><head><title>t{0}</title></head><body><div><p>Site line</p></div><div>Own {0}</div><p>Quote</p></body></html>"
    rows = [(i, f"http://a.example/{i}", body.format(i)) for i in range(8)]
    rows += [(100 + i, f"http://b{i}.example/x", body.format(i)) for i in range(8)]
    found = {r.page_id: r.text for r in site.extract(pages(spark, rows)).collect()}
    assert found[3] == "Own 3"
    assert found[103] == "Site line\nOwn 3\nQuote"


def test_copies_of_an_article_stay(spark):
    page = "<title>same</title><div><p>Copied text</p></div>"
    rows = [(i, f"http://a.example/{i}", page) for i in range(50)]
    assert {r.text for r in site.extract(pages(spark, rows)).collect()} == {"Copied text"}


def test_templates_go_from_pages_of_one_title(spark):
    body = "<title>The site</title><div>Site line</div><div><p>Own text {0}, longer than all else on its page.</p></div>"
    found = site.extract(pages(spark, [(i, f"http://a.example/{i}", body.format(i)) for i in range(8)])).collect()
    assert {r.text for r in found} == {f"Own text {i}, longer than all else on its page." for i in range(8)}


def test_copies_in_different_surroundings_stay(spark):
    copy = "<title>t{0}</title><div>Ad {0}</div><div><p>An article that eight pages of the host have.</p></div>"
    other = "<title>t{0}</title><div><p>Some other article of the host, number {0}.</p></div>"
    rows = [(i, f"http://a.example/{i}", (copy if i < 8 else other).format(i)) for i in range(30)]
    found = {r.page_id: r.text for r in site.extract(pages(spark, rows)).collect()}
    assert found[3] == "Ad 3\nAn article that eight pages of the host have."
    assert found[20] == "Some other article of the host, number 20."


def test_section_templates_go(spark):
    menu = "<ul><li>One</li><li>Two</li></ul>"
    own = "<title>t{0}</title><h2>Heading</h2><p>Own text {0}, longer than all else on its page.</p>"
    rows = [(i, f"http://a.example/{i}", (menu if i < 60 else "") + own.format(i)) for i in range(200)]
    found = {r.page_id: r.text for r in site.extract(pages(spark, rows)).collect()}
    assert all(text == f"Own text {i}, longer than all else on its page." for i, text in found.items())


def test_awkward_pages(spark):
    rows = [(1, None, None), (None, "not a url", "<p>x"), (2, "http://h/", ""), (2, "http://h/", ""), (3, "HTTPS://U:P@H:8/", "<p>" + "y " * 200_000)]
    found = site.extract(pages(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == 5
    assert found.where(F.col("n_chars") != F.length("text")).count() == 0
    assert site.extract(pages(spark, [])).collect() == []


def test_query_reads_the_article(spark, sf_dir):
    found = site.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    import html
    import re

    for row in found:
        inside = re.search(r"<article>(.*?)(</article>|$)", raw[row.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", inside))
        assert row.text == "\n".join(part for part in parts if part)


@pytest.mark.parametrize("html, text", [
    ("<p>The <span class='share'>market share</span> rose by <b class='side'>five</b> points</p>", "The market share rose by five points"),
    ("<div>Text <span class='share'>Share this</span></div>", "Text"),
])
def test_words_of_a_sentence_stay(html, text):
    assert text_of(html) == text


def generated_site(rng, host, pages):
    """Pages of one host: menus, notices and footers without telling tags or classes, and own text."""
    menu = "<div><div>" + "".join(f"<div>{host} {i}</div>" for i in range(4)) + "</div></div>"
    notice, foot = f"<div><p>Read at {host} first</p></div>", f"<section><div>{host} office</div><p>Street 1</p></section>"
    out = []
    for i in range(pages):
        own = "".join(f"<p>Own text {host} {i} {j} {rng.random()}</p>" for j in range(int(rng.integers(1, 4))))
        parts = [menu if i % 10 else "", f"<div>{own}</div>", notice if i % 2 == 0 else "", foot]
        out.append((f"https://{host}/{i}", f"<html><body>{''.join(parts)}</body></html>"))
    return out


def brute_templates(pages, policy):
    """Subtrees of each host by plain counting over pages with different own text."""
    parsed = [(url.split("/")[2], site.parse(html)) for url, html in pages]
    out = set()
    for host in {host for host, _ in parsed}:
        own = [page for h, page in parsed if h == host]
        for digest in {element[0] for page in own for element in page[1]}:
            kinds = [element[2] for page in own for element in page[1] if element[0] == digest]
            n = sum(digest in {element[0] for element in page[1]} for page in own)
            needed = n >= policy.flow_share * len(own) or (min(kinds) == site.IN_SECTIONS and n >= policy.section_pages)
            if n >= policy.least_pages and (min(kinds) == site.PLAIN or needed):
                out.add((host, digest))
    return out


def test_templates_equal_plain_counts_and_make_the_result(spark):
    rng = np.random.default_rng(3)
    given = [page for host, n in (("a.example", 60), ("b.example", 12), ("c.example", 3)) for page in generated_site(rng, host, n)]
    table = pages(spark, [(i, url, html) for i, (url, html) in enumerate(given)])
    policy = site.TemplatePolicy()
    found = {(row.host, row.hash) for row in site.templates(site.stage(site.parsed_pages(table)), policy).collect()}
    assert found == brute_templates(given, policy)
    texts = {row.page_id: row.text for row in site.extract(table).collect()}
    for i, (url, html) in enumerate(given):
        own = [block for block, _ in site.parse(html)[2] if block.startswith("Own")]
        if "c.example" in url:
            assert len(texts[i].split("\n")) > len(own)
        else:
            assert texts[i] == "\n".join(own)
    off = site.extract(table, site.TemplatePolicy(least_pages=10**9)).collect()
    assert sum(texts[row.page_id] != row.text for row in off) == 72

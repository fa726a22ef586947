import html
import random
import re

import pytest

from tagloom.llm.webtext import Page, extract, main_text
from tests.llm import nasty

LONG = "A long paragraph of the article, with enough words to be told from menus."
MORE = "Another paragraph that says what the article has to say, in many words."


def article(inner, around="{}"):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{around.format(inner)}</body></html>"


@pytest.mark.parametrize("source, text", [
    (article(f"<article><h1>Head</h1><p>{LONG}</p></article>",
             "<nav><a href=a>Home</a></nav>{}<footer>&copy; x</footer>"), ["Head", LONG]),
    # Unclosed elements, line breaks and character references.
    (article(f"<article><h1>A &amp; B</h1><p><b>x&nbsp;y<br>z<p>{LONG} &lt;&#x41;&gt;</article>"),
     ["A & B", "x y z", f"{LONG} <A>"]),
    # No element names its meaning: the density decides.
    (article(f"<div><h1>Head</h1><div><p>{LONG}</p><p>{MORE}</p></div></div>",
             "<div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div>{}<div>c 2020</div>"),
     ["Head", LONG, MORE]),
    # What is no article by its class, role or name, within and without.
    (article(f"<main><header><h1>Head</h1></header><p>{LONG}</p><form>Name <input></form>"
             f"<div class='ad'>Buy</div><aside>By the way</aside><p>{MORE}</p>"
             f"<section id=comments><p>{LONG * 3}</p></section></main>",
             "<header><h1>Site</h1></header><div role=alert>We use cookies</div>"
             "<div class='side-bar sidebar'>" + LONG * 2 + "</div>{}"), ["Head", LONG, MORE]),
    # Link lists in the article are left out, links in its text are not.
    (article(f"<article><p>{LONG} <a href=x>link</a></p><ul>" + "<li><a href=y>go</a></li>" * 9
             + f"</ul><p>{MORE}</p></article>"), [f"{LONG} link", MORE]),
    (article("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>"),
     ["one", "two", "a", "b"]),
    (article(f"<div class=content><p>{LONG}</p><script>var a = '</p>' + \"<p>x</p>\";</script>"
             f"<style>p > a {{}}</style><!-- <p>no</p> --><p hidden>no</p><p>{MORE}</div>"), [LONG, MORE]),
])
def test_articles(source, text):
    assert main_text(source) == "\n\n".join(text)


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\n\nb"), ("<div>a < b</div>", "a < b"),
    ("<script>x</p>", ""), ("<", "<"), ("<!-- open", ""), ("<p title='>'>x</p>", "x"), ("<p", ""),
    ("</p></div>x", "x"), ("<body><br></body>", ""), ("<p a='x>text</p>", "text")])
def test_odd_pages(source, text):
    assert main_text(source) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 3000 + "x" + "</div>" * 10) == "x"
    text = nasty.words(1, 30_000)
    assert main_text(article(f"<article><p>{text}</p></article>")) == text


def test_density_counts_links_little():
    plain, linked = (Page._density(100, 1, links, tags, 0.2) for links, tags in ((0, 0), (90, 1)))
    assert plain > 5 * linked and Page._density(0, 3, 0, 0, 0.2) == 0


def test_pages_of_the_tables(spark):
    """The given pages hold their text in an `article` of headings and paragraphs."""
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inside = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?(?:h1|p)>", inside)]
        assert main_text(row.html) == "\n\n".join(b for b in blocks if b)


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", article(f"<p>{LONG}</p>"), "text", 5), (2, None, None, "t", 1), (None, "u", "", None, None),
         (1, "u", article(f"<p>{LONG}</p>"), "text", 5)],
        "page_id long, url string, html string, text string, n_chars long")
    rows = sorted(map(tuple, extract(pages).collect()), key=str)
    assert rows == [(1, "u", LONG, len(LONG))] * 2 + [(2, None, "", 0), (None, "u", "", 0)]
    assert extract(pages.where("false")).collect() == []


@pytest.mark.parametrize("wrapper", [
    "<div class='content has-sidebar'>{}</div>", "<form id=aspnetForm>{}</form>", "<aside>{}</aside>",
    "<div id=page class=no-menu><div class=social-layout>{}</div></div>", "<div role=form>{}</div>",
    "<div class=comments-open aria-hidden=true>{}</div>"])
def test_wrappers_with_names_of_menus(wrapper):
    """A name says nothing of an element that holds the page, with an `article` or without."""
    menu = "<div class=menu><a href=1>One</a> <a href=2>Two</a></div>"
    inner = f"<h1>Head</h1><p>{LONG}</p><p>{MORE}</p><div class='ad'>Buy</div>"
    for tag in ("div", "article"):
        page = article(f"{menu}<{tag}>{inner}</{tag}>", wrapper)
        assert main_text(page) == "\n\n".join(["Head", LONG, MORE])
    # An article within stays also where other text outweighs it.
    page = article(f"<article><p>{LONG}</p><p>{MORE}</p></article>", wrapper + f"<div><a href=x>{LONG * 9}</a></div>")
    assert main_text(page) == "\n\n".join([LONG, MORE])


COMMENT = "<div class=comment><p>A reader writes a long comment that goes on and on about the article.</p></div>"


@pytest.mark.parametrize("comments", [
    f"<section class=comments>{COMMENT * 5}</section>", f"<div id=comments><ol><li>{COMMENT * 5}</ol></div>",
    f"<div id=disqus_thread>{COMMENT * 5}</div>", "<ol class='comment-list'>" + "<li><article class='comment-body'>"
    f"<p>{LONG}</p></article>" * 5 + "</ol>", f"<section class=comments><article><p>{LONG * 4}</p></article></section>",
    f"<div class='cookie-notice'><p>{LONG * 4}</p></div>"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_comments_that_outweigh_the_article_are_left_out(tag, comments):
    """After it and within it."""
    inner = f"<h1>Head</h1><p>{LONG}</p><p>{MORE}</p>"
    for body in (f"<{tag}>{inner}</{tag}>{comments}", f"<{tag}>{inner}{comments}</{tag}>",
                 f"<div id=page><{tag}>{inner}</{tag}>{comments}</div>"):
        assert main_text(article(body)) == "\n\n".join(["Head", LONG, MORE])


def test_what_nothing_else_is_beside_is_the_page():
    assert main_text(article(f"<div class=comments><h1>Head</h1><p>{LONG}</p></div>")) == f"Head\n\n{LONG}"
    menu = "<ul><li><a href=1>One</a><li><a href=2>Two</a></ul>"
    assert main_text(article(f"{menu}<div class=notice><article><p>{LONG}</p></article></div>")) == LONG


@pytest.mark.parametrize("name", ["related-work", "share-price", "ad-hoc", "menu-prices", "comment-on-law",
                                  "no-sidebar", "footer-notes"])
def test_a_word_of_a_class_is_not_its_meaning(name):
    page = article(f"<article><h1>Head</h1><p>{LONG}</p><section class={name}><p>{MORE}</p></section></article>")
    assert main_text(page) == "\n\n".join(["Head", LONG, MORE])


def brute_root(page):
    """The node with the largest sum of its children's densities, each counted out of its own subtree."""
    def below(node):
        return [node, *(m for n in range(len(page.tag)) if n and page.parent[n] == node for m in below(n))]

    def linked(node):
        return node != 0 and (page.tag[node] == "a" or linked(page.parent[node]))

    def length(nodes, only_links=False):
        return sum(len(" ".join(html.unescape(t).split())) for n, _, t in page.texts
                   if n in nodes and not page.dropped[n] and (linked(n) or not only_links))

    def density(node):
        nodes = [n for n in below(node) if not page.dropped[n]]
        body = below(page.body)
        return Page._density(length(nodes), len(nodes) - 1, length(nodes, True),
                             sum(page.tag[n] == "a" for n in nodes if n != node),
                             length(body, True) / max(length(body), 1))

    sums = {node: sum(density(n) for n in range(1, len(page.tag)) if page.parent[n] == node and not page.dropped[n])
            for node in range(page.body, len(page.tag))}
    return max(sums, key=lambda n: (round(sums[n], 9), -n))


def test_root_against_brute_force():
    """On small random trees the subtree with the largest sum gives the text."""
    rng = random.Random(6)

    def tree(depth):
        if depth == 0 or rng.random() < 0.2:
            text = nasty.words(rng.randrange(99), rng.randint(1, 25))
            return f"<a href=x>{text}</a>" if rng.random() < 0.3 else f"<p>{text}</p>"
        return "<div>" + "".join(tree(depth - 1) for _ in range(rng.randint(1, 4))) + "</div>"

    for _ in range(60):
        page = Page(f"<body>{''.join(tree(3) for _ in range(3))}</body>")
        assert page.best_node()[0] == brute_root(page)


def test_formulas_are_text():
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>"
    assert main_text(article(f"<article><p>{LONG} {formula}</p></article>")) == f"{LONG} x=1"

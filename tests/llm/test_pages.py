from __future__ import annotations

import random

import pytest

from newsloom.llm import pages
from newsloom.llm.pages import MAIN, NOISE, OTHER, blocks, shared_lines


def length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("seed", range(5))
def test_shared_lines_are_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    for _ in range(300):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 9))] for _ in range(2))
        found = shared_lines(a, b)
        rest = iter(b)
        assert found == sorted(set(found)) and len(found) == length(a, b) and all(a[i] in rest for i in found)


@pytest.mark.parametrize("seed", range(3))
def test_halved_pages_give_a_longest_common_subsequence(monkeypatch, seed):
    monkeypatch.setattr(pages, "STATE_BITS", 12)
    monkeypatch.setattr(pages, "MASK_BITS", 40)
    rng = random.Random(seed)
    for kinds, most in ((3, 60), (40, 60), (1, 30)):
        for _ in range(40):
            a, b = ([rng.randrange(kinds) for _ in range(rng.randint(0, most))] for _ in range(2))
            found = shared_lines(a, b)
            rest = iter(b)
            assert found == sorted(set(found)) and len(found) == length(a, b) and all(a[i] in rest for i in found)


def test_long_pages_take_memory_in_line_with_their_lines():
    import tracemalloc

    n = 100_000
    own = list(range(n))
    other = own[::-1][: n // 2] + own[n // 4 :]
    tracemalloc.start()
    assert len(shared_lines(own, list(range(n, 2 * n)))) == 0
    assert shared_lines(own, other) == own[n // 4 :]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20


@pytest.mark.parametrize("quote", ["'", '"'])
@pytest.mark.parametrize("size", [4_000, 6_000, 1_000_000])
def test_long_attribute_values_are_no_text(quote, size):
    assert blocks(f"<article><p data-x={quote}{'a' * size}>LEAK{quote}>text</p></article>") == [(MAIN, "text")]


def test_unclosed_quotes_take_linear_time():
    import time

    start = time.perf_counter()
    assert blocks("<article>text</article>" + "<p a='x\" b='" * 100_000)[0] == (MAIN, "text")
    assert blocks("<article>text</article>" + "<p a=\"x" + "<p class=' y>" * 100_001)[0] == (MAIN, "text")
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("value", ["the hidden truth", "class=ad", "role=navigation", "style=display:none id=comments"])
def test_words_in_other_attributes_say_nothing(value):
    assert blocks(f'<article><p title="{value}">a</p></article><div data-x="role=main">b</div>') == [(MAIN, "a"), (OTHER, "b")]


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        ("", []),
        ("plain &amp; text", [(OTHER, "plain & text")]),
        ("<p>a<p>b <b>c</b>d\n e<br>f", [(OTHER, "a"), (OTHER, "b cd e f")]),
        ("<script>var t='</p>'</script><p>x</p><style>p{}</style><!-- <p>no</p> --><p>y", [(OTHER, "x"), (OTHER, "y")]),
        ("<article><header><h1>T</h1></header><p>a</p><footer>no</footer><div class='share-box'>no</div>t</article>u",
         [(MAIN, "T"), (MAIN, "a"), (NOISE, "no"), (NOISE, "no"), (MAIN, "t"), (OTHER, "u")]),
        ("<div id=commentList><p>c</p></div><p>x", [(NOISE, "c"), (OTHER, "x")]),
        ("<p title='a>b' class=\"lead\">x &lt;b&gt; &#233;&nbsp;&eacute;</p>", [(OTHER, "x <b> é é")]),
        ("<div role=navigation>n</div><div hidden>h</div><div style='display: none'>s</div>1 < 2", [(NOISE, "n"), (NOISE, "h"), (NOISE, "s"), (OTHER, "1 < 2")]),
        ("<main><p>a</main></div></p>b<", [(MAIN, "a"), (OTHER, "b<")]),
        ("<div role='main'><p>a</p><article class='comment reply'>c</article>b</div>d", [(MAIN, "a"), (NOISE, "c"), (MAIN, "b"), (OTHER, "d")]),
        ("<article class='post share'><h2>t</h2></article>", [(MAIN, "t")]),
        ("<form><input><p>f</p></form><p>x<textarea><p>t</textarea>y", [(NOISE, "f"), (OTHER, "xy")]),
    ],
)
def test_blocks(html, wanted):
    assert blocks(html) == wanted


def page(title, body, marked):
    inner = "".join(f"<p>{x}</p>" for x in body)
    return (
        f"<html><head><title>{title}</title></head><body><nav><a>Home</a></nav><p>Welcome to our site</p>"
        + (f"<article><h1>{title}</h1>{inner}</article>" if marked else f"<h1>{title}</h1>{inner}")
        + "<p>All rights reserved</p></body></html>"
    )


@pytest.mark.parametrize("range_rows", [pages.RANGE_ROWS, 3])
def test_pages(spark, monkeypatch, range_rows):
    monkeypatch.setattr(pages, "RANGE_ROWS", range_rows)
    rows, wanted = [], {}
    for i in range(20):
        marked = i % 2 == 0
        body = [f"paragraph {i} one", "A passage that all articles share"] if marked else [f"paragraph {i} one", f"and {i} two"]
        host = "big.example" if i < 14 else f"h{i}.example"
        rows.append((i, f"https://{host}/{'a' if marked else 'b'}/{i:03}?x=1", page(f"Title {i}", body, marked), "extra"))
        lines = [f"Title {i}", *body]
        alone = not marked and i >= 14
        wanted[i] = "\n".join(["Welcome to our site", *lines, "All rights reserved"] if alone else lines)
    rows += [(50, None, None, "x"), (51, "not a url", "<p>text</p>", "x"), (None, "https://n.example/", "", None)]
    wanted |= {50: "", 51: "text", None: ""}
    rows.append(rows[0])
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = pages.extract(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == wanted[r["page_id"]], r["page_id"]
        assert r["n_chars"] == len(r["text"])
    assert pages.extract(frame.where("false")).count() == 0


def test_given_pages_hold_their_articles(spark):
    import html as entities
    import re

    folder = "/root/testdata/sf0.001"
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in pages.html_extraction(spark, folder).collect():
        article = re.search(r"<article>(.*)</article>", source[r["page_id"]], re.S)[1]
        lines = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(x for x in lines if x)


@pytest.mark.parametrize("wrapper", [
    'div class="layout with-sidebar"', 'div id="page-header-fixed"', 'div class="modal"', 'form id="aspnetForm"', 'header',
])
@pytest.mark.parametrize("main", ["article", "main", 'div role="main" class="has-sidebar"'])
def test_articles_in_wrappers_named_like_noise(wrapper, main):
    end = lambda tag: f"</{tag.split()[0]}>"
    html = f"<{wrapper}><p>menu</p><{main}><p>Text.</p><div class=share>x</div></{main.split()[0]}><p>foot</p>{end(wrapper)}"
    assert blocks(html) == [(NOISE, "menu"), (MAIN, "Text."), (NOISE, "x"), (NOISE, "foot")]


@pytest.mark.parametrize("wrapper", ["aside", "nav", 'div class="related"', "div hidden", 'div style="display: none"', 'div id="comments"'])
def test_articles_in_sealed_wrappers_stay_noise(wrapper):
    inner = "<div class=sidebar><article>Other</article></div>"
    assert blocks(f"<article>Text <{wrapper}>{inner}</{wrapper.split()[0]}></article>") == [(MAIN, "Text"), (NOISE, "Other")]

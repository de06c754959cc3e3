"""Page extraction and BPE."""

import html
import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from conftest import SF01
from tidecast.llm import bpe, html_wrappers
from tidecast.llm.html_wrappers import Page, align, extract_pages, fold, regular_expression

PATH = public_tokenizers.path("byte_bpe_50k.json")


# ---- pages ----------------------------------------------------------------------------

def texts(spark, pages, **columns):
    rows = [(i, url, source) for i, (url, source) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    return [r.text for r in extract_pages(df).orderBy("page_id").collect()]


def test_marked_boilerplate_leaves_its_equal_looking_siblings(spark):
    def page(i, body):
        return (i, "http://a.example/x", f"<html><body class='has-sidebar no-comments'>{body}</body></html>")

    rows = [page(i, f"<article class='post related-off'><p>A{i}</p><p>B{i}</p><div>D{i}</div></article>") for i in range(20)]
    marked = ["<p hidden>C</p>", "<p id='ad-1'>C</p>", "<p role='navigation'>C</p>", "<p aria-hidden='true'>C</p>", "<p style='display: none'>C</p>"]
    rows += [page(20 + k, f"<article><p>A</p><p>B</p>{mark}<p>E</p><div id='ad-1'>C</div><div>D</div></article>") for k, mark in enumerate(marked)]
    rows += [(25, "http://b.example/x", "<article><p>A</p><p>B</p><p hidden>C</p></article>")]
    got = {r.page_id: r.text for r in html_wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"A{i}\n\nB{i}\n\nD{i}" for i in range(20)} | {20 + k: "A\n\nB\n\nE\n\nD" for k in range(5)} | {25: "A\n\nB"}


def test_articles_of_the_table_equal_brute_force(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", body[1])) if body else []
        want = [" ".join(html.unescape(p).split()) for p in parts]
        assert got[r.page_id] == "\n\n".join(p for p in want if p)


def test_copies_of_a_page_are_one_page(spark):
    """Repeated rows change no text; a text that differs from its copy elsewhere still tells."""
    page = "<div><h1>Title</h1><p>One body paragraph</p></div>"
    assert texts(spark, [("http://h/1", page)]) == texts(spark, [("http://h/1", page)] * 3)[:1] == ["Title\n\nOne body paragraph"]
    two = [("http://k/1", "<div><b>Site</b><p>A</p></div>"), ("http://k/2", "<div><b>Site</b><p>B</p></div>")]
    assert texts(spark, two + two)[:2] == texts(spark, two)


def test_formulas_stay_and_unclosed_elements_end_nothing(spark):
    pages = ["<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p></article>",
             "<article><p>Before</p><button>Go<p>After</p></article>", "<article><p>Before</p><svg><path d=''><p>After</p></article>",
             "<article><p>Before <button>Go</button> on</p><svg><title>t</title></svg><p>After</p></article>", "<article><p>Before</p><script>x</article>"]
    got = texts(spark, [(f"http://m{i}/1", p) for i, p in enumerate(pages)])
    assert got[0] == "Let x=1 be" and got[1].startswith("Before") and got[1].endswith("After") and got[2].endswith("After")
    assert got[3] == "Before on\n\nAfter" and got[4] == "Before"


def test_columns_named_like_the_operators_own(spark):
    rows = [(1, "http://h/1", "<article><p>A</p></article>", "h", 2, "k")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, _host string, _sig int, kept string")
    out = extract_pages(df)
    assert out.columns == ["page_id", "url", "_host", "_sig", "kept", "text"]
    assert [tuple(r) for r in out.collect()] == [(1, "http://h/1", "h", 2, "k", "A")]


LONG = "<p>One &amp; <b>two</b><br>three &lt;4&gt;</p>"


def test_boilerplate_is_left_out(spark):
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body hidden-x><header><h1>Site</h1></header>
      <div class="cookie-notice">We use</div><nav><a href=x>Home</a></nav><main><article><header><h1>Head</h1><p>by X</p></header>{LONG}
      <ul><li>a<li>b</ul><div class="share">Share</div><p>Four <span class="ad">Buy</span><p>five<script>var p="</p>"</script>
      <form>f</form><section class="comments"><article><p>nice</p></article></section></article>
      <aside>Rel</aside></main><!-- <p>c</p> --><div id=newsletter>Join</div><footer>&copy; x</footer>"""
    assert texts(spark, [("http://h/1", page)]) == ["Head\n\nOne & two three <4>\n\na\n\nb\n\nFour\n\nfive"]


def test_wrapper_finds_the_text_where_no_element_names_it(spark):
    def page(k):
        menu = "".join(f"<li><a href=/{i}>Part {i}</a></li>" for i in range(k % 3 + 2))
        return f"<body><table><tr><td><ul>{menu}</ul></td><td><h2>Title {k}</h2><p>Text number {k}.</p><p>More of {k}</p></td></tr></table><p>All rights reserved</p></body>"

    got = texts(spark, [(f"https://x.org/{k}", page(k)) for k in range(8)])
    assert got == [f"Title {k}\n\nText number {k}.\n\nMore of {k}" for k in range(8)]


def stats(n):
    return [[1, i, i, 5, 0, 0, 1, 0, 0] for i in range(n)]


def test_alignment_makes_optional_and_repeated_groups():
    a = "div h1 # > p # > > footer # >".split()
    b = "div h1 # > table # > +p # > > footer # >".split()
    wrapper, own, slots = align(a, stats(3), b, stats(4))
    assert regular_expression(wrapper) == "(div (h1 # ) (table # )? (p # )+ ) (footer # )" and slots == [0, 1, 2, 3]
    assert [s[0] for s in own] == [2, 1, 2, 2]
    again, same, slots = align(wrapper, own, a, stats(3))
    assert again == wrapper and slots == [0, 2, 3]
    assert fold([(a, stats(3)), (b, stats(4)), (a, stats(3))])[0] == wrapper


def test_structures_align_whatever_they_are():
    rng = random.Random(3)

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            return ["#"]
        return [rng.choice(["div", "p", "+li"]), *(t for _ in range(rng.randint(1, 3)) for t in tree(depth - 1)), ">"]

    for _ in range(300):
        rows = [[t for _ in range(rng.randint(1, 3)) for t in tree(3)] for _ in range(4)]
        wrapper, own = fold([(r, stats(sum(t == "#" for t in r))) for r in rows])
        assert len(own) == sum(html_wrappers._bare(t) == "#" for t in wrapper) and max(s[0] for s in own) <= 4
        for r in rows:
            out, merged, slots = align(wrapper, own, r, stats(sum(t == "#" for t in r)))
            assert len(slots) == sum(t == "#" for t in r) and slots == sorted(slots)


def test_groups_of_structures_are_folded_in_rounds(spark):
    pages = [("https://one.org/a", "<body>" + "".join(f"<{t}>x{k}</{t}>" for t in rng) + f"<article><p>body {k}</p></article></body>")
             for k, rng in enumerate([random.Random(s).choices(["h2", "h3", "pre", "div"], k=5) for s in range(40)])]
    df = spark.createDataFrame(pages, "url string, html string")
    kinds, wrappers = html_wrappers.infer_wrappers(df, group=8)
    assert kinds.count() > 20 and wrappers.count() == 1
    assert texts(spark, pages) == [f"body {k}" for k in range(40)]


def test_page_edge_rows(spark):
    rows = [(1, None, None, "u"), (2, "http://a/", "", "u"), (3, "http://a/", "<article>" + "<div>" * 3000 + "deep &am", "u"), (4, "::odd", "a < b &amp c <", "u"),
            (4, "::odd", "a < b &amp c <", "u"), (5, "http://a/", "<p", None), (6, "HTTP://A/x", "<article>" + "<p>w</p>" * 4000, None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string")
    got = sorted((r.page_id, r.text) for r in extract_pages(df).collect())
    assert [g[:2] for g in got if g[0] < 6 and g[0] != 4] == [(1, ""), (2, ""), (3, "deep &am"), (5, "")]
    assert len([g for g in got if g[0] == 4]) == 2 and got[-1] == (6, "\n\n".join(["w"] * 4000))
    assert extract_pages(df.where("false")).count() == 0
    assert Page("<p>a<p>b</p></p>").texts[1][1] == "b" and [t[1] for t in Page("<table><tr><td>1<td>2<tr><td>3</table>").texts] == ["1", "2", "3"]


# ---- BPE ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def both():
    return bpe.Tokenizer(PATH), Library.from_file(PATH)


def check(both, text):
    own, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text[:80]
    assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_equals_the_library_on_documents(spark, both):
    from tidecast.llm import queries

    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    encoded = bpe.encode(docs, both[0])
    for r, s in zip(docs.orderBy("doc_id").collect(), bpe.decode(encoded, both[0]).orderBy("doc_id").collect()):
        ids = both[1].encode(r.text, add_special_tokens=False).ids
        assert np.frombuffer(s.ids, "<u4").tolist() == ids and s.n_tokens == len(ids) and s.text == r.text
    row = queries.op7_bpe(spark, SF01).where("doc_id = 0").first()
    assert len(row.ids_sha256) == len(row.decoded_sha256) == 64


def test_bpe_equals_the_library_on_odd_texts(both):
    rng = random.Random(7)
    for t in ["", " ", "\n\n \t x", "<|endoftext|>", "a<|endoftext|> b<|endoftext", "'s't 're'LL", "a" * 500, "ha" * 300, " " * 400 + "x", "日本語🙂é́", "\u0000 "]:
        check(both, t)
    letters = "abcdeht nosri'\n .,!?0129éßñ世🙂\t-_=क़ᲉꟚ"
    for _ in range(1500):
        check(both, "".join(rng.choice(letters) for _ in range(rng.randint(1, 40))))
    for _ in range(500):
        check(both, "".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF), rng.randint(32, 0x3000)])) for _ in range(15)))


def test_automaton_accepts_only_what_bpe_makes():
    merges = [(97, 98), (256, 99), (98, 99), (97, 97), (259, 97)]  # ab, abc, bc, aa, aaa
    automaton = bpe.TokenAutomaton(merges)

    def slow(word):
        parts = list(word)
        for k, (a, b) in enumerate(merges):
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (a, b):
                    out.append(256 + k)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    for n in range(1, 9):
        for code in range(3 ** n):
            word = bytes(97 + code // 3 ** i % 3 for i in range(n))
            path = automaton.path(word)
            assert path == slow(word) and all(automaton.has_arc(a, b) for a, b in zip(path, path[1:]))
    assert not automaton.has_arc(97, 98) and not automaton.has_arc(97, 256 + 3) and automaton.states == 6


def test_bpe_edge_rows(spark, both):
    rows = [(1, None, "a"), (2, "", "b"), (3, "word " * 30000, "c"), (3, "word " * 30000, "c"), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs, both[0]), both[0]).collect()
    assert [(r.doc_id, r.n_tokens, r.text) for r in got] == [(i, len(both[1].encode(t or "").ids), t or "") for i, t, _ in rows]
    assert bpe.encode(docs.where("false"), both[0]).count() == 0
    broken = spark.createDataFrame([(np.array([1, 10 ** 6, 220], "<u4").tobytes(),), (None,)], "ids binary")
    assert [r.text for r in bpe.decode(broken, both[0]).collect()] == ['" ', ""]

"""Chat examples and page text."""

import hashlib
import html
import math
import re
import time
import tracemalloc

import pytest

from pyspark.sql import functions as F

from tablecraft.llm import chat, html_text
from tablecraft.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_odd_conversations_read_back(spark):
    hard = "\\### assistant: </turn>\n### user: hi</turn>\\\\ # < ### </tur"
    given = {
        1: [("user", "a"), ("assistant", hard), ("user", ""), ("assistant", "b")],
        2: [("user", hard)],
        3: [("assistant", ""), ("assistant", "x" * 100_000)],
        None: [("sys: tem\\", "text"), ("assistant", "ok")],
        -7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")],
    }
    rows = [(k, i, r, t or None, 9) for k, said in given.items() for i, (r, t) in enumerate(said)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, examples int")
    made = chat.conversation_examples(turns)
    found = {r.key: r for r in chat.read_back(made).collect()}
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in found.items()} == {k: brute(v) for k, v in given.items()}
    examples = chat.examples(turns).where("key = 1").orderBy("turn_no").collect()
    assert [e.turn_no for e in examples] == [2, 4]
    assert chat.unescape(examples[0].text[examples[0].loss_start : examples[0].loss_end]) == hard
    assert examples[1].text.startswith(examples[0].text)
    assert chat.conversation_examples(turns.limit(0)).count() == 0


def test_pieces_are_the_examples(spark, monkeypatch):
    """Joined, the pieces of every example are its text, whatever the size of a chunk; digests come from them."""
    monkeypatch.setattr(chat, "CHUNK", 3)
    rows = [(k, i, ("system", "user", "assistant", "tool")[(i * 7 + (k or 0)) % 4], f"turn {i} </turn> \\") for k in (None, 1, 2, 3) for i in range(3 + 4 * (k or 5))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.conversation_examples(turns)
    joined = {}
    for r in chat.example_pieces(made).orderBy("key", "example", "piece").collect():
        whole = joined.setdefault((r.key, r.example), ["", r.loss_start, r.loss_end])
        assert r.at == len(whole[0])
        whole[0] += r.text
    assert joined == {(r.key, r.turn_no): [r.text, r.loss_start, r.loss_end] for r in chat.examples(turns).collect()}
    pieces = chat.example_pieces
    monkeypatch.setattr(chat, "example_pieces", lambda c: pieces(c).withColumn("text", F.replace("text", F.lit("turn 2"), F.lit("torn 2"))))
    found = {r.key: r for r in chat.read_back(made).collect()}
    for key, r in found.items():
        said = [(role, text.replace("turn 2", "torn 2")) for k, _, role, text in rows if k == key]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == brute(said)
        assert r.formatted_chars == sum(len(x[0]) for (k, _), x in joined.items() if k == key)


def test_long_conversations_are_streamed(spark):
    """3000 turns: all examples of one would be 2.2 billion characters."""
    given = {k: [(("user", "assistant")[i % 2], f"{i} " + "long text " * 100) for i in range(3000)] for k in (None, 1)}
    rows = [(k, i, r, t) for k, turns in given.items() for i, (r, t) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.conversation_examples(turns)
    assert made.count() == len(rows)
    found = {r.key: r for r in chat.read_back(made).collect()}
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in found.items()} == {k: brute(v) for k, v in given.items()}
    ends, total = 0, 0
    for i, (r, t) in enumerate(given[1]):
        ends += len(f"### {r}: {t}</turn>\n")
        total += ends if r == "assistant" else 0
    assert found[1].formatted_chars == found[None].formatted_chars == total > 2**31


def test_all_conversations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    given = {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    for r in rows:
        given.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    found = QUERIES["op6_chat_examples"](spark, sf_dir).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == {k: brute(v) for k, v in given.items()}


def test_article_text_of_all_pages(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = QUERIES["op7_main_text"](spark, sf_dir).collect()
    assert {r.page_id for r in found} == set(pages)
    for r in found:
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        inside = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inside))
        assert r.text == " ".join(html.unescape(inside).split())
        assert r.n_chars == len(r.text)


def test_furniture_is_left_out():
    page = """<html><head><title>t</title></head><body><header><h1>Site of many words here</h1></header>
    <ul class="main-menu"><li>Home</li><li>About us and our long history of text</li></ul>
    <div id="cookie-notice">We use cookies, and say so at length in this sentence.</div>
    <div class="story"><h2>A title</h2><p>The first   paragraph is <i>rather</i> long &amp; has text.<p>Ok.</p>
    <table><tr><td>cell</td></tr></table>
    <form><input name=q><p>search for something in here</p></form>
    <section class="reader-comments"><p>I read this and have an opinion of some length.</p></section></div>
    <aside>Other stories you may like, with long names</aside><div class="sidebar"><p>More things to read</p></div>
    <script>var x = "<p>no</p>";</script><footer>All rights reserved by the site of many words</footer></body></html>"""
    assert html_text.main_text(page) == "A title The first paragraph is rather long & has text. Ok. cell"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p><b>") == ""
    assert html_text.main_text("<article><p>" + "a b " * 50_000) == ("a b " * 50_000).strip()
    assert html_text.main_text("just text &lt; that") == "just text < that"


def prose(name, n):
    return "".join(f"<p>Paragraph {i} of {name} has a good number of words in it, as prose has.</p>" for i in range(n))


def said(page):
    return " ".join(html.unescape(re.sub(r"<[^>]+>", " ", page)).split())


def test_divided_main_text_is_whole():
    parts = f"<h2>First</h2>{prose('one', 13)}", f"<h2>Second</h2>{prose('two', 7)}<p>End.</p>"
    menu = "<div class='menu'><a href=x>Home</a></div>"
    both = said("".join(parts))
    for outer, inner in (("div", "section"), ("div", "div"), ("main", "article"), ("main", "section"), ("article", "div")):
        page = f"<body>{menu}<{outer} id='content'>{''.join(f'<{inner}>{p}</{inner}>' for p in parts)}</{outer}></body>"
        assert html_text.main_text(page) == both
    short = "<div><a href=y>More</a></div>"
    articles = f"<body>{short}<article>{parts[0]}</article>{short}<article>{parts[1]}</article></body>"
    assert html_text.main_text(articles) == both


def test_one_long_block_does_not_replace_its_article():
    words = "many words of a long block that goes on " * 30
    for block in ("<blockquote>{}</blockquote>", "<pre>{}</pre>", "<ul><li>{}</li></ul>", "<table><tr><td>{}</td></tr></table>", "<h4>{}</h4>"):
        inside = f"<h1>Title</h1>{prose('a', 3)}{block.format(words)}{prose('b', 3)}<p>End.</p>"
        assert html_text.main_text(f"<body><div class='menu'>Home</div><div>{inside}</div></body>") == said(inside)


def test_names_of_content_are_not_furniture():
    parts = """<h2 id="related-work" class="share">Related work</h2><section id="search-methods"><p class="market-share">The share of the market grew.</p></section>
    <section id="search"><p>How a search is done <span class="code-comment">as a comment says</span> <a class="reply">here</a></p></section>
    <div class="market-share"><p>A block on the market.</p></div><ul><li class="menu">An item of a list of dishes</li></ul>"""
    gone = """<div class="share">Tell your friends about this page</div><div class="related-posts"><p>Other things to read here</p></div>
    <section class="box comments"><p>I have an opinion.</p></section><div role="search">Find something</div>"""
    for outer in ("article", "main"):
        assert html_text.main_text(f"<body><{outer}>{parts}{gone}</{outer}></body>") == said(parts)
    parts = parts.replace('id="search"', 'id="methods"')
    assert html_text.main_text(f"<body><div class='site-header'>Name</div><div>{parts}{gone}</div></body>") == said(parts)


def test_pages_with_nulls(spark):
    pages = spark.createDataFrame([(1, None, "text"), (None, "<p>x</p>", None), (1, None, "text")], "page_id long, html string, text string")
    assert sorted((str(r.page_id), r.text) for r in html_text.extract(pages, "page_id").collect()) == [("1", ""), ("1", ""), ("None", "x")]
    assert html_text.extract(pages.limit(0), "page_id").count() == 0


@pytest.mark.parametrize("part", ["<div>some words here ", "<b>some words here ", "<p><b>some words ", "<section><p>some words here", "<nav><div>x", "<div><p>a</div>", "</p></div>x "])
def test_nested_and_stray_tags_take_linear_time(part):
    begun = time.process_time()
    html_text.main_text(part * (2_000_000 // len(part)))
    assert time.process_time() - begun < 60
    tracemalloc.start()
    html_text.main_text(part * (200_000 // len(part)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6


def test_furniture_that_was_left_open():
    text = prose("a", 4)
    for left in ("<nav><a href=x>Home</a>", "<header><b>Site name</b>", "<menu><li>Home"):
        for region in ("article", "main"):
            assert html_text.main_text(f"<body>{left}<{region}><h1>Title</h1>{text}</{region}></body>") == "Title " + said(text)
    for left in ("<button>Press", "<select><option>One<option>Two"):
        assert html_text.main_text(f"<body><div>{left}{text}</div></body>") == said(text)
    assert html_text.main_text(f"<head><title>t</title><p>{text}") == said(text)
    teasers = "<aside><article><p>Another story of many words, which is told elsewhere.</p></article></aside>"
    assert html_text.main_text(f"<body><article>{text}</article>{teasers}</body>") == said(text)


def test_clusters_find_the_text_of_pages_without_regions(monkeypatch):
    """No name and no element says where the content is; only the ratio of text to tags does."""
    links = "".join(f"<li><a href='{i}'><b>Go</b> <i>{i}</i></a></li>" for i in range(12))
    for outer in ("div", "section"):
        text = prose("it", 6)
        page = f"<body><div><ul>{links}</ul></div><div><{outer}><h2>Title</h2>{text}</{outer}></div><div><ul>{links}</ul></div></body>"
        assert html_text.main_text(page) == "Title " + said(text)
        with monkeypatch.context() as off:
            off.setattr(html_text, "_threshold", lambda values: -math.inf)
            assert html_text.main_text(page) != "Title " + said(text)

"""Learned operators: held-out accuracy, defined results for odd input."""

import math
import os
import random
import time

import numpy as np
import pytest

from tallyloom.llm import html_blocks, language_id, shingles, toxicity
from tallyloom.llm.registry import load_all

SF_DIR, LARGER_DIR = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@needs_data
def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = language_id.identify(docs, language_id.learn(docs)).where("held_out").join(docs, "doc_id").collect()
    assert len(got) > 150
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_without_letters_or_labels(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = language_id.identify(docs, language_id.learn(docs)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, *_ in odd_rows)
    unknown = sorted(str(r.doc_id) for r in got if r.lang_pred == "und")
    assert unknown == sorted(str(i) for i, text, *_ in odd_rows if not text or not any(c.isalpha() for c in text))
    blank = make_docs([(1, "some words", None, "a"), (2, None, "en", "a")])
    assert {r.lang_pred for r in language_id.identify(blank, language_id.learn(blank)).collect()} == {"und"}
    assert language_id.identify(make_docs([]), language_id.learn(make_docs([]))).count() == 0


@needs_data
def test_toxic_documents_are_caught_and_clean_ones_left(spark):
    docs = spark.read.parquet(f"{LARGER_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER_DIR}/labels.parquet")
    known = {r.doc_id: r.toxic for r in labels.collect()}
    seen = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 0")
    chain = toxicity.learn(docs, seen)
    got = toxicity.score(docs, chain).collect()
    assert len(got) == docs.count()
    trained = {r.doc_id for r in seen.select("doc_id").collect()}
    unseen = [(r.toxic, known[r.doc_id]) for r in got if r.doc_id in known and r.doc_id not in trained]
    caught = [t for t, y in unseen if y]
    clean = [t for t, y in unseen if not y]
    assert sum(caught) >= 0.85 * len(caught) and sum(clean) <= 0.04 * len(clean)
    assert all(0 <= p <= 1 for r in got for p in (r.p_insult, r.p_contempt, r.p_toxic))


def test_toxicity_on_odd_rows_and_without_labels(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.learn(docs, labels)
    assert not any(r.toxic for r in toxicity.score(docs, chain).collect())
    kept = toxicity.drop_toxic(docs, chain)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows)
    assert toxicity.score(make_docs([]), chain).count() == 0


def test_an_id_with_many_rows_gives_few_training_texts(spark, make_docs, monkeypatch):
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda bags, marks, categories: taken.append((len(bags), int(marks[:, -1].sum()))))
    rows = [(1, f"word{i % 3}", "en", "a") for i in range(50)] + [(2, "x " + "y" * i, "en", "a") for i in range(30)]
    toxicity.learn(make_docs(rows), spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int"))
    assert taken == [(3 + toxicity.TEXTS_PER_ID, 3)]


def test_later_links_use_earlier_probabilities():
    rng = random.Random(2)
    bags, marks = [], []
    for _ in range(300):
        first, second = rng.random() < 0.5, rng.random() < 0.5
        bags.append(np.unique([1 if first else 2, 3 if second else 4, 10 + rng.randrange(30)]).astype(np.int64))
        marks.append([first, first and second])
    chain = toxicity.train(bags, np.array(marks, float), ("a", "b"))
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1 and chain.weights[1][-2] > 0
    assert chain.chances(np.array([1, 3]))[1] > 0.8 > 0.2 > chain.chances(np.array([2, 3]))[1]


@pytest.mark.parametrize("page", [
    None, "", "<", "<<>>", "<p", "<!--", "<script>x", "</p></div>", "<p \"=>x", "<![foo[x]]>", "<a><b></a>t", "&#xFFFFFFFF;",
])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html_blocks.main_text(page, html_blocks.train()), str)


def test_main_text_without_furniture():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1><nav><a href=x>Home</a></nav></header>"
        "<div class='cookie-notice'>We use cookies on this site to give you the best experience of it.</div>"
        "<main><h1>The title</h1><p>First &amp; <b>be</b>st\n para&shy;graph <a href=z>link</a>.<p>Short.</p>"
        "<div class=sidebar><p>Read this other thing too, it is long enough to pass for the main text of a page.</p></div>"
        "<form>Name <button>Send</button></form><!-- no --><script>var a = '</p>';</script><p>Last one.</p></main>"
        "<section id=comments><p>I disagree with all of this and want to say so in many words today.</p></section>"
        "<footer>&copy; us</footer>"
    )
    assert html_blocks.main_text(page, html_blocks.train()) == "The title First & best para­graph link. Short. Last one."


@pytest.mark.parametrize("before, after", [
    ("<div class='page has-sidebar'>", "</div>"), ("<div class='layout no-ads'>", "</div>"), ("<div class='layout--with-menu'>", "</div>"),
    ("<form id=aspnetForm method=post>", "</form>"), ("<div class='content-sidebar-wrap'>", "</div>"),
    ("<div class='elementor-widget'>", "</div>"), ("<div class='sidebar'><main>", "</main></div>"), ("", ""),
])
def test_article_inside_wrappers(before, after):
    story = "The first paragraph of the story, with enough words to be read as text by anyone who likes it."
    page = (
        f"<body>{before}<nav><a href=x>Home</a></nav><article><div class='post-header'><h1>The title</h1></div><p>{story}</p>"
        f"<p>Short.</p><div class='post-share'><p>Share this.</p></div></article>"
        f"<div class=related-posts><article><p>{story} Again.</p></article></div>"
        f"<aside><article><p>{story} Aside.</p></article></aside><div id=comments><article><p>{story} No.</p></article></div>{after}"
    )
    assert html_blocks.main_text(page, html_blocks.train()) == f"The title {story} Short."


@pytest.mark.parametrize("mark", [
    "<article class='post category-news tag-social'>", "<article class='post category-notices'>", "<article class='hentry widget share'>",
    "<div class='article-text text-widget'>", "<main id=search class='tags toolbar'>",
])
def test_articles_keep_their_text_whatever_their_class(mark):
    story = "The first paragraph of the story, with enough words to be read as text by anyone who likes it."
    end = "</" + mark[1:].split()[0] + ">"
    page = f"<nav><a href=x>Home</a></nav>{mark}<p>{story}</p><p>Short.</p>{end}<article class='comment tag-x'><p>{story} No.</p></article>"
    assert html_blocks.main_text(page, html_blocks.train()) == f"{story} Short."


@pytest.mark.parametrize("part, tail", [
    ("<p", ""), ("<p", ">"), ("<b>x", "</div>"), ("<b>x", "</i>"), ("<div>", "</p>"), ("<a title=\"x", ""), ("<a b=\">\" ", ""), ("<p a='", ""),
    ("<!--", ""), ("<ul><li>", "</li>"), ("<a href=x>", "</a>"), ("<x y=z ", ""), ("&amp", ""), ("<form><div class=a>", "</form>"),
])
def test_hostile_pages_take_time_in_proportion(part, tail):
    tree = html_blocks.train()

    def taken(n):
        page = part * n + tail * n
        began = time.perf_counter()
        html_blocks.main_text(page, tree)
        return time.perf_counter() - began

    taken(500)
    small, large = taken(5_000), taken(40_000)
    assert large < 16 * small + 1.5


def test_form_without_an_article_is_furniture():
    page = "<article><p>Text of it.</p></article><form class=x><p>Your name and many other words that a form asks for here.</p></form>"
    named = "<form><div class='main content'><p>A page built as one form has its text in a named element of it.</p></div></form>"
    assert html_blocks.main_text(page + page, html_blocks.train()) == "Text of it. Text of it."
    assert html_blocks.main_text(named, html_blocks.train()).startswith("A page built")


def test_extract_gives_one_row_per_page(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<article><p>a  b</p></article>"), (2, None, None), (None, "v", ""), (1, "u", "<article><p>a  b</p></article>")],
        "page_id long, url string, html string",
    )
    got = html_blocks.extract(pages).collect()
    assert sorted(((r.page_id, r.text, r.n_chars) for r in got), key=str) == sorted(
        [(1, "a b", 3), (2, "", 0), (None, "", 0), (1, "a b", 3)], key=str)
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_span_hashes_are_equal_only_for_equal_runs(monkeypatch):
    monkeypatch.setattr(shingles, "BLOCK", 7)
    rng = random.Random(1)
    words = [rng.choice([b"a", b"b", b"ab", b"ba", "é".encode()]) for _ in range(400)]
    hashes = shingles.run_hashes(shingles.SpanHasher(), words, 5)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    assert len(hashes) == len(runs)
    assert len(set(hashes.tolist())) == len(set(runs)) == len(set(zip(hashes.tolist(), runs)))
    assert len(shingles.run_hashes(shingles.SpanHasher(), words[:3], 5)) == 1
    assert not math.isnan(float(len(shingles.run_hashes(shingles.SpanHasher(), [], 5))))


def test_every_operator_is_registered():
    runs, sql = load_all()
    assert sorted(int(n[2:].split("_")[0]) for n in runs) == list(range(1, 14))
    assert set(sql) <= set(runs)

"""The Jaccard join, HTML extraction and the pipeline against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from fixtures import ROWS, docs, labels, lower_words, plain
from waitspark.llm import html_text, jaccard_join
from waitspark.llm.components import components
from waitspark.workspace import materialize


def shingles(text):
    w = lower_words(text)
    if len(w) < 3:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def brute_components(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                root[find(i)] = find(j)
    members = {}
    for i in range(len(sets)):
        members.setdefault(find(i), []).append(sets[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return sorted(((sets[i][0], len(sets[i][1]), least[find(i)]) for i in range(len(sets))), key=repr)


def near_groups(groups=4, members=40, size=120, seed=3):
    """Groups of variants with one to eight edits, most pairs just beyond or just within a link."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(size)]
        for m in range(members):
            words = list(base)
            for _ in range(rng.randint(0, 8) if g else rng.randint(0, 1)):
                words[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
            rows.append((g * 1000 + m, " ".join(words), "en", "a", 1, "x", 1.0))
    passage = " ".join(f"shared{i}" for i in range(50))
    rows += [(9000 + i, passage + " " + " ".join(f"u{i}v{k}" for k in range(60)), "en", "a", 1, "x", 1.0) for i in range(100)]
    return rows


@pytest.mark.parametrize("rare", [2, jaccard_join.RARE])
def test_components_match_brute_force(spark, rare):
    # Few rare tokens force combinations of frequent ones.
    rows = near_groups() + ROWS
    got = jaccard_join.op7(docs(spark, rows), rare).collect()
    assert plain(got) == brute_components(rows)


def test_a_pair_is_made_about_once(spark, monkeypatch):
    """Near copies share many keys; each pair is compared at the least of them."""
    found, made = jaccard_join.candidates, []

    def counted(live, percent):
        pairs = found(live, percent)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(jaccard_join, "candidates", counted)
    rows = near_groups(3, 30)
    assert plain(jaccard_join.op7(docs(spark, rows)).collect()) == brute_components(rows)
    assert 0 < sum(n for n, _ in made) <= 2 * sum(n for _, n in made)


def test_one_of_the_keys_with_the_same_members_stays(spark):
    members = {1: [1, 2], 2: [1, 2], 3: [1, 2, 3], 4: [3, 2, 1], 5: [4], 6: [3, 4]}
    postings = spark.createDataFrame([(k, c) for k, found in members.items() for c in found], "key long, cid long")
    assert sorted(r["key"] for r in jaccard_join.meeting_keys(postings).collect()) == [1, 3, 6]
    least = {r["cid"]: sorted(r["least_keys"]) for r in jaccard_join.least_keys(postings).collect()}
    assert least == {1: [1, 2, 3, 4], 2: [1, 2, 3, 4], 3: [3, 4, 6], 4: [5, 6]}


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 10**6), st.integers(20, 400), st.sampled_from([0, 1, 4, 1000]))
def test_linked_sets_share_a_key(seed, n, rare):
    """Any two sets that link meet in a key, whatever the counts."""
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(1, 2**63, 2 * n).astype(np.uint64))
    a = pool[:n]
    gone = rng.integers(0, max(1, n // 20) + 1)
    b = np.concatenate([a[gone:], pool[n : n + rng.integers(0, max(1, n // 20) + 1)]])
    counts = {t: int(rng.integers(2, 9)) for t in pool.tolist()}
    if 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
        return
    keys = [
        set(jaccard_join.signature(len(s), s, np.array([counts[t] for t in s.tolist()]), rare)) for s in (a, b)
    ]
    assert keys[0] & keys[1]


def cut_texts(sizes=range(1, 31)):
    """For each size texts of two sets of words, each also without its first or its last word."""
    rows = []
    for n in sizes:
        for v in range(2):
            words = [f"n{n}v{v}w{i}" for i in range(n + 2)]
            for cut in (words, words[1:], words[:-1]):
                rows.append((len(rows), " ".join(cut), "en", "a", 1, "x", 1.0))
    return rows


def test_texts_with_a_word_cut_at_either_end_link(spark):
    """Sets of 10 and 9 shingles differ in how many tokens they may lack; the sieve must leave both."""
    rows = cut_texts()
    assert plain(jaccard_join.op7(docs(spark, rows)).collect()) == brute_components(rows)


def test_linked_sets_pass_the_sieve():
    """For all sizes and the worst order of tokens, what the two sets show has more common tokens than either may lack."""
    for a in range(1, 200):
        for b in range(jaccard_join.least_overlap(a), a + 1):
            common = -(-90 * (a + b) // 190)
            x, y = a - common, b - common
            shown = min(jaccard_join.sieve_size(a) - x, jaccard_join.sieve_size(b) - y, common)
            assert shown >= jaccard_join.prefix_size(a) >= jaccard_join.prefix_size(b)


def test_one_of_each(spark):
    rows = near_groups(2, 15) + ROWS
    got = jaccard_join.one_of_each(docs(spark, rows))
    assert got.columns == docs(spark).columns
    kept = got.collect()
    expected = {c for _, n, c in brute_components(rows) if n}
    assert sorted(str(r["doc_id"]) for r in kept if shingles(r["text"])) == sorted(map(str, expected))
    assert sorted(r["doc_id"] for r in kept if not shingles(r["text"])) == [4, 5, 6]


def test_near_copies_of_the_pipeline_share_five_words(spark):
    """Two replaced words of 100 leave five-word similarity at 0.81 and three-word similarity at 0.88."""
    words = [f"w{i}" for i in range(100)]
    changed = ["x" if i == 30 else "y" if i == 70 else w for i, w in enumerate(words)]
    # Three of 60 leave 0.58.
    other = [f"v{i}" for i in range(60)]
    apart = ["z" if i in (10, 30, 50) else w for i, w in enumerate(other)]
    rows = [(i, " ".join(w), "en", "a", 1, "x", 1.0) for i, w in enumerate((words, changed, other, apart))]
    got = corpus_pipeline.drop_near_copies(spark, docs(spark, rows), "")
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 2, 3]
    assert sorted(r["doc_id"] for r in jaccard_join.one_of_each(docs(spark, rows)).collect()) == [0, 1, 2, 3]


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10**6), st.integers(1, 400), st.sampled_from([0, 1, 4, 1000]))
def test_linked_sets_share_a_key_at_80_percent(seed, n, rare):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(1, 2**63, 2 * n).astype(np.uint64))
    gone, new = rng.integers(0, n // 5 + 1), rng.integers(0, n // 5 + 1)
    a, b = pool[:n], np.concatenate([pool[gone:n], pool[n : n + new]])
    counts = {t: int(rng.integers(2, 9)) for t in pool.tolist()}
    if not gone + new or 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
        return
    found = [set(jaccard_join.signature(len(s), s, np.array([counts[t] for t in s.tolist()]), rare, 80)) for s in (a, b)]
    assert found[0] & found[1]


def test_long_paths_are_one_component(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100}


@pytest.mark.parametrize("f", [jaccard_join.op7, jaccard_join.one_of_each])
def test_empty_table(spark, f):
    assert f(docs(spark, [])).collect() == []


# HTML


ARTICLE_PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style></head><body class="home">
<header>Site</header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
<main><article><h1>Head&shy;line</h1><p>One <b>two</b>three<br>four<p>five &lt;six&gt; &#55;
<form><input name=q><label>Search</label></form><aside>aside</aside><!-- hidden --><script>var a="</p>";</script>
<div class="share-buttons">Share</div><ul><li>seven<li>eight</ul></article><section id="comments"><article>me too</article></section>
</main><div class="ad">Buy</div><footer>&copy; end</footer></body></html>"""


def test_structure():
    assert html_text.kept_text(html_text.blocks(ARTICLE_PAGE), set()) == "Head\xadline One twothree four five <six> 7 seven eight"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain text &amp; more", "plain text & more"),
        ("<p>unclosed <b>bold<p>next", "unclosed bold next"),
        ("<article>a < b and 3 > 2</article>", "a < b and 3 > 2"),
        ("<article>cut <a href='x", "cut"),
        ("<article><script>never closed", ""),
        ("<div>x</div></div></div><div>y</div>", "x y"),
        ("<nav>menu</nav>", ""),
        ("<article><p>" + "w " * 50_000 + "</p></article>", ("w " * 50_000).strip()),
    ],
)
def test_pages(page, text):
    assert html_text.kept_text(html_text.blocks(page), set()) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class='layout has-sidebar'><article>a b</article><div class='sidebar-right'>s</div></div>", "a b"),
        ("<div id='page-with-header'><p>a b</p></div>", "a b"),
        ("<form action='/x'><p>menu</p><article>a b</article></form>", "a b"),
        ("<div class='content header'><main>a b</main></div>", "a b"),
        ("<article><div class='post-header'>head</div><p class='related-work'>work</p><p class='share-buttons'>s</p></article>", "head work"),
        ("<article>a <svg viewBox='0 0'/> b <math/> c<svg><title>t</title></svg> d</article>", "a b c d"),
        ("<article>a<section id='comments'><article>me too</article></section></article>", "a"),
        ("<form><p>search</p></form><p>a</p>", "a"),
    ],
)
def test_markup_that_only_looks_like_furniture(page, text):
    assert html_text.kept_text(html_text.blocks(page), set()) == text


def open_page(i):
    menu = "<div>Home Products Service Contact Imprint Help Jobs Press Login</div>"
    body = " ".join(f"p{i}w{k}" for k in range(30))
    return f"<html><body>{menu}<div><p>{body}</p><p>Call us today</p></div></body></html>", body


def test_repeats_of_a_host_go_where_no_article_is_marked(spark):
    rows = [(i, "http://h.example/" + str(i), open_page(i)[0]) for i in range(5)]
    rows += [(10, "http://other.example/x", open_page(10)[0]), (11, None, None), (12, "no host", "<article>a</article>")]
    rows += [rows[0]]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        assert got[i] == (open_page(i)[1], len(open_page(i)[1]))
    assert got[10][0].startswith("Home Products") and got[10][0].endswith("Call us today")
    assert got[11] == ("", 0) and got[12] == ("a", 1)


def test_runs_are_the_repeated_substrings_of_a_suffix_array():
    rng = random.Random(1)
    text = [f"t{rng.randrange(3)}" for _ in range(400)]
    names = html_text.run_names(np.array([hash(t) % 2**63 for t in text], dtype=np.uint64))
    suffixes = sorted(range(len(names)), key=lambda i: text[i:])
    same = {frozenset((a, b)) for a, b in zip(suffixes, suffixes[1:]) if text[a : a + html_text.RUN] == text[b : b + html_text.RUN]}
    assert all(names[a] == names[b] for a, b in map(tuple, same))
    assert len(set(names.tolist())) == len({tuple(text[i : i + html_text.RUN]) for i in range(len(names))})


def test_shared_passages_inside_articles_stay(spark):
    line = "this very sentence stands in all the articles of the host"
    rows = [(i, "http://h/" + str(i), f"<article><p>{line}</p><p>own{i}</p></article><footer>{line}</footer>") for i in range(4)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {f"{line} own{i}" for i in range(4)}


# Pipeline


def test_pipeline(spark, tmp_path):
    rng = random.Random(11)
    common = [f"w{i}" for i in range(400)]
    rows, marks = [], []
    for i in range(300):
        text = [rng.choice(common) for _ in range(60)]
        if i % 5 == 0:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["vile", "nasty"]))
        rows.append((i, " ".join(text), "en", f"s{i % 3}", 1, "x", 1.0))
        marks.append((i, 1, int(i % 5 == 0)))
    rows += [(1000 + i, rows[1][1], "en", "s0", 1, "x", 1.0) for i in range(5)]
    rows += [(2000, rows[2][1] + " more", "en", "s1", 1, "x", 1.0)] + [rows[3]] + ROWS
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, marks).write.parquet(f"{tmp_path}/labels.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before = df
        df = materialize(stage(spark, df, str(tmp_path)), name)
        counts.append((name, before.count(), df.count()))
        if name != names[-1]:
            assert df.columns == before.columns
        got = df.collect()
        if name == "toxicity":
            kept = {r["doc_id"] for r in got}
            assert sum(i in kept for i in range(0, 300, 5)) <= 2
            assert sum(i in kept for i in range(300) if i % 5) >= 238
            assert {4, 5, 6} <= kept
        elif name == "exact_dedup":
            texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in got]
            assert len(texts) == len(set(texts))
            assert set(texts) == {re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in before.collect()}
        elif name == "jaccard_join":
            expected = {str(c) for _, n, c in brute_components([tuple(r) for r in before.collect()]) if n}
            assert {str(r["doc_id"]) for r in got if shingles(r["text"])} == expected
        elif name == "mixing":
            assert {r["doc_id"] for r in got} <= {r["doc_id"] for r in before.collect()}
        else:
            assert len(got) == counts[-1][1] and all(len(r["ids"]) == r["n_tokens"] for r in got)


def test_pipeline_on_empty_tables(spark, tmp_path):
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize(
    "name",
    ["post-comments", "user-comments", "reader-comments", "comment-thread", "related-posts", "newsletter-signup", "page-footer",
     "page-header", "ad-300x250", "promo-card", "global-nav", "social-icons", "cookieConsent", "sidebarWidget", "pageFooter", "notice-box"],
)
def test_names_of_furniture(name):
    page = f"<div><p>text one</p><div class='{name}'><p>gone</p></div><p id='{name}'>gone</p></div>"
    assert html_text.kept_text(html_text.blocks(page), set()) == "text one"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article>a</article><div class='reader-comments'><article>b</article></div><div class='related-articles'><article>c</article></div>", "a"),
        ("<div class='main-sidebar-layout'><article>a</article></div>", "a"),
        ("<article class='post category-social type-post has-sidebar'>a</article>", "a"),
        ("<article class='related-post'>b</article><article>a</article>", "a"),
        ("<article>x <math>y</math> z</article>", "x y z"),
        ("<article>a<ul class='related-posts'><li>b</ul></article>", "a"),
    ],
)
def test_articles_of_the_page_and_others(page, text):
    assert html_text.kept_text(html_text.blocks(page), set()) == text


def test_stray_end_tags_cost_nothing():
    import time

    start = time.process_time()
    assert html_text.kept_text(html_text.blocks("<div>" * 60_000 + "x</p>" * 30_000), set()).count("x") == 30_000
    assert time.process_time() - start < 10


def extracted(spark, rows):
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r["page_id"]: r["text"] for r in found}


def test_pages_alike_but_for_title_or_date_keep_their_text(spark):
    body = " ".join(f"word{k}" for k in range(60))
    rows = [(i, f"http://t.example/{i}", f"<title>{i}</title><div><p>{body}</p></div>") for i in range(2)]
    rows += [(10 + i, f"http://d.example/{i}", f"<div>{i} May</div><div><p>{body}</p></div>") for i in range(2)]
    got = extracted(spark, rows)
    assert got[0] == got[1] == body
    assert all(body in got[10 + i] for i in range(2))


def test_a_passage_of_a_few_pages_stays_and_the_menu_of_all_goes(spark):
    quote = " ".join(f"q{k}" for k in range(55))
    rows, wanted = [], {}
    for i in range(30):
        page, body = open_page(i)
        extra = quote if i < 2 else ""
        rows.append((i, f"http://h.example/{i}", page.replace("</body>", f"<p>{extra}</p></body>")))
        wanted[i] = f"{body} {extra}".strip()
    assert extracted(spark, rows) == wanted


def test_own_names_of_operators_may_be_columns(spark):
    from waitspark.llm import exact_dedup, mixing, sentencepiece_codec

    names = ["_key", "_copies", "_twins", "_copy", "_sha", "_id", "_digest", "_i", "_d", "_row", "_stay", "_least", "_text", "_source", "_slot", "_word", "size", "copies"]
    rows = docs(spark).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for operator in (mixing.mix, exact_dedup.deduplicate, jaccard_join.one_of_each, sentencepiece_codec.encode):
        out = operator(rows)
        assert set(rows.columns) <= set(out.columns)
        for r in out.filter("doc_id IS NOT NULL").collect():
            assert all(r[n] == f"{n}{r['doc_id']}" for n in names), operator


def test_row_keys_do_not_collide(spark):
    from waitspark.llm.mixing import row_key

    rows = spark.createDataFrame(
        [("a\x1f=b", "c"), ("a", "b\x1f=c"), ("a", "=b"), (None, "-"), ("-", None), ("1:a", ""), ("", "1:a"), (None, None)], "x string, y string"
    )
    assert rows.select(row_key(rows).alias("k")).distinct().count() == 8

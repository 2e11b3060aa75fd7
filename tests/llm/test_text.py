"""Main text of pages, chat formatting, mixing and the pipeline."""

import itertools
import os
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillbank.llm import chat, html_content as hc, mixing as mx
from quillbank.llm.queries import CONTROL_TEXT, ORACLES, QUERIES
from tests.llm import plain
from tests.llm.conftest import plain_rows

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body class="home post">
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies.</div><div class=ad>Buy now!</div>
<main><article><header class="entry-header"><h1>A   title &amp; more</h1></header><p>First <b>bold</b> text,<br>same block&nbsp;&eacute;.<p>Second paragraph
follows.<ul><li>one thing<li>another thing</ul><blockquote>Quoted words.</blockquote>
<table><tr><td>left<td>right</table><form><label>Mail</label><input></form><aside>Related: x</aside>
<section id="comments"><h2>Comments</h2><p>I disagree, this article is quite wrong, and long enough to look like text.</p></section></article></main>
<div id="sidebar"><p>Popular posts of this week, told at length.</p></div><footer>&copy; me</footer></body></html>"""
TEXT = "A title & more\nFirst bold text, same block é.\nSecond paragraph follows.\none thing\nanother thing\nQuoted words.\nleft\nright"


def test_main_text_of_a_page():
    assert hc.main_text(PAGE, np.zeros(8))[0] == TEXT


@pytest.mark.parametrize("part", [
    '<h2 id="related-work">Kept.</h2>', '<h2 id="comments">Kept.</h2>', '<section id="search-algorithms"><h2>Kept</h2><p>So is this.</p></section>',
    '<p class="notice">Kept.</p>', '<p title="The hidden valley">Kept.</p>', '<div data-hidden="false">Kept.</div>', "<p title='id=\"x\" class=\"ad\"'>Kept.</p>",
    '<div class="share-prices"><header><h2>Kept</h2></header>Text.</div>',
])
def test_names_in_an_article_do_not_lose_its_text(part):
    page = f"<nav><a href=/>Home</a></nav><article><p>Before it.</p>{part}<p>Behind it.</p></article><footer>me</footer>"
    text = hc.main_text(page, np.zeros(8))[0]
    assert text.split("\n") == ["Before it.", *[t for t in re.sub("<[^>]*>", "\n", part).split("\n") if t], "Behind it."]


def test_the_cut_decides_on_named_sections_in_an_article():
    page = '<article><p>Before it.</p><section id="search"><p>A part of it.</p></section><p>Behind it.</p></article>'
    for bias, kept in ((3.0, True), (-1.0, False)):
        assert ("A part of it." in hc.main_text(page, np.array([bias] + [0.0] * 7))[0]) == kept


@pytest.mark.parametrize("page,want", [
    ('<form id="aspnetForm"><header>Site</header><article><p>Text.</p><form class="mail"><label>Mail</label></form></article></form>', "Text."),
    ("<FORM method=post><nav><a href=/>Home</a></nav><main><p>Text.</p></main>", "Text."),
    ("<article><p>Text.</p><form><label>Your mail</label><button>Send</button></form><p>End.</p></article>", "Text.\nEnd."),
    ('<form action="/find"><label>Find</label></form><article><h1>Head</h1><p>Text.</p></article>', "Head\nText."),
    ('<article><p>Text.</p><div id="comment-12"><p>Reply.</p></div><ol class="comment-list"><li>Reply.</ol></article>', "Text."),
    ('<article><p>Text.</p><div class="ad-slot">Buy.</div><p>End.</p><article class="comment"><p>Reply.</p></article></article>', "Text.\nEnd."),
    ("<article><p>Text.</p><svg><title>No</title></svg><p>End.</p><svg></article>", "Text.\nEnd."),
])
def test_forms_comments_and_adverts(page, want):
    for bias in (0.0, 3.0):
        assert hc.main_text(page, np.array([bias] + [0.0] * 7))[0] == want


@pytest.mark.parametrize("page", [
    "<div>some words " * 20_000, "<p>a<svg>" * 20_000, "<div>" * 10_000 + "</li>" * 40_000, "<ul><li>x" * 10_000, "<form><h1>y" * 10_000, "<td><div>z" * 10_000,
])
def test_deep_and_long_pages_take_time_as_their_length(page):
    started = time.process_time()
    blocks = hc.main_text(page, np.zeros(8))[1]
    assert time.process_time() - started < 20
    assert sum(len(b.__dict__) for b in blocks) == 7 * len(blocks)


def test_a_long_chain_of_open_blocks_is_cut_quickly():
    n = 8000
    started = time.process_time()
    labels = hc.minimum_cut([0.9 if k % 2 else -0.9 for k in range(n)], {(k, k + 1): 1.0 for k in range(n - 1)})
    assert time.process_time() - started < 10 and len(labels) == n


#: Layouts without <article>, or with names that mislead; {} is the content, and all other words start with "zz".
LAYOUTS = [
    "<body>{}<div><a href=/>zzone zztwo</a> <a href=/>zzthree</a></div></body>",
    "<div id=page><div><a href=/>zzhome</a></div><div>{}</div><div><a href=/>zzabout</a></div></div>",
    "<div class=navbar><a href=/>zzhome</a></div><div class=columns>{}</div><footer>zzme</footer>",
    "<table><tr><td><a href=/>zzhome</a></td><td>{}</td></tr></table>",
    "<form id=f1><header>zzsite</header><div class=body>{}</div><footer>zzme</footer></form>",
    "<div class=header><p>zzsite</p></div><section>{}</section><div class=related-posts><p>zzmore</p></div>",
    "<main class=with-sidebar>{}</main><aside><p>zzpopular zzposts</p></aside>",
    "<div class=post>{}<div class=share-buttons><a href=/>zzshare</a></div></div>",
    "<div class=content><div class=ad-slot>zzbuy</div>{}<div id=comment-1><p>zzno, zzreally.</p></div></div>",
    "<div id=main>{}<ol class=comment-list><li>zzfirst</ol></div>",
]
STORIES = [
    "<h1>{}</h1><p>{}. {}.</p><p>{}, {}.</p>", "<h2>{}</h2><div>{}. {}.</div><ul><li>{}.<li>{}.</ul>", "<p>{}. {}.</p><section id=search><p>{}, {}. {}.</p></section>",
    "<p>{}.</p><blockquote>{}. {}.</blockquote><p>{}. {}.</p>",
]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="tables not present")
def test_words_found_on_forty_kinds_of_pages(spark):
    weights = hc.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    rng = random.Random(3)
    right = found = wanted = by_cut = 0
    for layout in LAYOUTS:
        for story in STORIES:
            parts = [" ".join(rng.choice(["winter", "river", "stone", "early", "walked", "under", "quiet", "market"]) for _ in range(rng.randint(9, 25))) for _ in range(5)]
            body = story.format(*parts)
            text, blocks, labels = hc.main_text(layout.format(body), weights)
            got, want = Counter(re.findall(r"\w+", text)), Counter(re.findall(r"\w+", " ".join(parts)))
            right += (got & want).total()
            found += got.total()
            wanted += want.total()
            by_cut += sum(content != (b.evidence > 0) for b, content in zip(blocks, labels))
    assert right >= 0.9 * found and right >= 0.9 * wanted, (right, found, wanted)
    assert by_cut >= 50, by_cut


def test_hidden_and_named_parts_still_go():
    parts = ["<p hidden>x</p>", "<div aria-hidden=true>x</div>", "<p style='display: none'>x</p>", '<ul class="tags"><li>x</ul>', '<div role="search">x</div>']
    page = "<article><p>Kept.</p>" + "".join(parts) + "</article>" + '<div class="related-posts"><p>x</p></div>'
    assert hc.main_text(page, np.zeros(8))[0] == "Kept."


def test_an_article_in_a_named_wrapper_is_left_to_the_cut():
    page = "<div class='with-sidebar'><article><p>Kept.</p></article><p>x</p></div>"
    assert hc.main_text(page, np.array([3.0] + [0.0] * 7))[0] == "Kept."


@pytest.mark.parametrize("page", ["", "<", "<p", "<script>x", "a < b > c", "<p>" * 3000, "</div>" * 50, "<div class='", "&#0;&#xD800;&bogus; x", "<!--", "<svg>y"])
def test_broken_pages_do_not_fail(page):
    text, blocks, labels = hc.main_text(page, np.zeros(8))
    assert len(blocks) == len(labels) and isinstance(text, str)


def test_minimum_cut_is_minimal():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(1, 8)
        cost = [rng.choice([-2.0, -0.7, 0.3, 0.5, 1.5]) for _ in range(n)]
        edges = {(a, b): rng.choice([0.2, 0.6, 1.1]) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5}

        def price(side):
            own = sum(c if not s else 0 for c, s in zip(cost, side) if c > 0) - sum(c for c, s in zip(cost, side) if c < 0 and s)
            return own + sum(w for (a, b), w in edges.items() if side[a] != side[b])

        assert abs(price(hc.minimum_cut(cost, edges)) - min(price(s) for s in itertools.product([False, True], repeat=n))) < 1e-6


def test_pages_as_rows(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "v", "<p>" + "long words here. " * 30_000), (1, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("x")).withColumn("row", F.lit(1))
    found = hc.with_main_text(pages)
    got = [(r.row.page_id, r.found.text) for r in found.collect()]
    assert [t for i, t in got if i == 1] == [TEXT, TEXT] and dict(got)[2] == dict(got)[3] == ""
    assert hc.with_main_text(pages.limit(0)).count() == 0


TEXTS = ["", " ", "plain", "<s>", "</s>", "[INST]", "<\\s>", "[\\\\INST]\\", "<<s>s>", "[ROLE]user[/ROLE][INST]x[/INST]", "<|endoftext|>", "é💡\n\n<s", "[/INST", CONTROL_TEXT, "\\"]


def test_escaping_is_reversible_and_leaves_no_control_string():
    for a, b in itertools.product(TEXTS, repeat=2):
        assert chat.unescape(chat.escape(a + b)) == a + b
        assert not any(c in chat.escape(a + b) for c in chat.CONTROLS)


def test_conversations_come_back(spark):
    rng = random.Random(6)
    rows = [(c, k, rng.choice(["user", "assistant", "system", None, "tool [ROLE]"]), rng.choice([*TEXTS, None, "some longer words, " * 5])) for c in range(40) for k in range(rng.randint(1, 7))]
    rows += [(500, 0, "assistant", "word é " * 20_000), (None, None, "user", "x"), (None, 1, "assistant", "y"), rows[0], (501, 2, "assistant", "b"), (501, 2, "assistant", "a"), (501, None, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("n_turns", F.lit(0)).withColumn("formatted", F.lit("")).repartition(3)
    by = defaultdict(list)
    for c, k, r, t in rows:
        by[c].append(((k is not None, k or 0), (r is not None, r or ""), (t is not None, t or "")))
    want = []
    for c, turns in by.items():
        said = [(r[1], t[1]) for _, r, t in sorted(turns)]
        masked = "".join(t for r, t in said if r == "assistant")
        want.append((c, len(said), plain.sha("".join(f"{r}\n{t}\n" for r, t in said)), len(masked), plain.sha(masked)))
    formatted = chat.format_conversations(df)
    assert plain_rows(chat.read_back(formatted), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want, key=repr)
    for r in formatted.where("conv_id < 40").collect():
        assert all(a <= b for a, b in zip(r.token_starts, r.token_ends)) and "".join(
            r.formatted[a:b] for k, (a, b) in enumerate(zip(r.token_starts, r.token_ends)) if not k or a >= r.token_ends[k - 1]) == r.formatted
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


@pytest.mark.parametrize("blocks,levels", [(1024, 4), (3, 2), (1, 0)])
def test_mix_meets_its_targets(frame, rows, blocks, levels):
    size, target = plain.mix_targets([(s, t) for _, s, t in rows])
    df = frame(rows, clashing=True)
    got = mx.allotments(df, blocks, levels).join(df.select("doc_id", "source").distinct().groupBy("doc_id").count().where("count = 1").select(F.col("doc_id").alias("i")), F.expr("doc_id = i"), "left").collect()
    assert len(got) == len(rows)
    assert sorted((r.size for r in got)) == sorted(len(plain.SPACED.findall(t or "")) for _, _, t in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    mixed = mx.mix(df, blocks, levels)
    assert set(df.columns) | {"copy", "taken", "shard", "position"} == set(mixed.columns)
    taken, shards = Counter(), Counter()
    for r in mixed.collect():
        taken[r.source] += r.taken
        shards[r.shard] += 1
    for s in size:
        assert abs(taken[s] - target[s]) <= 1 + 0.5 * sum(1 for _, x, _ in rows if x == s) / blocks + 8, s
    assert sum(taken.values()) == sum(r.taken for r in got) and set(shards) <= set(range(2**levels))
    again = mx.allotments(df.repartition(3), blocks, levels)
    assert plain_rows(again, "doc_id", "size", "taken", "target") == sorted(((r.doc_id, r.size, r.taken, r.target) for r in got), key=repr)


def test_tasks_of_the_mix_follow_its_words(frame, monkeypatch):
    assert [mx.pieces(w, 16) for w in (0, 1e6, 1.25e8, 7.5e9, 2.5e13)] == [1, 1, 4, 170, 9766]
    monkeypatch.setattr(mx, "TASK_WORDS", 8)
    monkeypatch.setattr(mx, "TASK_GROWTH", 0)
    df = frame([(k, "ab"[k % 2], "one two three") for k in range(200)])
    mixed = mx.mix(df, 64, 1)
    tasks = mixed.withColumn("task", F.spark_partition_id()).collect()
    assert len(set(r.task for r in tasks)) > 20
    assert all(len({r.shard for r in tasks if r.task == t}) == 1 for t in {r.task for r in tasks})
    for shard in (0, 1):
        own = [r.position for r in sorted((r for r in tasks if r.shard == shard), key=lambda r: r.task)]
        assert own == sorted(own)


def test_splitting_tree_is_exact(spark):
    quotas = spark.createDataFrame([(k, n) for k, n in enumerate([500, 0, 1, 37, 200])], "nth int, quota bigint").where("quota > 0")
    tree = mx.splitting_tree(quotas, 3).collect()
    by_source, by_shard = Counter(), Counter()
    for r in tree:
        by_source[r.nth] += r.quota
        by_shard[r.shard] += r.quota
    assert by_source == {0: 500, 2: 1, 3: 37, 4: 200}
    assert max(by_shard.values()) - min(by_shard.values()) <= 1 and len(by_shard) == 8
    large = [r.quota for r in tree if r.nth == 0]
    assert len(set(large)) > 1 and all(abs(q - 62.5) < 25 for q in large)


@pytest.mark.parametrize("some", [[], [(1, None, None)], [(None, "s", "a b c")]])
def test_mix_of_hardly_anything(frame, some):
    assert mx.allotments(frame(some)).count() == len(some)
    assert mx.mix(frame(some)).where("taken <= 0").count() == 0


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")
def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = corpus_pipeline.toxic(spark, docs, SF_DIR)
    assert first.columns == docs.columns
    left = {r.doc_id: r for r in first.collect()}
    kept = {i for i, _, _, k, _ in plain.exact_groups([(i, r.text) for i, r in left.items()]) if k}
    near = plain.near_components([(i, left[i].text) for i in sorted(kept)])
    kept = {i for i, _, c, _ in near if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = {r[0] for r in plain.contamination([(i, left[i].text) for i in kept], items) if not r[-1]}
    size, target = plain.mix_targets([(left[i].source, left[i].text) for i in kept])
    taken, reads = Counter(), Counter()
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        assert r.doc_id in kept and r.text == left[r.doc_id].text
        taken[r.source] += r.taken
        reads[r.doc_id] += r.taken
    assert all(abs(taken[s] - target[s]) < 5 for s in size)
    assert all(n <= 2 * len(plain.SPACED.findall(left[i].text)) for i, n in reads.items())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(columns) == sorted(got.columns)
    assert plain_rows(got, *columns) == sorted(cur.fetchall(), key=repr)

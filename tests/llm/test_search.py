"""Ranked lexical search, URL filters and spelling variants against plain Python."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillbank.llm import lexical_search as ls, spelling as sp, url_filter as uf
from quillbank.llm.frames import unpacked
from quillbank.llm.queries import ORACLES, QUERIES, URL_RULES
from tests.llm.conftest import CLASHING
from tests.llm.plain import LOWER

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, places=10):
    held = [(i, Counter(w), len(w)) for i, t in docs if (w := TERM.findall((t or "").translate(LOWER)))]
    n, total = len(held), sum(size for _, _, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in held:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in TERM.findall((text or "").translate(LOWER)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:places])]
    return out


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def items_of(texts):
    out = [(k, " ".join((t or "").split()[:k % 30])) for k, t in enumerate(texts[10:40])]
    return out + [(90, None), (91, ""), (92, "qqq unknown"), (93, texts[12] * 2), (93, texts[13]), (None, texts[14]), (94, texts[15]), (94, texts[15])]


@pytest.mark.parametrize("shard,depth", [(1 << 20, 64), (40, 1), (1, 2)])
def test_search_equals_scoring_every_document(spark, frame, rows, texts, monkeypatch, shard, depth):
    monkeypatch.setattr(ls, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(ls, "FIRST_DEPTH", depth)
    items = items_of(texts)
    queries = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, query string").repartition(3)
    found = ls.search(frame(rows, clashing=True), queries)
    assert got(found, "item_id", "rank", "doc_id", "score") == sorted(ranked([(i, t) for i, _, t in rows], items), key=repr)


def test_search_in_blocks_of_queries(spark, frame, rows, texts, monkeypatch):
    items = items_of(texts)
    queries = spark.createDataFrame(items, "item_id bigint, text string")
    whole = got(ls.search(frame(rows), queries), "item_id", "rank", "doc_id", "score")
    monkeypatch.setattr(ls, "BLOCK_BYTES", 600)
    held = [sum(map(len, b.vocabulary)) for b in ls.blocks(ls.query_rows(queries))]
    assert len(held) > 3 and max(held) <= 600 + max(len((t or "").encode()) for _, t in items)
    assert got(ls.search(frame(rows), queries), "item_id", "rank", "doc_id", "score") == whole


def test_search_with_ties_and_empty_tables(spark, frame):
    docs = [(k, "s", "same words here") for k in range(40)] + [(None, "s", "same words here"), (3, "s", "same words here"), (50, "s", "other things")]
    queries = spark.createDataFrame([("a", "same words")], "item_id string, text string")
    found = ls.search(frame(docs), queries)
    assert [r.doc_id for r in found.sort("rank").collect()] == [0, 1, 2, 3, 3, 4, 5, 6, 7, 8]
    assert ls.search(frame(docs).limit(0), queries).count() == 0
    assert ls.search(frame([(1, "s", None), (2, "s", " . ")]), queries).count() == 0
    assert ls.search(frame(docs), queries.limit(0)).count() == 0


def test_reading_stops_before_the_lists_end():
    """A shard where few documents stand out: the bounds settle the places long before all postings are read."""
    rng = np.random.default_rng(1)
    size, n_terms = 8000, 12
    rows = {(t, d): 1 for t in range(n_terms) for d in rng.choice(size, 3000, replace=False)} | {(t, d): 60 for t in range(n_terms) for d in range(70, 82)}
    term, doc, tf = (np.array(x, np.int64) for x in zip(*[(t, d, n) for (t, d), n in rows.items()]))
    given = ls.Statistics(size, size * 50, np.arange(1, n_terms + 1) * 100)
    lists = ls.Lists(term, doc, tf, rng.integers(20, 80, size), given)
    reads = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            out = super().__getitem__(key)
            if isinstance(key, slice):
                reads.append(out.size)
            return out

    query = ls.Query(0, "q", np.arange(n_terms), np.ones(n_terms, np.int64))
    lists.impact = lists.impact.view(Counted)
    found, scores = lists.best(query, 0)
    plain = np.bincount(lists.document, np.asarray(lists.impact), size).astype(np.int64)
    tenth = np.sort(plain)[-10]
    assert sorted(found) == list(np.flatnonzero(plain >= tenth)) and list(scores) == list(plain[found])
    assert sum(reads) < len(term) / 4
    floor = int(np.sort(plain)[-2])
    reads.clear()
    found, _ = lists.best(query, floor)
    assert sorted(found) == list(np.flatnonzero(plain >= floor)) and sum(reads) < len(term) / 4


# --- URL filters ------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_rule(host, path, rules):
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1?a=/x", "http://www.example.com/en/", "http://www.example.com/EN/", "https://com/", "http://com",
    "http://a.net/es/1", "http://a.net/es", "http://net/fr/#x", "http://xnet/fr/", "http://notexample.com/en/", "http://b.example.com/en/7", "http://u@h.example.org:80/x",
    "x://y://z/en/", "http://a.net?/es/", "http://a.net#/es/", "http://ü.example.net/es/ä", "http://a.net/es/1", "http://" + "a." * 50_000 + "net/fr/x", "http://h.org/" + "p/" * 200_000,
    "http://" + "h" * 300_000 + "/", "http://.com/", "http://example.com./en/", "//example.com/en/",
]


@pytest.fixture(scope="module")
def model(spark):
    return uf.train(uf.labelled_urls(spark))


def test_urls_by_rule_and_model(spark, model):
    pages = spark.createDataFrame([(k, u, "kept") for k, u in enumerate(URLS)], "page_id bigint, url string, host string").repartition(3)
    found = unpacked(uf.judge(pages, URL_RULES, model, ["page_id"])).collect()
    assert len(found) == len(URLS)
    for r in found:
        host, path = plain_parts(URLS[r.page_id])
        rule, verdict = plain_rule(host, path, URL_RULES)
        z = plain_score(host, path, model)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.score == pytest.approx(z, abs=1e-6)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def plain_score(host, path, model):
    """n-grams one by one, in plain integers."""
    z = model.bias
    for seed, part in enumerate((host, path)):
        framed, held = f"^{part.translate(LOWER)}$", set()
        for n in uf.GRAMS if part else ():
            for k in range(len(framed) - n + 1):
                h = seed * 31 + n
                for c in framed[k : k + n]:
                    h = (h ^ ord(c)) * 0x9E3779B1 % 2**32
                    h ^= h >> 15
                held.add(h % uf.BUCKETS)
        z += sum(float(model.weight[b]) for b in held) / math.sqrt(max(1, len(held)))
    return 1 / (1 + math.exp(-z))


def test_longest_rule_of_many():
    rng = random.Random(2)
    hosts = ["a", "b.a", "c.b.a", "x.a", "ab"]
    rules = [(rng.choice(["allow", "block"]), h, p) for h in hosts for p in ["/", "/p", "/p/", "/p/q", "/ö", ""] if rng.random() < 0.7]
    known = uf.Rules(rules)
    for _ in range(500):
        host = rng.choice(["", "d."]) + rng.choice(hosts)
        path = "".join(rng.choice(["/", "p", "q", "ö"]) for _ in range(rng.randint(0, 4)))
        assert (known.of(host.encode(), path.encode()) or (None, None)) == plain_rule(host, path, rules)


def test_model_on_urls_left_out(spark):
    rows = uf.labelled_urls(spark).collect()
    held = [zlib.crc32(r.url.encode()) % 4 == 2 for r in rows]
    model = uf.fit([r.url.encode() for r, h in zip(rows, held) if not h], np.array([r.blocked for r, h in zip(rows, held) if not h], float))
    said = [(r.blocked, model.score(*uf.features(r.url.encode())) >= 0.5) for r, h in zip(rows, held) if h]
    hit = sum(y and s for y, s in said)
    assert hit / sum(s for _, s in said) >= 0.95 and hit / sum(y for y, _ in said) >= 0.85
    names = ["https://greenvalleyhotel.example.org/en/1", "http://ththing.example.net/en/99", "https://marlow-and-sons.example.net/"]
    assert not any(model.score(*uf.features(u.encode())) >= 0.5 for u in names)


def test_training_tables_of_any_kind(spark):
    schema = "url string, blocked int"
    assert uf.train(spark.createDataFrame([], schema)) is None
    assert uf.train(spark.createDataFrame([("http://a/", 1), (None, 0), ("http://b/", 7), ("http://b/", None)], schema)) is None
    rows = [("http://bad.example/", 1), ("http://good.example/", 0)] * 20 + [(None, 1)]
    model = uf.train(spark.createDataFrame(rows, schema))
    assert model.score(*uf.features(b"http://bad.example/")) > 0.5 > model.score(*uf.features(b"http://good.example/"))
    pages = spark.createDataFrame([(1, "http://a.net/es/")] * 2 + [(2, None)], "page_id bigint, url string")
    assert [r.found.verdict for r in uf.judge(pages, URL_RULES, None).sort("row.page_id").collect()] == ["block", "block", "allow"]
    assert uf.judge(pages.limit(0), URL_RULES, model).count() == 0 and uf.allowed(pages, URL_RULES, None).columns == pages.columns


# --- Spelling variants --------------------------------------------------------


def plain_vocabulary(docs, noise=31):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    form = {}
    near = defaultdict(list)
    for w in counts:
        for v in counts:
            if one_edit(w, v):
                near[w].append(v)
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), form[w] and counts[form[w]]))
    return sorted(out, key=repr)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_vocabulary(spark, frame):
    rng = random.Random(6)
    letters = "abcÀÿéZ"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(80)) for _ in range(60)]
    texts += [None, "", "x" * 50_000, "x" * 50_000, "İstanbullu ŁódźŁódź naïveté×÷ 123abcdefgh456 abcdefgh", "\u0100abcdefgh\u0100", "💡abcdefgh💡"]
    rows = [(None if k % 17 == 3 else k % 50, "s", t) for k, t in enumerate(texts)]
    rows += rows[:8]
    got_rows = sp.vocabulary(frame(rows, clashing=True), noise=5).collect()
    assert {r.word: r.n for r in got_rows} == plain_vocabulary([(i, t) for i, _, t in rows], noise=5) and len(got_rows) > 3
    assert sp.vocabulary(frame(rows).limit(0)).count() == 0


def mutated(rng, w, letters):
    k = rng.randrange(len(w))
    return rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])


@pytest.mark.parametrize("tile,points", [(1024, 1 << 20), (8, 1 << 20), (2, 1 << 20), (1024, 60)])
def test_variants_of_words_like_each_other(spark, monkeypatch, tile, points):
    monkeypatch.setattr(sp, "SIDE", 5)
    rng = random.Random(tile)
    letters = "abß"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(40)]
    words = set(base) | {"a" * k for k in range(1, 14)} | {"prefix" + "".join(rng.choice(letters) for _ in range(4)) for _ in range(60)} | {"日本語日本語日", "日本語日本語", "💡💡💡"}
    for w in list(words):
        for _ in range(3):
            words.add(mutated(rng, w, letters) or "b")
    counts = {w: rng.choice([2, 3, 30, 31, 300, 4000, 50_000]) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(4)
    for k, c in enumerate(CLASHING):
        df = df.withColumn(c, F.lit(k))
    assert got(sp.variants(df, tile, points), *COLUMNS) == plain_variants(counts)


def test_chains_of_forms_and_empty_vocabularies(spark):
    counts = {"abcdefgh" + "x" * k: 2 * 10**k for k in range(9)} | {"abcdefg": 20, "é" * 3000: 5, "é" * 2999 + "e": 50, "é" * 2999: 500}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert got(sp.variants(df), *COLUMNS) == plain_variants(counts)
    assert sp.variants(df.limit(0)).count() == 0


def test_pairs_meet_once_and_groups_are_bounded(spark):
    words = {"counter" + a + b + c for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"}
    df = spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n bigint")
    rows = sp.groups(df, tile=32)
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.expr("c - p - s")).alias("between"))
    assert sizes.where("size > 32").count() == sizes.where("size > 32 AND between = 1 AND size <= 64").count()
    pairs = [(r.word, r.near) for r in sp.near_words(df, tile=32).collect()]
    assert len(pairs) == len(set(pairs)) == 512 * 3 * 7


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")
@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_lexical_search"])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    found = QUERIES[name](spark, SF_DIR)
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(found.columns) and got(found, *columns) == sorted(cur.fetchall(), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")
def test_url_query_equals_brute_force(spark, model):
    given = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op12_url_filter"](spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(given)
    for r in rows:
        host, path = plain_parts(given[r.page_id])
        rule, verdict = plain_rule(host, path, URL_RULES)
        z = plain_score(host, path, model)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or ("block" if z >= 0.5 else "allow"))

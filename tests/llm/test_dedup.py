"""Exact, near and substring duplicates, and decontamination, against the contracts in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from quillbank.llm import decontaminate as dec, exact_dedup as ex, simhash as sh, substring_dedup as sub
from quillbank.llm.frames import unpacked
from tests.llm import plain
from tests.llm.conftest import CLASHING, plain_rows


def pairs(rows):
    return [(i, t) for i, _, t in rows]


def test_exact_groups(frame, rows):
    got = plain_rows(ex.groups(frame(rows)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(plain.exact_groups(pairs(rows)), key=repr)


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact_groups_do_not_depend_on_the_split(frame, rows, counters):
    many = rows + [(1000 + k, "s", "Hot text") for k in range(300)]
    got = plain_rows(ex.groups(frame(many), counters), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(plain.exact_groups(pairs(many)), key=repr)
    kept = ex.deduplicate(frame(many, clashing=True), counters)
    assert kept.columns == frame(many, clashing=True).columns
    want = [(i, h) for i, _, _, k, h in plain.exact_groups(pairs(many)) if k]
    assert sorted(((r.doc_id, plain.sha((r.text or "").translate(plain.LOWER))) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert {r[c] for r in kept.collect() for c in ["row"]} == {"kept 0"}


def test_misra_gries_finds_every_frequent_digest(spark):
    rng = random.Random(1)
    values = [b"a"] * 400 + [b"b"] * 300 + [str(rng.random()).encode() for _ in range(500)]
    rng.shuffle(values)
    df = spark.createDataFrame([(bytearray(v),) for v in values], "digest binary").repartition(7)
    found = {bytes(r.digest) for r in ex.candidates(df, 4).collect()}
    assert {b"a", b"b"} <= found and len(found) <= 4


def test_fingerprints_and_components(frame, rows):
    want = plain.near_components(pairs(rows))
    got = plain_rows(sh.near_duplicates(frame(rows), shard_points=8), "doc_id", "fingerprint", "component_id")
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    assert got == sorted(((i, signed(f), c) for i, f, c, _ in want), key=repr)
    kept = sh.one_of_each(frame(rows, clashing=True), shard_points=8)
    assert kept.columns == frame(rows, clashing=True).columns
    ids = [c for i, _, c, _ in want if c is not None]
    lone = {r for _, _, c, r in want if c is None}
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(set(ids))
    assert kept.where("doc_id IS NULL").count() == len(lone)


def test_vantage_point_shards_lose_no_link(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    close = base[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    points = np.unique(np.concatenate([base, close, np.arange(200, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fingerprint bigint")
    links = {(r.a, r.b) for r in sh.stars(df, 3, shard_points=16).collect()}
    groups = sh.Groups(len(points))
    at = {int(p): k for k, p in enumerate(points.view(np.int64))}
    groups.join(np.array([at[a] for a, _ in links]), np.array([at[b] for _, b in links]))
    want = sh.Groups(len(points))
    a, b = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3)
    want.join(a, b)
    every = np.arange(len(points))
    assert Counter(Counter(groups.roots(every).tolist()).values()) == Counter(Counter(want.roots(every).tolist()).values())
    assert (groups.roots(a) == groups.roots(b)).all()


def test_components_of_long_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in sh.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}


@pytest.mark.parametrize("bound", [None, 64])
def test_substring_removal(frame, rows, bound, monkeypatch):
    if bound:  # many blocks and ranges, full sketches
        monkeypatch.setattr(sub, "RANGE_CELLS", 1 << 12)
        monkeypatch.setattr(sub, "CELLS_A_WINDOW", 0.5)
        monkeypatch.setattr(sub, "BLOCK_WINDOWS", 32 * bound)
    found = sub.with_removal(frame(rows, clashing=True))
    want = sorted(plain.removal(pairs(rows)), key=repr)
    assert plain_rows(found.select("row.doc_id", "found.*"), "doc_id", "n_words", "n_removed", "kept") == want
    kept = sub.deduplicate(frame(rows, clashing=True))
    assert kept.columns == frame(rows, clashing=True).columns and kept.count() == len(rows)


def test_messages_stay_in_proportion_to_the_text():
    rng = np.random.default_rng(2)
    for size in (10**8, 5 * 10**8, 3 * 10**10, 3 * 10**11, 3 * 10**12, 10**14):
        sizes = sub.Sizes(size, 13)
        windows = size / sub.BYTES_A_WINDOW / sizes.blocks
        span, cells = 1 << sizes.range_bits, max(1, int(windows / sizes.spans))
        packed = sub.pack(np.sort(rng.integers(0, span, cells)), span)
        assert windows <= 1 << 23 and span <= 1 << 27
        assert sub.ROWS * sizes.blocks * min(sizes.spans, windows) * (len(packed) + 40) < 1.5 * size, size


def test_packed_cells_come_back():
    cells = np.sort(np.array([0, 0, 1, 254, 255, 256, 510, 100_000, 100_000, 1 << 20]))
    for n in range(len(cells) + 1):
        assert sub.unpack(sub.pack(cells[:n], 1 << 21), 1 << 21).tolist() == cells[:n].tolist()
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 50, dtype=np.uint64) * np.uint64(2))
    assert sub.hashes_of(sub.steps(hashes)).tolist() == hashes.tolist()


BENCHMARK = [(1, "alpha beta"), (1, "alpha beta"), (2, None), (3, "..."), (None, "gamma"), (10, "alpha")]


def items(texts):
    long = [t for t in texts if t and len(t.split()) > 30]
    return BENCHMARK + [(20 + k, " ".join(t.split()[3:28])) for k, t in enumerate(long[:12])] + [(50, long[0].split()[0])]


@pytest.mark.parametrize("block_bytes", [dec.BLOCK_BYTES, 300])
def test_contamination(spark, frame, rows, texts, block_bytes, monkeypatch):
    if block_bytes == 300:
        monkeypatch.setattr(dec, "SHARD_WORDS", 50)
    bench = spark.createDataFrame(items(texts), "item_id bigint, text string")
    more = rows + [(900, "s", "x Alpha-BETA y"), (901, "s", "gamma " * 50), (902, "s", "alpha " + "z " * 30)]
    got = dec.find_contamination(frame(more, clashing=True), bench, block_bytes=block_bytes)
    got = got.select("row.doc_id", "found.n_words", "found.n_hit", "found.items", dec.is_contaminated().alias("bad"))
    assert plain_rows(got, "doc_id", "n_words", "n_hit", "items", "bad") == sorted(plain.contamination(pairs(more), items(texts)), key=repr)
    clean = dec.decontaminate(frame(more, clashing=True), bench)
    assert clean.columns == frame(more, clashing=True).columns
    assert clean.count() == sum(not r[-1] for r in plain.contamination(pairs(more), items(texts)))


def test_longest_match_has_its_places(spark, frame):
    bench = spark.createDataFrame([(5, " ".join(f"w{k}" for k in range(40)))], "item_id bigint, text string")
    text = "z " * 7 + " ".join(f"w{k}" for k in range(4, 30)) + " z " + " ".join(f"w{k}" for k in range(14))
    found = dec.find_contamination(frame([(1, "s", text)]), bench).first().found
    assert found.longest.asDict() == {"n_words": 26, "item_id": "5", "item_word": 4, "doc_word": 7}
    assert found.spans == [7, 33, 34, 48]


def test_shards_that_end_in_benchmark_words():
    """Of one document each: closed queries must not read behind the end of a shard."""
    rng = random.Random(12)
    for _ in range(300):
        items = [(str(k), " ".join(rng.choices("abc", k=rng.randint(1, 20)))) for k in range(3)]
        text = " ".join(["z"] * rng.randint(0, 2) + rng.choices("abc", k=rng.randint(1, 20)))
        window = rng.randint(2, 13)
        block = dec.Block.of([(i, t.encode()) for i, t in items], window)
        document = np.array([block.numbers.get(w, 0) for w in dec.words(text.encode())], np.int32)
        [found] = dec._search([document], block)
        hit = {x for b, e in zip(found["spans"][::2], found["spans"][1::2]) for x in range(b, e)}
        [(_, n, n_hit, ids, _)] = plain.contamination([(1, text)], items, window)
        assert (len(document), len(hit), sorted(set(found["items"]))) == (n, n_hit, ids)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    tokens = np.append(rng.integers(0, 4, 500), 0).astype(np.int32)
    order = dec.suffix_array(tokens, 2, 600).tolist()
    run = lambda p: tokens[p : p + int(np.argmin(tokens[p:]))].tolist()
    assert [run(p) for p in order] == sorted(run(p) for p in order)


@pytest.mark.parametrize("n", [0, 1])
def test_tables_without_rows(spark, frame, n):
    some = [(1, "s", None)][:n]
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert ex.groups(frame(some)).count() == ex.deduplicate(frame(some)).count() == n
    assert sh.near_duplicates(frame(some)).count() == sh.one_of_each(frame(some)).count() == n
    assert sub.deduplicate(frame(some)).count() == dec.decontaminate(frame(some), bench).count() == n
    assert unpacked(dec.find_contamination(frame(some), bench), ["n_words"]).count() == n


def test_clashing_names_are_used():
    assert {"row", "found", "a.b"} <= set(CLASHING)

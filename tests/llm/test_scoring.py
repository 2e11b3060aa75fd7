"""Toxicity, secrets and licenses: held-out accuracy and plain Python."""

import random

import numpy as np
from pyspark.sql import functions as F

from quillbank.llm import licenses as li, secrets as se, toxicity as tx
from tests.llm.conftest import CLASHING


def labelled(n, seed=1):
    """Toxic: an insult and a group together; either alone is harmless."""
    rng = random.Random(seed)
    filler = [f"word{k}" for k in range(200)]
    rows = []
    for k in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        said = rng.choices(filler, k=rng.randint(5, 40)) + ["awful"] * a + ["neighbours"] * b
        rng.shuffle(said)
        rows.append((k, " ".join(said), int(a and b)))
    return rows


def test_machine_learns_what_only_pairs_tell():
    rows = labelled(3000)
    known = tx.Buckets()
    x = [tx.text_buckets(t.encode(), known) for _, t, _ in rows]
    y = np.array([r[2] for r in rows], float)
    m = tx.fit(x[:2000], y[:2000], np.ones(2000), features=64, epochs=30)
    score = np.array([m.score_buckets(r) for r in x[2000:]])
    assert ((score > 0.5) == y[2000:]).mean() > 0.97


def test_pairs_whose_terms_are_even_alone():
    rng = random.Random(6)
    filler, rows = [f"w{k}" for k in range(200)], []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((" ".join(rng.choices(filler, k=12) + ["xab"] * a + ["yab"] * b), int(a == b)))
    known = tx.Buckets()
    x = [tx.text_buckets(t.encode(), known) for t, _ in rows]
    y = np.array([r[1] for r in rows], float)
    m = tx.fit(x[:3000], y[:3000], np.ones(3000), epochs=30)
    score = np.array([m.score_buckets(r) for r in x[3000:]])
    assert ((score > 0.5) == y[3000:]).mean() > 0.95


def test_a_rare_insult_is_learnt_from_all_labels(spark, frame):
    rows = [(i, t + " dreadful" * y + " scoundrel" * (i % 100 == 1), int(y or i % 100 == 1)) for i, t, y in labelled(3000)]
    docs = frame([(i, "s", t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    machine = tx.train(docs, labels, sample=150)
    said = frame([(1, "s", "word1 word2 word3 scoundrel"), (2, "s", "word1 word2 word3")])
    got = {r.row.doc_id: r.found.score for r in tx.with_score(said, machine).collect()}
    assert got[1] >= tx.THRESHOLD > got[2]


def test_scores_of_held_out_rows(spark, frame):
    rows = labelled(1200)
    docs = frame([(i, "s", t) for i, t, _ in rows] + [(5000, "s", None), (5001, None, ""), (None, "s", "awful neighbours"), (5002, "s", "w " * 30_000), (1, "s", rows[1][1])], clashing=True)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, None), (None, 1), (3, 7), (99_999, 1)], "doc_id bigint, toxic int")
    got = tx.score(docs, labels).collect()
    assert len(got) == 1205 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.93
    kept = tx.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_scores_do_not_depend_on_held_out_labels(spark, frame):
    rows = labelled(300)
    docs = frame([(i, "s", t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    turned = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda lab: sorted((r.doc_id, round(r.score, 9)) for r in tx.score(docs, lab).collect())
    assert score(labels) == score(turned)


def test_without_labels_or_documents(spark, frame):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    assert [r.score for r in tx.score(frame([(1, "s", "x")]), none).collect()] == [0.0]
    assert tx.score(frame([]), one).count() == 0 and tx.score(frame([(1, "s", "x")]), one).count() == 1


def secret_rows():
    rng = random.Random(2)
    word = lambda: rng.choice(["north", "wind", "over", "hill", "water", "stone"])
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for k in range(400):
        noise = rng.choice([f"password=a1{hexes(16)}", f'token = "b2{hexes(38)}"', "AKIA" + "".join(rng.choice("ABCDEFGH234567") for _ in range(16)),
                            str(rng.randint(10**15, 10**16)), f"north-wind-over-hill-{k}-water-stone", f"/docs/water/stone{k}/north/wind"])
        rows.append((k, "lib/main", f"{word()} {word()}\n{word()} {noise} {word()} {word()}\n{word()}"))
    return rows


def test_forest_on_held_out_findings(spark):
    rows = secret_rows() + [(900, None, None), (901, "x", ""), (902, "tests/x", "plain " * 5000), (None, "x", "token = a1b2c3d4e5f6a7b8c9"), secret_rows()[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    for k, c in enumerate(CLASHING):
        docs = docs.withColumn(c, F.lit(k))
    got = se.scan(docs).collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400]
    truth = {i: "password" in t or "token" in t or "AKIA" in t for i, _, t in rows[:400]}
    assert len(held) == 401 and len([r for r in got if r.doc_id is None]) == 1
    ids = {r.doc_id for r in spark.range(400).where(se.held_out(F.col("id"))).select(F.col("id").alias("doc_id")).collect()}
    right = [r.secret == truth[r.doc_id] for r in held if r.doc_id in ids]
    assert len(right) > 60 and sum(right) / len(right) > 0.95


def test_assigned_values_of_any_form_are_candidates(spark):
    given = {
        "password=Tr0ub4dor&3": "Tr0ub4dor&3", 'token: "abcdefgh"': "abcdefgh", "secret = correcthorse;": "correcthorse", "db_password=a!b@c": "a!b@c",
        "api_key=0123456789abcdef&0123456789abcdef": "0123456789abcdef&0123456789abcdef", "password=north1234567890abc": "north1234567890abc",
    }
    docs = spark.createDataFrame([(k, "x", f"so {t} here") for k, t in enumerate(given)], "doc_id bigint, path string, text string")
    assert sorted((r.doc_id, r.value) for r in se.candidates(docs).collect()) == list(enumerate(given.values()))


def test_labels_know_issuers_and_leave_unknown_values_open(spark):
    values = {"ghp_" + "a1B2" * 9: 1, "sk_live_" + "a1B2" * 6: 1, "AKIA" + "ABCDEFG2" * 2: 1, "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzz": None, "1234567890123456": 0, "north-wind-over-hill-3": 0}
    docs = spark.createDataFrame([(k, "x", f"so {v} here") for k, v in enumerate(values)], "doc_id bigint, path string, text string")
    got = {r.value: r.label for r in se.candidates(docs).select("value", se.issued_format().alias("label")).collect()}
    assert got == values


def test_secret_scan_without_findings(spark):
    schema = "doc_id bigint, path string, text string"
    assert se.scan(spark.createDataFrame([], schema)).count() == 0
    assert [r.score for r in se.scan(spark.createDataFrame([(1, None, "x 1234567890123456")], schema)).collect()] == [0.0]


def test_features_of_a_candidate(spark):
    text = "the word north is here\npassword=north1234567890abc here\nnorth"
    docs = spark.createDataFrame([(1, "tests/a.py", text), (2, "b", "north here")], "doc_id bigint, path string, text string")
    r = se.describe(docs).first()
    assert (r.line_no, r.word_no, r.value, r.length, r.key_before, r.assigned, r.quiet_path, r.path_depth) == (1, 0, "north1234567890abc", 18.0, 1, 1, 1, 1)
    assert r.coverage == 5 / 18 and r.transitions == 2 / 18


FILES = [
    ("LICENSE", "Released under the MIT License."), ("a/LICENSE.txt", "x\nLicensed under the Apache License, Version 2.0.\ny"),
    ("a/b/c/x.py", "no"), ("a/b/c/y.py", "# Licensed under CC BY-NC 4.0."), ("ab/z", "no"), ("top", None), (None, "no"), ("a/b/COPYING", "nothing"),
    ("d/licence", "SPDX-License-Identifier: Apache-2.0"), ("d/LICENSE", "Released under the MIT License."), ("d/e/f", ""), ("a/b/c/x.py", "no"),
    ("g/h", "word " * 30_000 + "\nThis work is licensed under the GNU General Public License, version 3.\n" + "word " * 9000),
]


def test_licenses_are_found_and_inherited(spark):
    df = spark.createDataFrame([(k, p, t) for k, (p, t) in enumerate(FILES)], "doc_id bigint, path string, text string").withColumn("dir", F.lit(1)).withColumn("license", F.lit("x"))
    got = {r.doc_id: (r.own_license, r.license, r.from_dir) for r in li.licenses(df).collect()}
    mit, apache = ("MIT", "MIT", None), ("Apache-2.0", "Apache-2.0", None)
    assert got == {
        0: mit, 1: apache, 2: (None, "Apache-2.0", "a"), 3: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None), 4: (None, "MIT", ""), 5: (None, "MIT", ""),
        6: (None, None, None), 7: (None, "Apache-2.0", "a"), 8: apache, 9: mit, 10: (None, "Apache-2.0", "d"), 11: (None, "Apache-2.0", "a"),
        12: ("GPL-3.0-only", "GPL-3.0-only", None)}
    assert li.licenses(df.limit(0)).count() == 0


def test_near_misses_are_not_another_license():
    templates = li.Templates.of(li.TEMPLATES, 1000, {})
    name = lambda text: (li.scan(text.encode(), templates) or (0, None))[1]
    for given in ("MPL-2.0", "GPL-2.0-only", "ISC", "BSD-2-Clause"):
        assert name(f"// SPDX-License-Identifier: {given}") == given
    notice = ("This {} is free software; you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as published by\n"
              "the Free Software Foundation; either version {} of the License, or\n(at your option) any later version.")
    assert name(notice.format("program", "", "2")) == "GPL-2.0-or-later"
    assert name(notice.format("program", "", "3")) == "GPL-3.0-or-later"
    assert name(notice.format("library", "Lesser ", "2.1")) == "LGPL-2.1-or-later"
    assert name(notice.format("program", "Affero ", "3")) == "AGPL-3.0-or-later"


def cosine(line, templates):
    terms = li.words(line)
    weight = lambda t: templates.weight.get(t, templates.other)
    vector = {t: terms.count(t) * weight(t) for t in terms}
    size = sum(x * x for x in vector.values()) ** 0.5
    return max((round(sum(x * v.get(t, 0) for t, x in vector.items()) / size, 9), ) for v in templates.vectors)[0] if terms else 0


def test_skipped_lines_could_not_have_matched():
    rng = random.Random(5)
    terms = sorted({t for _, text in li.TEMPLATES for t in li.words(text.encode())}) + [b"other", b"thing"]
    templates = li.Templates.of(li.TEMPLATES, 1000, {t: rng.randint(0, 900) for t in terms[:-2]})
    for _ in range(500):
        line = b" ".join(rng.choices(terms, k=rng.randint(1, 12)))
        best, want = templates.best(li.words(line), 0.4), cosine(line, templates)
        assert (round(best[0], 9) == want) if best else want < 0.4 + 1e-9


def long_values():
    n = 100_000
    return [
        "ab-" * n + "c1", "a1/" * n, "x_" * n + "9", "key_" * n + "1", "key" * n + "=v1", "token " * n + "= a1b2c3d4", "secret.key-" * n + ": a1b2c3d4", "a" * (10 * n),
        "A1b2+/" * n, "-" * n + "1", "password=" + "ab-" * n + "c1", "password=" * n + "z9", "key = " * n, "f0" * n, "[" * n + "token" + "]" * n + "=a1b2", "token" + "\t" * n + "= a1b2c3d4",
        "eyJ" + "a1b2c3d4." * n, "passphrase: " + "=" * n, "7" * n, '"' * n + "key" + '"' * n + ":" + '"' * n + "a1", "one two 3 " * n,
    ]


def test_long_values_of_many_shapes_end(spark):
    """Repeated groups overflow the stack of a JVM, patterns that start anew at each character never end."""
    docs = spark.createDataFrame([(k, "p", f"password = a1b2c3d4e5f6a7b8c9{k:04d}\n{v}") for k, v in enumerate(long_values())], "doc_id bigint, path string, text string")
    got = se.scan(docs).select("doc_id", "value", "secret").collect()
    assert {r.doc_id for r in got} == set(range(len(long_values())))
    assert any(r.value == "ab-" * 100_000 + "c1" for r in got) and max(len(r.value) for r in got) > 600_000


def test_values_that_are_no_keys_by_form(spark):
    """The repeated group, matched in Python on short values."""
    import re

    joined = re.compile(r"[/_+-]*[a-z]+[0-9]{0,4}([/_+-]+([a-z]+[0-9]{0,4}|[0-9]{1,8}))+[/_+-]*")
    rng = random.Random(8)
    values = ["".join(rng.choice("ab1290_-/+A") for _ in range(rng.randint(1, 12))) for _ in range(3000)] + ["ab-cd", "-ab-1", "1-ab", "ab", "", "--"]
    rows = spark.createDataFrame([(v,) for v in values], "value string").select("value", se.no_key(F.col("value")).alias("no"), F.col("value").rlike(se.NO_KEY).alias("listed")).collect()
    assert all(r.no == bool(r.listed or joined.fullmatch(r.value)) for r in rows) and any(r.no and not r.listed for r in rows)


def test_candidates_equal_brute_force(spark):
    """Runs and assigned values, by patterns that may repeat and look back as they like in Python on short lines."""
    import re

    rng = random.Random(9)
    parts = ["token", "my_secret", "key", "monkey", "api-key", "=", ":", " = ", "=>", " ", " ", '"', "'", "]", "a1b2c3d4e5f6a7b8c9", "north-wind-over-hill-1", "plain", "x1", ",", "(", "\n", "keyed", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    key = se._KEY
    assigned = re.compile(rf"(?i)(?:^|[^a-z]){key}[a-z0-9_.-]*[\"'\]]*(?::=|=>|[=:])[\"'`]*([^\s\"'`]+)")
    names = re.compile(rf"(?i)(?:^|[^a-z]){key}[a-z0-9_.-]*[\"'\]]*\s*(?::=|=>|[=:])$")
    expect = set()
    for i, text in enumerate(texts):
        for line_no, line in enumerate(text.split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            for k, word in enumerate(words):
                before = " ".join([*[""] * max(0, 3 - k), *words[max(0, k - 3) : k]])
                inside = assigned.search(word)
                whole = names.search(before) and not re.match("^[=:]+$", word) and re.match("[\"'`]*([^\"'`]+)", word)
                given = re.sub(r"[,;)\]]+$", "", inside[1] if inside else whole[1] if whole else "")
                runs = re.findall("[A-Za-z0-9+/_-]{16,}", word)
                digit = [(p, r) for p, r in enumerate(runs) if re.search("[0-9]", r)]
                if given and given not in [r for _, r in digit]:
                    digit = [(p, r) for p, r in digit if r not in given] + [(len(runs), given)]
                expect |= {(i, line_no, k, p, v) for p, v in digit}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("path", F.lit("p"))
    got = {(r.doc_id, r.line_no, r.word_no, r.part, r.value) for r in se.candidates(docs).collect()}
    assert got == expect and len(got) > 500

"""Files that cannot be read, documents as files, and the run counters."""

import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quillbank import fixed_values as fv
from quillbank.operators.clean import clean
from quillbank.operators.enrich import enrich
from quillbank.plans import reports
from quillbank.plans.migrate import classify, run_counters
from quillbank.sources import json_files as jf, sinks
from quillbank.sources.documents import list_documents, read_documents, read_reference, scan_documents, unreadable
from tests.samples import document, part
from tests.test_jobs import named, write


def spoil(path):
    """A checksum that the file doesn't have: the file system refuses to hand out its bytes."""
    (path.parent / f".{path.name}.crc").write_bytes(b"crc\x00\x00\x00\x02\x00" + b"\x12\x34\x56\x78" * 64)


@pytest.fixture()
def folder(tmp_path):
    """Two documents that can be read, and one each that is spoiled, truncated behind its checksum, and gone when it is read."""
    write(tmp_path / "in dir", {"a/1.json": named(1, part("frq")), "2.json": named(2, part("mcq")), "a/bad é.json": named(3, part("frq")),
                                "b/cut.json": json.dumps(named(4, part("frq"))) * 50, "gone.json": named(5, part("frq"))})
    spoil(tmp_path / "in dir/a/bad é.json")
    cut = tmp_path / "in dir/b/cut.json"
    spoil(cut)
    cut.write_bytes(cut.read_bytes()[:700])
    return tmp_path / "in dir"


LOST = ["bad é.json", "cut.json", "gone.json"]


def test_listed_but_not_read(spark, folder, tmp_path):
    list_documents(spark, str(folder)).write.parquet(str(tmp_path / "listed"))
    listed = spark.read.parquet(str(tmp_path / "listed"))
    read = read_documents(spark, str(folder), tolerant=True)
    assert sorted(r.filename for r in listed.collect()) == ["1.json", "2.json", *LOST] and all(r.n_bytes > 0 for r in listed.collect())
    (folder / "gone.json").unlink()
    assert sorted(r.filename for r in read.collect()) == ["1.json", "2.json"]
    lost = unreadable(listed, read).collect()
    assert sorted(r.filename for r in lost) == LOST and all(r.raw is None and r.path.endswith(r.filename) for r in lost)


def test_a_scan_that_is_not_tolerant_fails(spark, folder):
    with pytest.raises(Exception, match="(?i)checksum"):
        read_documents(spark, str(folder)).collect()


def test_unreadable_files_are_rows_of_the_migration(spark, folder, tmp_path, monkeypatch):
    real = sinks.read_documents

    def read_then_lose(*args, **kwargs):
        out = real(*args, **kwargs)
        (folder / "gone.json").unlink()
        return out

    monkeypatch.setattr(sinks, "read_documents", read_then_lose)
    out = sinks.migrate(spark, str(folder), str(tmp_path / "out"))
    summary = out["summary"].first()
    assert (summary.total, summary.success, summary.conversion_failed) == (5, 2, 3)
    errors = {r["Filename"]: r for r in out["errors"].collect()}
    assert sorted(errors) == LOST and {r["Error Message"] for r in errors.values()} == {fv.MESSAGES["X11"]}
    assert {r["Question ID"] for r in errors.values()} == {"unknown"} and {r.rule_id for r in errors.values()} == {"X11"}
    assert {r.payload for r in out["bank"].where(F.col("outcome") == fv.CONVERSION_FAILED).collect()} == {None}


def test_unreadable_files_in_dry_runs_and_with_types(spark, folder, tmp_path):
    dry = sinks.migrate(spark, str(folder), str(tmp_path / "dry"), dry_run=True)
    assert dry["summary"].first().total == 5 and dry["summary"].first().conversion_failed == 2 and not (tmp_path / "dry").exists()
    kept = sinks.migrate(spark, str(folder), str(tmp_path / "out"), types=["frq"])
    assert kept["summary"].first().asDict()["total"] == 2
    assert scan_documents(spark, str(folder)).where("raw IS NULL").count() == 2


def test_unreadable_files_of_the_companion_jobs(spark, folder, tmp_path):
    (tmp_path / "r.csv").write_text("base_question_id,section_id\n1,2\n")
    sinks.enrich_folder(spark, str(folder), str(tmp_path / "r.csv"), str(tmp_path / "e"), recursive=True)
    sinks.clean_folder(spark, str(folder), str(tmp_path / "c"))
    for name in ("e", "c"):
        assert spark.read.parquet(str(tmp_path / name)).count() == 3
        errors = spark.read.parquet(str(tmp_path / f"{name}_errors")).collect()
        assert sorted((r.filename, r.reason) for r in errors) == [("bad é.json", "unreadable"), ("cut.json", "unreadable")]


def tree(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read()
            for d, _, files in os.walk(folder) for f in files if not f.endswith(".crc")}


def test_cleaned_files_mirror_the_folder(spark, tmp_path):
    rng = random.Random(1)
    names = [f"{'/'.join(rng.choice(['a', 'b c', 'é', 'x+y']) for _ in range(rng.randint(0, 3)))}/{k}.json".lstrip("/") for k in range(60)]
    write(tmp_path / "in", {n: json.dumps({"s": "<p>ü</p>", "n": n}, ensure_ascii=False) for n in names})
    base = str(tmp_path / "in")
    outside = sinks.write_cleaned_files(clean(read_documents(spark, base).repartition(7), base), str(tmp_path / "out"))
    assert outside.count() == 0 and tree(tmp_path / "out") == tree(tmp_path / "in")
    assert sorted(os.listdir(tmp_path / "out")) == sorted(os.listdir(tmp_path / "in"))


def test_payloads_and_enriched_documents_as_files(spark, tmp_path):
    write(tmp_path / "in", {"a/1.json": named(1, part("frq")), "b/1.json": named(1, part("frq", stem=None)), "3.json": "{"})
    base = str(tmp_path / "in")
    sinks.write_bank_files(classify(read_documents(spark, base)), base, str(tmp_path / "out"))
    got = tree(tmp_path / "out")
    assert sorted(got) == sorted([f"{fv.CONVERTED}/a/1.json", f"{fv.PRE_FAILED}/b/1.json", f"{fv.CONVERSION_FAILED}/3.json"])
    assert got[f"{fv.PRE_FAILED}/b/1.json"] == (tmp_path / "in/b/1.json").read_bytes() and got[f"{fv.CONVERSION_FAILED}/3.json"] == b"{"
    (tmp_path / "r.csv").write_text("base_question_id,section_id\n1,2\n")
    enriched = enrich(read_documents(spark, base), read_reference(spark, str(tmp_path / "r.csv")))
    sinks.write_enriched_files(enriched, base, str(tmp_path / "e"))
    assert sorted(tree(tmp_path / "e")) == ["frq/a/1.json", "frq/b/1.json"]


def test_overwriting_appending_and_paths_outside(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame(list(rows), "rel_path string, text string")
    put = lambda df, mode: sinks.write_files(df, F.col("rel_path"), F.col("text"), str(tmp_path / "o"), mode)
    bad = ["../x", "/x", "a/../b", "", ".", "a//b", "_temporary/x", "_temporary", "a/", "./x", None]
    outside = put(frame(("a/1", "one"), ("n", None), *[(b, "x") for b in bad]), "overwrite")
    assert outside.count() == len(bad) and tree(tmp_path / "o") == {"a/1": b"one"} and os.listdir(tmp_path) == ["o"]
    put(frame(("a/2", "")), "append")
    assert tree(tmp_path / "o") == {"a/1": b"one", "a/2": b""}
    put(frame(("..a/b..", "new")), "overwrite")
    assert tree(tmp_path / "o") == {"..a/b..": b"new"} and os.listdir(tmp_path / "o") == ["..a"]
    put(frame(), "overwrite")
    assert tree(tmp_path / "o") == {}


def batch(*rows):
    paths, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["rel_path", "text"])


def test_retried_tasks_leave_no_half_files(tmp_path):
    """The phases as a scheduler runs them: an attempt fails midway, its retry and a doubled attempt succeed, one of them counts."""
    writer = jf.FilesWriter(str(tmp_path / "o"), False)

    def failing():
        yield batch(("a/1", "half"))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(failing())
    whole = [batch(("a/1", "one"), ("a/2", "two"))]
    done, doubled, empty = writer.write(iter(whole)), writer.write(iter(whole)), writer.write(iter([]))
    assert tree(tmp_path / "o").keys() & {"a/1", "a/2"} == set() and (done.n_files, empty.n_files) == (2, 0) and doubled.attempt != done.attempt
    writer.commit([done, empty, None])
    assert tree(tmp_path / "o") == {"a/1": b"one", "a/2": b"two"} and os.listdir(tmp_path / "o") == ["a"]
    other, third = jf.FilesWriter(str(tmp_path / "o"), True), jf.FilesWriter(f"file://{tmp_path}/o", False)
    message = other.write(iter([batch(("b", "x"))]))
    kept = third.write(iter([batch(("c", "y"))]))
    other.abort([message, None])
    assert set(tree(tmp_path / "o")) - {"a/1", "a/2"} == {f"_temporary/{third.run}/{kept.attempt}/c"}
    third.commit([kept])
    assert set(tree(tmp_path / "o")) == {"a/1", "a/2", "c"} and sorted(os.listdir(tmp_path / "o")) == ["a", "c"]


def test_a_failing_job_leaves_the_folder_as_it_was(spark, tmp_path):
    jf.register(spark)
    good = spark.createDataFrame([("a", "kept")], "rel_path string, text string")
    good.write.format(jf.FORMAT).mode("append").save(str(tmp_path / "o"))
    rows = spark.range(0, 40, 1, 4).selectExpr("concat('f', id) AS rel_path", "IF(id = 39, raise_error('no'), 'x') AS text")
    with pytest.raises(Exception):
        rows.write.format(jf.FORMAT).mode("append").save(str(tmp_path / "o"))
    assert {k: v for k, v in tree(tmp_path / "o").items() if not k.startswith("_temporary/")} == {"a": b"kept"}
    assert spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "o")).count() == 1


def test_run_counters_equal_the_summary(spark, tmp_path):
    raws = [json.dumps(document(part("frq"), question_id=str(k), metadata={"id": 1, "mapped_id": k})) for k in range(7)] + ["{", None]
    frame = spark.createDataFrame([(f"/in/{k}.json", f"{k}.json", r) for k, r in enumerate(raws)], "path string, filename string, raw string")
    counted = Observation()
    classify(frame, counted).write.format("noop").mode("overwrite").save()
    assert run_counters(counted) == reports.summary(classify(frame)).first().asDict()
    empty = Observation()
    classify(frame.limit(0), empty).write.format("noop").mode("overwrite").save()
    assert run_counters(empty)["success_rate"] is None and run_counters(empty)["all_converted"]

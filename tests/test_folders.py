"""Folders listed, read and written by tasks."""

from __future__ import annotations

import fnmatch
import re

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from images import draw_tree
from tessera import sources
from tessera.operators.sampling import sample_images
from tessera.sinks.files import write_files
from tessera.sources.files import with_contents
from tessera.sources.folders import glob_expression, reading_tasks


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    root = draw_tree(spark, tmp_path_factory.mktemp("images"))
    (root / "deep" / "er" / "est").mkdir(parents=True)
    (root / "deep" / "er" / "est" / "é +%41.jpg").write_bytes(b"x" * 5)
    (root / "_skipped").mkdir()
    (root / "_skipped" / "a.jpg").write_bytes(b"x")
    (root / ".hidden.jpg").write_bytes(b"x")
    (root / "empty").mkdir()
    (root / "top.jpg").write_bytes(b"y")
    return root


def test_the_same_images_as_the_file_source(spark, tree):
    ours = sources.listed_images(spark, str(tree))
    theirs = sources.labelled_images(spark, str(tree))
    assert ours.columns == theirs.columns
    columns = ["path", "length", "content", "label", "modificationTime"]

    def rows(df):
        return sorted(
            (r.path, r.length, bytes(r.content), r.label, r.modificationTime.replace(microsecond=0))
            for r in df.select(*columns).collect()
        )

    assert rows(ours) == rows(theirs)
    assert ours.count() == 15


def test_the_tree_is_not_indexed_on_the_driver(spark, tree):
    plan = sources.listed_files(spark, str(tree))._jdf.queryExecution().toString()
    assert str(tree) not in plan


def test_names_and_levels(spark, tree):
    names = {r.name for r in sources.listed_files(spark, str(tree), "*.jpg").collect()}
    assert {"top.jpg", "deep/er/est/é +%41.jpg", "Kiwi/broken.jpg"} <= names
    assert not any("skipped" in n or "hidden" in n for n in names)
    flat = sources.listed_files(spark, str(tree), recursive=False).collect()
    assert [r.name for r in flat] == ["top.jpg"]
    assert sources.listed_files(spark, str(tree / "empty")).count() == 0
    with pytest.raises(PySparkException, match="absent"):
        sources.listed_files(spark, str(tree / "absent"))


@pytest.mark.parametrize("pattern", ["*.jpg", "a?c", "[abc]*", "[!a]x", "x", "*.*", "a.b"])
@pytest.mark.parametrize("name", ["a.jpg", "abc", "axc", "bx", "ax", "x", "aXb", "a.b"])
def test_globs(pattern, name):
    assert bool(re.fullmatch(glob_expression(pattern), name)) == fnmatch.fnmatchcase(name, pattern)


def test_globs_with_alternatives():
    either = re.compile(glob_expression("*.{jpg,p[n]g}"))
    assert [bool(either.fullmatch(n)) for n in ("a.jpg", "a.png", "a.gif", "a.{jpg")] == [True, True, False, False]
    assert re.fullmatch(glob_expression(r"a\*{b}"), "a*b")
    with pytest.raises(ValueError, match="unclosed"):
        glob_expression("{a")


def test_sampled_images_are_read_by_many_tasks(spark, tree, monkeypatch):
    monkeypatch.setattr("tessera.operators.sampling.FILES_PER_TASK", 1)
    sample = sample_images(spark, str(tree), 12)
    rows = sample.rows.collect()
    assert len(rows) == 12 == sum(r.quota for r in sample.plan.collect())
    assert all(len(r.content) == r.length for r in rows)
    assert sum(n > 0 for n in sample.rows.rdd.glom().map(len).collect()) > 4


def test_written_files_come_back(spark, tmp_path):
    rows = [(f"c{i % 3}/{i}.bin", bytes([i]) * i) for i in range(40)] + [("null.bin", None)]
    written = write_files(spark.createDataFrame(rows, "name string, content binary"), str(tmp_path))
    assert {(r.name, r.length) for r in written.collect()} == {(n, len(c or b"")) for n, c in rows}
    back = sources.read_files(sources.listed_files(spark, str(tmp_path)), 5)
    assert {(r.name, bytes(r.content)) for r in back.collect()} == {(n, c or b"") for n, c in rows}


def test_tasks_that_read_stay_few_however_many_files():
    assert [reading_tasks(n, n * 1000, 12) for n in (0, 31, 320, 3_200)] == [1, 1, 10, 48]
    assert reading_tasks(3_000_000, 6 << 30, 12) == 367
    assert reading_tasks(4_000, 1 << 40, 12) == 125
    assert reading_tasks(1 << 20, 1 << 40, 12) == 4096


def test_small_files_share_batches(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i % 251]) * (i % 7) if i != 150 else b"x" * (3 << 20))
    batches = with_contents(sources.listed_files(spark, str(tmp_path)).coalesce(1))

    def sizes(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows])], names=["n"])

    counts = [r.n for r in batches.mapInArrow(sizes, "n long").collect()]
    assert sum(counts) == 300 and len(counts) < 30
    got = {r.name: bytes(r.content) for r in batches.collect()}
    assert got == {p.name: p.read_bytes() for p in tmp_path.iterdir()}


@pytest.mark.parametrize("bad", ["/etc/x", "a/../../x", "", None, "taken"])
def test_a_failing_attempt_leaves_no_part(spark, tmp_path, bad):
    (tmp_path / "taken" / "by a folder").mkdir(parents=True)
    rows = spark.createDataFrame([(bad, b"abc")], "name string, content binary")
    with pytest.raises(PySparkException):
        write_files(rows, str(tmp_path))
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == []

"""Accepted values, headers file by file, large artifacts, manifests and evaluated layers."""

from __future__ import annotations

import hashlib
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.operators import contracts
from sievework.operators.contracts import accepted_values
from sievework.operators.ledger import unknown_manifest_fields
from sievework.operators.model import layer_measures
from sievework.operators.skew import heavy_keys
from sievework.sources.artifacts import scan_artifacts
from sievework.sources.delimited import header_drift


def rows(frame) -> Counter:
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("listed", [10_000, 2])
def test_values_that_are_not_listed(spark, monkeypatch, listed):
    monkeypatch.setattr(contracts, "LISTED_VALUES", listed)
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), (None, None), ("A", 3)], "s string, `n.x` int")
    allowed = spark.createDataFrame([("s", "a"), ("s", "a"), ("n.x", "1"), ("n.x", "3")], "column string, value string")
    assert rows(accepted_values(frame, allowed)) == Counter([("s", "b", 2), ("s", "A", 1), ("n.x", "2", 1)])
    assert rows(accepted_values(frame, allowed, ["s"])) == Counter([("s", "b", 2), ("s", "A", 1)])
    # a column without any allowed value accepts NULL alone
    none = allowed.filter("column = 's'")
    assert rows(accepted_values(frame, none, ["n.x"])) == Counter([("n.x", "1", 2), ("n.x", "2", 1), ("n.x", "3", 1)])
    assert accepted_values(frame.limit(0), allowed).collect() == []


def test_a_short_list_is_tested_where_rows_are_read(spark):
    frame = spark.createDataFrame([("a",)], "s string")
    plan = accepted_values(frame, spark.createDataFrame([("s", "a")], "column string, value string"))._jdf.queryExecution()
    assert "Join" not in plan.executedPlan().toString()


def test_headers_file_by_file(spark, tmp_path):
    files = {
        "good.csv": "a,b,c\n1,2,3\n", "quoted.csv": '"a","b",c\r\n', "bom.csv": "﻿a,b,c", "moved.csv": "b,a,c\n1,2,3",
        "short.csv": "a,b\n", "long.csv": "a,b,c,d\n", "empty.csv": "\na,b,c\n", "nothing.csv": "", "deep/other.csv": "a,b,C\n",
    }
    (tmp_path / "deep").mkdir()
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    found = header_drift(spark, str(tmp_path), ["a", "b", "c"]).withColumn("file", F.regexp_extract("file", "[^/]+$", 0))
    assert rows(found) == Counter([
        ("moved.csv", 0, "a", "b"), ("moved.csv", 1, "b", "a"), ("short.csv", 2, "c", None), ("long.csv", 3, None, "d"),
        ("empty.csv", 0, "a", None), ("empty.csv", 1, "b", None), ("empty.csv", 2, "c", None), ("other.csv", 2, "c", "C")])


@pytest.mark.parametrize("above", [0, 10, 1 << 31])
def test_files_of_any_size_have_one_digest(spark, tmp_path, above):
    contents = {"empty.bin": b"", "ten.bin": b"0123456789", "more bytes.bin": bytes(range(256)) * 50_000}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    found = scan_artifacts(spark, str(tmp_path), stream_above=above).collect()
    got = {r["path"].rsplit("/", 1)[1].replace("%20", " "): (r["sha256"], r["size_bytes"]) for r in found}
    # Spark passes over files without a byte
    assert got == {n: (hashlib.sha256(c).hexdigest(), len(c)) for n, c in contents.items() if c}


def test_a_file_beyond_two_gigabytes_is_streamed(spark, tmp_path):
    size = (1 << 31) + 12345
    with open(tmp_path / "sparse.bin", "wb") as out:
        out.truncate(size)  # a hole, which takes no disk
    expected, zeros = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size >> 24):
        expected.update(zeros)
    expected.update(zeros[: size & ((1 << 24) - 1)])
    row = scan_artifacts(spark, str(tmp_path)).first()
    assert (row["sha256"], row["size_bytes"]) == (expected.hexdigest(), size)


def test_unknown_fields_of_manifests(spark):
    good = {"manifest_version": 1, "run_id": "r", "source": {"id": "TS", "edition": "e", "version": 1},
            "artifacts": [{"kind": "csv", "etag": None}, {"sha256": "0"}]}
    bad = {**good, "x": 1, "A": {"id": 2}, "source": {"id": 1, "title": "t"}, "artifacts": [{"kind": "csv"}, {"md5": 1, "name": "n"}]}
    docs = [good, bad, {}, {"source": 5, "artifacts": "none"}]
    frame = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(9, None), (10, "{oops")], "i int, d string")
    assert rows(unknown_manifest_fields(frame, "i", "d")) == Counter([
        (1, "manifest", "A"), (1, "manifest", "x"), (1, "source", "title"), (1, "artifact 1", "md5"), (1, "artifact 1", "name")])


def test_layers_are_evaluated_in_one_aggregation(spark):
    frame = spark.range(10)
    doubled = frame.select((F.col("id") * 2).alias("v"))
    measured = layer_measures({"a": (frame, "id"), "b": (doubled, "v"), "none": (doubled.limit(0), "v")})
    assert rows(measured) == Counter([("a", 10, 45), ("b", 10, 90)])


def test_no_sketch_is_made_where_no_key_can_be_heavy(spark, monkeypatch):
    from sievework.operators import skew

    def never(*_):
        raise AssertionError("a sketch was made")

    frame = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.lit(1).alias("one"))
    monkeypatch.setattr(skew, "sketched_counts", never)
    assert heavy_keys(frame, ["k"], min_rows=30_000) == []  # fewer rows than that in all
    assert heavy_keys(frame, ["k"], min_rows=1000) == []  # no class has as many
    assert heavy_keys(frame, ["one"], min_rows=1000, among=F.col("k") < 0) == []
    monkeypatch.undo()
    skewed = frame.unionByName(spark.range(1500).select(F.lit(7).cast("long").alias("k"), F.lit(1).alias("one")))
    assert len(heavy_keys(skewed, ["k"], min_rows=1000)) == 1

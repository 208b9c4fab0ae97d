from __future__ import annotations

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from sievework.functions.canonical import canonical_hash, canonical_json
from sievework.functions.keys import (
    composite_key,
    content_key,
    row_fingerprint,
    strict_fingerprint,
    surrogate_key,
)
from sievework.functions.status import job_status, parse_status
from sievework.functions.text import any_missing, trim_columns
from sievework.operators.ledger import with_fingerprint
from sievework.operators.provenance import PROVENANCE, RunMetadata, with_provenance
from sievework.operators.rules import classify, split, standard_rules


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def one(frame, *columns):
    return tuple(frame.select(*columns).first())


def test_keys_and_null_handling(spark):
    frame = spark.createDataFrame([("a", 2, None)], "x string, y int, z string")
    keys = [surrogate_key("x"), surrogate_key("z"), composite_key(["x", "y"])]
    assert one(frame, *keys, composite_key(["x", "z"])) == (md5("a"), None, md5("a|2"), None)


def test_fingerprint_is_order_sensitive_and_shows_nulls(spark):
    frame = spark.createDataFrame([("a", 2, None)], "x string, y int, z string")
    assert one(frame, row_fingerprint(["x", "y", "z"])) == (sha("a||2||<null>"),)
    assert one(frame, row_fingerprint(["y", "x"])) == (sha("2||a"),)


def test_strict_fingerprint_separates_what_the_plain_one_mixes_up(spark):
    frame = spark.createDataFrame([("a||b", "c"), ("a", "b||c"), (None, "c"), ("<null>", "c")], "x string, y string")
    plain = {r[0] for r in frame.select(row_fingerprint(["x", "y"])).collect()}
    strict = {r[0] for r in frame.select(strict_fingerprint(["x", "y"])).collect()}
    assert (len(plain), len(strict)) == (2, 4)


def test_content_key(spark):
    parts = [F.lit(v) for v in ("TS009", "2021")] + [F.lit(1), F.lit("f" * 64), F.lit("csv")]
    expected = f"landing/ons/TS009/edition=2021/version=1/filter={'f' * 64}/csv/{'a' * 64}"
    frame = spark.range(1)
    assert one(frame, content_key(*parts, F.lit("a" * 64))) == (expected,)
    assert one(frame, content_key(*parts, F.lit(None).cast("string"))) == (None,)


def random_json(rng: random.Random, depth: int = 0):
    kinds = ["text", "int", "bool", "null"] + ["list", "dict"] * (depth < 3)
    kind = rng.choice(kinds)
    letters = 'aZ09 "\\/\n\t\r\b\f\x00\x1f\x7f\x80éß中 😀𝒳u'
    text = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(6)))
    if kind == "list":
        return [random_json(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind == "dict":
        return {text(): random_json(rng, depth + 1) for _ in range(rng.randrange(4))}
    return {"text": text(), "int": rng.randrange(-(10**12), 10**12), "bool": True, "null": None}[kind]


def test_canonical_json_equals_sorted_compact_ascii_dump(spark):
    rng = random.Random(7)
    values = [{"root": random_json(rng), "b": random_json(rng)} for _ in range(400)]
    values.append({"path": "\\u001F \\\\u00e9 \x1f", "a": [1, {"z": None, "y": "é"}]})
    documents = [json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2])) for v in values]
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "i int, d string")
    found = dict(frame.select("i", canonical_json(F.col("d"))).collect())
    hashes = dict(frame.select("i", canonical_hash(F.col("d"))).collect())
    for i, value in enumerate(values):
        expected = json.dumps(value, sort_keys=True, separators=(",", ":"))
        assert found[i] == expected
        assert hashes[i] == sha(expected)


def test_canonical_json_of_numbers_is_that_of_a_dump(spark):
    rng = random.Random(5)
    numbers = ["1.0", "1", "0.5", "-2.25", "1e5", "1E-7", "0.00001", "-0.0", "1.50", "123456789.5", "0.001"]
    numbers += [str(rng.randrange(10 ** rng.randint(1, 50))) for _ in range(40)]
    numbers += [repr(rng.uniform(-10, 10) * 10 ** rng.randint(-8, 18)) for _ in range(200)]
    numbers += [f"{rng.randrange(1000)}.{rng.randrange(1, 100)}" for _ in range(60)]
    documents = [f'{{"t":"1.0 e \\" 1e5","a":[{n},{{"b":{n}}}]}}' for n in numbers]
    numbers += ["1e400", "-1e400", "-0", "0.0", "5e-324", "1.7976931348623157e308", "1e15", "1e16", "1e17", "2e-5", "2e-4", "1" * 60]
    documents += [f"[{n}]" for n in numbers[-12:]]
    documents += ['{"a":1,"a":2}', '{"b":{"x":1.0,"x":2.50},"n1":"n1.0","s":"s"}', '{"t":"' + "x1.0\\n" * 9000 + '","a":7.0}']
    frame = spark.createDataFrame(list(enumerate(documents)), "i int, d string")
    found = dict(frame.select("i", canonical_json(F.col("d"))).collect())
    for i, document in enumerate(documents):
        expected = json.dumps(json.loads(document), sort_keys=True, separators=(",", ":"))
        assert found[i] == expected, document


def test_canonical_json_refuses_what_is_no_json(spark):
    documents = ['{"a":1.}', '{"a":01.0}', '{"a":-}', "nan", '{"a":1.0', "1.0.0", '"x', "[1.0,]"]
    frame = spark.createDataFrame([(d,) for d in documents], "d string")
    assert [r[0] for r in frame.select(canonical_json(F.col("d"))).collect()] == [None] * len(documents)


def test_canonical_hash_ignores_key_order_but_not_array_order(spark):
    rows = [('{"a":1,"b":[1,2]}',), ('{"b": [1, 2], "a": 1}',), ('{"a":1,"b":[2,1]}',), ("{oops",)]
    first, second, third, bad = (
        r[0] for r in spark.createDataFrame(rows, "d string").select(canonical_hash(F.col("d"))).collect()
    )
    assert first == second != third
    assert bad is None and re.fullmatch("[a-f0-9]{64}", first)


def test_digest_of_any_bytes(spark):
    rng = random.Random(3)
    contents = [b"", b"example", "naïve".encode()] + [rng.randbytes(rng.randrange(200)) for _ in range(50)]
    frame = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(contents)], "i int, content binary")
    for i, digest, size in with_fingerprint(frame, "content").collect():
        assert (digest, size) == (sha(contents[i]), len(contents[i]))
    text = spark.createDataFrame([("naïve",)], "content string")
    assert tuple(with_fingerprint(text, "content").first()) == (sha("naïve"), 6)


READY = {
    "id": "output-1",
    "events": [],
    "downloads": {
        "csv": {"public": "https://example.org/x.csv", "size": "512", "skipped": False},
        "csvw": {"href": "/x.csvw"},
    },
}
ERROR = {"id": "output-1", "events": [{"type": "note"}, {"type": "error"}], "downloads": {}}


@pytest.mark.parametrize(
    ("document", "status"),
    [
        (READY, "ready"),
        ({**READY, "events": [{"type": "error"}]}, "ready"),
        (ERROR, "error"),
        ({"id": "output-1", "published": False, "events": [], "downloads": {}}, "pending"),
        ({"id": "output-1"}, "pending"),
        ({"events": [{"timestamp": "2026-01-01"}]}, "pending"),
        ({"downloads": {"csv": {"public": "x"}}}, "pending"),
        ({"downloads": {"csv": {"public": "", "href": ""}, "csvw": {"href": "y"}}}, "pending"),
        ({"downloads": {"csv": {"public": "x", "skipped": True}, "csvw": {"href": "y"}}}, "pending"),
    ],
)
def test_job_status(spark, document, status):
    frame = spark.createDataFrame([(json.dumps(document),)], "d string")
    assert one(frame, job_status(parse_status(F.col("d")))) == (status,)


def test_missing_and_trim(spark):
    frame = spark.createDataFrame([(" a ", ""), (None, "b"), ("\tc ", "d")], "x string, y string")
    trimmed = trim_columns(frame, ["x", "y"])
    assert [r["x"] for r in trimmed.collect()] == ["a", None, "\tc"]
    assert [r[0] for r in trimmed.select(any_missing(["x", "y"])).collect()] == [True, True, False]
    assert trim_columns(frame, ["x"], all_whitespace=True).collect()[2]["x"] == "c"
    assert one(frame, any_missing([])) == (False,)


def test_rules_fire_in_order(spark):
    rows = [("", -1), ("a", None), ("a", -1), ("a", 0), ("", None)]
    tagged = classify(spark.createDataFrame(rows, "d string, m int"), standard_rules(["d"], "m"))
    assert [r["quality_rule"] for r in tagged.collect()] == [
        "missing_dimension",
        "invalid_observation",
        "negative_observation",
        None,
        "missing_dimension",
    ]
    valid, invalid = split(tagged)
    assert valid.columns == ["d", "m"] and valid.count() == 1 and invalid.count() == 4


def test_provenance(spark):
    frame = spark.createDataFrame([("a", 1)], "x string, y int")
    stamped = with_provenance(frame, RunMetadata("D", "2021", 1, "c" * 64, "run", "2026-01-01 00:00:00+00:00"), ["x", "y"])
    assert stamped.columns == ["x", "y", *PROVENANCE]
    row = stamped.withColumn("loaded_at", F.col("loaded_at").cast("string")).first()
    assert tuple(row)[2:] == ("D", "2021", 1, "c" * 64, "run", sha("a||1"), "2026-01-01 00:00:00")
    assert stamped.schema["version"].dataType.simpleString() == "int"
    assert stamped.schema["loaded_at"].dataType.simpleString() == "timestamp"

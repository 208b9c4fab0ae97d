from __future__ import annotations

import hashlib
import json
import os

import pytest
from conftest import FAULT_ROWS, SAMPLE_ROWS, SAMPLE_TOTALS, csv_text, metadata_document

from sievework import session as session_module
from sievework.errors import ArtifactError, SchemaContractError
from sievework.operators.evidence import collect_evidence
from sievework.operators.gate import quality_gate
from sievework.operators.ledger import with_object_key
from sievework.operators.model import layer_counts
from sievework.operators.provenance import PROVENANCE, RunMetadata
from sievework.operators.rules import OUTCOME
from sievework.operators.skew import spread_rows
from sievework.plans import census
from sievework.plans.landing import land_artifacts, read_definition
from sievework.plans.warehouse import gate_and_stamp, publish
from sievework.schemas import declare
from sievework.session import fresh_folder, shared_folder
from sievework.sinks import parquet
from sievework.sinks.jdbc import write_jdbc
from sievework.sinks.parquet import replace_version, save_gated, version_path, write_gate_result
from sievework.sinks.reports import SUMMARY_SCHEMA, run_summary, write_json
from sievework.sinks.tables import materialize
from sievework.sources.artifacts import content_checksum, scan_artifacts, source_checksum
from sievework.sources.delimited import CORRUPT, read_delimited
from sievework.sources.documents import read_json_objects
from sievework.sources.tables import read_layer, read_table

SCHEMA = declare("code string, label string, n long")


def write(path, text) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def rows(frame) -> set:
    return {tuple(r) for r in frame.collect()}


def run(edition="2021", version=1, run_id="run-1") -> RunMetadata:
    return RunMetadata("TS009", edition, version, "a" * 64, run_id, "2026-01-01 00:00:00+00:00")


def test_typed_scan_nulls_what_a_type_cannot_hold(spark, tmp_path):
    path = write(tmp_path / "x.csv", "code,label,n\na,A,1\nb,B,1.5\nc,C,x\n")
    assert rows(read_delimited(spark, path, SCHEMA)) == {("a", "A", 1), ("b", "B", None), ("c", "C", None)}


def test_corrupt_lines_are_kept_on_request(spark, tmp_path):
    path = write(tmp_path / "x.csv", "code,label,n\na,A,1\nb,B,oops\nc,C,3,extra\n")
    found = {r["code"]: r[CORRUPT] for r in read_delimited(spark, path, SCHEMA, keep_corrupt=True).collect()}
    assert found == {"a": None, "b": "b,B,oops", "c": "c,C,3,extra"}


@pytest.mark.parametrize("header", ["label,code,n", "code,label", "code,label,n,x", "code,Label,n"])
def test_header_drift_is_an_error(spark, tmp_path, header):
    path = write(tmp_path / "x.csv", f"{header}\na,A,1\n")
    with pytest.raises(SchemaContractError):
        read_delimited(spark, path, SCHEMA)


def test_header_drift_in_a_later_file_fails_the_scan(spark, tmp_path):
    write(tmp_path / "d" / "1.csv", "code,label,n\na,A,1\n" + "b,B,2\n" * 50)
    write(tmp_path / "d" / "2.csv", "label,code,n\nA,a,1\n")
    frame = read_delimited(spark, str(tmp_path / "d"), SCHEMA)
    for scan in (frame, frame.select("code")):
        with pytest.raises(Exception, match="does not conform to the schema"):
            scan.collect()


def test_artifacts_and_checksums(spark, tmp_path):
    write(tmp_path / "one" / "a.csv", "example")
    digest = hashlib.sha256(b"example").hexdigest()
    found = scan_artifacts(spark, str(tmp_path / "one")).collect()
    assert [(os.path.basename(r["path"]), r["sha256"], r["size_bytes"]) for r in found] == [("a.csv", digest, 7)]
    assert source_checksum(spark, str(tmp_path / "one" / "a.csv")) == digest
    write(tmp_path / "two" / "a.csv", "example")
    write(tmp_path / "two" / "deep" / "b.txt", "other")
    both = source_checksum(spark, str(tmp_path / "two"))
    assert len(both) == 64 and both != digest
    assert both == source_checksum(spark, str(tmp_path / "two"))
    assert scan_artifacts(spark, str(tmp_path / "two"), "*.txt").count() == 1


def test_json_objects(spark, tmp_path):
    assert read_json_objects(spark, str(tmp_path / "missing.json"), "a int").count() == 0
    assert read_json_objects(spark, write(tmp_path / "l.json", "[]"), "a int").count() == 0
    assert read_json_objects(spark, write(tmp_path / "m.json", '[{"a": 1}]'), "a int").count() == 0
    found = read_json_objects(spark, write(tmp_path / "o.json", '\n {"a": 1,\n "z": 2}'), "a int, b string")
    assert rows(found) == {(1, None)}
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_objects(spark, write(tmp_path / "bad.json", '{"a": '), "a int").collect()


def test_replacing_a_version_leaves_others_and_drops_stale_rules(spark, tmp_path):
    path = str(tmp_path / "q")
    schema = "n int, edition string, version int, quality_rule string"
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    replace_version(frame((1, "2021", 1, "x"), (2, "2021", 1, "y")), path, "2021", 1, [OUTCOME])
    replace_version(frame((3, "2021", 2, "x")), path, "2021", 2, [OUTCOME])
    replace_version(frame((4, "2021", 1, "y")), path, "2021", 1, [OUTCOME])
    saved = read_layer(spark, path, frame((1, "", 1, "")).schema)
    assert rows(saved) == {(4, "2021", 1, "y"), (3, "2021", 2, "x")}


def test_odd_editions_survive_the_folder_name(spark, tmp_path):
    edition = "a/b=c: 100%é"
    frame = spark.createDataFrame([(1, edition, 1)], "n int, edition string, version int")
    replace_version(frame, str(tmp_path / "o"), edition, 1)
    assert "a%2Fb%3Dc%3A 100%25é" in version_path("", edition, 1)
    assert rows(read_layer(spark, str(tmp_path / "o"), frame.schema)) == {(1, edition, 1)}


def test_gate_result_round_trip(spark, tmp_path):
    source = spark.createDataFrame(SAMPLE_ROWS + FAULT_ROWS, census.source_schema())
    gated = gate_and_stamp(source, census.MODEL, run())
    accepted, quarantined = write_gate_result(
        gated, run(), str(tmp_path / "a"), str(tmp_path / "q"), str(tmp_path / "stage")
    )
    assert accepted.columns == [*census.SOURCE_COLUMNS, *PROVENANCE]
    assert rows(accepted) == rows(gated.filter("quality_rule is null").drop(OUTCOME))
    assert rows(quarantined.select(gated.columns)) == rows(gated.filter("quality_rule is not null"))
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 0
    assert (tmp_path / "a/edition=2021/version=1").is_dir()
    assert (tmp_path / "q/edition=2021/version=1/quality_rule=exact_duplicate").is_dir()
    counts = layer_counts({"input": source, "accepted": accepted, "quarantined": quarantined})
    write_json(run_summary(counts, run()), str(tmp_path / "summary"))
    saved = read_json_objects(spark, str(tmp_path / "summary"), SUMMARY_SCHEMA)
    assert tuple(saved.first()) == ("run-1", "TS009", "2021", 1, 15, 9, 6)


def test_bare_gate_result_is_stamped_where_it_is_copied(spark, tmp_path, monkeypatch):
    """Staged without the stamp's columns; the rest is dealt out by rows, not in one task per rule."""
    source = spark.createDataFrame(SAMPLE_ROWS + FAULT_ROWS, census.source_schema())
    stage = str(tmp_path / "stage")
    monkeypatch.setattr(parquet, "spread_rows", lambda df: spread_rows(df, 2))
    accepted, quarantined = write_gate_result(
        quality_gate(source, census.MODEL.gate), run(), str(tmp_path / "a"), str(tmp_path / "q"), stage,
        hash_columns=census.MODEL.hash_columns,
    )
    stamped = gate_and_stamp(source, census.MODEL, run())
    assert accepted.columns == [*census.SOURCE_COLUMNS, *PROVENANCE]
    assert rows(accepted) == rows(stamped.filter("quality_rule is null").drop(OUTCOME))
    assert rows(quarantined.select(stamped.columns)) == rows(stamped.filter("quality_rule is not null"))
    assert not set(PROVENANCE) & set(spark.read.parquet(stage).columns)
    files = [f for f in (tmp_path / "q").rglob("*.parquet")]
    assert len({f.name.split("-")[1] for f in files}) == 3  # six rows, two a task


@pytest.fixture
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_gated_rows_are_saved_once_and_read_by_part(spark, tmp_path, long_plans):
    source = spark.createDataFrame(SAMPLE_ROWS + FAULT_ROWS, census.source_schema())
    gated = gate_and_stamp(source, census.MODEL, run())
    for _ in range(2):
        accepted, quarantined = save_gated(gated, str(tmp_path / "g"), run())
        assert accepted.columns == [*census.SOURCE_COLUMNS, *PROVENANCE]
        assert rows(accepted) == rows(gated.filter("quality_rule is null").drop(OUTCOME))
        assert rows(quarantined) == rows(gated.filter("quality_rule is not null"))
    plan = accepted._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "edition" in filters and "version" in filters and "isnull(quality_rule" in filters
    later = gate_and_stamp(source.limit(0), census.MODEL, run(version=2))
    accepted, quarantined = save_gated(later, str(tmp_path / "g"), run(version=2))
    assert (accepted.count(), quarantined.count()) == (0, 0)


def test_empty_quarantine_can_be_read(spark, tmp_path):
    source = spark.createDataFrame(SAMPLE_ROWS, census.source_schema())
    accepted, quarantined = write_gate_result(
        gate_and_stamp(source, census.MODEL, run()), run(), str(tmp_path / "a"), str(tmp_path / "q")
    )
    assert (accepted.count(), quarantined.count()) == (8, 0)


class FakeWriter:
    """Records what would reach a database; none is started for tests."""

    def __init__(self):
        self.settings, self.calls = {}, []

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def options(self, **settings):
        self.settings = settings
        return self

    def mode(self, name):
        self.calls.append(("mode", name))
        return self

    def save(self):
        self.calls.append(("save", None))


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_jdbc_options(mode):
    frame = type("Frame", (), {"write": FakeWriter()})()
    write_jdbc(frame, "jdbc:postgresql://h/db", "raw.t", "u", "p", mode=mode, connections=4)
    assert frame.write.calls == [("format", "jdbc"), ("mode", mode), ("save", None)]
    assert frame.write.settings == {
        "url": "jdbc:postgresql://h/db",
        "dbtable": "raw.t",
        "user": "u",
        "password": "p",
        "driver": "org.postgresql.Driver",
        "truncate": True,
        "numPartitions": 4,
        "batchsize": 10_000,
    }


def test_materialize(spark, tmp_path):
    frame = spark.range(3)
    assert materialize(frame, "sw_view").count() == 3
    path = str(tmp_path / "t")
    for size in (3, 2):
        materialize(spark.range(size), "sw_table", "table", path)
        assert read_table(spark, "sw_table").count() == size
    spark.sql("drop table sw_table")
    with pytest.raises(ValueError):
        materialize(frame, "x", "index")


def test_shared_folder_comes_from_the_session(monkeypatch):
    class Conf(dict):
        def get(self, name, default=None):
            return dict.get(self, name, default)

    def fake(**conf):
        return type("Session", (), {"conf": Conf({k.replace("__", "."): v for k, v in conf.items()})})()

    assert shared_folder(fake(spark__checkpoint__dir="hdfs://x/ck")) == "hdfs://x/ck"
    one, two = (fresh_folder(fake(spark__checkpoint__dir="s3a://b"), "n") for _ in range(2))
    assert one.startswith("s3a://b/") and one != two
    monkeypatch.setattr(session_module.tempfile, "gettempdir", lambda: "/tmp/x")
    assert shared_folder(fake(spark__master="local[4]")) == "/tmp/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(fake(spark__master="yarn"))


def test_census_extract_end_to_end(spark, tmp_path, sample_csv):
    metadata = write(tmp_path / "extract.csvw", json.dumps(metadata_document()))
    out = str(tmp_path / "out")
    layers = census.run_extract(spark, sample_csv, metadata, out, "run-1")
    summary = layers.summary.first()
    assert (summary["input_rows"], summary["accepted_rows"], summary["quarantined_rows"]) == (8, 8, 0)
    assert layers.accepted.select("source_record_hash").distinct().count() == 8
    rows_read = census.read_source(spark, sample_csv)
    checksum = content_checksum(rows_read)
    assert checksum == content_checksum(rows_read.repartition(3)) != content_checksum(rows_read.limit(7))
    assert {r[0] for r in layers.accepted.select("source_checksum").collect()} == {checksum}
    totals = {r["geography_code"]: r["population"] for r in layers.mart.collect()}
    assert totals == SAMPLE_TOTALS
    results = census.run_suite(layers, SAMPLE_TOTALS)
    statuses = [r["status"] for r in results.collect()]
    assert len(statuses) == 63
    assert statuses.count("pass") == 56 and statuses.count("success") == 7
    for _ in range(2):
        relations = publish(layers, out, "sw_census_")
    assert {t: spark.table(f"sw_census_{t}").count() for t in relations} == {
        "dim_geography": 2,
        "dim_age": 2,
        "dim_sex": 2,
        "fact": 8,
        "mart": 2,
        "staging": 8,
        "audit": 3,
    }
    joined = spark.sql(
        "select g.geography_label, sum(f.observation) as n from sw_census_fact f "
        "join sw_census_dim_geography g using (geography_key) group by 1"
    )
    assert rows(joined) == {("Northumberland", 273000), ("Birmingham", 962000)}
    # a rerun replaces, and another version is added next to it
    again = census.run_extract(spark, sample_csv, metadata, out, "run-2", version=2)
    assert again.accepted.count() == 8
    both = read_layer(spark, f"{out}/gated", layers.quarantined.schema)
    assert {tuple(r) for r in both.groupBy("version").count().collect()} == {(1, 8), (2, 8)}


def test_evidence_of_a_whole_run(spark, tmp_path):
    """Landing, gate, layers, checks and evidence of the same extract."""
    write(tmp_path / "definition.json", json.dumps(DEFINITION))
    csv = write(tmp_path / "files" / "x.csv", csv_text(census.RAW_HEADERS, SAMPLE_ROWS))
    metadata = write(tmp_path / "files" / "x.csvw", json.dumps(metadata_document()))
    manifest = land(spark, tmp_path)
    landed = manifest.filter("kind = 'csv'").first()["sha256"]
    layers = census.run_extract(spark, csv, metadata, str(tmp_path / "out"), "run-9",
                                source_checksum=landed, loaded_at="2026-01-01 00:00:00+00:00")
    evidence = collect_evidence(layers.summary, manifest, census.run_suite(layers, SAMPLE_TOTALS))
    found = {(r["section"], r["item"]): r["value"] for r in evidence.collect()}
    digests = {r["kind"]: r["sha256"] for r in manifest.collect()}
    assert digests["csv"] == layers.accepted.first()["source_checksum"]
    assert found == {
        ("run", "pipeline_run_id"): "run-9",
        ("run", "dataset_id"): "TS009",
        ("run", "edition"): "2021",
        ("run", "version"): "1",
        ("run", "filter_hash"): manifest.first()["filter_hash"],
        ("gate", "input_rows"): "8",
        ("gate", "accepted_rows"): "8",
        ("gate", "quarantined_rows"): "0",
        ("artifact", "csv"): digests["csv"],
        ("artifact", "csvw"): digests["csvw"],
        ("checks", "executed"): "63",
        ("checks", "passed"): "63",
        ("checks", "failed"): "0",
    }
    statuses = [
        census.freshness(layers, now).first()["status"]
        for now in ("2030-01-01 00:00:00", "2036-01-01 00:00:00", "2046-01-01 00:00:00")
    ]
    assert statuses == ["pass", "warn", "error"]


def test_census_suite_reports_what_is_wrong(spark, tmp_path, sample_csv):
    metadata = write(tmp_path / "extract.csvw", json.dumps(metadata_document()))
    layers = census.run_extract(spark, sample_csv, metadata, str(tmp_path / "out"), "run-1")
    wrong = {"E06000057": 1, "E09000001": 5}
    failed = {
        (r["check"], r["failures"])
        for r in census.run_suite(layers, wrong).filter("status = 'fail'").collect()
    }
    assert failed == {("expected_totals", 3)}


def test_census_transform(spark, sample_csv):
    frame = census.read_source(spark, sample_csv)
    assert frame.schema == census.source_schema()
    accepted, quarantined = census.transform(frame, run())
    assert accepted.columns == [*census.SOURCE_COLUMNS, *PROVENANCE]
    assert quarantined.columns == [*census.SOURCE_COLUMNS, OUTCOME, *PROVENANCE]
    assert (accepted.count(), quarantined.count()) == (8, 0)


def test_census_header_drift(spark, tmp_path):
    path = write(tmp_path / "x.csv", csv_text(census.RAW_HEADERS[::-1], [r[::-1] for r in SAMPLE_ROWS]))
    with pytest.raises(SchemaContractError):
        census.read_source(spark, path)


def test_census_metadata_contract(spark, tmp_path):
    census.validate_metadata(spark, write(tmp_path / "ok.csvw", json.dumps(metadata_document())))
    swapped = json.dumps(metadata_document(census.RAW_HEADERS[::-1]))
    with pytest.raises(SchemaContractError, match="do not match"):
        census.validate_metadata(spark, write(tmp_path / "swapped.csvw", swapped))
    retyped = json.dumps(metadata_document(measure_type="string"))
    with pytest.raises(SchemaContractError, match="must be an integer"):
        census.validate_metadata(spark, write(tmp_path / "retyped.csvw", retyped))
    with pytest.raises(SchemaContractError, match="do not match"):
        census.validate_metadata(spark, write(tmp_path / "empty.csvw", "{}"))


def test_seed_scan(spark, tmp_path):
    header = census.SEED_SCHEMA.names
    row = "North,E1,Young,0,Female,1,36000,TS009,2021,1,check,run,hash-1,2026-01-01 00:00:00"
    path = write(tmp_path / "seed.csv", ",".join(header) + "\n" + row + "\n")
    frame = census.read_seed(spark, path)
    assert frame.schema == census.SEED_SCHEMA
    assert frame.selectExpr("edition", "version", "string(loaded_at)").first() == (
        "2021",
        1,
        "2026-01-01 00:00:00",
    )


def test_object_key_binds_identity_and_bytes(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([("csv", "d" * 64)], "kind string, sha256 string")
    keyed = with_object_key(frame, F.lit("TS009"), F.lit("2021"), F.lit(1), F.lit("f" * 64))
    assert keyed.first()["object_key"].endswith(f"/csv/{'d' * 64}")


DEFINITION = {
    "dataset": {"id": "TS009", "edition": "2021", "version": 1},
    "population_type": "UR",
    "dimensions": [{"name": "ltla", "is_area_type": True, "options": ["E1", "E2"]}, {"name": "sex"}],
}


def land(spark, tmp_path, run_id="run-1"):
    specs = [
        ("x.csv", "csv", "https://example.org/x.csv", "text/csv", None),
        ("x.csvw", "csvw", "https://example.org/x.csvw", "application/csvm+json", None),
    ]
    artifacts = spark.createDataFrame(
        specs, "name string, kind string, source_url string, content_type string, etag string"
    )
    return land_artifacts(
        spark,
        artifacts,
        str(tmp_path / "files"),
        str(tmp_path / "definition.json"),
        str(tmp_path / "ledger"),
        str(tmp_path / "manifest"),
        run_id,
        "filter-1",
        "output-1",
        "2026-01-01 00:00:00",
    )


def test_landing_is_repeatable(spark, tmp_path):
    write(tmp_path / "definition.json", json.dumps(DEFINITION, indent=2))
    write(tmp_path / "files" / "x.csv", "example")
    write(tmp_path / "files" / "x.csvw", "{}")
    first = {r["kind"]: r.asDict() for r in land(spark, tmp_path).collect()}
    reordered = {k: DEFINITION[k] for k in ("dimensions", "population_type", "dataset")}
    write(tmp_path / "definition.json", json.dumps(reordered))
    again = {r["kind"]: r.asDict() for r in land(spark, tmp_path).collect()}
    assert first == again and set(first) == {"csv", "csvw"}
    canonical = json.dumps(DEFINITION, sort_keys=True, separators=(",", ":"))
    assert first["csv"]["filter_hash"] == hashlib.sha256(canonical.encode()).hexdigest()
    digest = hashlib.sha256(b"example").hexdigest()
    assert first["csv"]["object_key"] == (
        f"landing/ons/TS009/edition=2021/version=1/filter={first['csv']['filter_hash']}/csv/{digest}"
    )
    assert first["csv"]["size_bytes"] == 7
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2


def test_landing_needs_each_file_once(spark, tmp_path):
    write(tmp_path / "definition.json", json.dumps(DEFINITION))
    write(tmp_path / "files" / "x.csv", "example")
    with pytest.raises(ArtifactError, match="no file x.csvw"):
        land(spark, tmp_path)
    write(tmp_path / "files" / "x.csvw", "{}")
    write(tmp_path / "files" / "old" / "x.csv", "other")
    with pytest.raises(ArtifactError, match="2 files x.csv"):
        land(spark, tmp_path)


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"extra": 1}, "no_unknown_field"),
        ({"dataset": {"id": "T", "edition": "2021", "version": 1, "title": "x"}}, "no_unknown_dataset_field"),
        ({"dataset": {"id": "T", "edition": "2021", "version": 0}}, "version_is_positive"),
        ({"dataset": {"id": "T", "version": 1}}, "edition_is_text"),
        ({"dataset": {"id": 7, "edition": "2021", "version": 1}}, "dataset_id_is_text"),
        ({"population_type": None}, "population_type_is_text"),
        ({"dimensions": [{"name": "sex"}, None]}, "dimensions_are_objects"),
        ({"dimensions": "sex"}, "dimensions_are_objects"),
    ],
)
def test_definition_rules(spark, tmp_path, change, rule):
    path = write(tmp_path / "definition.json", json.dumps({**DEFINITION, **change}))
    with pytest.raises(SchemaContractError, match=rule):
        read_definition(spark, path)


def test_definition_with_no_dimensions_is_sound(spark, tmp_path):
    path = write(tmp_path / "definition.json", json.dumps({**DEFINITION, "dimensions": []}))
    assert read_definition(spark, path)["source_version"] == 1

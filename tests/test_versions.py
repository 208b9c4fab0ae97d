"""Commits, incremental loads, publication, histories, digests, backfills and distributions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sievework.errors import AlreadyPublishedError, CommitConflictError
from sievework.operators.digests import differing_nodes, differing_rows, digest_tree, leaf_digests, same_content
from sievework.operators.distribution import (
    class_floor,
    distribution_mart,
    distribution_sketches,
    rollup_mismatches,
    value_class,
    with_bands,
)
from sievework.operators.revisions import as_of, revision_mart, validity_windows, version_changes, with_deltas
from sievework.plans.backfill import BackfilledLayer, source_digests, stale_partitions
from sievework.plans.incremental import KeyedTable
from sievework.plans.publication import RunLedger
from sievework.schemas import declare
from sievework.sinks.commits import NONE, CommitLog


def rows(frame) -> Counter:
    return Counter(tuple(r) for r in frame.collect())


# --- commits -------------------------------------------------------------------------------------


def test_a_commit_number_is_taken_once(spark, tmp_path):
    mine, theirs = CommitLog(spark, str(tmp_path / "log")), CommitLog(spark, str(tmp_path / "log"))
    assert mine.latest() == NONE and mine.table("a int").collect() == []
    mine.put(0, {"a": 1, "text": "é\n"})
    seen = theirs.latest() + 1
    mine.put(seen, {"a": 2})
    with pytest.raises(CommitConflictError):
        theirs.put(seen, {"a": 3})
    assert mine.read(0) == {"a": 1, "text": "é\n"} and theirs.read(1) == {"a": 2}
    assert rows(theirs.table("a int")) == Counter([(0, 1), (1, 2)])


def test_the_rename_itself_refuses_a_taken_number(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path / "log"))
    log.put(0, {"a": 1})
    monkeypatch.setattr(log, "numbers", list)  # as if the other commit came after the look
    with pytest.raises(CommitConflictError):
        log.put(0, {"a": 2})
    monkeypatch.undo()
    assert log.read(0) == {"a": 1}
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == [f"{0:020d}.json"]


def test_half_written_commits_do_not_count(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    log.put(0, {"a": 1})
    (tmp_path / "log" / f".{1:020d}-dead").write_text('{"a":')
    (tmp_path / "log" / "1.json").write_text("{}")
    assert log.latest() == 0
    log.put(1, {"a": 2})
    assert log.numbers() == [0, 1]


# --- changes -------------------------------------------------------------------------------------

CHANGED = "k int, g string, m long"


def test_changes_are_null_safe(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, None, None), (None, "b", 1), (4, "b", 2)], CHANGED)
    new = spark.createDataFrame([(1, "a", 6), (2, "a", None), (3, None, 0), (None, "b", 1), (5, "c", 7)], CHANGED)
    found = {r["k"]: (r["change"], r["old"], r["new"], r["m_delta"]) for r in with_deltas(version_changes(old, new, ["k"]), ["m"]).collect()}
    assert {k: v[0] for k, v in found.items()} == {
        1: "revised", 2: "unchanged", 3: "revised", None: "unchanged", 4: "removed", 5: "added"
    }
    assert {k: v[3] for k, v in found.items()} == {1: 1, 2: 0, 3: 0, None: 0, 4: -2, 5: 7}
    assert found[4][2] is None and found[5][1] is None and tuple(found[3][1]) == (None, None)
    mart = revision_mart(old, new, ["k"], ["g"], "m")
    assert rows(mart.select("g", "change", "n_keys", "delta")) == Counter([
        ("a", "revised", 1, 1), ("a", "unchanged", 1, 0), (None, "revised", 1, 0), ("b", "unchanged", 1, 0),
        ("b", "removed", 1, -2), ("c", "added", 1, 7)])
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    none = old.limit(0)
    assert rows(version_changes(none, none, ["k"])) == Counter()
    with pytest.raises(Exception, match="key occurs twice"):
        version_changes(old, new.unionByName(new), ["k"]).collect()


# --- incremental loads ---------------------------------------------------------------------------

KEYED = declare("a long, b string, v double, w string")


def model_load(state: dict, batch: list, complete: bool) -> tuple[dict, Counter]:
    """The same load over a dict."""
    out, counts = ({} if complete else dict(state)), Counter()
    for a, b, v, w, *gone in batch:
        key = (a, b)
        if gone and gone[0]:
            if key in state:
                del out[key]
                counts["removed"] += 1
            continue
        counts["added" if key not in state else "unchanged" if state[key] == (v, w) else "revised"] += 1
        out[key] = (v, w)
    if complete:
        counts["removed"] += len(state.keys() - out.keys())
    return out, counts


@pytest.mark.parametrize("seed", range(3))
def test_loads_equal_a_model(spark, tmp_path, seed):
    rng = random.Random(seed)
    held = KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], KEYED, buckets=5)
    assert held.read().collect() == []
    state: dict = {}
    states = []
    keys = [(a if a else None, b) for a in range(12) for b in ("x", "y", None)]
    for step in range(5):
        complete = step in (0, 3)
        some = rng.sample(keys, rng.randint(5, 25))
        batch = [(*k, rng.choice([None, 1.5, 2.5]), rng.choice(["p", None])) for k in some]
        if not complete:
            batch = [(*r, rng.random() < 0.4) for r in batch]
        schema = "a long, b string, v double, w string" + ("" if complete else ", gone boolean")
        before = held.log.latest()
        result = held.load(spark.createDataFrame(batch, schema), step, f"run-{step}", complete, None if complete else "gone")
        state, counts = model_load(state, batch, complete)
        states.append(dict(state))
        for kind in ("added", "removed", "revised"):
            assert result.changes[kind] == counts[kind]
        assert result.commit == before + 1
        assert rows(held.read()) == Counter((*k, *v) for k, v in state.items())
        feed = Counter(r["change"] for r in held.changes(result.commit).collect())
        assert feed == Counter({k: counts[k] for k in ("added", "removed", "revised") if counts[k]})
    for number, then in enumerate(states):
        assert rows(held.read(number)) == Counter((*k, *v) for k, v in then.items())


def test_a_rerun_commits_nothing_and_a_race_is_refused(spark, tmp_path):
    batch = spark.createDataFrame([(i, "x", float(i), None) for i in range(50)], "a long, b string, v double, w string")
    held = KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], KEYED, buckets=4)
    first = held.load(batch, 1, "run-1")
    again = held.load(batch, 1, "run-1-again")
    assert (first.commit, first.rewritten_buckets) == (0, 4)
    assert (again.commit, again.rewritten_buckets, again.changes["unchanged"]) == (0, 0, 50)
    # a new version without changes is a commit over the same folders
    same = held.load(batch, 2, "run-2")
    assert same.commit == 1 and held.state()["folders"] == held.state(0)["folders"]
    # one key changes: one bucket is written, the others keep their folders
    one = held.load(batch.filter("a = 7").withColumn("v", F.lit(-1.0)), 3, "run-3", complete=False)
    assert one.rewritten_buckets == 1 and one.changes["revised"] == 1
    kept = set(held.state(2)["folders"].items()) & set(held.state(1)["folders"].items())
    assert len(kept) == 3
    # another load commits between this one's look and its commit
    slow = KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], KEYED)
    seen = slow.state()
    held.load(batch, 4, "run-4")
    slow.state = lambda commit=None: seen
    with pytest.raises(CommitConflictError):
        slow.load(batch.filter("a > 5"), 5, "run-5")
    assert held.read().count() == 50 and held.state()["run_id"] == "run-4"
    with pytest.raises(Exception, match="key occurs twice"):
        held.load(batch.unionByName(batch), 6, "run-6")
    assert held.state()["run_id"] == "run-4"


# --- publication ---------------------------------------------------------------------------------


def test_a_version_has_one_publisher(spark, tmp_path):
    path = str(tmp_path / "runs")
    one, two = RunLedger(spark, path), RunLedger(spark, path)
    mine = one.claim("D", "2021", 1, "run-1", "a")
    assert one.claim("D", "2021", 1, "run-1", "a") == mine  # goes on after an interruption
    with pytest.raises(AlreadyPublishedError):
        two.claim("D", "2021", 1, "run-2", "a")
    other = two.claim("D", "2021", 2, "run-2", "b")
    one.publish(mine, 10)
    assert two.claim("D", "2021", 1, "run-3", "a") is None
    with pytest.raises(AlreadyPublishedError):
        two.claim("D", "2021", 1, "run-3", "other content")
    # a dead run's claim is given up by another one, which then holds it
    one.abandon(other)
    theirs = one.claim("D", "2021", 2, "run-4", "b")
    with pytest.raises(AlreadyPublishedError):
        two.publish(other, 5)
    one.publish(theirs, 6)
    last = {(r["version"], r["run_id"], r["state"], r["n_rows"]) for r in one.current().collect()}
    assert last == {(1, "run-1", "published", 10), (2, "run-4", "published", 6)}


def test_claims_that_race_are_told_by_the_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    one, two = RunLedger(spark, path), RunLedger(spark, path)
    look = one._last

    def slow(*version):
        found = look(*version)
        if two.log.latest() == NONE:  # the other run commits after this one's look
            two.claim("D", "2021", 1, "run-2", "b")
        return found

    monkeypatch.setattr(one, "_last", slow)
    with pytest.raises(AlreadyPublishedError):
        one.claim("D", "2021", 1, "run-1", "a")
    assert [r["run_id"] for r in two.history().collect()] == ["run-2"]


# --- histories -----------------------------------------------------------------------------------


def test_histories_equal_a_model(spark):
    rng = random.Random(4)
    published = [3, 10, 4, 7, 20, 15, 30]  # 30 holds no row
    observed, truth = [], defaultdict(dict)
    for version in rng.sample(published[:-1], 6):
        for key in [*range(15), None]:
            if rng.random() < 0.7:
                value = (rng.choice(["x", "y", None]), rng.choice([1, None]))
                observed += [(key, *value, version)] * rng.choice([1, 1, 2])
                truth[key][version] = value
    want, ordered = Counter(), sorted(published)
    for key, held in truth.items():
        start = None
        for i, version in enumerate(ordered):
            if version in held and start is None:
                start = version
            if start is not None and (i + 1 == len(ordered) or held.get(ordered[i + 1], 0) != held[start]):
                want[(key, *held[start], start, ordered[i + 1] if i + 1 < len(ordered) else None)] += 1
                start = None
    frame = spark.createDataFrame(observed, "k int, a string, b int, version int").repartition(7)
    versions = spark.createDataFrame([(v,) for v in published], "version int")
    history = validity_windows(frame, ["k"], ["a", "b"], "version", versions)
    assert rows(history) == want
    assert validity_windows(frame.limit(0), ["k"], ["a", "b"], "version").collect() == []
    # every version as of itself is what was observed
    probes = spark.createDataFrame([(k, v) for k in range(16) for v in (*published, 1, 99)], "k int, at int")
    found = as_of(history, probes, ["k"], "at")
    for r in found.collect():
        known = [v for v in ordered if v <= r["at"]]
        value = truth[r["k"]].get(known[-1]) if known else None
        assert (r["a"], r["b"]) == (value or (None, None)), r
    assert found.count() == probes.count()
    assert as_of(history, probes.limit(0), ["k"], "at").collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_long_windows_are_cut_into_few_pieces(spark):
    history = spark.createDataFrame([(1, "x", 0, None), (2, "y", 5, 900_000)], "k int, v string, valid_from int, valid_to int")
    probes = spark.range(1_000).select((F.col("id") % 2 + 1).cast("int").alias("k"), (F.col("id") * 1000).cast("int").alias("at"))
    found = as_of(history, probes, ["k"], "at")
    assert found.filter("k = 1 and v = 'x'").count() == 500
    assert found.filter("k = 2 and v = 'y'").count() == 450


# --- digests -------------------------------------------------------------------------------------


def test_digests_find_the_rows_that_differ(spark):
    base = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v"), F.lit("t").alias("w"))
    same = same_content(base, base.select("w", "v", "id").repartition(13), ["id"]).first()
    assert (same["left_rows"], same["right_rows"], same["differing_leaves"], same["same"]) == (20_000, 20_000, 0, True)
    # one row changed, one gone, one twice, one NULL that moved to another column
    other = base.filter("id <> 11").withColumn("v", F.when(F.col("id") == 5, 99).otherwise(F.col("v")))
    other = other.unionByName(base.filter("id = 17"))
    found = rows(differing_rows(base, other, ["id"]))
    assert found == Counter([(5, 5, "t", 1, 0), (5, 99, "t", 0, 1), (11, 4, "t", 1, 0), (17, 3, "t", 1, 2)])
    assert same_content(base, other, ["id"]).first()["differing_leaves"] == 3
    left, right = (digest_tree(leaf_digests(df, ["id"])) for df in (base, other))
    apart = differing_nodes(left, right).collect()
    per_level = Counter(r["level"] for r in apart)
    assert per_level[0] == 1 and per_level[16] == 3 and sorted(per_level) == [0, 4, 8, 12, 16]
    root = next(r for r in apart if r["level"] == 0)
    assert (root["left_rows"], root["right_rows"]) == (20_000, 20_000)
    assert differing_nodes(left, left).collect() == []
    empty = base.limit(0)
    assert same_content(empty, empty, ["id"]).first()["same"]
    assert not same_content(empty, base, ["id"]).first()["same"]


def test_digests_tell_nulls_apart(spark):
    one = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "k int, a string, b string")
    two = spark.createDataFrame([(1, "x", None), (2, None, "x")], "k int, a string, b string")
    assert not same_content(one, two, ["k"]).first()["same"]
    # the same rows under other keys are another table
    swapped = one.withColumn("k", 3 - F.col("k"))
    assert not same_content(one, swapped, ["k"]).first()["same"]


# --- backfill ------------------------------------------------------------------------------------

LAYER = declare("n long, total long, part string")


def build(frame):
    return frame.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("total"))


def test_a_late_version_rebuilds_its_partitions_only(spark, tmp_path):
    data = [("a", 1, 5), ("a", 2, 6), ("b=/1", 1, 7), ("c", 2, 8), (None, 1, 3)]
    schema = "part string, version int, m long"
    layer = BackfilledLayer(spark, str(tmp_path / "l"), "part", "version", build, LAYER)
    assert layer.read().collect() == []

    def state(source):
        return rows(build(source).select("n", "total", "part"))

    first = spark.createDataFrame(data, schema)
    assert rows(layer.refresh(first, "r1").select("partition")) == Counter([("a",), ("b=/1",), ("c",), (None,)])
    assert rows(layer.read()) == state(first)
    assert layer.refresh(first.repartition(3), "r2").isEmpty()
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "l" / "layer").rglob("*.parquet")}
    late = spark.createDataFrame([*data, ("c", 1, 100), ("d", 3, 1)], schema)
    assert {(r["partition"], *r["versions"]) for r in layer.refresh(late, "r3").collect()} == {("c", "1"), ("d", "3")}
    assert rows(layer.read()) == state(late)
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "l" / "layer").rglob("*.parquet")}
    assert {p for p in files if "part=c" not in str(p)} <= {p for p in now if now[p] == files.get(p)}
    # a correction, a removed row and a partition that is gone
    fixed = spark.createDataFrame([("a", 1, 5), ("b=/1", 1, 70), ("c", 2, 8), ("c", 1, 100), ("d", 3, 1)], schema)
    stale = {(r["partition"], *r["versions"]) for r in layer.refresh(fixed, "r4", only=["a"]).collect()}
    assert stale == {("a", "2")}
    stale = {(r["partition"], *r["versions"]) for r in layer.refresh(fixed, "r5").collect()}
    assert stale == {("b=/1", "1"), (None, "1")}
    assert rows(layer.read()) == state(fixed)


def test_a_refresh_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    source = spark.createDataFrame([("a", 1, 5)], "part string, version int, m long")
    layer = BackfilledLayer(spark, str(tmp_path / "l"), "part", "version", build, LAYER)
    with monkeypatch.context() as broken:
        broken.setattr(layer.log, "put", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            layer.refresh(source, "r1")
    assert rows(layer.refresh(source, "r2").select("partition")) == Counter([("a",)])
    assert rows(layer.read()) == Counter([(1, 5, "a")])


def test_digests_of_sources_follow_content_only(spark):
    frame = spark.createDataFrame([("a", 1, 5), ("a", 1, 6)], "part string, version int, m long")
    one, two = source_digests(frame, "part", "version"), source_digests(frame.orderBy(F.desc("m")), "part", "version")
    assert stale_partitions(one, two).isEmpty()
    assert stale_partitions(one, two.limit(0)).count() == 1


# --- distributions -------------------------------------------------------------------------------


def test_value_classes_are_narrow_and_ordered(spark):
    values = [*range(-70, 5000), *(2**p + d for p in range(12, 62) for d in (-1, 0, 1, 12345))]
    found = spark.createDataFrame([(v,) for v in values], "v long").select(
        "v", value_class(F.col("v")).alias("c"), class_floor(value_class(F.col("v"))).alias("f")
    ).collect()
    by_value = sorted((r["v"], r["c"], r["f"]) for r in found)
    assert all(a[1] <= b[1] for a, b in zip(by_value, by_value[1:]))
    for v, _, f in by_value:
        assert abs(f) <= abs(v) and abs(v) - abs(f) <= abs(v) / 8 and (v >= 0) == (f >= 0)
        if abs(v) < 16:
            assert f == v


@pytest.mark.parametrize("nulls", [False, True])
def test_levels_equal_brute_force(spark, nulls):
    rng = random.Random(6)
    data = [(rng.choice("ab"), rng.choice(["x", "y", None]), None if nulls and rng.random() < 0.2 else rng.randint(-9, 3000))
            for _ in range(2000)]
    levels = {"all": [], "g": ["g"], "gh": ["g", "h"]}
    frame = spark.createDataFrame(data, "g string, h string, m long")
    mart = distribution_mart(frame, levels, "m", {"median": 0.5, "top": 1.0})
    groups = defaultdict(list)
    for g, h, m in data:
        for level, key in (("all", (None, None)), ("g", (g, None)), ("gh", (g, h))):
            groups[(level, *key)].append(m)
    found = {(r["level"], r["g"], r["h"]): r for r in mart.collect()}
    assert found.keys() == groups.keys()
    for key, values in groups.items():
        row, known = found[key], sorted(v for v in values if v is not None)
        assert (row["n_rows"], row["total"], row["minimum"], row["maximum"]) == (len(values), sum(known), known[0], known[-1])
        exact = known[max(-(-len(known) // 2), 1) - 1]
        assert abs(row["median"]) <= abs(exact) <= abs(row["median"]) * 8 / 7 + 1
    assert rollup_mismatches(mart.withColumn("one", F.lit(1)), "g", "all", ["one"]).isEmpty()
    assert rollup_mismatches(mart, "gh", "g", ["g"]).isEmpty()
    lost = mart.filter("level <> 'gh' or h = 'x'")
    assert rollup_mismatches(lost, "gh", "g", ["g"]).count() == 2
    assert distribution_sketches(frame.limit(0), levels, "m").collect() == []


def test_bands(spark):
    frame = spark.createDataFrame([(None,), (0,), (15,), (16,), (99,)], "age int")
    banded = with_bands(frame, "age", {"child": (None, 15), "adult": (16, 64)}, "band")
    assert [r["band"] for r in banded.orderBy("age").collect()] == [None, "child", "child", "adult", None]

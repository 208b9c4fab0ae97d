from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import FAULT_ROWS, SAMPLE_ROWS
from pyspark.sql import functions as F

from sievework.operators.compare import multiset_difference, same_rows
from sievework.operators.gate import (
    GateSpec,
    accepted_rows,
    conflicting_keys,
    count_outcomes,
    mark_duplicates,
    quality_gate,
    quarantined_rows,
)
from sievework.operators.rules import Rule, count_by_outcome
from sievework.operators.skew import (
    heavy_keys,
    key_hash,
    rows_with_keys,
    rows_without_keys,
    sketched_counts,
)
from sievework.plans import census

SPEC = GateSpec(key=["a", "b"], measure="m", dimensions=["d"])
SCHEMA = "a string, b int, m long, d string, e int"


def outcomes(frame) -> dict:
    return {r["quality_rule"]: r["n"] for r in count_by_outcome(frame).collect()}


def rows(frame) -> Counter:
    return Counter(tuple(r) for r in frame.collect())


def null_first(value):
    return (value is not None, value if value is not None else 0)


def expected_gate(data) -> Counter:
    """The rules again, over plain Python rows."""
    result, groups = Counter(), defaultdict(list)
    for a, b, m, d, e in data:
        d = d.strip(" ") if d is not None else None
        row = (a, b, m, d, e)
        if not d:
            result[(*row, "missing_dimension")] += 1
        elif m is None:
            result[(*row, "invalid_observation")] += 1
        elif m < 0:
            result[(*row, "negative_observation")] += 1
        else:
            groups[(a, b)].append(row)
    for group in groups.values():
        if len({r[2] for r in group}) > 1:
            result.update((*r, "conflicting_duplicate") for r in group)
            continue
        group.sort(key=lambda r: (r[3], null_first(r[4])))
        result[(*group[0], None)] += 1
        result.update((*r, "exact_duplicate") for r in group[1:])
    return result


def random_rows(seed: int, size: int = 1500) -> list[tuple]:
    rng = random.Random(seed)
    data = []
    for _ in range(size):
        # one key holds a third of the rows, another a fifth of equal copies
        draw = rng.random()
        if draw < 0.33:
            a, b, m = "hot", 1, 5
        elif draw < 0.53:
            data.append(("copies", 2, 7, "same", 1))
            continue
        elif draw < 0.6:
            a, b, m = "clash", 3, rng.choice([1, 2])
        else:
            a, b, m = rng.choice("xyz"), rng.randrange(200), rng.choice([1, 1, 1, 1, 2])
        m = rng.choice([m] * 20 + [None, -1])
        d = rng.choice(["p", " p", "q ", "q", "", "  ", None, "\t"])
        data.append((a, b, m, d, rng.choice([None, 1, 2, 3])))
    return data


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("heavy", ["none", "some", "all"])
def test_gate_equals_brute_force_on_both_ways(spark, seed, heavy):
    data = random_rows(seed)
    frame = spark.createDataFrame(data, SCHEMA).repartition(5)
    hashes = [r[0] for r in frame.select(key_hash(["a", "b"])).distinct().collect()]
    hot = [
        r[0]
        for r in frame.filter(F.col("a").isin("hot", "copies", "clash"))
        .select(key_hash(["a", "b"]))
        .distinct()
        .collect()
    ]
    chosen = {"none": [], "some": hot, "all": hashes}[heavy]
    expected = expected_gate(data)
    assert rows(quality_gate(frame, SPEC, heavy=chosen)) == expected
    counts = Counter()
    for row, n in expected.items():
        counts[row[-1] or "accepted"] += n
    found = {r["quality_rule"]: r["n"] for r in count_outcomes(frame, SPEC).collect()}
    assert found == counts


def test_heavy_keys_are_found_and_used(spark):
    data = random_rows(4, 3000)
    frame = spark.createDataFrame(data, SCHEMA)
    found = heavy_keys(frame, ["a", "b"], min_rows=100)
    names = frame.filter(key_hash(["a", "b"]).isin(found)).select("a").distinct().collect()
    assert {r[0] for r in names} == {"hot", "copies", "clash"}
    assert rows(quality_gate(frame, SPEC, heavy_rows=100)) == expected_gate(data)
    assert heavy_keys(frame, ["a", "b"], min_rows=10_000) == []
    assert heavy_keys(frame.limit(0), ["a", "b"]) == []


def test_one_of_many_identical_copies_is_kept(spark):
    frame = spark.range(1000).select(F.lit("k").alias("a"), F.lit(1).alias("m"))
    heavy = [frame.select(key_hash(["a"])).first()[0]]
    spec = GateSpec(key=["a"], measure="m")
    assert outcomes(quality_gate(frame, spec, heavy=heavy)) == {
        "accepted": 1,
        "exact_duplicate": 999,
    }


def test_both_ways_keep_every_value_as_it_is(spark):
    """Signed zeros and collated text compare equal without being the same."""
    schema = "k string collate UTF8_LCASE, m double, t string collate UTF8_LCASE, x float"
    data = [
        (k, m, t, x)
        for k in ("Key", "key", "other")
        for m in (0.0, -0.0)
        for t in ("A", "a", "B")
        for x in (-0.0, 0.0, 1.0)
    ] * 3 + [("clash", 1.0, "a", 0.0), ("CLASH", 2.0, "A", -0.0)]
    frame = spark.createDataFrame(data, schema).repartition(6)
    spec = GateSpec(key=["k"], measure="m")
    hashes = [r[0] for r in frame.select(key_hash(["k"])).distinct().collect()]

    def exact(gated):
        return Counter((*map(repr, r[:4]), r[4]) for r in map(tuple, gated.collect()))

    ordinary, heavy = exact(quality_gate(frame, spec, heavy=[])), exact(quality_gate(frame, spec, heavy=hashes))
    assert ordinary == heavy
    given = Counter(tuple(map(repr, r)) for r in map(tuple, frame.collect()))
    assert Counter({k: sum(n for r, n in heavy.items() if r[:4] == k) for k in given}) == given
    assert sum(n for r, n in heavy.items() if r[4] is None) == 2
    assert sum(n for r, n in heavy.items() if r[4] == "conflicting_duplicate") == 2


def test_a_key_far_below_a_share_of_the_rows_is_found(spark):
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 4000 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("m")
    )
    found = heavy_keys(rows, ["k"], min_rows=80)  # 100 of 400,000 rows
    assert rows.filter("k = -1").select(key_hash(["k"])).first()[0] in found
    assert len(found) < 10


def test_looking_for_heavy_keys_shuffles_sketches_only(spark):
    rows = spark.range(0, 2_000_000, 1, 200).select((F.col("id") % 1_000_003).alias("k"))
    counts = sketched_counts(rows, ["k"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CollectLimit" not in plan
    # every exchange lies above an aggregate into sketches
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("approx_top_k_accumulate") < plan.rindex("Exchange hashpartitioning")
    assert "partial_approx_top_k_accumulate" in plan[plan.rindex("Exchange hashpartitioning") :]


def test_ordinary_keys_take_one_exchange_one_sort_one_window(spark):
    frame = spark.range(100).select(
        (F.col("id") % 7).alias("k"), F.col("id").alias("m"), F.lit("x").alias("d")
    )
    gated = quality_gate(frame, GateSpec(key=["k"], measure="m", dimensions=["d"]), heavy=[])
    plan = gated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 1


def test_tasks_of_the_gate_follow_the_rows(spark):
    """However few shuffle partitions the session has, and still one exchange and one sort."""
    frame = spark.range(3000).select((F.col("id") % 700).alias("k"), (F.col("id") % 1400).alias("m"))
    spec = GateSpec(key=["k"], measure="m")
    gated = quality_gate(frame, spec, task_rows=100)
    plan = gated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    assert gated.rdd.getNumPartitions() == 30
    assert rows(gated) == rows(quality_gate(frame, spec, heavy=[]))
    assert quality_gate(frame, spec, task_rows=1000).rdd.getNumPartitions() <= 4  # up to four tasks' share


def test_heavy_rows_are_ranked_in_lanes(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("m"))
    heavy = [frame.select(key_hash(["k"])).first()[0]]
    plan = quality_gate(frame, GateSpec(key=["k"], measure="m"), heavy=heavy)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("Range (") == 1  # the rows of heavy keys were saved
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text


def test_fault_rows_have_one_stable_reason_each(spark):
    frame = spark.createDataFrame(FAULT_ROWS, census.source_schema()).repartition(3)
    gated = quality_gate(frame, census.MODEL.gate)
    assert outcomes(gated) == {
        "accepted": 1,
        "exact_duplicate": 1,
        "conflicting_duplicate": 2,
        "missing_dimension": 1,
        "negative_observation": 1,
        "invalid_observation": 1,
    }
    assert accepted_rows(gated).count() == 1
    assert quarantined_rows(gated).count() == 6


def test_result_does_not_depend_on_partitioning(spark):
    frame = spark.createDataFrame(SAMPLE_ROWS + FAULT_ROWS, census.source_schema())
    results = [quality_gate(frame.repartition(n), census.MODEL.gate) for n in (1, 4, 7)]
    for other in results[1:]:
        assert multiset_difference(results[0], other).count() == 0


def test_differing_labels_count_as_exact_duplicate(spark):
    data = [("k", 1, 5, "b", 1), ("k", 1, 5, "a", 9)]
    gated = quality_gate(spark.createDataFrame(data, SCHEMA), SPEC)
    assert [r["d"] for r in accepted_rows(gated).collect()] == ["a"]
    assert outcomes(gated) == {"accepted": 1, "exact_duplicate": 1}


def test_tabs_survive_unless_asked_for(spark):
    frame = spark.createDataFrame([("k", 1, 5, "\t", 1)], SCHEMA)
    assert outcomes(quality_gate(frame, SPEC)) == {"accepted": 1}
    strict = GateSpec(key=["a", "b"], measure="m", dimensions=["d"], all_whitespace=True)
    assert outcomes(quality_gate(frame, strict)) == {"missing_dimension": 1}


def test_own_rules_replace_the_standard_ones(spark):
    frame = spark.createDataFrame([("k", 1, -5, "x", 1), ("l", 1, 3, "x", 1)], SCHEMA)
    spec = GateSpec(key=["a"], measure="m", rules=[Rule("too_small", F.col("m") < 4)])
    assert outcomes(quality_gate(frame, spec)) == {"too_small": 2}


@pytest.mark.parametrize("large", [False, True])
def test_a_row_without_measure_is_invalid_under_any_rules(spark, large):
    data = [("k", 1, None, "x", 1), ("k", 1, 5, "x", 1), ("k", 1, None, "x", 1), ("l", 1, None, "x", 1)]
    frame = spark.createDataFrame(data, SCHEMA)
    heavy = [r[0] for r in frame.select(key_hash(["a"])).distinct().collect()] if large else []
    gated = quality_gate(frame, GateSpec(key=["a"], measure="m", rules=()), heavy=heavy)
    assert outcomes(gated) == {"accepted": 1, "invalid_observation": 3}


def test_null_keys_form_one_group_without_a_missing_rule(spark):
    frame = spark.createDataFrame([(None, 1, 5, "x", 1), (None, 1, 5, "x", 1)], SCHEMA)
    spec = GateSpec(key=["a", "b"], measure="m")
    heavy = [frame.select(key_hash(["a", "b"])).first()[0]]
    expected = {"accepted": 1, "exact_duplicate": 1}
    assert outcomes(quality_gate(frame, spec, heavy=[])) == expected
    assert outcomes(quality_gate(frame, spec, heavy=heavy)) == expected


def test_gated_input_is_refused(spark):
    gated = quality_gate(spark.createDataFrame([], SCHEMA), SPEC)
    with pytest.raises(ValueError, match="quality_rule"):
        quality_gate(gated, SPEC)


def test_empty_input(spark):
    gated = quality_gate(spark.createDataFrame([], SCHEMA), SPEC)
    assert gated.columns == ["a", "b", "m", "d", "e", "quality_rule"]
    assert gated.count() == 0


@pytest.mark.parametrize("heavy", [False, True])
def test_duplicates_keep_the_first(spark, heavy):
    frame = spark.createDataFrame([(i, "same" if i % 3 else str(i)) for i in range(50)], "id int, t string")
    hashes = [r[0] for r in frame.select(key_hash(["t"])).distinct().collect()] if heavy else []
    marked = mark_duplicates(frame, ["t"], ["id"], heavy=hashes)
    kept = {r["id"] for r in marked.collect() if r["quality_rule"] is None}
    assert kept == {1} | {i for i in range(50) if i % 3 == 0}


def test_conflicting_keys_and_their_rows(spark):
    data = random_rows(5)
    frame = spark.createDataFrame(data, SCHEMA).filter("m is not null")
    keys = conflicting_keys(frame, ["a", "b"], "m")
    values = defaultdict(set)
    for row in frame.collect():
        values[(row["a"], row["b"])].add(row["m"])
    clashing = {k for k, v in values.items() if len(v) > 1}
    assert {tuple(r) for r in keys.collect()} == clashing
    inside = rows(rows_with_keys(frame, keys, ["a", "b"]))
    outside = rows(rows_without_keys(frame, keys, ["a", "b"]))
    assert set(r[:2] for r in inside) == clashing
    assert inside + outside == rows(frame)


def test_membership_treats_null_keys_like_a_join(spark):
    frame = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    keys = spark.createDataFrame([(None,), (1,), (1,)], "k int")
    assert rows(rows_with_keys(frame, keys, ["k"])) == Counter([(1,)])
    assert rows(rows_without_keys(frame, keys, ["k"])) == Counter([(None,), (2,)])


def test_multiset_comparison_counts_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    right = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    found = {tuple(r) for r in multiset_difference(left, right).collect()}
    assert found == {(1, 2, 1), (3, 0, 1)}
    assert same_rows(left, right).first().asDict() == {"different_rows": 2, "same": False}
    assert same_rows(left, left).first().asDict() == {"different_rows": 0, "same": True}

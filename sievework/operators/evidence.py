"""Evidence of a run in long form: ``(section, item, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.checks import summarize_results

# Fixed values: (item, run-summary column, manifest column, text when neither has it).
_IDENTITY = (
    ("pipeline_run_id", "pipeline_run_id", "run_id", "not generated"),
    ("dataset_id", "dataset_id", "source_id", "unknown"),
    ("edition", "edition", "source_edition", "unknown"),
    ("version", "version", "source_version", "unknown"),
    ("filter_hash", None, "filter_hash", "not generated"),
)
_COUNTS = ("input_rows", "accepted_rows", "quarantined_rows")


def _preferred(frame: DataFrame, section: str, items: list[tuple]) -> DataFrame:
    """Candidates ``(section, item, preference, value)`` from one row of ``frame``, that of the last run.

    An aggregate has a row even over an empty frame, so absent evidence needs no special case.
    """
    columns = list(dict.fromkeys(column for _, column, _ in items))
    whole = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    run = "pipeline_run_id" if "pipeline_run_id" in frame.columns else "run_id"
    # ties within a run by the values themselves
    last = frame.agg(F.max(F.struct(F.col(run).cast("string"), whole.alias("row"))).alias("last"))
    maxima = last.select(*[F.col("last.row")[c].alias(c) for c in columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                F.lit(item).alias("item"),
                F.lit(preference).alias("preference"),
                F.col(column).alias("value"),
            )
            for item, column, preference in items
        ]
    )
    return maxima.select(F.inline(rows))


def collect_evidence(summary: DataFrame, manifest: DataFrame, results: DataFrame) -> DataFrame:
    """Run identity (summary before manifest before a default), artifacts, counts and check totals.

    Every source becomes rows of one long table, so nothing needs a cross join.
    """
    from_summary = [(item, column, 1) for item, column, _, _ in _IDENTITY if column]
    from_manifest = [(item, column, 2) for item, _, column, _ in _IDENTITY]
    candidates = (
        _preferred(summary, "run", from_summary)
        .unionByName(_preferred(manifest, "run", from_manifest))
        .unionByName(_preferred(summary, "gate", [(name, name, 1) for name in _COUNTS]))
        .filter(F.col("value").isNotNull())
    )
    defaults = {item: text for item, _, _, text in _IDENTITY} | dict.fromkeys(
        _COUNTS, "not generated"
    )
    fallback = F.array(
        *[
            F.struct(
                F.lit("gate" if item in _COUNTS else "run").alias("section"),
                F.lit(item).alias("item"),
                F.lit(9).alias("preference"),
                F.lit(text).alias("value"),
            )
            for item, text in defaults.items()
        ]
    )
    candidates = candidates.unionByName(summary.agg(F.count(F.lit(1))).select(F.inline(fallback)))
    best = F.min_by("value", "preference").alias("value")
    chosen = candidates.groupBy("section", "item").agg(best)
    artifacts = manifest.select(
        F.lit("artifact").alias("section"),
        F.coalesce(F.col("kind"), F.lit("unknown")).alias("item"),
        F.coalesce(F.col("sha256"), F.lit("missing")).alias("value"),
    )
    totals = (
        summarize_results(results)
        .unpivot([], ["executed", "passed", "failed"], "item", "value")
        .select(F.lit("checks").alias("section"), "item", F.col("value").cast("string"))
    )
    return chosen.unionByName(artifacts).unionByName(totals)

"""From a source to gated, modelled and audited layers, saved one after another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.operators.contracts import enforce_contract
from sievework.operators.gate import GateSpec, quality_gate
from sievework.operators.model import (
    build_dimension,
    build_fact,
    build_mart,
    conform,
    layer_counts,
)
from sievework.operators.provenance import RunMetadata, with_provenance
from sievework.sinks.parquet import save_gated, save_layer
from sievework.sinks.reports import run_summary, write_json
from sievework.sinks.tables import materialize, register_table


@dataclass(frozen=True)
class ModelSpec:
    """Everything that differs from one subject to the next."""

    gate: GateSpec
    hash_columns: Sequence[str]
    staging: StructType
    # dimension name -> (code column, label column)
    dimensions: Mapping[str, tuple[str, str]]
    fact_key: Sequence[str]
    fact_columns: Sequence[str]
    mart_dimension: str
    mart_group: Sequence[str]
    measure: str
    total: str


@dataclass(frozen=True)
class Layers:
    """Saved layers of one run."""

    accepted: DataFrame
    quarantined: DataFrame
    staging: DataFrame
    dimensions: Mapping[str, DataFrame]
    fact: DataFrame
    mart: DataFrame
    summary: DataFrame
    audit: DataFrame = field(repr=False)

    def tables(self) -> dict[str, DataFrame]:
        """Layers by table name, as checks refer to them."""
        return {
            "raw": self.accepted,
            "staging": self.staging,
            **{f"dim_{name}": df for name, df in self.dimensions.items()},
            "fact": self.fact,
            "mart": self.mart,
            "audit": self.audit,
        }


def gate_and_stamp(
    source: DataFrame, spec: ModelSpec, run: RunMetadata, heavy: Sequence[int] | None = None
) -> DataFrame:
    """Gate the source, then stamp run identity and fingerprints on every row."""
    return with_provenance(quality_gate(source, spec.gate, heavy), run, spec.hash_columns)


def model_layers(loaded: DataFrame, spec: ModelSpec) -> dict[str, DataFrame]:
    """Staging, dimensions, fact and mart over loaded rows, all still lazy."""
    staging = enforce_contract(conform(loaded, spec.staging), spec.staging)
    layers = {"staging": staging}
    for name, (code, label) in spec.dimensions.items():
        layers[f"dim_{name}"] = build_dimension(staging, name, code, label)
    codes = {name: code for name, (code, _) in spec.dimensions.items()}
    layers["fact"] = build_fact(staging, spec.fact_key, codes, spec.fact_columns)
    return layers


def mart_of(fact: DataFrame, dimension: DataFrame, spec: ModelSpec) -> DataFrame:
    key = f"{spec.mart_dimension}_key"
    return build_mart(fact, dimension, key, spec.mart_group, spec.measure, spec.total)


def build_layers(
    source: DataFrame,
    spec: ModelSpec,
    run: RunMetadata,
    out: str,
    heavy: Sequence[int] | None = None,
) -> Layers:
    """Run everything below ``out``. Each layer is built from the saved one before it."""
    gated = gate_and_stamp(source, spec, run, heavy)
    accepted, quarantined = save_gated(gated, f"{out}/gated", run)
    spark = source.sparkSession
    lazy = model_layers(accepted, spec)
    dimensions = {
        name: save_layer(lazy[f"dim_{name}"], f"{out}/dim_{name}") for name in spec.dimensions
    }
    fact = save_layer(lazy["fact"], f"{out}/fact")
    mart = save_layer(mart_of(fact, dimensions[spec.mart_dimension], spec), f"{out}/mart")
    counts = layer_counts({"input": source, "accepted": accepted, "quarantined": quarantined})
    summary = run_summary(counts, run)
    write_json(summary, f"{out}/summary")
    return Layers(
        accepted=accepted,
        quarantined=quarantined,
        staging=lazy["staging"],
        dimensions=dimensions,
        fact=fact,
        mart=mart,
        summary=spark.read.schema(summary.schema).json(f"{out}/summary"),
        audit=layer_counts({"raw": accepted, "staging": lazy["staging"], "fact": fact}),
    )


def publish(layers: Layers, out: str, prefix: str = "") -> dict[str, DataFrame]:
    """Make the layers of a run below ``out`` available by name.

    Dimensions, fact and mart become tables over their saved files, staging and audit views.
    """
    spark = layers.fact.sparkSession
    saved = [*(f"dim_{name}" for name in layers.dimensions), "fact", "mart"]
    relations = {n: register_table(spark, f"{prefix}{n}", f"{out}/{n}") for n in saved}
    for name in ("staging", "audit"):
        relations[name] = materialize(layers.tables()[name], f"{prefix}{name}")
    return relations


def model_results(layers: Layers) -> DataFrame:
    """One ``success`` row per built model, in the shape of check results."""
    models = {name: df for name, df in layers.tables().items() if name != "raw"}
    return layer_counts(models).select(
        F.lit("model").alias("check"),
        F.col("layer").alias("target"),
        F.lit(None).cast("string").alias("column"),
        F.lit(0).cast("long").alias("failures"),
        F.lit("success").alias("status"),
    )

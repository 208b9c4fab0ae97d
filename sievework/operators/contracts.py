"""Declared schemas, metadata documents and row constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from sievework.errors import SchemaContractError

# Patterns and vocabularies of the landing records.
SHA256_PATTERN = "^[a-f0-9]{64}$"
ARTIFACT_KINDS = ("csv", "csvw", "json")
INTEGER_DATATYPES = ("integer", "long")

METADATA_SCHEMA = (
    "tableSchema struct<columns:array<struct<name:string,datatype:string,required:boolean>>,"
    "primaryKey:array<string>>"
)


def enforce_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """Return ``df`` when its names and types are the declared ones in order, else raise."""
    expected = [(f.name, f.dataType.simpleString()) for f in contract.fields]
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if expected != actual:
        raise SchemaContractError(f"expected columns {expected}, got {actual}")
    return df


def _lost_by_cast(df: DataFrame, column: str, target: DataType) -> Column:
    """Values a type cannot hold; all of them where there is no cast between the two types."""
    present = F.col(column).isNotNull()
    held = F.col(column).try_cast(target)
    try:
        df.select(held)  # analysis only
    except AnalysisException:
        return present
    return present & held.isNull()


def contract_drift(df: DataFrame, contract: StructType) -> DataFrame:
    """Every deviation from ``contract`` with the number of rows it touches, in one pass.

    ``problem`` is missing, unexpected, moved, retyped or null_in_required; ``n_rows`` counts all
    rows, for ``retyped`` the values the declared type cannot hold, for ``null_in_required`` the
    NULLs (reported only when there are any).
    """
    actual = {f.name: (i, f) for i, f in enumerate(df.schema.fields)}
    declared = {f.name: (i, f) for i, f in enumerate(contract.fields)}
    every = F.count(F.lit(1))
    findings: list[tuple[str, str, str | None, str | None, Column]] = []
    for name, (position, field) in declared.items():
        want = field.dataType.simpleString()
        if name not in actual:
            findings.append((name, "missing", want, None, every))
            continue
        at, have = actual[name]
        if at != position:
            findings.append((name, "moved", str(position), str(at), every))
        if have.dataType != field.dataType:
            got = have.dataType.simpleString()
            lost = F.count_if(_lost_by_cast(df, name, field.dataType))
            findings.append((name, "retyped", want, got, lost))
        if not field.nullable:
            nulls = F.count_if(F.col(name).isNull())
            findings.append((name, "null_in_required", "not null", None, nulls))
    for name, (_, field) in actual.items():
        if name not in declared:
            findings.append((name, "unexpected", None, field.dataType.simpleString(), every))
    text = lambda value: F.lit(value).cast("string")
    rows = F.array(
        *[
            F.struct(
                text(name).alias("column"),
                text(problem).alias("problem"),
                text(want).alias("expected"),
                text(got).alias("actual"),
                F.col(f"_{i}").alias("n_rows"),
            )
            for i, (name, problem, want, got, _) in enumerate(findings)
        ]
    )
    if not findings:
        empty = "column string, problem string, expected string, actual string, n_rows long"
        return df.sparkSession.createDataFrame([], empty)
    counts = df.agg(*[count.alias(f"_{i}") for i, (*_, count) in enumerate(findings)])
    return counts.select(F.inline(rows)).filter(
        (F.col("problem") != "null_in_required") | (F.col("n_rows") > 0)
    )


def metadata_drift(
    docs: DataFrame,
    doc_id: str,
    content: str,
    names: Sequence[str],
    measure: str,
    datatypes: Sequence[str] = INTEGER_DATATYPES,
) -> DataFrame:
    """Deviations of metadata documents from the expected column list, per document.

    Position by position: ``name`` where the column name differs (or one side ends), and
    ``datatype`` where the measure is not one of ``datatypes``. Row-local, hence no shuffle; a text
    that is no such document has no columns at all.
    """
    parsed = F.coalesce(
        F.from_json(F.col(content), METADATA_SCHEMA)["tableSchema"]["columns"],
        F.array().cast("array<struct<name:string,datatype:string,required:boolean>>"),
    )
    # a column of its own, so that each document is parsed once and not once per position
    docs = docs.select(doc_id, parsed.alias("_columns"))
    columns = F.col("_columns")
    expected = F.array(*[F.lit(n) for n in names])
    slots = F.sequence(F.lit(0), F.greatest(F.size(expected), F.size(columns)) - 1)

    def compare(position: Column) -> Column:
        have = F.get(columns, position)
        want = F.get(expected, position)
        wrong_name = ~have["name"].eqNullSafe(want)
        typed = F.coalesce(have["datatype"].isin(*datatypes), F.lit(False))
        return F.struct(
            position.alias("position"),
            F.when(wrong_name, "name")
            .when((want == measure) & ~typed, "datatype")
            .alias("problem"),
            F.when(wrong_name, want).otherwise(F.lit("|".join(datatypes))).alias("expected"),
            F.when(wrong_name, have["name"]).otherwise(have["datatype"]).alias("actual"),
        )

    found = F.filter(F.transform(slots, compare), lambda s: s["problem"].isNotNull())
    return docs.select(F.col(doc_id), F.inline(found))


def constraint_violations(
    df: DataFrame, row_id: Sequence[str], constraints: Mapping[str, Column]
) -> DataFrame:
    """``(row_id, rule)`` for every constraint a row does not meet; NULL counts as not met."""
    broken = F.array(
        *[
            F.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
            for name, holds in constraints.items()
        ]
    )
    return df.select(*row_id, F.explode(F.array_compact(broken)).alias("rule"))


def at_least(column: str, bound: int) -> Column:
    return F.col(column) >= bound


def matches(column: str, pattern: str) -> Column:
    return F.col(column).rlike(pattern)


def one_of(column: str, values: Sequence[str | int]) -> Column:
    return F.col(column).isin(*values)


def optional(column: str, holds: Column) -> Column:
    """NULL is allowed."""
    return F.col(column).isNull() | holds


def unknown_fields(document: Column, allowed: Sequence[str]) -> Column:
    """Sorted top-level fields of a JSON object that are not declared; NULL if it is no object."""
    keys = F.json_object_keys(document)
    known = F.array(*[F.lit(n) for n in allowed]).cast("array<string>")
    return F.array_sort(F.array_except(keys, known))


# Allowed values that are written into the query itself; more are joined.
LISTED_VALUES = 10_000


def accepted_values(df: DataFrame, allowed: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column``, ``value``, ``n`` of every value of a column that ``allowed`` (``column``, ``value``) does not list.

    Values are compared as text; NULLs are left to the not-null checks. All columns, by default those that ``allowed`` names, are
    checked in one pass. A short list (``LISTED_VALUES``, checked) is tested row by row, so only violations are
    counted and shuffled; otherwise all values are counted first, combined where they are read, and the distinct ones meet the list in an anti join.
    """
    listed = allowed.select(F.col("column"), F.col("value").cast("string").alias("value")).distinct()
    known = listed.limit(LISTED_VALUES + 1).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("column", "value")).alias("pairs")
    ).first()
    by_column: dict[str, list[str]] = {}
    for pair in known["pairs"]:
        by_column.setdefault(pair["column"], []).append(pair["value"])
    short = known["n"] <= LISTED_VALUES
    if columns is None:
        columns = sorted(by_column) if short else sorted(
            r["column"] for r in listed.select("column").distinct().limit(len(df.columns) + 1).agg(
                F.collect_list(F.struct("column")).alias("c")).first()["c"]
        )
    text = {c: F.col(f"`{c}`").cast("string") for c in columns}

    def found(c: str) -> Column:
        fits = text[c].isin(by_column.get(c, [])) if short and by_column.get(c) else F.lit(False)
        return F.when(text[c].isNotNull() & ~fits, F.struct(F.lit(c).alias("column"), text[c].alias("value")))

    values = df.select(F.explode(F.array_compact(F.array(*map(found, columns)))).alias("v")).select("v.column", "v.value")
    counted = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted if short else counted.join(listed, ["column", "value"], "left_anti")

"""Schema gate: BACKWARD compatibility on append, evolution, row-level fit."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T


class IncompatibleSchema(ValueError):
    """The new schema cannot read data written with the old one."""


@dataclass(frozen=True)
class GateReport:
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    breaking: list[str] = field(default_factory=list)

    @property
    def compatible(self) -> bool:
        return not self.breaking


# Promotions that keep every value: what a reader may apply to older data, and what a table may grow to.
_WIDENS = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("tinyint", "float"), ("tinyint", "double"),
    ("smallint", "int"), ("smallint", "bigint"), ("smallint", "float"), ("smallint", "double"),
    ("int", "bigint"), ("int", "double"), ("float", "double"), ("string", "binary"), ("binary", "string"),
}
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of two numeric types, if one of them does; null for others that differ."""
    x, y = a.simpleString(), b.simpleString()
    if x == y or x in _NUMBERS and (y, x) in _WIDENS:
        return a
    return b if x in _NUMBERS and (x, y) in _WIDENS else None


def fitted(new: T.StructType, old: T.StructType) -> T.StructType:
    """``new`` as it can be stored beside ``old``: shared numeric columns in their common type, where there is one."""
    before = {f.name: f.dataType for f in old.fields}
    return T.StructType([
        T.StructField(f.name, (common_type(before[f.name], f.dataType) if f.name in before else None) or f.dataType, f.nullable) for f in new.fields])


def compare(old: T.StructType, new: T.StructType, defaults: frozenset[str] = frozenset()) -> GateReport:
    """BACKWARD rule: a new field needs a default (here: nullable, or listed); removal is fine."""
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    added = [n for n in after if n not in before]
    breaking = [f"{n}: new required field without default" for n in added
                if not after[n].nullable and n not in defaults]
    for n in after.keys() & before.keys():
        have, want = before[n].dataType.simpleString(), after[n].dataType.simpleString()
        if have != want and (have, want) not in _WIDENS:
            breaking.append(f"{n}: {have} cannot be read as {want}")
    return GateReport(added, [n for n in before if n not in after], sorted(breaking))


def require_compatible(old: T.StructType, new: T.StructType, defaults: frozenset[str] = frozenset()) -> GateReport:
    report = compare(old, new, defaults)
    if not report.compatible:
        raise IncompatibleSchema("; ".join(report.breaking))
    return report


def misfit(columns: dict[str, Column], schema: T.StructType) -> Column:
    """Name of the first field whose text does not fit the schema, or null."""
    bad = []
    for f in schema.fields:
        source = columns.get(f.name, F.lit(None).cast("string"))
        wrong = source.isNotNull() & source.try_cast(f.dataType).isNull()
        if not f.nullable:
            wrong = wrong | source.isNull()
        bad.append(F.when(wrong, F.lit(f.name)))
    return F.coalesce(*bad)


def gate_rows(df: DataFrame, columns: dict[str, Column], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(typed rows that fit, rows that do not with ``misfit``); the rest of a batch goes on."""
    tagged = df.withColumn("misfit", misfit(columns, schema))
    typed = [columns.get(f.name, F.lit(None).cast("string")).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return (
        tagged.filter(F.col("misfit").isNull()).select(*typed),
        tagged.filter(F.col("misfit").isNotNull()),
    )


def evolve(df: DataFrame, table: T.StructType) -> DataFrame:
    """``df`` with the table's missing columns added as nulls, table columns first, shared columns in their common type.

    Give it only what ``compare`` of the table with ``fitted`` lets pass: both use the same promotions.
    """
    types = {f.name: f.dataType for f in fitted(df.schema, table).fields}
    known = [F.col(f.name).cast(types[f.name]).alias(f.name) if f.name in types
             else F.lit(None).cast(f.dataType).alias(f.name) for f in table.fields]
    return df.select(*known, *[c for c in df.columns if c not in set(table.fieldNames())])

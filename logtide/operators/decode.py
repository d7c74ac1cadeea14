"""Decoding of log values: split good from bad, unwrap, declare, version, budget."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from logtide.functions import jsontext as J
from logtide.operators.gate import IncompatibleSchema, common_type


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often they are used later.

    After ``withColumn`` the optimizer copies a column's expression into every filter above
    it, so a parsed document would be parsed again per condition. A one-row generator is
    a border it does not move expressions across, and it stays inside generated code.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def with_box(df: DataFrame, value: str = "value", box: str = "_box") -> DataFrame:
    """Add the parsed box of a JSON text column (see ``logtide.functions.jsontext``)."""
    return computed_once(df, **{box: J.boxed(F.col(value))})


def with_reject_reason(log: DataFrame, value: str = "value") -> DataFrame:
    """Add ``reject_reason``: null for usable JSON, else why the record is skipped."""
    reason = J.reject_reason(F.col(value), F.col("_box"))
    return computed_once(with_box(log, value), reject_reason=reason).drop("_box")


def parse_split(log: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, bad) records; ``bad`` keeps the raw value and the reason."""
    tagged = with_reject_reason(log, value)
    return (
        tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        tagged.filter(F.col("reject_reason").isNotNull()),
    )


def declare(log: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """A JSON log read with a declared schema; ``undeclared`` gives the records that are not JSON objects of it."""
    good = with_box(log, value).filter(J.is_json(F.col(value), F.col("_box")))
    return computed_once(good, _v=J.typed(F.col(value), schema)).filter(F.col("_v").isNotNull()).select(*keep, "_v.*")


def undeclared(log: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The records that ``declare`` leaves out, whole, with ``reason``: each record is in one of the two."""
    tagged = with_box(log, value).withColumn("reason", F.when(~F.coalesce(J.is_json(F.col(value), F.col("_box")), F.lit(False)), F.lit("not JSON")))
    read = computed_once(tagged, _v=F.when(F.col("reason").isNull(), J.typed(F.col(value), schema)))
    return read.filter(F.col("_v").isNull()).select(*log.columns, F.coalesce("reason", F.lit("not an object")).alias("reason"))


def unwrap_log(log: DataFrame, value: str = "value") -> DataFrame:
    """Add ``document``: the text of the inner document of a possibly double-encoded value.

    A JSON string literal gives the text inside it when that is JSON itself; any other
    JSON value gives its own text; anything else gives null. ``literal`` tells which.
    """
    outer = computed_once(with_box(log, value), literal=J.kind(F.col("_box")) == "STRING")
    once = F.when(J.is_json(F.col(value), F.col("_box")),
                  F.when(F.col("literal"), J.literal_text(F.col("_box"))).otherwise(F.col(value)))
    inner = computed_once(outer, _once=once).drop("_box")
    checked = with_box(inner, "_once")
    return computed_once(
        checked, document=F.when(J.is_json(F.col("_once"), F.col("_box")), F.col("_once"))).drop("_once", "_box")


def shape_guard(log: DataFrame, fields: dict[str, str], value: str = "value") -> DataFrame:
    """Add ``shape_ok``: whether the value is an object with these fields and types."""
    ok = J.has_shape(F.col(value), F.col("_box"), fields)
    return computed_once(with_box(log, value), shape_ok=ok).drop("_box")


def raw_to_typed(raw: DataFrame, paths: dict[str, tuple[str, str]], required: str, value: str = "raw") -> DataFrame:
    """Typed rows from raw double-encoded text, each text parsed once per level.

    ``paths`` maps a column to (path, ``string`` or ``double``). A missing path gives ''
    or 0, and rows whose ``required`` column is '' are left out: those are records in
    another format, or broken ones.
    """
    inner = computed_once(with_box(raw.select(value), value), _text=J.literal_text(F.col("_box"))).drop("_box")
    read: dict[str, Column] = {
        name: (J.text_or_empty if want == "string" else J.number_or_zero)(F.col("_box"), path)
        for name, (path, want) in paths.items()
    }
    return computed_once(with_box(inner, "_text"), **read).select(*paths).filter(F.col(required) != "")


ORDER_PATHS = {
    "order_id": (".order.orderId", "string"),
    "customer_id": (".order.customerId", "string"),
    "total": (".order.total", "double"),
    "status": (".order.status", "string"),
}
PAYMENT_PATHS = {
    "order_id": (".orderId", "string"),
    "amount": (".amount", "double"),
    "status": (".status", "string"),
}


def read_versions(log: DataFrame, schemas: dict[int, T.StructType], version: str = "schema_id",
                  value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of several schema versions read together, in one pass.

    Each record is decoded with the schema it was written with. Columns that its version
    lacks are null; a column whose type changed gets the type of the newest version.
    ``unread_versions`` gives the records with another version and those that do not decode.
    """
    ordered = sorted(schemas.items())
    decoded = computed_once(log.filter(F.col(version).isin(list(schemas))), **{
        f"_v{sid}": F.when(F.col(version) == sid, J.typed(F.col(value), schema)) for sid, schema in ordered})
    newest: dict[str, T.DataType] = {}
    for _, schema in ordered:
        newest.update({f.name: f.dataType for f in schema.fields})
    fields = [
        F.coalesce(*[F.col(f"_v{sid}.{name}").cast(kind) for sid, schema in ordered if name in schema.fieldNames()]).alias(name)
        for name, kind in newest.items()
    ]
    readable = reduce(lambda a, b: a | b, [F.col(f"_v{sid}").isNotNull() for sid, _ in ordered])
    return decoded.filter(readable).select(*keep, version, *fields)


def unread_versions(log: DataFrame, schemas: dict[int, T.StructType], version: str = "schema_id", value: str = "value") -> DataFrame:
    """The records that ``read_versions`` leaves out, whole, with ``reason``: each record is in one of the two."""
    known = F.coalesce(F.col(version).isin(list(schemas)), F.lit(False))
    read = computed_once(log, **{f"_v{sid}": F.when(F.col(version) == sid, J.typed(F.col(value), schema)) for sid, schema in schemas.items()})
    readable = reduce(lambda a, b: a | b, [F.col(f"_v{sid}").isNotNull() for sid in schemas])
    return read.filter(~readable).select(*log.columns, F.when(known, F.lit("does not decode")).otherwise(F.lit("unknown version")).alias("reason"))


def wire_header(df: DataFrame, body: str = "body") -> DataFrame:
    """Split ``0x00 | 4-byte big-endian schema id | payload`` frames.

    A frame with another magic byte, or shorter than its header, has a null schema id.
    """
    frame = F.col(body)
    framed = (F.octet_length(frame) >= 5) & (F.hex(F.substring(frame, 1, 1)) == "00")
    return df.select(
        *[c for c in df.columns if c != body],
        F.when(framed, F.conv(F.hex(F.substring(frame, 2, 4)), 16, 10).cast("bigint")).alias("schema_id"),
        F.when(framed, F.substr(frame, F.lit(6))).alias("payload"),
    )


@dataclass(frozen=True)
class Writer:
    """A schema that records were written with, and the reader's names for fields that it called otherwise."""

    schema: T.StructType
    renamed: dict[str, str] = field(default_factory=dict)  # reader's name -> writer's name


def _resolution(writers: dict[int, Writer], reader: T.StructType, defaults: dict[str, Column]) -> list[Column]:
    """The reader's fields as columns over ``schema_id`` and the parsed payload ``_v``; raises if a writer cannot be read."""
    out, problems = [], []
    for f in reader.fields:
        ways = []
        for sid, w in writers.items():
            name = w.renamed.get(f.name, f.name)
            if name in w.schema.fieldNames():
                kind = w.schema[name].dataType
                if common_type(kind, f.dataType) != f.dataType:
                    problems.append(f"schema {sid}: {name} {kind.simpleString()} cannot be read as {f.name} {f.dataType.simpleString()}")
                value = F.try_variant_get("_v", f"$.{name}", kind.simpleString()).cast(f.dataType)
            elif f.name in defaults:
                value = defaults[f.name].cast(f.dataType)
            else:
                if not f.nullable:
                    problems.append(f"schema {sid}: no {f.name}, which has no default")
                value = F.lit(None).cast(f.dataType)
            ways.append((sid, value))
        column = F.lit(None).cast(f.dataType)
        for sid, value in ways:
            column = F.when(F.col("schema_id") == sid, value).otherwise(column)
        out.append(column.alias(f.name))
    if problems:
        raise IncompatibleSchema("; ".join(problems))
    return out


def read_framed(frames: DataFrame, writers: dict[int, Writer], reader: T.StructType, defaults: dict[str, Column] | None = None, body: str = "body") -> DataFrame:
    """Binary frames to rows of the reader's schema in one pass: the other columns, ``schema_id, reject_reason`` and the fields.

    The id in the frame picks the writer's schema. A field is found under its own or its former name, read with the
    writer's type and promoted to the reader's; one that the writer lacks takes its default, or null. Whether this works
    is decided before any record is read: a type that cannot be promoted without loss, or a required field that a writer
    lacks and that has no default, raises ``IncompatibleSchema``.

    A record that cannot be read keeps its other columns, has null fields, and tells why: ``not framed``, ``unknown schema``,
    ``not JSON``, or ``misfit: <field>`` for a value that is not of the writer's type or a required one that is missing.
    Every payload is parsed once, whatever the number of versions.
    """
    rest = [c for c in frames.columns if c != body]
    fields = _resolution(writers, reader, defaults or {})
    framed = wire_header(frames, body)
    known = F.col("schema_id").isin(list(writers))
    text = F.when(known, F.expr("CASE WHEN is_valid_utf8(CAST(payload AS STRING)) THEN CAST(payload AS STRING) END"))
    parsed = computed_once(framed, _v=F.try_parse_json(text))
    bad = []
    for sid, w in writers.items():
        for f in w.schema.fields:
            got = F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString())
            there = F.coalesce(F.schema_of_variant(F.try_variant_get("_v", f"$.{f.name}", "variant")) != "VOID", F.lit(False))
            wrong = got.isNull() & (there if f.nullable else F.lit(True))
            bad.append(F.when((F.col("schema_id") == sid) & wrong, F.lit(f"misfit: {f.name}")))
    reason = (F.when(F.col("schema_id").isNull(), "not framed").when(~known, "unknown schema").when(F.col("_v").isNull(), "not JSON")
              .otherwise(F.coalesce(*bad)))
    judged = computed_once(parsed, reject_reason=reason)
    good = F.col("reject_reason").isNull()
    return judged.select(*rest, "schema_id", "reject_reason", *[F.when(good, c).alias(f.name) for c, f in zip(fields, reader.fields, strict=True)])


class ErrorBudgetExceeded(RuntimeError):
    """A block of input had more broken records than its budget allows."""


def block_errors(df: DataFrame, is_bad: Column, block: Column, max_bad: int) -> DataFrame:
    """Per block: records, broken records, and whether the block may be ingested."""
    bad = F.count_if(is_bad)
    return df.groupBy(block.alias("block")).agg(
        F.count("*").alias("records"), bad.alias("bad_records"), (bad <= max_bad).alias("within_budget"))


def error_budget(df: DataFrame, is_bad: Column, block: Column, max_bad: int = 100) -> tuple[DataFrame, DataFrame]:
    """(good, bad) records, or ``ErrorBudgetExceeded`` when any block is over budget."""
    worst = (
        block_errors(df, is_bad, block, max_bad).filter(~F.col("within_budget"))
        .orderBy(F.desc("bad_records"), "block").limit(1).collect()
    )
    if worst:
        raise ErrorBudgetExceeded(f"block {worst[0].block}: {worst[0].bad_records} broken records, budget {max_bad}")
    return df.filter(~is_bad), df.filter(is_bad)

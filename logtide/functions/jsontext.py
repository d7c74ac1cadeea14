"""JSON text functions that never fail a job and never mistake one shape for another.

A value is parsed once, by ``boxed``, and every question about it is then asked of the
parsed box. ``logtide.operators.decode.with_box`` computes the box once per row; the
functions here that take only ``value`` parse it themselves and suit single uses.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Closing element of the box; any text works that values are unlikely to contain.
_SEAL = "end-of-value/7d1f"


def boxed(value: Column) -> Column:
    """``[value, seal]`` as a variant, or null when that does not parse."""
    return F.try_parse_json(F.concat(F.lit("["), value, F.lit(f',"{_SEAL}"]')))


def is_json(value: Column, box: Column | None = None) -> Column:
    """Whether the text is exactly one JSON value (any kind, nothing after it).

    ``try_parse_json`` alone stops after the first value and so accepts ``{} x``. In the
    box, the seal comes second only if the text was one value and nothing more. Text that
    contains the seal itself could forge that by closing the box early; it must also fit
    inside an object, where the ``]`` it would need is a syntax error.
    """
    box = boxed(value) if box is None else box
    sealed = F.try_variant_get(box, "$[1]", "string") == _SEAL
    in_object = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit(',"w":0}')), "$.w") == "0"
    return F.coalesce(sealed & (~value.contains(_SEAL) | in_object), F.lit(False))


def kind(box: Column, path: str = "") -> Column:
    """Variant type name (STRING, BIGINT, OBJECT<...>) of the boxed value or a path in it."""
    return F.schema_of_variant(F.try_variant_get(box, f"$[0]{path}", "variant"))


def reject_reason(value: Column, box: Column | None = None) -> Column:
    """Why a value cannot be used as JSON, or null when it can."""
    return (
        F.when(value.isNull(), F.lit("null_value"))
        .when(~is_json(value, box), F.lit("invalid_json"))
        .when(F.trim(value) == "null", F.lit("null_value"))
    )


def literal_text(box: Column) -> Column:
    """The text inside a JSON string literal; null for every other kind of value."""
    return F.when(kind(box) == "STRING", F.try_variant_get(box, "$[0]", "string"))


def text_or_empty(box: Column, path: str) -> Column:
    """String at a path of the boxed value; '' when it is missing or not a string."""
    return F.coalesce(F.when(kind(box, path) == "STRING", F.try_variant_get(box, f"$[0]{path}", "string")), F.lit(""))


def number_or_zero(box: Column, path: str) -> Column:
    """Number at a path of the boxed value; 0 when it is missing or no number."""
    return F.coalesce(F.try_variant_get(box, f"$[0]{path}", "double"), F.lit(0.0))


_NUMBER_KINDS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$"


def has_shape(value: Column, box: Column, fields: dict[str, str]) -> Column:
    """Whether the boxed value is an object whose fields have the JSON types given.

    ``fields`` maps a field name to ``string``, ``number``, ``boolean``, ``object`` or
    ``array``. The number 3 and the string "3" are told apart.
    """
    ok = is_json(value, box) & kind(box).startswith("OBJECT")
    for name, wanted in fields.items():
        found = kind(box, f".{name}")
        matches = {
            "string": found == "STRING",
            "number": found.rlike(_NUMBER_KINDS),
            "boolean": found == "BOOLEAN",
            "object": found.startswith("OBJECT"),
            "array": found.startswith("ARRAY"),
        }[wanted]
        ok = ok & matches
    return F.coalesce(ok, F.lit(False))


def typed(value: Column, schema: T.StructType) -> Column:
    """The value read with a declared schema; fields that do not fit become null."""
    return F.from_json(value, schema, {"mode": "PERMISSIVE"})


def json_literal(text: Column) -> Column:
    """``text`` as a JSON string literal (what a relay of a text column publishes)."""
    quoted = F.to_json(F.array(text))
    return F.substr(quoted, F.lit(2), F.length(quoted) - 2)

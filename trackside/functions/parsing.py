"""Message text to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from trackside import schemas


def nan_to_null(col: Column, kind: T.DataType) -> Column:
    """NaN to NULL in a float column, or in the floats inside structs and arrays.

    A NaN reading would otherwise turn every average and maximum it meets into
    NaN.
    """
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    if isinstance(kind, T.StructType) and _holds_float(kind):
        members = [
            nan_to_null(col.getField(f.name), f.dataType).alias(f.name)
            for f in kind.fields
        ]
        return F.when(col.isNotNull(), F.struct(*members))
    if isinstance(kind, T.ArrayType) and _holds_float(kind.elementType):
        return F.transform(col, lambda item: nan_to_null(item, kind.elementType))
    return col


def _holds_float(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_float(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_float(kind.elementType)
    return isinstance(kind, (T.FloatType, T.DoubleType))


def json_parse(
    messages: DataFrame,
    schema: str,
    value: str = "value",
    keep: Sequence[str] = (),
    keep_nan: bool = False,
) -> DataFrame:
    """Parse JSON text or bytes in `value` into the columns of `schema`.

    Text that is no JSON object, a field that is missing or of the wrong type,
    and a number out of range all read as NULL; field names are case-sensitive.
    Columns named in `keep` (topic, offset, the raw value) stay in front.
    """
    record = F.from_json(F.col(value).cast("string"), schema)
    # a generator, since a filter on a parsed field would otherwise be moved in
    # front of the projection and parse every message a second time
    parsed = messages.select(*keep, F.inline(F.array(record)))
    if keep_nan:
        return parsed
    return parsed.select(
        *keep,
        *(
            nan_to_null(F.col(f.name), f.dataType).alias(f.name)
            for f in parsed.schema.fields[len(keep):]
        ),
    )


def nested_parse(
    messages: DataFrame,
    value: str = "value",
    keep: Sequence[str] = (),
    keep_nan: bool = False,
) -> DataFrame:
    """Parse lap messages: columns `part`, `lap`, `weather` and the array `car`."""
    return json_parse(messages, schemas.NESTED, value, keep, keep_nan)


def is_sentinel(value: str | Column = "value") -> Column:
    """True for an end-of-stream message: a JSON object with the key ``end``.

    The text search comes first, so that the keys of a large ordinary message
    are not listed.
    """
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    has_key = F.array_contains(F.json_object_keys(text), "end")
    return F.coalesce(text.contains('"end"') & has_key, F.lit(False))


#: Why a message is rejected.
REASONS = ("sentinel", "not JSON", "not an object", "missing field", "wrong type")


def rejects_by_reason(
    messages: DataFrame,
    schema: str,
    required: Sequence[str],
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The messages that lack a `required` field once parsed as `json_parse` does, with
    `reason` (one of `REASONS`) and the `field` that is to blame, the first of several.

    A field that is NULL in the message is a missing one; one with a value that does
    not fit its type, out of range included, is of the wrong type. Columns `keep` stay
    in front. Batch or stream; together with the rows the gate keeps these are all.
    """
    text = F.col(value).cast("string")
    typed = json_parse(messages.withColumn("_text", text), schema, value, [*dict.fromkeys([*keep, "_text"])], True)
    whole = F.try_parse_json("_text")
    reason = (
        F.when(is_sentinel(F.col("_text")), "sentinel")
        .when(whole.isNull(), "not JSON")
        .when(~F.schema_of_variant(whole).startswith("OBJECT"), "not an object")
    )
    blamed, why = F.lit(None).cast("string"), F.lit(None).cast("string")
    for field in reversed(list(required)):
        given = F.try_variant_get(whole, f"$['{field}']", "variant")
        absent = given.isNull() | F.is_variant_null(given)
        blamed = F.when(F.col(field).isNull(), F.lit(field)).otherwise(blamed)
        why = F.when(
            F.col(field).isNull(), F.when(absent, "missing field").otherwise("wrong type")
        ).otherwise(why)
    lacks = typed.where(blamed.isNotNull())
    return lacks.select(
        *keep,
        F.coalesce(reason, why).alias("reason"),
        F.when(reason.isNull(), blamed).alias("field"),
    )

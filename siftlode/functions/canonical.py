"""Canonical JSON of any column, by its type: keys in order at every depth, no blanks, nulls written, numbers and escapes as scripts on pages write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlode.functions.text import let

#: Control characters with short escapes.
_SHORT = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def _key(name: str) -> tuple:
    """Names in the order of a locale: letters before their case, lower case first."""
    return name.lower(), name.swapcase()


def _string(c: Column) -> Column:
    def controls(x: Column) -> Column:
        for n in range(32):
            x = F.replace(x, F.lit(chr(n)), F.lit(_SHORT.get(chr(n), f"\\u{n:04x}")))
        return x

    plain = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = let(plain, lambda x: F.when(x.rlike(r"[\x00-\x1f]"), controls(x)).otherwise(x))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def _double(c: Column) -> Column:
    """Whole numbers without a point, others without needless zeros; exponents from 1e21 on and below 1e-6; what is no number is null."""

    def told(x: Column) -> Column:
        digits = F.regexp_extract(x.cast("string"), r"^(-?[0-9]+)(?:\.([0-9]+))?(?:E(-?)([0-9]+))?$", 1)
        rest = F.regexp_replace(F.regexp_extract(x.cast("string"), r"^-?[0-9]+\.([0-9]+)", 1), "0+$", "")
        power = F.regexp_extract(x.cast("string"), r"E(-?[0-9]+)$", 1)
        exponent = F.concat(digits, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), F.lit("e"), F.when(power.startswith("-"), power).otherwise(F.concat(F.lit("+"), power)))
        # digits around a point that is moved by the power
        n, all_digits, whole = F.coalesce(F.when(power != "", power).cast("int"), F.lit(0)), F.concat(F.regexp_replace(digits, "-", ""), rest), F.length(F.regexp_replace(digits, "-", ""))
        at = whole + n
        moved = (
            F.when(at <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -at), all_digits))
            .when(F.length(all_digits) <= at, F.concat(all_digits, F.repeat(F.lit("0"), at - F.length(all_digits))))
            .otherwise(F.concat(F.substring(all_digits, F.lit(1), at), F.lit("."), F.substring(all_digits, at + 1, F.lit(1 << 20))))
        )
        sign = F.when(x < 0, "-").otherwise("")
        return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), "null").when(x == 0, "0").when((F.abs(x) >= 1e21) | (F.abs(x) < 1e-6), exponent).otherwise(F.concat(sign, moved))

    return let(c.cast("double"), told)


def _value(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = [F.concat(F.lit(f'"{f.name}":'), canonical_json(c.getField(f.name), f.dataType)) for f in sorted(kind.fields, key=lambda f: _key(f.name))]
        return F.when(c.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: canonical_json(x, kind.elementType)), ","), F.lit("]"))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(F.collate(e["key"].cast("string"), "UNICODE").alias("k"), F.concat(_string(e["key"].cast("string")), F.lit(":"), canonical_json(e["value"], kind.valueType)).alias("j"))
        return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.transform(F.map_entries(c), entry)), lambda e: e["j"]), ","), F.lit("}"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _double(c)
    if isinstance(kind, T.NumericType):
        return c.cast("string")
    if isinstance(kind, T.BooleanType):
        return c.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit('"'))
    return _string(c.cast("string"))


def canonical_json(c: Column, kind: T.DataType) -> Column:
    """The JSON of a column of a type; null is ``null``. Times are told as the session's zone has them, with a Z: run it in UTC.

    Fields and keys go by a locale's order at every depth; names of fields are letters, digits and underscores.
    """
    return F.coalesce(_value(c, kind), F.lit("null"))


def hash_of(c: Column, kind: T.DataType) -> Column:
    return F.sha2(canonical_json(c, kind), 256)

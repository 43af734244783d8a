"""Column functions whose semantics differ from Spark's, or that Spark spells differently."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_index(s: ColumnOrName, sep: str, i: int) -> Column:
    """0-based part of a split text; NULL when there are fewer parts."""
    return F.get(F.split(_c(s), _literal(sep)), F.lit(i))


def _literal(text: str) -> str:
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in text)


def row_hash(*cols: ColumnOrName, sep: str = "||") -> Column:
    return F.md5(F.concat_ws(sep, *[_c(c).cast("string") for c in cols]))


def bucket(key: ColumnOrName, n: int) -> Column:
    """Stable bucket 0..n-1 of any key."""
    return F.pmod(F.xxhash64(_c(key)), F.lit(n)).cast("int")


def epoch_to_timestamp(c: ColumnOrName, precision: int = 3) -> Column:
    return F.timestamp_millis(_c(c).cast("bigint")) if precision == 3 else F.timestamp_seconds(_c(c).cast("bigint"))


def price_text(c: ColumnOrName) -> Column:
    """'$1,234.50' -> 1234.50"""
    return F.regexp_replace(_c(c), r"[$,]", "").try_cast("decimal(20,2)")


def seconds_of_day(c: ColumnOrName) -> Column:
    """'HH:mm:ss' kept as INT seconds (there is no time-of-day column type here)."""
    return (split_index(c, ":", 0).cast("int") * 3600 + split_index(c, ":", 1).cast("int") * 60
            + F.coalesce(split_index(c, ":", 2).cast("int"), F.lit(0)))


def format_seconds_of_day(c: ColumnOrName) -> Column:
    x = _c(c)
    return F.format_string("%02d:%02d:%02d", F.floor(x / 3600), F.floor(x / 60) % 60, x % 60)


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """Great-circle distance, earth radius 6371 km."""
    a, b = F.radians(_c(lat1)), F.radians(_c(lat2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(_c(lon2)) - F.radians(_c(lon1))) / 2), 2)
    return 2 * 6371.0 * F.asin(F.sqrt(h))


def strip_wire_header(value: ColumnOrName) -> Column:
    """Body of a registry-framed message: 1 magic byte and 4 id bytes come first."""
    return F.substring(_c(value), 6, 2147483647)


def wire_schema_id(value: ColumnOrName) -> Column:
    return F.conv(F.hex(F.substring(_c(value), 2, 4)), 16, 10).cast("int")


def decode_bytes(value: ColumnOrName) -> Column:
    return F.decode(_c(value), "UTF-8")


# ---- JSON --------------------------------------------------------------------------------------

def _at(doc: ColumnOrName, path: str) -> tuple[bool, Column, Column, Column]:
    """Strict mode, text at the path, its JSON kind (NULL: nothing there) and the value as JSON text."""
    mode, _, bare = path.strip().partition(" ")
    strict = mode == "strict"
    bare = bare.strip() if mode in ("strict", "lax") else path
    text, inner = F.get_json_object(_c(doc), bare), F.try_variant_get(F.try_parse_json(_c(doc)), bare, "variant")
    return strict, text, F.schema_of_variant(inner), F.to_json(inner)


def _nested(kind: Column) -> Column:
    return F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))


def json_value(doc: ColumnOrName, path: str, returning: str = "string", on_empty: object = None, on_error: object = None) -> Column:
    """Scalar at a path; objects and arrays are no scalars, whatever a text at the path starts with.

    ``path`` may start with ``lax`` (the default) or ``strict``. Nothing at the path gives ``on_empty`` in lax mode and
    ``on_error`` in strict mode; an object, an array or a value that does not cast gives ``on_error``. A JSON null is NULL.
    """
    strict, text, kind, _ = _at(doc, path)
    value = F.when(~_nested(kind), text).try_cast(returning)
    if on_empty is None and on_error is None:
        return value
    as_value = lambda x: F.lit(x).cast(returning)
    nothing = kind.isNull() & text.isNull()
    return (F.when(_c(doc).isNull() | (kind == "VOID"), as_value(None)).when(nothing, as_value(on_error if strict else on_empty))
            .otherwise(F.coalesce(value, as_value(on_error))))


def json_query(doc: ColumnOrName, path: str, wrap: bool | str = False) -> Column:
    """Object or array text at a path, by its JSON kind. ``wrap``: False (scalars give NULL), ``"conditional"`` (scalars become an array
    of one) or True (any found value is put in an array)."""
    _, text, kind, as_json = _at(doc, path)
    inner = F.when(_nested(kind), text).otherwise(as_json)
    if wrap == "conditional":
        return F.when(_nested(kind), text).otherwise(F.concat(F.lit("["), as_json, F.lit("]")))
    return F.concat(F.lit("["), inner, F.lit("]")) if wrap else F.when(_nested(kind), text)


def json_query_array(doc: ColumnOrName, path: str) -> Column:
    """Array at a path RETURNING ARRAY<STRING>: scalars as plain text, nested values as JSON text; no array gives NULL."""
    _, text, kind, _ = _at(doc, path)
    return F.when(kind.startswith("ARRAY"), F.from_json(text, "array<string>"))


def json_rows(doc: ColumnOrName, schema: str) -> Column:
    """JSON array of objects -> array of rows, ready for ``unnest``. ``schema``: 'a int, b string'."""
    return F.from_json(_c(doc), f"array<struct<{_colon(schema)}>>")


def _colon(schema: str) -> str:
    return ", ".join(f"{p.split()[0]}:{' '.join(p.split()[1:])}" for p in schema.split(","))


def json_object(**fields: ColumnOrName) -> Column:
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in fields.items()]))


def ndjson_line(*cols: str) -> Column:
    """One JSON line of a row; quoting is done by the writer, not by text replacement."""
    return F.to_json(F.struct(*cols))

"""Change-data-capture envelopes: unwrap, filter, keep the latest, merge, history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .core import Keys, all_of, as_list
from .dedup import dedup_last


def unwrap_debezium(df: DataFrame, cols: Keys, before: str = "before", after: str = "after", op: str = "op",
                    source_ts: str | None = "source.ts_ms", keep: Keys = ()) -> DataFrame:
    """Flat rows of a before/after/op envelope: a delete takes ``before``, anything else ``after``."""
    deleted = F.col(op) == "d"
    out = [F.when(deleted, F.col(f"{before}.{c}")).otherwise(F.col(f"{after}.{c}")).alias(c) for c in as_list(cols)]
    meta = [F.col(op).alias("src_op"), F.coalesce(deleted, F.lit(False)).alias("is_deleted")]
    if source_ts:
        meta.append(F.timestamp_millis(F.col(source_ts).cast("bigint")).alias("src_timestamp"))
    return df.select(*as_list(keep), *out, *meta)


def unwrap_qlik(df: DataFrame, cols: Keys, headers: str = "headers", data: str = "data", before: str = "beforeData",
                key: str | None = None) -> DataFrame:
    """Flat rows of a headers/data/beforeData envelope; rows where both payloads are missing are dropped."""
    c = as_list(cols)
    op = F.col(f"{headers}.operation")
    gone = op == "DELETE"
    out = [F.when(gone, F.col(f"{before}.{x}")).otherwise(F.col(f"{data}.{x}")).alias(x) for x in c]
    d = df.filter(F.col(data).isNotNull() | F.col(before).isNotNull())
    d = d.select(*out, op.alias("operation"), F.col(f"{headers}.changeSequence").alias("change_sequence"),
                 F.col(f"{headers}.timestamp").alias("change_timestamp"), F.coalesce(gone, F.lit(False)).alias("is_deleted"))
    return d.filter(F.col(key).isNotNull()) if key else d


def unwrap_json_cdc(df: DataFrame, col: str, spec: dict[str, str], keep: Keys = (), op_field: str = "op") -> DataFrame:
    """Envelope kept as JSON text: one ``from_json`` pass over strings, then a guarded cast per column.

    ``spec``: column -> type. A value that does not cast gives NULL and keeps the row.
    """
    body = ", ".join(f"`{c}`: string" for c in spec)
    e = F.from_json(col, f"struct<`{op_field}`: string, ts_ms: string, before: struct<{body}>, after: struct<{body}>>")
    d = df.select(*as_list(keep), e.alias("__e"))
    gone = F.col(f"__e.{op_field}") == "d"
    cols = [F.when(gone, F.col(f"__e.before.{c}")).otherwise(F.col(f"__e.after.{c}")).try_cast(t).alias(c) for c, t in spec.items()]
    return d.select(*as_list(keep), *cols, F.col(f"__e.{op_field}").alias("src_op"),
                    F.coalesce(gone, F.lit(False)).alias("is_deleted"),
                    F.timestamp_millis(F.col("__e.ts_ms").try_cast("bigint")).alias("src_timestamp"))


def filter_ops(df: DataFrame, op: str, skip: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(op).isin(*skip))


def cdc_latest(flat: DataFrame, keys: Keys, order_by: Keys, keep_deleted: bool = False, deleted: str = "is_deleted") -> DataFrame:
    """Latest change per key; a key whose latest change is a delete is gone unless ``keep_deleted``."""
    last = dedup_last(flat, keys, as_list(order_by))
    return last if keep_deleted else last.filter(~F.col(deleted))


def merge_into(target: DataFrame, staging: DataFrame, keys: Keys, accept: Column, deleted: str,
               keep_on_delete: Keys) -> DataFrame:
    """Rows to write for a conditional merge.

    ``staging`` (alias ``s``) left joins ``target`` (alias ``m``); a row passes when it is new or ``accept``
    holds; on a delete the ``keep_on_delete`` columns keep the target's old values. Write the result with
    the upsert sink.
    """
    k, kept = as_list(keys), as_list(keep_on_delete)
    s, m = staging.alias("s"), target.withColumn("__found", F.lit(True)).alias("m")
    j = s.join(m, all_of([F.col(f"s.{c}") == F.col(f"m.{c}") for c in k]), "left")
    j = j.filter(F.col("m.__found").isNull() | F.coalesce(accept, F.lit(False)))
    cols = [F.when(~F.col(f"s.{deleted}"), F.col(f"s.{c}")).otherwise(F.col(f"m.{c}")).alias(c) if c in kept
            else F.col(f"s.{c}").alias(c) for c in staging.columns]
    return j.select(*cols)


def apply_merge(target: DataFrame, changes: DataFrame, keys: Keys) -> DataFrame:
    """Target after the merge: untouched rows plus the written ones."""
    return target.join(changes, as_list(keys), "left_anti").unionByName(changes)


def json_to_dim(df: DataFrame, col: str, fields: dict[str, tuple[str, str]], nested: dict[str, dict[str, tuple[str, str]]],
                skip_ops: Sequence[str] = ("DELETE",), op_path: str = "$.headers.op") -> DataFrame:
    """Dimension from JSON text: (path, type) per column and per field of nested rows."""
    from ..functions.scalar import json_value
    d = df if not skip_ops else df.filter(~F.coalesce(F.get_json_object(col, op_path), F.lit("")).isin(*skip_ops))
    flat = [json_value(col, p, t).alias(n) for n, (p, t) in fields.items()]
    rows = [F.struct(*[json_value(col, p, t).alias(n) for n, (p, t) in sub.items()]).alias(name) for name, sub in nested.items()]
    return d.select(*flat, *rows)


def scd2_history(df: DataFrame, keys: Keys, updated_at: str, deleted: Column | None = None) -> DataFrame:
    """Type-2 history of a change log: [valid_from, valid_to), the open version has NULL and ``is_current``.

    A delete closes the version before it and opens none.
    """
    from .temporal import versions
    v = versions(df, keys, updated_at)
    if deleted is not None:
        v = v.filter(~F.coalesce(deleted, F.lit(False)))
    return v.withColumn("is_current", F.col("valid_to").isNull())


def scd2(target: DataFrame, source: DataFrame, keys: Keys, updated_at: str, as_of: str) -> DataFrame:
    """One snapshot step. ``target``: history with valid_from / valid_to; ``source``: today's rows.

    New keys and newer versions are opened, replaced versions closed at the new version's time, and keys
    missing from the source are closed at ``as_of``.
    """
    k = as_list(keys)
    cols = source.columns
    closed = target.filter(F.col("valid_to").isNotNull())
    current = target.filter(F.col("valid_to").isNull())
    cur = current.select(*[F.col(c).alias(f"__t_{c}") for c in cols], F.col("valid_from").alias("__t_from"))
    j = cur.join(source, all_of([F.col(f"__t_{c}") == F.col(c) for c in k]), "full")
    at = F.lit(as_of).cast(target.schema["valid_to"].dataType)
    has_t, has_s = F.col(f"__t_{k[0]}").isNotNull(), F.col(k[0]).isNotNull()
    newer = F.col(updated_at) > F.col(f"__t_{updated_at}")
    end = F.when(~has_s, at).when(newer, F.col(updated_at))
    old = F.when(has_t, F.struct(*[F.col(f"__t_{c}").alias(c) for c in cols], F.col("__t_from").alias("valid_from"), end.alias("valid_to")))
    fresh = F.when(has_s & (~has_t | newer), F.struct(*[F.col(c) for c in cols], F.col(updated_at).alias("valid_from"),
                                                     F.lit(None).cast(target.schema["valid_to"].dataType).alias("valid_to")))
    both = j.select(F.explode(F.filter(F.array(old, fresh), lambda x: x.isNotNull())).alias("v")).select("v.*")
    return closed.select(*cols, "valid_from", "valid_to").unionByName(both)

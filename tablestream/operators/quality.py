"""Data-quality rules, routing of bad rows, checks that return the failing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .core import Keys, all_of, as_list, join_null_safe

# The e-mail shapes accepted by the routing rule and by the repair step.
EMAIL_ROUTE = r"^[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
EMAIL_REPAIR = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
INVALID_EMAIL = "email_invalid"


def route_invalid(df: DataFrame, rules: dict[str, Column], reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(good, bad). A rule names what is wrong; the first that holds is the reason of the rejected row."""
    why = F.coalesce(*[F.when(c, F.lit(n)) for n, c in rules.items()])
    marked = df.withColumn(reason, why)
    return marked.filter(F.col(reason).isNull()).drop(reason), marked.filter(F.col(reason).isNotNull())


def envelope_rules(headers: str = "headers", data: str = "data", key: str = "id") -> dict[str, Column]:
    """Structural rules of a headers/data envelope: no payload although it is no delete, or a payload without key."""
    empty = F.col(data).isNull()
    return {"missing_payload": empty & (F.col(f"{headers}.operation") != "DELETE"), "missing_key": ~empty & F.col(f"{data}.{key}").isNull()}


def route_business(df: DataFrame, email: str, age: str, min_age: int = 0) -> tuple[DataFrame, DataFrame]:
    """(good, bad) by business rules: an e-mail is needed and must be well formed; an age may be missing but not too low."""
    return route_invalid(df, {"bad_email": ~F.coalesce(F.col(email).rlike(EMAIL_ROUTE), F.lit(False)),
                              "bad_age": F.col(age).isNotNull() & (F.col(age) < min_age)})


def repair(df: DataFrame, col: str, valid: Column, marker: object) -> DataFrame:
    return df.withColumn(col, F.when(valid, F.col(col)).otherwise(F.lit(marker)))


def validate_struct(rules: dict[str, tuple[Column, str]]) -> Column:
    """First broken rule as struct(code, msg), NULL for a valid row. Rules: code -> (is broken, message)."""
    return F.coalesce(*[F.when(c, F.struct(F.lit(code).alias("code"), F.lit(msg).alias("msg"))) for code, (c, msg) in rules.items()])


def to_error_rows(df: DataFrame, error: str, ts: str, cols: Keys | None = None) -> DataFrame:
    """Rows for an error sink: time, code, message and the raw record as JSON."""
    raw = F.to_json(F.struct(*(as_list(cols) or [c for c in df.columns if c != error])))
    return df.filter(F.col(error).isNotNull()).select(
        F.col(ts).alias("error_timestamp"), F.col(f"{error}.code").alias("error_code"),
        F.col(f"{error}.msg").alias("error_message"), raw.alias("raw_data"))


def decode_errors(df: DataFrame, raw: str, paths: dict[str, str]) -> DataFrame:
    """Fields read back from stored error bytes."""
    text = F.decode(raw, "UTF-8") if isinstance(df.schema[raw].dataType, T.BinaryType) else F.col(raw)
    return df.select(*[c for c in df.columns if c != raw], *[F.get_json_object(text, p).alias(n) for n, p in paths.items()])


def route_unparseable(df: DataFrame, col: str, fmt: str, out: str = "parsed_ts") -> tuple[DataFrame, DataFrame]:
    """(parsed, unparseable); a NULL input counts as unparseable."""
    d = df.withColumn(out, F.try_to_timestamp(F.col(col), F.lit(fmt)))
    return d.filter(F.col(out).isNotNull()), d.filter(F.col(out).isNull()).drop(out)


# ---- checks: each returns the rows (or keys) that break the rule ----------------------------------

def check_not_null(df: DataFrame, cols: Keys) -> DataFrame:
    return df.filter(~all_of([F.col(c).isNotNull() for c in as_list(cols)]))


def check_unique(df: DataFrame, cols: Keys) -> DataFrame:
    return df.groupBy(*as_list(cols)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def check_min_value(df: DataFrame, col: str, low: float) -> DataFrame:
    return df.filter(F.col(col) < low)


def check_relationship(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).join(parent.select(F.col(parent_col).alias(col)), col, "left_anti")


def expect_equal(actual: DataFrame, expected: DataFrame, keys: Keys) -> DataFrame:
    """One PASS / FAIL row: every expected row must be there with equal values, and none besides."""
    k = as_list(keys)
    vals = [c for c in expected.columns if c not in k]
    a = actual.select(*k, F.struct(F.lit(True).alias("__in"), *vals).alias("__a"))
    e = expected.select(*k, F.struct(F.lit(True).alias("__in"), *vals).alias("__e"))
    j = join_null_safe(a, e, k, "full")
    return j.agg(F.count("__e").alias("expected_rows"), F.count("__a").alias("actual_rows"),
                 F.count_if(F.col("__a").eqNullSafe(F.col("__e"))).alias("matching_rows")).select(
        F.when((F.col("expected_rows") == F.col("matching_rows")) & (F.col("actual_rows") == F.col("matching_rows")), "PASS")
        .otherwise("FAIL").alias("test_result"), "expected_rows", "actual_rows", "matching_rows")


def assert_schema(df: DataFrame, contract: dict[str, str]) -> list[str]:
    """Differences between a frame and its contract (column -> type); an empty list means it holds."""
    have = dict(df.dtypes)
    missing = [f"missing column {c}" for c in contract if c not in have]
    wrong = [f"column {c} is {have[c]}, not {t}" for c, t in contract.items() if c in have and have[c] != t]
    return missing + wrong + [f"unexpected column {c}" for c in have if c not in contract]


def infer_types(df: DataFrame, cols: Keys | None = None) -> DataFrame:
    """Narrowest type of each text column, in one pass of conditional counts over all rows.

    Empty texts do not count; a column without any value stays STRING.
    """
    names = as_list(cols) or df.columns
    per = []
    for c in names:
        v = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        per.append(F.struct(
            F.lit(c).alias("column"), F.count(v).alias("n"),
            F.count_if(v.rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("dates"),
            F.count_if(v.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$")).alias("stamps"),
            F.count_if(v.rlike(r"^[+-]?\d+$") & v.try_cast("int").isNotNull()).alias("ints"),
            F.count_if(v.rlike(r"^[+-]?\d+$")).alias("longs"),
            F.count_if(v.rlike(r"^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$")).alias("decimals")))
    stats = df.agg(F.array(*per).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    n = F.col("n")
    kind = (F.when(n == 0, "STRING").when(F.col("dates") == n, "DATE").when(F.col("stamps") == n, "TIMESTAMP")
            .when(F.col("ints") == n, "INT").when(F.col("longs") == n, "BIGINT")
            .when(F.col("decimals") == n, "DECIMAL(18,2)").otherwise("STRING"))
    return stats.select("column", kind.alias("type"), "n")


def validate_json(df: DataFrame, col: str, schema: T.StructType, required: Keys) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid). Invalid: not JSON, a required field missing, or a value of the wrong type."""
    doc = F.from_json(col, T.StructType([*schema.fields, T.StructField("__corrupt", T.StringType())]),
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
    d = df.withColumn("__doc", doc)
    why = F.coalesce(F.when(F.get_json_object(col, "$").isNull(), "not json"),
                     *[F.when(F.get_json_object(col, f"$.{p}").isNull(), f"missing {p}") for p in as_list(required)],
                     F.when(F.col("__doc.__corrupt").isNotNull(), "bad value"))
    d = d.withColumn("error", why)
    fields = [F.col(f"__doc.{f.name}").alias(f.name) for f in schema.fields]
    keep = df.columns
    return (d.filter("error is null").select(*keep, F.struct(*fields).alias("doc")),
            d.filter("error is not null").select(*keep, "error"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def error_rate(df: DataFrame, ts: str, code: str) -> DataFrame:
    """Errors per hour and code."""
    from .windows import tumble
    return tumble(df, ts, "1 hour", code, {"error_count": ("count", "*")})


def top_errors(df: DataFrame, ts: str, code: str, message: str, record: str, as_of: str, back: str = "24 hours",
               n: int = 10) -> DataFrame:
    """Most frequent (code, message) of the last ``back`` before ``as_of`` with distinct records affected."""
    from .windows import time_filter
    d = time_filter(df, ts, as_of, newer_than=back).filter(F.col(ts) <= F.lit(as_of).cast(df.schema[ts].dataType))
    per = d.groupBy(code, message, record).agg(F.count(F.lit(1)).alias("c"))      # distinct by two-step counting
    out = per.groupBy(code, message).agg(F.sum("c").alias("frequency"), F.count(record).alias("records_affected"))
    return out.orderBy(F.col("frequency").desc(), F.col(code), F.col(message)).limit(n)

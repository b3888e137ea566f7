"""CSV files as typed SQL sources (S15): column types inferred from all rows in one aggregate.

Every value has a place in a lattice: missing below long below double below text, and missing below date
below text. A column's type is the least one above all its values. Two parts' answers merge into the whole's, so
the types of a table come from partial aggregates of its splits, each value being looked at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.session import path_exists
from pitlane.sources.ingest import SEQ_COL, null_sentinels, read_raw_csv

#: What a value can be, as bits: a column's bits are the union of its values' bits.
LONG, DOUBLE, DATE, TEXT = 1, 2, 4, 8
_WHOLE = r"[+-]?[0-9]+"
_DOUBLE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?"
_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"


def bits_of(value: Column) -> Column:
    """The bit of the lowest type that holds a text; none for a missing one.

    A whole number beyond 64 bits is text, as a double would change it.
    """
    text = F.trim(value)
    whole = F.regexp_like(text, F.lit(f"^{_WHOLE}$"))
    number = F.regexp_like(text, F.lit(f"^{_DOUBLE}$"))
    day = F.regexp_like(text, F.lit(f"^{_DATE}$")) & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
    return (F.when(value.isNull(), 0).when(whole, F.when(text.try_cast("long").isNotNull(), LONG).otherwise(TEXT))
            .when(number, DOUBLE).when(day, DATE).otherwise(TEXT))


def type_of(bits: int) -> str:
    """The least type above all that the bits name; a column without any value is text."""
    if bits == LONG:
        return "bigint"
    if bits and bits & ~(LONG | DOUBLE) == 0:
        return "double"
    return "date" if bits == DATE else "string"


def inferred_types(df: DataFrame) -> dict[str, str]:
    """Column name to type of an all-text frame, from every row, in one aggregate."""
    if not df.columns:
        return {}
    row = df.agg(*[F.bit_or(bits_of(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return {c: type_of(row[f"c{i}"] or 0) for i, c in enumerate(df.columns)}


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The text columns of ``df`` as their types; every value fits if the types were inferred from it."""
    def cast(c: str) -> Column:
        value = F.col(f"`{c}`")
        if types[c] == "string":
            return value.alias(c)
        value = F.trim(value)
        return (F.try_to_date(value, "yyyy-MM-dd") if types[c] == "date" else value.try_cast(types[c])).alias(c)

    return df.select(*[cast(c) for c in df.columns])


def csv_source(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """A CSV file or folder as a typed frame. Declared ``types`` come before inferred ones.

    Malformed records are left out as everywhere (``records``); without any column to infer the
    file is read once only. A missing path raises FileNotFoundError.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no CSV source at {path}")
    raw = null_sentinels(read_raw_csv(spark, path).drop(SEQ_COL))
    known = dict(types or {})
    open_ = [c for c in raw.columns if c not in known]
    if open_:
        known |= inferred_types(raw.select(*[F.col(f"`{c}`") for c in open_]))
    return typed(raw, known)


def register_csv_sources(spark: SparkSession, folder: str, names: list[str], suffix: str = "_clean.csv",
                         prefix: str = "") -> dict[str, DataFrame]:
    """Temp views ``{prefix}{name}`` over ``{folder}/{name}{suffix}``, for SQL models to select from."""
    out = {}
    for name in names:
        out[name] = csv_source(spark, f"{folder.rstrip('/')}/{name}{suffix}")
        out[name].createOrReplaceTempView(f"{prefix}{name}")
    return out

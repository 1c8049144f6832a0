"""Schema checks and cleaning of flights and delay-cause reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit import constants as K
from delaykit.functions import codes, numbers
from delaykit.operators.lookups import lookup_join


class MissingColumns(ValueError):
    """A required column is not there."""


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing required columns: {', '.join(missing)}")
    return df


def coerce_numeric(df: DataFrame, cols: Sequence[str] = K.REPORT_NUMERIC) -> DataFrame:
    """To double, bad values to null; columns that are absent are skipped."""
    return df.withColumns({c: numbers.as_number(df, c) for c in cols if c in df.columns})


def normalize_codes(df: DataFrame, cols: Sequence[str] = ("carrier", "airport")) -> DataFrame:
    """Upper case without surrounding white space; empty codes are null."""
    return df.withColumns(
        {c: codes.blank_to_null(codes.normalize_code(F.col(c))) for c in cols if c in df.columns}
    )


def clean_delay_cause(df: DataFrame) -> DataFrame:
    """Codes normalised, measures numeric, keys present and flights counted."""
    ready = coerce_numeric(normalize_codes(df))
    return (
        ready.na.drop(subset=["year", "month", "carrier", "airport"])
        .filter(F.col("arr_flights") > 0)
        .withColumns({"year": F.col("year").cast("int"), "month": F.col("month").cast("int")})
    )


def parse_flight_date(df: DataFrame, col: str = "FL_DATE") -> DataFrame:
    """Dates parsed, rows without a valid date dropped."""
    return df.withColumn(col, codes.to_date(F.col(col))).na.drop(subset=[col])


def clean_flights(df: DataFrame) -> DataFrame:
    """Flights with a departure hour, a delay within range and normalised ids.

    A flight whose date does not parse stays, with a null date.
    """
    low, high = K.DELAY_RANGE
    read = F.struct(
        numbers.hhmm_to_hour(numbers.as_whole(df, "CRS_DEP_TIME")).alias("hour"),
        numbers.as_number(df, "DEP_DELAY").alias("delay"),
    )
    if any(isinstance(df.schema[c].dataType, T.StringType) for c in ("CRS_DEP_TIME", "DEP_DELAY")):
        # A list of one, unfolded: a plain column would be parsed again for each test of the filters.
        parsed = df.select("*", F.explode(F.array(read)).alias("_read"))
    else:
        # Numbers cost nothing, and their filters go below the joins of the flights.
        parsed = df.withColumn("_read", read)
    return (
        parsed.filter(F.col("_read.hour").isNotNull())
        .filter(F.col("_read.delay").between(low, high))
        .withColumns(
            {
                "FL_DATE": codes.to_date(F.col("FL_DATE")),
                "DEP_HOUR": F.col("_read.hour"),
                "OP_CARRIER": codes.normalize_code(F.col("OP_CARRIER")),
                "FL_NUM": codes.strip(F.col("FL_NUM").cast("string")),
                "ORIGIN": codes.normalize_code(F.col("ORIGIN")),
                "DEST": codes.normalize_code(F.col("DEST")),
                "DEP_DELAY": F.col("_read.delay"),
            }
        )
        .drop("_read")
    )


def fill_missing_features(
    df: DataFrame, features: Sequence[str] = K.HISTORY_ORIGIN + K.HISTORY_DEST
) -> DataFrame:
    """Absent features become 0.0 columns and nulls become 0.0."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
            for c in features
        }
    )


def filter_hubs(df: DataFrame, hubs: Iterable[str] = K.MAJOR_HUBS) -> DataFrame:
    """Rows of the hub airports; no hubs means no filter."""
    hubs = sorted(hubs)
    return df.filter(F.col("airport").isin(hubs)) if hubs else df


def filter_hub_routes(df: DataFrame, hubs: Iterable[str] = K.MAJOR_HUBS) -> DataFrame:
    """Three-letter codes on both sides and at least one end in a hub."""
    hubs = sorted(hubs)
    return df.filter(
        (F.length("ORIGIN") == 3)
        & (F.length("DEST") == 3)
        & (F.col("ORIGIN").isin(hubs) | F.col("DEST").isin(hubs))
    )


def _as_text(name: str, kind: T.DataType) -> Column:
    """A text that is equal for equal values of the type."""
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")  # one zero
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def profile_table(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Position, name, type, rows, filled rows, nulls and distinct values of each column.

    One pass: every value is counted under the number of its column, so a frequent value leaves a
    task once, but each distinct value is shuffled. With ``approximate`` a sketch per column takes
    their place and nothing but sketches is shuffled. A table without rows has zeros.
    """
    fields = [(i, f.name, f.dataType) for i, f in enumerate(df.schema.fields)]
    if not fields:
        raise ValueError("a table without columns has no profile")
    if approximate:
        totals = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(F.col(f"`{c}`")).alias(f"_f{i}") for i, c, _ in fields],
            *[F.approx_count_distinct(_as_text(c, kind)).alias(f"_d{i}") for i, c, kind in fields],
        )
        counts = totals.select(F.inline(F.array(*[
            F.struct(
                F.lit(i).alias("position"), F.col("_rows").alias("n_rows"),
                F.col(f"_f{i}").alias("n_filled"), F.col(f"_d{i}").alias("n_distinct"),
            )
            for i, _, _ in fields
        ])))
    else:
        values = df.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("position"), _as_text(c, kind).alias("value")) for i, c, kind in fields
        ])))
        counts = values.groupBy("position", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("position").agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n_filled"),
            F.count("value").alias("n_distinct"),
        )
    columns = df.sparkSession.createDataFrame(
        [(i, c, kind.simpleString()) for i, c, kind in fields],
        "position int, column_name string, data_type string",
    )
    zero = F.lit(0).cast("bigint")
    return lookup_join(columns, counts, ["position"]).select(
        "position", "column_name", "data_type",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("n_rows", "n_filled")],
        F.coalesce(F.col("n_rows") - F.col("n_filled"), zero).alias("n_null"),
        F.coalesce(F.col("n_distinct"), zero).alias("n_distinct"),
    )


def head(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def select_features(
    df: DataFrame, candidates: Sequence[str] | None = None, target: str | None = None
) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns among the candidates that are present."""
    numeric, categorical = [], []
    wanted = list(candidates) if candidates is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for name in wanted:
        if name == target or name not in kinds:
            continue
        if isinstance(kinds[name], T.NumericType):
            numeric.append(name)
        elif isinstance(kinds[name], T.StringType):
            categorical.append(name)
    return numeric, categorical

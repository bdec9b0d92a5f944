"""Positional text encodings of the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEP = "#CS#"
MISSING = "NULL"

# Raw request line: twelve fields in this order (fixed value).
RAW_FIELDS = ["time_local", "request", "request_method", "content_type", "request_body",
              "http_referer", "remote_addr", "http_user_agent", "time_iso8601", "server_addr",
              "http_cookie", "active_user_num"]

# Structured record: nineteen fields in this order (fixed value).
RECORD_FIELDS = ["source_data", "request_method", "request", "remote_addr", "http_user_agent",
                 "time_iso8601", "server_addr", "high_freq_ip", "flight_type", "behavior_type",
                 "travel_type", "flight_date", "dep_city", "arr_city", "session_id", "user_id",
                 "query_data", "book_data", "http_referer"]

QUERY_DATA = T.StructType([
    T.StructField("is_empty", T.BooleanType()), T.StructField("flight_type", T.IntegerType()),
    *[T.StructField(n, T.StringType()) for n in
      ["dep_city", "arr_city", "flight_date", "adult_num", "child_num", "infant_num", "country"]],
    T.StructField("travel_type", T.IntegerType())])
_A = T.ArrayType(T.StringType())
BOOK_DATA = T.StructType([
    T.StructField("flight_type", T.IntegerType()), T.StructField("travel_type", T.IntegerType()),
    T.StructField("user_id", T.StringType()), T.StructField("psg_name", _A),
    T.StructField("psg_type", _A), T.StructField("id_type", _A), T.StructField("id_card", _A),
    T.StructField("contact_name", T.StringType()), T.StructField("contact_phone", T.StringType()),
    T.StructField("agent", T.StringType()),
    *[T.StructField(n, _A) for n in ["dep_city", "arr_city", "flight_date", "flight_no", "cabin"]]])


def parse_raw(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw line -> twelve columns; ``active_user_num`` as BIGINT (NULL when not
    a number: such rows are routed to the reject output by the caller)."""
    parts = F.split(F.col(value_col), SEP, -1)
    cols = [F.get(parts, i).alias(n) for i, n in enumerate(RAW_FIELDS[:-1])]
    n = F.get(parts, len(RAW_FIELDS) - 1)
    return df.select("*", *cols, F.trim(n).alias("_n_raw")) \
             .withColumn("active_user_num", F.col("_n_raw").try_cast("bigint")) \
             .withColumn("is_valid_number", F.col("active_user_num").isNotNull()) \
             .drop("_n_raw")


def _txt(c: Column) -> Column:
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(MISSING))


def to_record_line(df: DataFrame) -> Column:
    """P10: the nineteen-field line; empty -> ``NULL``, structs -> JSON."""
    out = []
    for f in RECORD_FIELDS:
        if f not in df.columns:
            out.append(F.lit(MISSING))
        elif f in ("query_data", "book_data"):
            out.append(F.coalesce(F.to_json(F.col(f)), F.lit(MISSING)))
        else:
            out.append(_txt(F.col(f)))
    return F.concat_ws(SEP, *out)


def from_record_line(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Nineteen-field line -> typed columns (trailing empties kept, JSON -> struct,
    ``NULL`` JSON -> NULL struct, booleans by text)."""
    parts = F.split(F.col(value_col), SEP, -1)
    cols = []
    for i, f in enumerate(RECORD_FIELDS):
        v = F.get(parts, i)
        if f == "query_data":
            v = F.from_json(F.nullif(v, F.lit(MISSING)), QUERY_DATA)
        elif f == "book_data":
            v = F.from_json(F.nullif(v, F.lit(MISSING)), BOOK_DATA)
        elif f == "high_freq_ip":
            v = v == F.lit("true")
        cols.append(v.alias(f))
    return df.select(*cols)

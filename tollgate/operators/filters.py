"""Row filters and predicates (F1-F8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.match import flag_any_match

SEP = "#CS#"


# Characters String.trim() removes: every char up to and including the space.
_CTRL = "".join(chr(i) for i in range(0x21))


def field_count(value: Column, sep: str = SEP) -> Column:
    """Number of fields after trimming, where trailing empty fields do not count
    (``String.split`` semantics: an empty input is one field).

    One pass over the split parts (the input is referenced once, so the
    optimizer has nothing to duplicate when it pushes this predicate down):
    the accumulator tracks the part count and the index of the last non-empty part.
    """
    parts = F.split(F.btrim(value, F.lit(_CTRL)), sep, -1)
    init = F.struct(F.lit(0).alias("n"), F.lit(0).alias("last"))
    return F.aggregate(
        parts, init,
        lambda acc, x: F.struct((acc["n"] + 1).alias("n"),
                                F.when(F.length(x) > 0, acc["n"] + 1).otherwise(acc["last"]).alias("last")),
        lambda acc: F.when((acc["n"] == 1) & (acc["last"] == 0), F.lit(1)).otherwise(acc["last"]))


def keep_complete_lines(df: DataFrame, value_col: str = "value", min_fields: int = 12) -> DataFrame:
    """keep raw lines with at least ``min_fields`` fields."""
    return df.filter(field_count(F.col(value_col)) >= min_fields)


def drop_filtered_urls(df: DataFrame, rules: DataFrame, request_col: str = "request") -> DataFrame:
    """drop rows whose request line fully matches any URL-filter rule."""
    d = df.withColumn("_line", F.coalesce(F.col(request_col), F.lit("")))
    return flag_any_match(d, "_line", rules, rules.columns[0], "_filtered").filter(~F.col("_filtered")).drop("_line", "_filtered")


def by_behavior(df: DataFrame, *behaviors: str, col: str = "behavior_type") -> DataFrame:
    """behaviour equality (routing)."""
    return df.filter(F.col(col).isin(*behaviors))


def unexpired(df: DataFrame, now_ms: Column, exp_col: str = "key_exp_time",
              min_left_ms: int = 1000) -> DataFrame:
    """F8: keep rows with at least ``min_left_ms`` of lifetime left."""
    return df.filter(F.col(exp_col).cast("bigint") - now_ms >= min_left_ms)

"""Near-real-time / offline rule catalogue metrics (§2.11): bookings, payments,
cancellations and unpaid bookings by IP block, buyer, contact name, contact
phone, passenger and contact name & phone, over 1 h / 1 day windows.

All keys are computed in ONE grouped pass: the key columns are unpivoted to
``(key_kind, key)`` and one ``groupBy(window, key_kind, key)`` with
conditional counts follows (partial aggregation before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.operators.metrics import WIN, _with_window

def key_kinds(only: set[str] | None = None) -> dict:
    kinds = {"ip_block": F.col("ip_block"), "buyer": F.col("buyer_id"),
            "contact_name": F.col("contact_name"), "contact_phone": F.col("contact_phone"),
            "passenger": F.col("passenger"),
            "contact": F.concat(F.col("contact_name"), F.lit("|"), F.col("contact_phone"))}
    return {k: v for k, v in kinds.items() if only is None or k in only}


def _keyed(events: DataFrame, only: set[str] | None = None) -> DataFrame:
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("key_kind"), v.alias("key"))
                                for k, v in key_kinds(only).items()]))
    return events.select("ts", "step", "order_key", kinds.alias("_k")).select(
        "ts", "step", "order_key", "_k.key_kind", "_k.key")


STEP_OF_MEASURE = {"bookings": "book", "payments": "pay", "cancellations": "cancel"}


def booking_metrics(events: DataFrame, window: str | None = "1 day", kinds: set[str] | None = None,
                    measures: tuple[str, ...] | None = None) -> DataFrame:
    """Wide: bookings, payments, cancellations per (window, key_kind, key);
    ``kinds`` limits the key kinds computed, ``measures`` the counts and the events they need."""
    steps = {m: s for m, s in STEP_OF_MEASURE.items() if measures is None or m in measures}
    if len(steps) < len(STEP_OF_MEASURE):
        events = events.filter(F.col("step").isin(*steps.values()))
    k = _with_window(_keyed(events, kinds), F.col("ts"), window, None)
    return k.groupBy(*WIN, "key_kind", "key").agg(
        *[F.count_if(F.col("step") == s).cast("bigint").alias(m) for m, s in steps.items()])


def unpaid_bookings(events: DataFrame, window: str | None = "1 day",
                    kinds: set[str] | None = None) -> DataFrame:
    """Booked-not-paid: bookings with no payment of the same order inside the
    booking's window (left anti join on the order key + time condition)."""
    books = _with_window(events.filter(F.col("step") == "book"), F.col("ts"), window, None)
    pays = events.filter(F.col("step") == "pay").select("order_key", F.col("ts").alias("pay_ts"))
    cond = [books.order_key == pays.order_key]
    if window is not None:
        cond += [pays.pay_ts >= books.window_start, pays.pay_ts < books.window_end]
    unpaid = books.join(pays, cond, "left_anti")
    ex = F.explode(F.array(*[F.struct(F.lit(n).alias("key_kind"), v.alias("key"))
                             for n, v in key_kinds(kinds).items()]))
    k = unpaid.select(*WIN, ex.alias("_k")).select(*WIN, "_k.key_kind", "_k.key")
    return k.groupBy(*WIN, "key_kind", "key").agg(F.count(F.lit(1)).alias("unpaid"))


CATALOGUE_MEASURES = ("bookings", "payments", "cancellations", "unpaid")


def catalogue_long(metrics: DataFrame | None, unpaid: DataFrame | None,
                   measures: tuple[str, ...] = CATALOGUE_MEASURES) -> DataFrame:
    """Long form ``(window, metric, key, value)`` with metric ``<kind>_by_<key_kind>``."""
    parts = [metrics.select(*WIN, F.concat(F.lit(f"{m}_by_"), F.col("key_kind")).alias("metric"),
                            "key", F.col(m).alias("value")).where(F.col(m) > 0)
             for m in ("bookings", "payments", "cancellations") if m in measures and metrics is not None]
    if unpaid is not None and "unpaid" in measures:
        parts.append(unpaid.select(*WIN, F.concat(F.lit("unpaid_by_"), F.col("key_kind")).alias("metric"),
                                   "key", F.col("unpaid").cast("bigint").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

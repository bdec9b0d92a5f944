"""Booking-side events derived from ``orders`` ⋈ ``customer``.

One booking per order (buyer = ``o_custkey``, contact = ``c_name``); status F
adds a payment, P a cancellation, O stays unpaid. Payments land a few days
after the booking (``o_orderkey % 3`` days and up to 80 minutes) so "booked but not paid within the
window" is a real anti join. Keys: IP block, buyer, contact name, contact
phone (hashed; buyers with custkey % 10 = 0 share a phone with others of
the same custkey % 50: the agents), passenger, and contact name & phone together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.redact import md5_upper
from tollgate.sources.tables import read_table


def bookings(spark: SparkSession, base_dir: str) -> DataFrame:
    o = read_table(spark, base_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                     "o_orderdate")
    c = read_table(spark, base_dir, "customer").select("c_custkey", "c_name")
    # customer grows with the data: plain join, AQE decides broadcast at runtime
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    num = F.when(F.col("o_custkey") % 10 == 0, F.col("o_custkey") % 50).otherwise(F.col("o_custkey"))
    phone = md5_upper(F.concat(F.lit("139"), F.lpad(num.cast("string"), 8, "0")))
    day = F.unix_seconds(F.col("o_orderdate").cast("date").cast("timestamp"))
    second = (F.col("o_orderkey") * 7919) % 86_400       # spreads the bookings over the day
    return j.select(
        F.col("o_orderkey").alias("order_key"),
        F.timestamp_seconds(day + second).alias("book_ts"),
        F.timestamp_seconds(day + second + (F.col("o_orderkey") % 3) * 86_400
                            + (F.col("o_orderkey") % 5) * 1_200).alias("pay_ts"),
        F.col("o_orderstatus").alias("status"),
        F.concat(F.lit("10."), (F.col("o_custkey") % 8).cast("string")).alias("ip_block"),
        F.col("o_custkey").cast("string").alias("buyer_id"),
        F.coalesce(F.col("c_name"), F.lit("")).alias("contact_name"),
        phone.alias("contact_phone"),
        F.concat(F.lit("P"), (F.col("o_orderkey") % 500).cast("string")).alias("passenger"))


def booking_events(b: DataFrame) -> DataFrame:
    """Long event stream: every booking, plus its payment or cancellation.
    One pass: each order explodes into its one or two events."""
    keys = ["order_key", "ip_block", "buyer_id", "contact_name", "contact_phone", "passenger"]
    evs = F.array(
        F.struct(F.col("book_ts").alias("ts"), F.lit("book").alias("step")),
        F.struct(F.col("pay_ts").alias("ts"),
                 F.when(F.col("status") == "F", F.lit("pay")).alias("step")),
        F.struct(F.col("book_ts").alias("ts"),
                 F.when(F.col("status") == "P", F.lit("cancel")).alias("step")))
    e = b.select(*keys, F.explode(F.filter(evs, lambda x: x["step"].isNotNull())).alias("_e"))
    return e.select(*keys, F.col("_e.ts").alias("ts"), F.col("_e.step").alias("step"))

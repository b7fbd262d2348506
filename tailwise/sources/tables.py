"""The reserving domain on top of the star-schema test tables.

orders are claims, line items are payments, nations are counties and regions states. The tables
carry no adjuster notes, so Spark derives a note and a description for every order from its key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Order priority -> loss type, order status -> claim status.
LOSS_TYPE_OF = {
    "1-URGENT": "Water Damage",
    "2-HIGH": "Wind",
    "3-MEDIUM": "Fire",
    "4-NOT SPECIFIED": "Theft",
    "5-LOW": "Liability",
}
CLAIM_STATUS_OF = {"F": "Closed", "O": "Open", "P": "Pending"}

# Notes by order key modulo their number; None and "" are cases of their own.
NOTES = (
    "Black mold found behind drywall; attorney representation confirmed by letter.",
    "Slow seepage from roof, damp carpet and high humidity recorded.",
    "Claimant says he will sue; demand letter received from legal counsel.",
    "Foundation crack widening, structural engineer engaged, partial collapse feared.",
    "Visitor injured, medical bills and hospital stay documented.",
    "Statements inconsistent and suspicious, prior damage visible, loss may be staged.",
    "Routine inspection complete, repairs finished on schedule, customer satisfied.",
    "Tissue boxes and mouldings soaked, pursued through ensuing storms.",
    None,
    "",
    "Pre-existing leak noted before hurricane; hail marks on siding.",
    "LAWSUIT filed in court after fatality; litigation expected.",
    "Toxic mold and flooding after earthquake; sinkhole near garage; lawyer hired.",
)
DESCRIPTIONS = (
    "Water damage in kitchen",
    "Wind damage to roof",
    None,
    "Settling and cracking of walls",
    "Contents stolen overnight",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(texts: tuple[str | None, ...], key: Column) -> Column:
    """Element of ``texts`` at key modulo length; a literal array, so one lookup per row."""
    options = F.array(*[F.lit(t).cast("string") for t in texts])
    return F.get(options, (key % len(texts)).cast("int"))


def _mapped(column: str, mapping: dict[str, str]) -> Column:
    expr = None
    for key, value in mapping.items():
        hit = F.col(column) == key
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    return expr


def claims(read: Callable[[str], DataFrame]) -> DataFrame:
    """Orders as claims, with ``customer_key`` for :func:`with_places`.

    ``read`` returns a raw table by name.
    """
    orders = read("orders")
    key = F.col("o_orderkey")
    loss_date = F.to_date("o_orderdate")
    return orders.select(
        key.alias("claim_id"),
        F.concat(F.lit("POL-"), F.col("o_custkey").cast("string")).alias("policy_id"),
        loss_date.alias("loss_date"),
        F.date_add(loss_date, (key % 30).cast("int")).alias("report_date"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("claimant_name"),
        _mapped("o_orderpriority", LOSS_TYPE_OF).alias("loss_type"),
        _pick(DESCRIPTIONS, key).alias("loss_description"),
        _pick(NOTES, key).alias("adjuster_notes"),
        _mapped("o_orderstatus", CLAIM_STATUS_OF).alias("claim_status"),
        F.when(
            key % 7 == 0, F.concat(F.lit("CAT-"), F.year(loss_date).cast("string"))
        ).alias("catastrophe_code"),
        F.col("o_custkey").alias("customer_key"),
    )


def with_places(claims: DataFrame, read: Callable[[str], DataFrame]) -> DataFrame:
    """Add county and state through the customer.

    The joins are left to Spark: nation and region are small enough by their own file size for a
    broadcast, the customer side is shuffled when it is not.
    """
    nations = read("nation").join(
        read("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = (
        read("customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_key"),
            F.col("n_name").alias("county"),
            F.col("r_name").alias("state"),
        )
    )
    return claims.join(customers, "customer_key", "left").drop("customer_key")


def payments(read: Callable[[str], DataFrame]) -> DataFrame:
    """Line items as payments: net price paid on the ship date, price × tax as case reserve."""
    items = read("lineitem")
    price = F.col("l_extendedprice")
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("payment_id"),
        F.col("l_orderkey").alias("claim_id"),
        F.to_date("l_shipdate").alias("payment_date"),
        F.when(F.col("l_returnflag") == "A", "Expense").otherwise("Indemnity").alias("payment_type"),
        (price * (1 - F.col("l_discount"))).alias("payment_amount"),
        (price * F.col("l_tax")).alias("reserve_amount"),
        F.when(F.col("l_linestatus") == "F", "Cleared").otherwise("Pending").alias("payment_status"),
    )

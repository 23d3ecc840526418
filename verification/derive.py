"""The marketplace tables, derived from the driver's star schema by Spark.

Raw inputs come first, with native types and the raw column names; `raw_text` turns them into
the all-text form a CSV scan gives, and `typed` takes them to staging without that detour.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.geo import centroids
from waybill.functions.text import has_text, pad_code
from waybill.params import COUNTRY_BOX
from waybill.sources.staging import latest_reviews, stage_products

HOUR_SPREAD = 720


# Plans are kept per session and folder, never data: the many queries over one folder skip the footer
# read and the analysis of their inputs. `forget_plans` makes the next query plan anew.
@cache
def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Derived(Mapping):
    """Named frames, each built when first asked for, so a query opens only what it reads."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = {name: cache(build) for name, build in builders.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def raw_orders(load: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    status, priority = c("o_orderstatus"), c("o_orderpriority")
    purchased = c("o_orderdate") + _hours(F.pmod("o_orderkey", F.lit(24)))
    travel = 24 + F.pmod(c("o_totalprice").cast("bigint"), F.lit(HOUR_SPREAD))
    undelivered = (status == "O") & (priority == "4-NOT SPECIFIED")
    promised_days = 11 + 4 * F.substring(priority, 1, 1).cast("int")
    return load("orders").select(
        c("o_orderkey").alias("order_id"),
        c("o_orderkey").alias("customer_id"),
        F.when((status == "P") & priority.isin("1-URGENT", "2-HIGH"), "canceled")
        .when((status == "P") & (priority == "3-MEDIUM"), "unavailable")
        .when((status == "O") & (priority == "5-LOW"), "shipped")
        .otherwise("delivered")
        .alias("order_status"),
        purchased.alias("order_purchase_timestamp"),
        (purchased + _hours(F.lit(1))).alias("order_approved_at"),
        (purchased + _hours(F.lit(24))).alias("order_delivered_carrier_date"),
        F.when(~undelivered, purchased + _hours(travel)).alias("order_delivered_customer_date"),
        (c("o_orderdate") + _hours(24 * promised_days)).alias("order_estimated_delivery_date"),
    )


def raw_customers(load: Callable[[str], DataFrame]) -> DataFrame:
    """One customer id per order; the person is the key they share."""
    c = F.col
    return (
        load("orders")
        .join(load("customer"), c("o_custkey") == c("c_custkey"))
        .join(load("nation"), c("c_nationkey") == c("n_nationkey"))
        .select(
            c("o_orderkey").alias("customer_id"),
            c("o_custkey").alias("customer_unique_id"),
            c("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
            c("c_mktsegment").alias("customer_city"),
            c("n_name").alias("customer_state"),
        )
    )


def raw_order_items(load: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    return load("lineitem").select(
        c("l_orderkey").alias("order_id"),
        c("l_linenumber").alias("order_item_id"),
        c("l_partkey").alias("product_id"),
        c("l_suppkey").alias("seller_id"),
        c("l_extendedprice").alias("price"),
        (c("l_extendedprice") * c("l_tax")).alias("freight_value"),
    )


def raw_payments(load: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    paid = c("l_extendedprice") * (1 - c("l_discount")) * (1 + c("l_tax"))
    return load("lineitem").select(
        c("l_orderkey").alias("order_id"),
        c("l_linestatus").alias("payment_type"),
        c("l_linenumber").alias("payment_installments"),
        paid.alias("payment_value"),
    )


def raw_reviews(load: Callable[[str], DataFrame]) -> DataFrame:
    """Returned and accepted lines are reviews, so an order has none, one or several."""
    c = F.col
    quoted = F.concat(F.lit('said "'), "l_returnflag", F.lit('"'))
    return (
        load("lineitem")
        .filter(c("l_returnflag") != "N")
        .select(
            F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("review_id"),
            c("l_orderkey").alias("order_id"),
            (1 + F.pmod(c("l_quantity").cast("int"), F.lit(5))).alias("review_score"),
            F.when(c("l_linestatus") == "O", quoted)
            .when(c("l_returnflag") == "A", "  ")
            .alias("review_comment_message"),
            (c("l_shipdate") - _hours(F.lit(24))).alias("review_creation_date"),
            c("l_shipdate").alias("review_answer_timestamp"),
        )
    )


def raw_products(load: Callable[[str], DataFrame]) -> DataFrame:
    """Some products lack a category, some have a weight that is not a number."""
    c = F.col
    weight = F.when(c("p_brand") == "Brand#1", "n/a").otherwise(c("p_size").cast("string"))
    return load("part").select(
        c("p_partkey").alias("product_id"),
        F.when(c("p_brand") != "Brand#2", c("p_type")).alias("product_category_name"),
        weight.alias("product_weight_g"),
    )


def raw_translation(load: Callable[[str], DataFrame]) -> DataFrame:
    """Two categories stay without a translation."""
    kind = F.col("p_type")
    return (
        load("part")
        .filter(~kind.isin("STANDARD", "LARGE"))
        .select(
            kind.alias("product_category_name"),
            F.lower(kind).alias("product_category_name_english"),
        )
        .distinct()
    )


def raw_sellers(load: Callable[[str], DataFrame]) -> DataFrame:
    c = F.col
    return (
        load("supplier")
        .join(load("nation"), c("s_nationkey") == c("n_nationkey"))
        .select(
            c("s_suppkey").alias("seller_id"),
            c("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
            c("s_name").alias("seller_city"),
            c("n_name").alias("seller_state"),
        )
    )


def raw_geolocation(load: Callable[[str], DataFrame]) -> DataFrame:
    """One point per customer; one segment and one nation lie outside the box."""
    c = F.col
    where, jitter = c("c_nationkey"), c("c_acctbal") / 100000.0
    off_map = F.when((c("c_mktsegment") == "MACHINERY") | (where == 24), 90.0).otherwise(0.0)
    return load("customer").select(
        where.cast("string").alias("geolocation_zip_code_prefix"),
        (where * 1.1 - 30.0 + jitter + off_map).alias("geolocation_lat"),
        (where * 1.3 - 70.0 + jitter).alias("geolocation_lng"),
    )


_RAW = {
    "orders": raw_orders,
    "customers": raw_customers,
    "order_items": raw_order_items,
    "payments": raw_payments,
    "reviews": raw_reviews,
    "products": raw_products,
    "translation": raw_translation,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
}


@cache
def raw_inputs(spark: SparkSession, sf_dir: str) -> Derived:
    open_table = partial(load, spark, sf_dir)
    return Derived({name: partial(build, open_table) for name, build in _RAW.items()})


@cache
def raw_text(spark: SparkSession, sf_dir: str) -> Derived:
    """The all-text form a CSV scan gives."""
    raw = raw_inputs(spark, sf_dir)

    def as_text(name: str) -> DataFrame:
        return raw[name].select(*[F.col(c).cast("string") for c in raw[name].columns])

    return Derived({name: partial(as_text, name) for name in raw})


@cache
def typed(spark: SparkSession, sf_dir: str) -> Derived:
    """Staging tables without the detour over text, keys left as numbers."""
    c = F.col
    raw = raw_inputs(spark, sf_dir)
    return Derived(
        {
            "stg_orders": lambda: raw["orders"].select(
                "order_id",
                "customer_id",
                "order_status",
                c("order_purchase_timestamp").alias("purchased_at"),
                c("order_approved_at").alias("approved_at"),
                c("order_delivered_carrier_date").alias("shipped_at"),
                c("order_delivered_customer_date").alias("delivered_at"),
                c("order_estimated_delivery_date").alias("estimated_at"),
            ),
            "stg_customers": lambda: raw["customers"].select(
                "customer_id",
                "customer_unique_id",
                pad_code(c("customer_zip_code_prefix")).alias("customer_zip"),
                "customer_city",
                "customer_state",
            ),
            "stg_order_items": lambda: raw["order_items"].withColumnRenamed(
                "freight_value", "freight"
            ),
            "stg_payments": lambda: raw["payments"].withColumnRenamed(
                "payment_installments", "installments"
            ),
            "stg_reviews": lambda: latest_reviews(
                raw["reviews"].select(
                    "review_id",
                    "order_id",
                    "review_score",
                    c("review_creation_date").alias("review_created_at"),
                    c("review_answer_timestamp").alias("review_answered_at"),
                    has_text(c("review_comment_message")).alias("has_comment"),
                )
            ),
            "stg_products": lambda: stage_products(raw["products"], raw["translation"]),
            "stg_sellers": lambda: raw["sellers"].select(
                "seller_id",
                pad_code(c("seller_zip_code_prefix")).alias("seller_zip"),
                "seller_city",
                "seller_state",
            ),
            "stg_zip_geo": lambda: centroids(
                raw["geolocation"].withColumn("zip", pad_code(c("geolocation_zip_code_prefix"))),
                "zip",
                "geolocation_lat",
                "geolocation_lng",
                COUNTRY_BOX,
            ),
        }
    )


def forget_plans() -> None:
    for kept in (load, raw_inputs, raw_text, typed):
        kept.cache_clear()

"""Token cost accounting (JN-2, AG-1, AG-2).

Money stays decimal end to end.  Usage is summed per model first (map-side
partial aggregation), and only the per-model sums meet the price list, a
fixed table of a handful of rows that is always safe to broadcast.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.schemas import MONEY_TYPE, PRICE_TYPE, PRICES_PER_MILLION

PRICES_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("input_cost_per_token", PRICE_TYPE, False),
    T.StructField("output_cost_per_token", PRICE_TYPE, False),
])
MILLION = Decimal(1_000_000)


def prices_frame(spark: SparkSession, prices: dict[str, tuple[Decimal, Decimal]] | None = None) -> DataFrame:
    """The price list as a table: USD per token, exact."""
    table = PRICES_PER_MILLION if prices is None else prices
    rows = [(m, i / MILLION, o / MILLION) for m, (i, o) in table.items()]
    return spark.createDataFrame(rows, PRICES_SCHEMA)


def unique_prices(prices: DataFrame) -> DataFrame:
    """One row per model of a price list: its prices, or nulls and ``ambiguous`` where the list gives several."""
    pair = F.struct("input_cost_per_token", "output_cost_per_token")
    low = F.min(pair)
    each = prices.groupBy("model").agg(low.alias("low"), (low != F.max(pair)).alias("ambiguous"))
    price = F.when(~F.col("ambiguous"), F.col("low"))
    return each.select(
        "model",
        price["input_cost_per_token"].alias("input_cost_per_token"),
        price["output_cost_per_token"].alias("output_cost_per_token"),
        "ambiguous",
    )


def price_usage(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """JN-2: unit prices for every usage row, which stays one row however often the list names its model.

    A model without a price gets ``UNKNOWN_MODEL``, one listed with different prices ``AMBIGUOUS_PRICE`` and none of them.
    """
    priced = usage.join(unique_prices(prices), "model", "left")
    return priced.withColumn(
        "price_status",
        F.when(F.col("ambiguous"), F.lit("AMBIGUOUS_PRICE"))
        .when(F.col("input_cost_per_token").isNull(), F.lit("UNKNOWN_MODEL"))
        .otherwise(F.lit("OK")),
    ).drop("ambiguous")


def _cost(tokens: str, price: str) -> F.Column:
    return (F.col(tokens).cast(T.DecimalType(18, 0)) * F.col(price)).cast(MONEY_TYPE)


def model_usage(usage: DataFrame) -> DataFrame:
    """Replies and token sums per model; a reply without usage counts as zero tokens."""
    return usage.groupBy("model").agg(
        F.count(F.lit(1)).alias("replies"),
        F.sum(F.coalesce("input_tokens", F.lit(0))).cast("long").alias("input_tokens"),
        F.sum(F.coalesce("output_tokens", F.lit(0))).cast("long").alias("output_tokens"),
        F.count_if(F.col("input_tokens").isNull() | F.col("output_tokens").isNull()).alias(
            "replies_without_usage"
        ),
    )


def price_model_usage(sums: DataFrame, prices: DataFrame) -> DataFrame:
    """Exact cost of per-model token sums."""
    priced = price_usage(sums, prices)
    return priced.select(
        "model",
        "replies",
        "input_tokens",
        "output_tokens",
        "replies_without_usage",
        "price_status",
        _cost("input_tokens", "input_cost_per_token").alias("input_cost"),
        _cost("output_tokens", "output_cost_per_token").alias("output_cost"),
        (_cost("input_tokens", "input_cost_per_token") + _cost("output_tokens", "output_cost_per_token"))
        .cast(MONEY_TYPE)
        .alias("total_cost"),
    )


def cost_by_model(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """AG-1: tokens and exact cost per model.

    Every reply is billed, failed ones too; a reply without usage counts as
    zero tokens and is counted in ``replies_without_usage``.  The sums are
    taken before the join, so only one row per model meets the price list.
    """
    return price_model_usage(model_usage(usage), prices)


def usd(amount: F.Column) -> F.Column:
    """Currency text: ``$1,234.57``, rounded half to even."""
    return F.concat(F.lit("$"), F.format_number(F.bround(amount, 2), 2))


def total_cost(per_model: DataFrame) -> DataFrame:
    """AG-2: the sum over all models that have a price, with its currency text and the number of models that have none."""
    total = F.coalesce(F.sum("total_cost"), F.lit(0)).cast(MONEY_TYPE)
    return per_model.agg(
        F.sum("input_tokens").cast("long").alias("input_tokens"),
        F.sum("output_tokens").cast("long").alias("output_tokens"),
        F.count_if(F.col("price_status") != "OK").alias("unpriced_models"),
        total.alias("total_cost"),
    ).withColumn("total_usd", usd(F.col("total_cost")))

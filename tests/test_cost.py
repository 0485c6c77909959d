from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from scanpress.operators import cost

USAGE = "model string, input_tokens long, output_tokens long"


def test_cost_by_model_exact_ledger_l7_l8(spark):
    usage = spark.createDataFrame(
        [("gemini-1.5", 1_000_000, 1_000_000), ("gemini-1.5", 100, None), ("claude-3.7", 3, 7), ("mystery", 5, 5)],
        USAGE,
    )
    per_model = {r.model: r for r in cost.cost_by_model(usage, cost.prices_frame(spark)).collect()}
    g = per_model["gemini-1.5"]
    assert (g.replies, g.input_tokens, g.output_tokens, g.replies_without_usage) == (2, 1_000_100, 1_000_000, 1)
    assert g.input_cost == Decimal("0.075007500000")
    assert g.output_cost == Decimal("0.300000000000")
    c = per_model["claude-3.7"]
    assert c.total_cost == Decimal(3) * Decimal("0.000003") + Decimal(7) * Decimal("0.000015")
    assert per_model["mystery"].price_status == "UNKNOWN_MODEL" and per_model["mystery"].total_cost is None


def test_total_equals_sum_of_models_and_currency(spark):
    usage = spark.createDataFrame([("gpt-4.1", 1_234_567_890, 0), ("qwen-2.5-vl", 5, 5)], USAGE)
    per_model = cost.cost_by_model(usage, cost.prices_frame(spark))
    total = cost.total_cost(per_model).collect()[0]
    assert total.total_cost == sum(r.total_cost for r in per_model.collect())
    assert total.total_usd == "$3,703.70"


def test_bround_half_even(spark):
    df = spark.createDataFrame([(Decimal("0.125"),), (Decimal("0.135"),)], "x decimal(38,12)")
    assert [r[0] for r in df.select(cost.usd(F.col("x"))).collect()] == ["$0.12", "$0.14"]


def test_a_model_listed_twice_keeps_one_row(spark):
    usage = spark.createDataFrame([("a", 3, 4), ("b", 5, 6), ("c", 1, 1)], "model string, input_tokens long, output_tokens long")
    one, two = Decimal("0.000001"), Decimal("0.000002")
    prices = spark.createDataFrame([("a", one, two), ("a", one, two), ("b", one, two), ("b", two, two)], cost.PRICES_SCHEMA)
    priced = {r.model: r for r in cost.price_usage(usage, prices).collect()}
    assert cost.price_usage(usage, prices).count() == 3
    assert {m: r.price_status for m, r in priced.items()} == {"a": "OK", "b": "AMBIGUOUS_PRICE", "c": "UNKNOWN_MODEL"}
    assert priced["a"].input_cost_per_token == one and priced["b"].input_cost_per_token is None
    total = cost.total_cost(cost.cost_by_model(usage, prices)).first()
    assert total.total_cost == 3 * one + 4 * two and total.unpriced_models == 2

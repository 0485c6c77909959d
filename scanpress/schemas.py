"""Declared schemas and fixed reference values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# Reply records: one row per (page, model, attempt).
RESPONSES = T.StructType([
    T.StructField("page_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("n_generations", T.IntegerType()),
    T.StructField("message_type", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("response_metadata", T.StringType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
])

# Articles extracted from replies.
ARTICLES = T.StructType([
    T.StructField("page_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("headline", T.StringType()),
    T.StructField("strapline", T.StringType()),
    T.StructField("author_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("body_html", T.StringType()),
])

# The corpus table written as Parquet (page is a 32-bit int).
CORPUS = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("issue", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("headline", T.StringType()),
    T.StructField("txt", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("strapline", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("category", T.StringType()),
])

PRICE_TYPE = T.DecimalType(18, 12)
MONEY_TYPE = T.DecimalType(38, 12)

# Fixed values that must equal the reference: supported model names, in
# declaration order, and their prices in USD per million tokens (input, output).
MODELS = ["gemini-1.5", "gemini-1.5-pro", "gemini-2.0", "claude-3.7", "gpt-4.1", "qwen-2.5-vl"]
PRICES_PER_MILLION = {
    "gemini-2.0": (Decimal("0.10"), Decimal("0.40")),
    "gemini-1.5-pro": (Decimal("1.25"), Decimal("5.00")),
    "gemini-1.5": (Decimal("0.075"), Decimal("0.30")),
    "claude-3.7": (Decimal("3"), Decimal("15")),
    "qwen-2.5-vl": (Decimal("0.7"), Decimal("0.7")),
    "gpt-4.1": (Decimal("3.00"), Decimal("12.00")),
}
DEFAULT_MODEL = "gemini-2.0"

# Fixed value: finish reasons a reply must carry to be accepted (case-sensitive).
ACCEPTED_FINISH_REASONS = ["STOP", "end_turn", "stop"]

# Fixed value: the slug is built from the headline shortened to this width.
SLUG_WIDTH = 60
SHORTEN_PLACEHOLDER = " [...]"

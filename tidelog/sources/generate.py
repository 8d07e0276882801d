"""Order, payment and payload rows computed from a record id, on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Domains of the generated messages.
ITEMS = [
    "Mechanical Keyboard", "USB-C Hub", "Standing Desk", "Monitor Arm",
    "Webcam", "Noise-Cancelling Headphones", "Laptop Stand", "Mouse Pad",
    "Ergonomic Chair", "LED Desk Lamp",
]
REGIONS = ["us-east", "us-west", "eu-west", "ap-southeast"]
PROCESSORS = ["stripe", "adyen", "braintree", "checkout.com"]
CURRENCIES = ["USD", "EUR", "GBP", "SGD"]


def draw(record: str, purpose: str, size: int, seed: int = 42) -> Column:
    """A number in ``0..size-1`` fixed by seed, purpose and record id."""
    text = F.concat(F.lit(f"{seed}/{purpose}/"), F.col(record).cast("string"))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(size)).cast("int")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _uuid(record: str, purpose: str, seed: int) -> Column:
    text = F.md5(F.concat(F.lit(f"{seed}/{purpose}/"), F.col(record).cast("string")).cast("binary"))
    return F.concat_ws("-", *[F.substring(text, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _cents(record: str, low: int, high: int, seed: int) -> Column:
    return (draw(record, "amount", high - low + 1, seed) + low).cast("double") / F.lit(100.0)


def gen_orders(ids: DataFrame, record: str = "id", seed: int = 42) -> DataFrame:
    """GEN-1: one order per id; the same id and seed always give the same order."""
    return ids.select(
        F.col(record).alias("record"),
        _uuid(record, "order", seed).alias("id"),
        F.concat(F.lit("customer-"), (draw(record, "customer", 50, seed) + 1).cast("string")).alias("customer_id"),
        _pick(ITEMS, draw(record, "item", len(ITEMS), seed)).alias("item"),
        _cents(record, 999, 49999, seed).alias("amount"),
        (draw(record, "status", 3, seed) + 1).alias("status"),
        _pick(REGIONS, draw(record, "region", len(REGIONS), seed)).alias("region"),
    )


def gen_payments(ids: DataFrame, record: str = "id", seed: int = 42) -> DataFrame:
    """GEN-2: one payment per id."""
    return ids.select(
        F.col(record).alias("record"),
        _uuid(record, "payment", seed).alias("payment_id"),
        _uuid(record, "payment-order", seed).alias("order_id"),
        F.concat(F.lit("cust-"), (draw(record, "customer", 200, seed) + 1).cast("string")).alias("customer_id"),
        _cents(record, 500, 200000, seed).alias("amount"),
        _pick(CURRENCIES, draw(record, "currency", len(CURRENCIES), seed)).alias("currency"),
        (draw(record, "status", 4, seed) + 1).alias("status"),
        _pick(PROCESSORS, draw(record, "processor", len(PROCESSORS), seed)).alias("processor"),
    )


def payload_rows(ids: DataFrame, record: str = "id", fixed_key: str | None = None, size: int | None = None) -> DataFrame:
    """GEN-3: numbered keys and payloads, or one fixed key, or payloads of a fixed size."""
    number = F.format_string("%04d", F.col(record))
    key = F.lit(fixed_key) if fixed_key is not None else F.concat(F.lit("msg-"), number)
    value = F.lit("x" * size) if size is not None else F.concat(F.lit("payload-"), number)
    return ids.select(F.col(record).alias("record"), key.alias("key"), value.alias("value"))

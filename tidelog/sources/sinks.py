"""Writing topics: publish with addresses, delivery reports, text reports, archive and restore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.records import enum_name, padded
from tidelog.operators.filters import check_size
from tidelog.operators.ordering import assign_offsets
from tidelog.operators.routing import assign_partition
from tidelog.schemas import TOPIC

ADDRESS = ["topic", "partition"]

# Head and rule of the text report.
REPORT_HEADER = "partition | offset | customer        | item                      | status                  | region"
REPORT_RULE = "-" * 100


def publish(
    df: DataFrame,
    topic: str,
    partitions: int,
    order: list[str],
    base: DataFrame | None = None,
    unique: str | None = None,
) -> DataFrame:
    """SNK-1: rows with ``key``, ``value`` and ``timestamp`` get a partition and the next offsets.

    ``base`` is ``bounds`` of the log that is appended to.
    """
    routed = assign_partition(df.withColumn("topic", F.lit(topic)), "key", partitions)
    return assign_offsets(routed, order, base, unique)


def append(records: DataFrame, path: str) -> None:
    """SNK-1: append to a landed log, sorted by offset so that scans can skip row groups."""
    (
        records.select(*TOPIC.names)
        .sortWithinPartitions(*ADDRESS, "offset")
        .write.mode("append").partitionBy(*ADDRESS).parquet(path)
    )


def send(records: DataFrame, servers: str) -> None:
    """SNK-1: write through the Kafka connector, which chooses partitions and offsets."""
    records.select("topic", "key", "value").write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).save()


def delivery_report(records: DataFrame, config: DataFrame) -> DataFrame:
    """SNK-2: partition and offset of each stored record, or the error that rejected it.

    ``records`` have no offsets yet but a unique ``seq``; rejected ones take none.
    """
    checked = check_size(records, config)
    stored = assign_offsets(checked.where(F.col("error").isNull()), ["seq"], unique="seq")
    refused = checked.where(F.col("error").isNotNull()).withColumn("offset", F.lit(None).cast("bigint"))
    return stored.unionByName(refused)


def report_lines(
    df: DataFrame, status_names: dict[int, str], preamble: list[str], closing: list[str], region: Column
) -> DataFrame:
    """SNK-3: a text report: preamble, header, rule, one fixed-width line per record, count.

    Rows come as ``(section, partition, offset, line)``; ``write_report`` puts them in order.
    ``closing`` lines may use ``{count}``.
    """
    line = F.concat(
        F.lit("p="), F.col("partition").cast("string"), F.lit("         | "),
        padded(F.col("offset").cast("string"), 6), F.lit(" | "),
        padded(F.col("customer_id"), 16), F.lit("| "), padded(F.col("item"), 26), F.lit("| "),
        padded(enum_name(F.col("status"), status_names, "?"), 24), F.lit("| "), region,
    )
    body = df.select(F.lit(2).alias("section"), "partition", "offset", line.alias("line"))

    def fixed(section: int, lines: list[str]) -> Column:
        parts = [
            F.struct(F.lit(section).alias("section"), F.lit(-1).alias("partition"),
                     F.lit(i).cast("bigint").alias("offset"),
                     F.replace(F.lit(text), F.lit("{count}"), F.col("n").cast("string")).alias("line"))
            for i, text in enumerate(lines)
        ]
        return F.array(*parts)

    frame = F.concat(fixed(1, [*preamble, REPORT_HEADER, REPORT_RULE]), fixed(3, [REPORT_RULE, *closing]))
    around = df.agg(F.count("*").alias("n")).select(F.inline(frame))
    return body.unionByName(around)


def write_report(lines: DataFrame, path: str) -> None:
    """SNK-3: the report as text files whose names follow its order."""
    lines.orderBy("section", "partition", "offset").select("line").write.mode("overwrite").text(path)


def archive(records: DataFrame, path: str) -> None:
    """SNK-4: write records of closed segments; ``records`` come from ``segments``."""
    records.where(~F.col("is_active")).select(*TOPIC.names).sortWithinPartitions(
        *ADDRESS, "offset"
    ).write.mode("append").partitionBy(*ADDRESS).parquet(path)


def restore(cold: DataFrame, base: DataFrame) -> DataFrame:
    """SNK-5: archived records at new offsets after the log end, old order kept."""
    renamed = cold.withColumnRenamed("offset", "old_offset")
    return assign_offsets(renamed, ["old_offset"], base, unique="old_offset")

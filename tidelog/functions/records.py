"""Typed records: reader projection, zero values, enums, times, text and JSON forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schemas import Field, spark_type

# What an absent field reads as, per Protobuf type.
ZERO = {
    "double": 0.0, "float": 0.0, "int32": 0, "int64": 0, "uint32": 0, "uint64": 0,
    "sint32": 0, "sint64": 0, "fixed32": 0, "fixed64": 0, "sfixed32": 0, "sfixed64": 0, "bool": False, "enum": 0, "string": "", "bytes": b"",
}


def zero(f: Field) -> Column:
    """The zero value of a field: no elements if repeated; a nested message or time has none and stays null."""
    return (F.array() if f.repeated else F.lit(ZERO.get(f.type))).cast(spark_type(f))


def project_reader(df: DataFrame, have: list[Field], reader: list[Field], keep: list[str]) -> DataFrame:
    """PRJ-6: read a typed table with another schema, matching fields by number.

    Fields the reader does not know are dropped, fields the writer did not know get zero
    values, and a rename is just a rename.
    """
    known = {f.no: f.name for f in have}
    cols = [
        (F.coalesce(F.col(known[f.no]).cast(spark_type(f)), zero(f)) if f.no in known else zero(f)).alias(f.name)
        for f in reader
    ]
    return df.select(*keep, *cols)


def fill_zero(df: DataFrame, fields: list[Field]) -> DataFrame:
    """PRJ-7: null to zero value."""
    return df.withColumns({f.name: F.coalesce(F.col(f.name), zero(f)) for f in fields if f.type in ZERO})


def zero_to_null(df: DataFrame, fields: list[Field]) -> DataFrame:
    """PRJ-7, the other way: zero value to null."""
    return df.withColumns({f.name: F.nullif(F.col(f.name), zero(f)) for f in fields if f.type in ZERO})


def enum_name(number: Column, names: dict[int, str], unknown: str = "UNKNOWN") -> Column:
    """PRJ-8: name of an enum number."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), number), F.lit(unknown))


def enum_number(name: Column, names: dict[int, str]) -> Column:
    """PRJ-8: number of an enum name, null if there is none."""
    pairs = [F.lit(x) for number, text in names.items() for x in (text, number)]
    return F.try_element_at(F.create_map(*pairs), name)


def _two_digits(amount: str) -> Column:
    return F.format_string("%.2f", F.col(amount))


def order_line(status_names: dict[int, str]) -> Column:
    """PRJ-9: one order as the text line a reader prints; the region only if it is set."""
    region = F.when(F.col("region") != "", F.concat(F.lit(" region="), "region")).otherwise("")
    return F.concat(
        F.lit("partition="), F.col("partition").cast("string"),
        F.lit(" offset="), F.col("offset").cast("string"),
        F.lit(" | id="), F.substring("id", 1, 8), F.lit("... customer="), "customer_id",
        F.lit(" item='"), "item", F.lit("' amount=$"), _two_digits("amount"),
        F.lit(" status="), enum_name(F.col("status"), status_names), F.coalesce(region, F.lit("")),
    )


def millis_to_time(millis: Column) -> Column:
    """PRJ-10: epoch milliseconds to a timestamp."""
    return F.timestamp_millis(millis.cast("bigint"))


def parts_to_time(seconds: Column, nanos: Column) -> Column:
    """PRJ-10: seconds and nanoseconds to a timestamp, cut to microseconds."""
    return F.timestamp_micros(
        seconds.cast("bigint") * 1000000 + F.floor(nanos.cast("bigint") / F.lit(1000)).cast("bigint")
    )


def time_to_parts(time: Column) -> tuple[Column, Column]:
    """PRJ-10: a timestamp as seconds and nanoseconds."""
    micros = F.unix_micros(time)
    rest = F.pmod(micros, F.lit(1000000))
    seconds = ((micros - rest) / F.lit(1000000)).cast("bigint")
    return seconds, (rest * 1000).cast("int")


def set_fields(fields: list[Field]) -> Column:
    """PRJ-11: names of the fields that are not zero, in field order."""
    def given(f: Field) -> Column:
        col = F.col(f.name)
        return col.isNotNull() & (col != zero(f)) if f.type in ZERO else col.isNotNull()

    return F.array_compact(F.array(*[F.when(given(f), F.lit(f.name)) for f in fields]))


def has_field(fields: list[Field], name: str) -> Column:
    """PRJ-11: whether one field is set."""
    return F.array_contains(set_fields(fields), name)


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def iso_time(time: Column) -> Column:
    """A timestamp as ``2024-01-15T10:30:00Z``, with a fraction only where there is one."""
    micros = F.pmod(F.unix_micros(time), F.lit(1000000))
    fraction = (
        F.when(micros == 0, "")
        .when(F.pmod(micros, F.lit(1000)) == 0, F.concat(F.lit("."), F.lpad((micros / F.lit(1000)).cast("bigint").cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    )
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def json_record(fields: list[Field], enums: dict[str, dict[int, str]] | None = None, case: str = "camel") -> Column:
    """PRJ-12: the record as JSON; zero fields are left out, enums are shown by name.

    Times are shown in the session time zone, which must be UTC.
    """
    cols = []
    for f in fields:
        col = F.nullif(F.col(f.name), zero(f)) if f.type in ZERO else F.col(f.name)
        if f.type == "enum" and enums and f.name in enums:
            col = F.when(col.isNotNull(), enum_name(col, enums[f.name]))
        if f.type == "timestamp":
            col = iso_time(col)
        cols.append(col.alias(camel(f.name) if case == "camel" else f.name))
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "true"})


def subject(topic: Column) -> Column:
    """PRJ-13: registry subject of a topic's values."""
    return F.concat(topic, F.lit("-value"))


def padded(col: Column, width: int) -> Column:
    """Left-aligned in ``width`` places; longer text is not cut."""
    return F.when(F.char_length(col) < width, F.rpad(col, width, " ")).otherwise(col)

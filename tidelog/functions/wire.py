"""Envelopes, sizes and signed codings as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schemas import WIRE, Field


def _number(binary: str) -> str:
    return f"cast(conv(hex({binary}), 16, 10) as bigint)"


def split_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """PRJ-1: magic byte, schema id, message index and payload of an enveloped value.

    The index list is one byte ``00`` for the first message of a file, else a count and
    that many numbers, all zigzag varints. One index of up to three bytes is read (more
    messages than any file has); of several, as nested messages have, the first is given.
    A list that is cut off has no payload.
    """
    def byte(at: int) -> str:
        return f"coalesce({_number(f'substring({value}, {at}, 1)')}, 0)"

    lead, one, two, three = byte(6), byte(7), byte(8), byte(9)
    width = f"if({one} < 128, 1, if({two} < 128, 2, 3))"
    raw = f"({one} % 128 + if({one} < 128, 0, {two} % 128 * 128 + if({two} < 128, 0, {three} % 128 * 16384)))"
    # The bytes of as many varints as the list has numbers, each of five bytes at most.
    several = f"concat('^(?:(?:[89A-F][0-9A-F]){{0,4}}[0-7][0-9A-F]){{', {lead} div 2, '}}')"
    header = f"regexp_extract(hex(substring({value}, 7, 5 * ({lead} div 2))), {several}, 0)"
    width = f"if({lead} = 2, {width}, if({lead} < 2, 0, nullif(length({header}) div 2, 0)))"
    return df.selectExpr(
        "*",
        f"cast({_number(f'substring({value}, 1, 1)')} as int) as magic",
        f"cast({_number(f'substring({value}, 2, 4)')} as int) as schema_id",
        f"cast(if({lead} = 0, 0, {raw} div 2) as int) as message_index",
        f"substring({value}, cast(7 + {width} as int)) as payload",
    )


def build_envelope(schema_id: Column, payload: Column) -> Column:
    """PRJ-2: magic byte, four id bytes, message index 0, payload."""
    head = F.concat(F.lit("00"), F.lpad(F.hex(schema_id.cast("bigint")), 8, "0"), F.lit("00"))
    return F.concat(F.unhex(head), payload)


def classify_value(value: str = "value") -> Column:
    """PRJ-3: null, enveloped, raw (starts with a valid field tag) or foreign."""
    first = F.expr(_number(f"substring({value}, 1, 1)"))
    wire = first.bitwiseAND(F.lit(7))
    valid_tag = (first >= 8) & wire.isin(0, 1, 2, 5)
    return (
        F.when(F.col(value).isNull(), "null")
        .when((first == 0) & (F.octet_length(value) >= 6), "enveloped")
        .when(valid_tag, "raw")
        .otherwise("foreign")
    )


def varint_length(n: Column) -> Column:
    """Bytes a number takes as a varint: seven bits each; negative numbers have 64 bits."""
    return F.ceil(F.char_length(F.bin(n.cast("bigint"))) / F.lit(7)).cast("int")


def zigzag(n: Column) -> Column:
    """A signed number in the sint coding."""
    n = n.cast("bigint")
    return F.shiftleft(n, 1).bitwiseXOR(F.shiftright(n, 63))


def unzigzag(n: Column) -> Column:
    n = n.cast("bigint")
    return F.shiftrightunsigned(n, 1).bitwiseXOR(-n.bitwiseAND(F.lit(1)))


def zigzag_misread(n: Column, bits: int = 32) -> tuple[Column, Column]:
    """PRJ-16: a plain integer re-read as sint, and a sint re-read as plain, in ``bits`` bits."""
    n = n.cast("bigint")
    if bits == 32:
        unsigned = n.bitwiseAND(F.lit(0xFFFFFFFF))
        coded = zigzag(n).bitwiseAND(F.lit(0xFFFFFFFF))
        wrapped = F.when(coded >= F.lit(1 << 31), coded - F.lit(1 << 32)).otherwise(coded)
        return unzigzag(unsigned), wrapped
    return unzigzag(n), zigzag(n)


def _is_set(f: Field, col: Column) -> Column:
    if f.type in ("string", "bytes"):
        return F.octet_length(col) > 0
    if f.type == "timestamp":
        return col.isNotNull()
    if f.type == "bool":
        return col
    if f.type in ("float", "double"):
        # Only the bits of +0.0 are the default; -0.0 is written.
        return (col != F.lit(0)) | (col.cast("string") == "-0.0")
    return col != F.lit(0)


def _tag(f: Field) -> int:
    return f.no << 3 | WIRE[f.type][0]


def _tag_length(f: Field) -> int:
    return -(-_tag(f).bit_length() // 7)


def _clock(col: Column) -> tuple[Column, Column]:
    return F.unix_seconds(col), F.pmod(F.unix_micros(col), F.lit(1000000)) * 1000


def _on_wire(f: Field, col: Column) -> Column:
    if f.type in ("sint32", "sint64"):
        return zigzag(col)
    if f.type == "bool":
        return col.cast("int")
    return col


def encoded_size(fields: list[Field], columns: dict[str, Column] | None = None) -> Column:
    """PRJ-14: bytes a row would take, from its columns, without encoding it."""
    sizes = []
    for f in fields:
        col = (columns or {}).get(f.name, F.col(f.name))
        if f.type in ("string", "bytes"):
            n = F.octet_length(col)
            body = varint_length(n) + n
        elif f.type == "double":
            body = F.lit(8)
        elif f.type == "float":
            body = F.lit(4)
        elif f.type == "timestamp":
            seconds, nanos = (F.when(p != 0, varint_length(p) + 1).otherwise(F.lit(0)) for p in _clock(col))
            body = seconds + nanos + 1
        else:
            body = varint_length(_on_wire(f, col))
        sizes.append(F.when(_is_set(f, col), body + F.lit(_tag_length(f))).otherwise(F.lit(0)))
    return reduce(lambda a, b: a + b, sizes)

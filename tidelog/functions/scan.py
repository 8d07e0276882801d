"""Message bytes to typed tables: one vectorised pass per Arrow batch.

All rows of a batch are walked in step: each turn reads one field of every row that has
bytes left, with array operations over the batch's byte buffer. There is no per-row loop.
Nested messages are walked in the same way, all of one field of a batch at once: their places
in the buffer are the rows of the next level. How often a field occurs in a row becomes the
offsets of an Arrow list, whether it occurs at all the validity of an Arrow struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.functions.records import ZERO
from tidelog.schemas import WIRE, Field, struct, struct_of

# Layout of the types of fixed width.
FIXED = {"double": "<f8", "float": "<f4", "fixed64": "<u8", "fixed32": "<u4", "sfixed64": "<i8", "sfixed32": "<i4"}


class Scan(NamedTuple):
    """Fields found in a batch, in wire order per row, and an error text per row (or None)."""

    row: np.ndarray
    number: np.ndarray
    wire: np.ndarray
    start: np.ndarray
    length: np.ndarray
    value: np.ndarray
    error: np.ndarray


def _varints(data, at, end):
    """Numbers starting at ``at``; returns values, next positions and which are broken."""
    value = np.zeros(len(at), np.uint64)
    at = at.copy()
    open_ = np.ones(len(at), bool)
    bad = np.zeros(len(at), bool)
    for shift in range(0, 70, 7):
        bad |= open_ & (at >= end)
        open_ &= ~bad
        if not open_.any():
            break
        byte = data[np.where(open_, at, 0)].astype(np.uint64)
        value[open_] |= (byte[open_] & np.uint64(127)) << np.uint64(shift)
        at[open_] += 1
        open_ &= byte >= 128
    return value, at, bad | open_


def scan(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Scan:
    """Walk every message between ``start`` and ``end`` in ``data``."""
    n = len(start)
    error = np.full(n, None, object)
    at, found = start.astype(np.int64).copy(), []
    live = np.flatnonzero(at < end)
    while len(live):
        stop = end[live]
        tag, pos, bad = _varints(data, at[live], stop)
        number, wire = (tag >> np.uint64(3)).astype(np.int64), (tag & np.uint64(7)).astype(np.int64)
        value = np.zeros(len(live), np.uint64)
        is_number, is_block = (wire == 0) & ~bad, (wire == 2) & ~bad
        first = pos.copy()
        coded = is_number | is_block
        if coded.any():
            v, p, b = _varints(data, pos[coded], stop[coded])
            value[coded], bad[coded] = v, b
            after = pos.copy()
            after[coded] = p
            first = np.where(is_block, after, pos)
            pos = after
        room = (stop - pos).astype(np.int64)
        too_long = is_block & (value > room.astype(np.uint64))
        size = np.select([is_block & ~too_long, wire == 1, wire == 5], [value.astype(np.int64), 8, 4], 0)
        unknown = ~bad & ~np.isin(wire, (0, 1, 2, 5))
        bad |= (number == 0) | unknown | too_long | (size > room)
        length = np.where(is_number, pos - first, size)
        pos = pos + np.where(is_number, 0, size)
        error[live[bad]] = "broken message"
        ok = ~bad
        found.append((live[ok], number[ok], wire[ok], first[ok], length[ok], value[ok]))
        at[live] = pos
        live = live[ok & (pos < stop)]
    if not found:
        empty = np.zeros(0, np.int64)
        return Scan(empty, empty, empty, empty, empty, np.zeros(0, np.uint64), error)
    return Scan(*[np.concatenate(c) for c in zip(*found)], error)


def binary_buffer(column: pa.Array):
    """Byte buffer of a binary array with start and end of every value (null is empty)."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(1, np.uint8)
    start, end = offsets[:-1].copy(), offsets[1:].copy()
    empty = column.is_null().to_numpy(zero_copy_only=False)
    end[empty] = start[empty]
    return data, start, end


def slices(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of all bytes of the given ranges, one range after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def _gather(data, start, length) -> pa.Array:
    """Binary array of the given slices of ``data``."""
    offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[slices(start, length)])]
    )


def _fixed(data, start, kind):
    size = np.dtype(kind).itemsize
    if not len(start):
        return np.zeros(0, kind)
    return data[start[:, None] + np.arange(size)].copy().view(kind)[:, 0]


def _signed(value, bits):
    if bits == 32:
        return value.astype(np.uint32).view(np.int32)
    return value.view(np.int64)


def _numbers(kind: str, value: np.ndarray) -> np.ndarray:
    if kind in ("int32", "enum"):
        return _signed(value, 32)
    if kind == "int64":
        return _signed(value, 64)
    if kind == "uint32":
        return value.astype(np.uint32).astype(np.int64)
    if kind in ("sint32", "sint64"):
        plain = (value >> np.uint64(1)) ^ (~(value & np.uint64(1)) + np.uint64(1))
        return _signed(plain, 32 if kind == "sint32" else 64)
    if kind == "bool":
        return value != 0
    return value


def _times(data, rows, start, length, n, error):
    """Nested seconds and nanos to microseconds; rows without the field stay null."""
    inner = scan(data, start, start + length)
    for i in np.flatnonzero(inner.error != None):  # noqa: E711
        error[rows[i]] = "broken message"
    seconds, nanos = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for number, target in ((1, seconds), (2, nanos)):
        hit = (inner.number == number) & (inner.wire == 0)
        target[inner.row[hit]] = inner.value[hit].view(np.int64)
    micros, absent = np.zeros(n, np.int64), np.ones(n, bool)
    micros[rows] = seconds * 1_000_000 + nanos // 1000
    absent[rows] = False
    return pa.array(micros, pa.timestamp("us", tz="UTC"), mask=absent)


def _last(rows: np.ndarray, n: int) -> np.ndarray:
    """Positions of the last entry of every row; on the wire the last value wins."""
    at = np.full(n, -1, np.int64)
    at[rows] = np.arange(len(rows))
    return at[at >= 0]


def _text(column: pa.Array, error: np.ndarray) -> pa.Array:
    try:
        text = column.view(pa.large_string())
        text.validate(full=True)
        return text
    except pa.ArrowInvalid:
        def read(i, raw):
            try:
                return raw.decode()
            except UnicodeDecodeError:
                error[i] = "invalid text"
                return ""

        return pa.array([read(i, raw) for i, raw in enumerate(column.to_pylist())], pa.large_string())


def _elements(f: Field, data, value, start, length) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Typed values of fields found at the given places, and error and mismatch of each."""
    count = len(start)
    error, mismatch = np.full(count, None, object), np.zeros(count, bool)
    if f.type == "message":
        columns, error, mismatch = decode_ranges(data, start, start + length, f.inner)
        return _struct(f, columns, count), error, mismatch
    if f.type == "timestamp":
        out = _times(data, np.arange(count), start, length, count, error)
    elif f.type in FIXED:
        out = pa.array(_fixed(data, start, FIXED[f.type]))
    elif WIRE[f.type][0] == 2:
        body = _gather(data, start, length)
        out = _text(body, error) if f.type == "string" else body
    else:
        out = pa.array(_numbers(f.type, value))
    return (out.cast(pa.decimal128(20, 0)) if f.type in ("uint64", "fixed64") else out), error, mismatch


def _struct(f: Field, columns: list[pa.Array], count: int, absent: np.ndarray | None = None) -> pa.Array:
    mask = None if absent is None else pa.array(absent)
    if not columns:
        return pa.array([None if absent is not None and absent[i] else {} for i in range(count)], pa.struct([]))
    return pa.StructArray.from_arrays(columns, [g.name for g in f.inner], mask=mask)


def _blame(rows: np.ndarray, found: np.ndarray, error: np.ndarray) -> None:
    """Errors of parts become errors of their rows."""
    for i in np.flatnonzero(found != None):  # noqa: E711
        error[rows[i]] = found[i]


def _packed(f: Field, data, found: Scan, pick: np.ndarray, error: np.ndarray):
    """Values and places of numbers that come one by one or packed in blocks, in wire order."""
    start, length, value = found.start[pick], found.length[pick], found.value[pick]
    block = found.wire[pick] == 2
    at = np.flatnonzero(block)
    if f.type in FIXED:
        size = np.dtype(FIXED[f.type]).itemsize
        counts = np.where(block, length // size, 1)
        error[found.row[pick[block & (length % size != 0)]]] = "broken message"
        entry = np.repeat(np.arange(len(pick)), counts)
        nth = np.arange(len(entry)) - np.repeat(np.cumsum(counts) - counts, counts)
        return entry, value[entry], start[entry] + nth * size
    inside = slices(start[at], length[at])
    owner = np.repeat(np.arange(len(at)), length[at])
    ends = data[inside] < 128
    opens = np.append(True, ends[:-1]) | np.append(True, owner[1:] != owner[:-1]) if len(inside) else np.zeros(0, bool)
    first, of = inside[opens], owner[opens]
    numbers, _, bad = _varints(data, first, (start + length)[at][of])
    error[found.row[pick[at[of[bad]]]]] = "broken message"
    counts = np.ones(len(pick), np.int64)
    counts[at] = np.bincount(of, minlength=len(at))
    entry = np.repeat(np.arange(len(pick)), counts)
    values = value[entry]
    values[block[entry]] = numbers
    return entry, values, start[entry]


def _list(f: Field, data, found: Scan, pick: np.ndarray, n: int, error: np.ndarray, mismatch: np.ndarray) -> pa.Array:
    """All values of a repeated field, as one list per row."""
    pick = pick[np.argsort(found.row[pick], kind="stable")]
    if WIRE[f.type][0] == 2:
        value, start, rows = found.value[pick], found.start[pick], found.row[pick]
    else:
        entry, value, start = _packed(f, data, found, pick, error)
        rows = found.row[pick][entry]
    length = found.length[pick] if WIRE[f.type][0] == 2 else np.zeros(len(start), np.int64)
    values, wrong, other = _elements(f, data, value, start, length)
    _blame(rows, wrong, error)
    mismatch[rows[other]] = True
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _nested(f: Field, data, found: Scan, pick: np.ndarray, n: int, error: np.ndarray, mismatch: np.ndarray) -> pa.Array:
    """One nested message per row, null where there is none; parts of a message sent in pieces are one message."""
    pick = pick[np.argsort(found.row[pick], kind="stable")]
    rows, begins = np.unique(found.row[pick], return_index=True)
    start, length = found.start[pick], found.length[pick]
    if len(rows) < len(pick):
        data = data[slices(start, length)]
        length = np.add.reduceat(length, begins)
        start = np.cumsum(length) - length
    columns, wrong, other = decode_ranges(data, start, start + length, f.inner)
    _blame(rows, wrong, error)
    mismatch[rows[other]] = True
    spot, absent = np.zeros(n, np.int64), np.ones(n, bool)
    spot[rows], absent[rows] = np.arange(len(rows)), False
    take = pa.array(spot, mask=absent)
    return _struct(f, [c.take(take) for c in columns], n, absent)


def decode_batch(column: pa.Array, fields: list[Field]) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """Typed columns, error per row, and whether a known field came with another wire type."""
    return decode_ranges(*binary_buffer(column), fields)


def decode_ranges(data, start, end, fields) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """The same for messages between ``start`` and ``end`` in ``data``."""
    n = len(start)
    found = scan(data, start, end)
    error, mismatch, out = found.error, np.zeros(n, bool), []
    for f in fields:
        wire = WIRE[f.type][0]
        mine = found.number == f.no
        fits = (found.wire == wire) | (found.wire == 2) if f.repeated else found.wire == wire
        mismatch[found.row[mine & ~fits]] = True
        pick = np.flatnonzero(mine & fits)
        if f.repeated:
            out.append(_list(f, data, found, pick, n, error, mismatch))
            continue
        if f.type == "message":
            out.append(_nested(f, data, found, pick, n, error, mismatch))
            continue
        pick = pick[_last(found.row[pick], n)]
        rows, first, length = found.row[pick], found.start[pick], found.length[pick]
        if f.type == "timestamp":
            out.append(_times(data, rows, first, length, n, error))
        elif wire == 2:
            begin, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
            begin[rows], size[rows] = first, length
            body = _gather(data, begin, size)
            out.append(_text(body, error) if f.type == "string" else body)
        else:
            values = _fixed(data, first, FIXED[f.type]) if f.type in FIXED else _numbers(f.type, found.value[pick])
            full = np.zeros(n, values.dtype)
            full[rows] = values
            out.append(pa.array(full).cast(pa.decimal128(20, 0)) if f.type in ("uint64", "fixed64") else pa.array(full))
    return out, error, mismatch


def _fit(array: pa.Array, kind: pa.DataType) -> pa.Array:
    """The array in the type that Spark expects, all the way down."""
    if pa.types.is_struct(kind):
        parts = [_fit(array.field(i), kind.field(i).type) for i in range(kind.num_fields)]
        return pa.StructArray.from_arrays(parts, fields=list(kind), mask=array.is_null()) if parts else array.cast(kind)
    if pa.types.is_list(kind):
        return pa.ListArray.from_arrays(array.offsets, _fit(array.values, kind.value_type), type=kind)
    return array.cast(kind)


def decode_messages(df: DataFrame, fields: list[Field], payload: str, keep: list[str]) -> DataFrame:
    """``keep``, the fields of the one message type in ``payload``, and ``decode_error``."""
    source = df.select(*keep, payload)
    kept = [f for f in source.schema.fields if f.name != payload]
    shape = T.StructType([*kept, *struct_of(fields).fields, T.StructField("decode_error", T.StringType())])
    arrow = to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, error, _ = decode_batch(batch.column(payload), fields)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(f.name).cast(arrow.field(f.name).type) for f in kept],
                    *[_fit(c, arrow.field(f.name).type) for f, c in zip(fields, columns)], pa.array(error, pa.string()),
                ],
                schema=arrow,
            )

    return source.mapInArrow(run, shape)


def decode_topic(
    df: DataFrame,
    writers: dict[int, list[Field]],
    columns: list[Field] | None = None,
    payload: str = "payload",
) -> DataFrame:
    """PRJ-4: typed topic table, each payload read with the schema its id names.

    ``writers`` maps schema ids to fields. ``columns`` limits the work to the fields that
    are needed; by default it is every field number of any writer. A row that cannot be
    read has ``decode_error`` and zero values; a field that came with another wire type
    reads as zero and sets ``wire_mismatch``.
    """
    columns = columns or list({f.no: f for fields in writers.values() for f in fields}.values())
    shape, one = _decoder(df.drop("value") if payload != "value" else df, columns, payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for schema_id, part in _by_schema(batch):
                yield one(part, writers.get(schema_id, []))

    return df.drop(*(["value"] if payload != "value" else [])).mapInArrow(run, shape)


def _by_schema(batch: pa.RecordBatch) -> Iterator[tuple[int | None, pa.RecordBatch]]:
    ids = batch.column("schema_id")
    for schema_id in pc.unique(ids).to_pylist():
        yield schema_id, batch.filter(pc.equal(ids, schema_id) if schema_id is not None else pc.is_null(ids))


def _decoder(df: DataFrame, columns: list[Field], payload: str, drop: tuple[str, ...] = ()):
    """The shape of a decoded table, and what decodes a batch of one writer into it."""
    keep = [f for f in df.schema.fields if f.name != payload and f.name not in drop]
    shape = T.StructType(
        keep
        + struct_of(columns).fields
        + [T.StructField("wire_mismatch", T.BooleanType()), T.StructField("decode_error", T.StringType())]
    )
    arrow = to_arrow_schema(shape)
    names = [f.name for f in keep]

    def one(batch: pa.RecordBatch, writer: list[Field]) -> pa.RecordBatch:
        n = batch.num_rows
        known = {f.no: f for f in writer}
        read = [_as_read(known[f.no], f) for f in columns if f.no in known]
        cols, error, mismatch = decode_batch(batch.column(payload), read)
        if not known:
            error = np.full(n, "unknown schema id", object)
        by_number = {f.no: c for f, c in zip(read, cols)}
        typed = []
        for f, target in zip(columns, list(arrow)[len(names) : -2]):
            got = by_number.get(f.no)
            typed.append(_zeros(f, n, target.type) if got is None else _fit(got, target.type))
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c).cast(arrow.field(c).type) for c in names], *typed, pa.array(mismatch), pa.array(error, pa.string())], schema=arrow
        )

    return shape, one


def _as_read(written: Field, wanted: Field) -> Field:
    """How to read a field of a writer for a reader: nested fields are met by number, with the reader's names.

    A writer's plain type is kept, as it says how the bytes are coded; where one side has a
    message or a list and the other has not, the reader's is taken and the bytes decide.
    """
    if wanted.type != "message":
        same = written.type != "message" and written.repeated == wanted.repeated
        return wanted._replace(type=written.type) if same else wanted
    theirs = {f.no: f for f in written.inner}
    return wanted._replace(inner=tuple(_as_read(theirs[f.no], f) if f.no in theirs else f for f in wanted.inner))


def _zeros(f: Field, n: int, kind: pa.DataType) -> pa.Array:
    if f.repeated:
        return pa.array([[]] * n, kind)
    if f.type not in ZERO:
        return pa.nulls(n, kind)
    return pa.array([ZERO[f.type]] * n).cast(kind)


_FIELD_ROWS = "field_index int, field_no int, wire_type int, length int"


def wire_fields(df: DataFrame, keep: list[str], payload: str = "payload") -> DataFrame:
    """PRJ-15: one row per field of every value: number, wire type, and bytes of the value.

    Every value is read to its end; a broken one also gives a row with ``decode_error``.
    """
    source = df.select(*keep, payload)
    kept = [f for f in source.schema.fields if f.name != payload]
    shape = T.StructType(
        kept + struct(_FIELD_ROWS).fields + [T.StructField("decode_error", T.StringType())]
    )
    arrow = to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scan(*binary_buffer(batch.column(payload)))
            broken = np.flatnonzero(found.error != None)  # noqa: E711
            order = np.argsort(found.row, kind="stable")
            rows = found.row[order]
            begin = np.searchsorted(rows, rows, "left")
            index = np.arange(len(rows)) - begin
            take = pa.array(np.concatenate((rows, broken)))
            blank = np.concatenate((np.zeros(len(rows), bool), np.ones(len(broken), bool)))

            def column(values):
                full = np.concatenate((values, np.zeros(len(broken), np.int64)))
                return pa.array(full.astype(np.int32), pa.int32(), mask=blank)

            text = [None] * len(rows) + ["broken message"] * len(broken)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(f.name).take(take).cast(arrow.field(f.name).type) for f in kept],
                    column(index), column(found.number[order]), column(found.wire[order]),
                    column(found.length[order]), pa.array(text, pa.string()),
                ],
                schema=arrow,
            )

    return source.mapInArrow(run, shape)

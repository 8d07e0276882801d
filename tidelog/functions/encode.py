"""Typed tables to message bytes: one vectorised pass per Arrow batch.

A message is a row of byte pieces. Each piece is prepared for the whole batch at once, and
the pieces are written next to each other into one buffer. There is no per-row loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.functions.scan import FIXED, binary_buffer, slices
from tidelog.schemas import WIRE, Field


class _Fixed:
    """A piece of at most a few bytes per row: a matrix of bytes and how many count."""

    def __init__(self, matrix: np.ndarray, length: np.ndarray):
        self.matrix, self.length = matrix, length

    def write(self, target: np.ndarray, at: np.ndarray) -> None:
        places = np.arange(self.matrix.shape[1])
        used = places < self.length[:, None]
        target[(at[:, None] + places)[used]] = self.matrix[used]


class _Text:
    """A piece copied from the buffer of a text or binary column."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.data, self.start, self.length = data, start, length

    def write(self, target: np.ndarray, at: np.ndarray) -> None:
        target[slices(at, self.length)] = self.data[slices(self.start, self.length)]


def _varint(value: np.ndarray) -> _Fixed:
    value = value.astype(np.int64).view(np.uint64)
    groups = (value[:, None] >> (np.arange(10, dtype=np.uint64) * np.uint64(7))) & np.uint64(127)
    bounds = np.uint64(1) << (np.arange(1, 10, dtype=np.uint64) * np.uint64(7))
    length = 1 + (value[:, None] >= bounds).sum(axis=1)
    matrix = groups.astype(np.uint8)
    matrix[np.arange(10) < length[:, None] - 1] |= 128
    return _Fixed(matrix, length)


def _tagged(tag: int, piece: _Fixed, given: np.ndarray) -> _Fixed:
    """The piece behind its tag, left out where the field is not given."""
    head = _varint(np.array([tag]))
    lead = np.repeat(head.matrix[:, : head.length[0]], len(given), axis=0)
    return _Fixed(np.hstack((lead, piece.matrix)), np.where(given, piece.length + head.length[0], 0))


def _plain(column: pa.Array, kind) -> np.ndarray:
    return column.cast(kind).fill_null(0).to_numpy(zero_copy_only=False)


def _scalar(f: Field, column: pa.Array) -> tuple[_Fixed, np.ndarray]:
    """Bytes of a number without its tag, and whether it is not zero."""
    if f.type in FIXED:
        kind = np.dtype(FIXED[f.type])
        plain = {"f": pa.float64(), "u": pa.uint64(), "i": pa.int64()}[kind.kind]
        value = _plain(column, plain).astype(kind)
        raw = value.view(np.uint8).reshape(len(value), kind.itemsize)
        return _Fixed(raw, np.full(len(value), kind.itemsize)), raw.any(axis=1)
    value = _plain(column, pa.uint64()).view(np.int64) if f.type == "uint64" else _plain(column, pa.int64())
    given = value != 0
    if f.type in ("sint32", "sint64"):
        value = (value << 1) ^ (value >> 63)
    return _varint(value), given


def _block(f: Field, column: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
    """Pieces of a text, time or message without its tag, their length, and whether it is given."""
    given = column.is_valid().to_numpy(zero_copy_only=False)
    if f.type == "timestamp":
        micros = _plain(column.cast(pa.timestamp("us", tz="UTC")), pa.int64())
        seconds, nanos = micros // 1_000_000, micros % 1_000_000 * 1000
        inner = [
            _tagged(8, _varint(seconds), given & (seconds != 0)),
            _tagged(16, _varint(nanos), given & (nanos != 0)),
        ]
        return inner, inner[0].length + inner[1].length, given
    if f.type == "message":
        names = [column.type.field(i).name for i in range(column.type.num_fields)]
        column = encode_batch(dict(zip(names, column.flatten())), list(f.inner), len(column))
    data, start, end = binary_buffer(column)
    length = np.where(given, end - start, 0)
    return [_Text(data, start, length)], length, given if f.type == "message" else length > 0


def _repeated(f: Field, column: pa.Array) -> list:
    """All elements of a list: numbers packed in one block, others one by one behind their tags."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
    ends = np.cumsum(counts)
    elements = column.flatten()
    every = np.ones(len(elements), bool)
    if WIRE[f.type][0] == 2:
        pieces, length, _ = _block(f, elements)
        target, offsets = _joined([_tagged(f.no << 3 | 2, _varint(length), every), *pieces], len(elements))
        return [_Text(target, offsets[ends - counts], offsets[ends] - offsets[ends - counts])]
    target, offsets = _joined([_scalar(f, elements)[0]], len(elements))
    length = offsets[ends] - offsets[ends - counts]
    return [_tagged(f.no << 3 | 2, _varint(length), length > 0), _Text(target, offsets[ends - counts], length)]


def _pieces(f: Field, column: pa.Array) -> list:
    if f.repeated:
        return _repeated(f, column)
    tag = f.no << 3 | WIRE[f.type][0]
    if WIRE[f.type][0] == 2:
        pieces, length, given = _block(f, column)
        return [_tagged(tag, _varint(length), given), *pieces]
    piece, given = _scalar(f, column)
    return [_tagged(tag, piece, given)]


def _joined(pieces: list, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of every row next to each other, and where each row begins."""
    sizes = np.array([p.length for p in pieces]).reshape(len(pieces), rows)
    offsets = np.concatenate(([0], np.cumsum(sizes.sum(axis=0)))).astype(np.int64)
    target = np.zeros(offsets[-1], np.uint8)
    at = offsets[:-1].copy()
    for piece in pieces:
        piece.write(target, at)
        at += piece.length
    return target, offsets


def encode_batch(columns: dict[str, pa.Array], fields: list[Field], rows: int) -> pa.Array:
    """Message bytes of every row; zero values, nulls and empty lists take no bytes."""
    target, offsets = _joined([p for f in sorted(fields) for p in _pieces(f, columns[f.name])], rows)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(target)]
    )


def encode_topic(df: DataFrame, fields: list[Field], payload: str = "payload") -> DataFrame:
    """PRJ-5: the message columns of a typed table become one column of message bytes."""
    names = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in names]
    shape = T.StructType([*kept, T.StructField(payload, T.BinaryType())])
    arrow = to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = encode_batch({n: batch.column(n) for n in names}, fields, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name).cast(arrow.field(f.name).type) for f in kept],
                 coded.cast(arrow.field(payload).type)],
                schema=arrow,
            )

    return df.mapInArrow(run, shape)

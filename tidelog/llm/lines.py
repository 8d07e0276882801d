"""Line deduplication: sorted line hashes, streamed; documents get keep bitmaps, not texts.

Every line is one small row. The rows are range-partitioned by hash, document and position
together and sorted in that order, so a line that stands in a third of all documents is
spread over many tasks. A task streams its runs of equal hashes and decides them at once;
only the first and the last run of a task may go on in a neighbour, and what those leave
open is settled by one small join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import table
from tidelog.scratch import cut

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(UPPER, LOWER)
# A line in so many documents goes.
MIN_DOCS = 10
# Lines that a task holds before it hands them on.
FLUSH = 100_000
_FIELDS = ["h", "g", "doc_id", "text_hash", "pos", "n"]


def line_key(line: str) -> str:
    """A line without blanks at its ends, A-Z as a-z."""
    line = line.strip(BLANKS)
    return line.lower() if line.isascii() else line.translate(_LOWER)


def line_rows(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """``h, g, doc_id, text_hash, pos, n, opens``: a row for each line with a key long enough.

    ``h`` and ``g`` are a 128-bit hash of the key and ``n`` counts the text's lines; ``opens``
    marks the first line of its key in this text. Document rows of equal id and equal text
    share an address but each counts as a document.
    """

    def run(batches):
        for batch in batches:
            held, count = [], 0
            for row, text in enumerate(batch.column("text")):
                lines = (text.as_py() or "").split("\n")
                digests, places, opens, seen = [], [], [], set()
                for pos, line in enumerate(lines):
                    if len(key := line_key(line)) >= min_chars:
                        digest = xxhash.xxh3_128_digest(key.encode())
                        digests.append(digest)
                        places.append(pos)
                        opens.append(digest not in seen)
                        seen.add(digest)
                held.append((row, len(lines), b"".join(digests), places, opens))
                count += len(places)
                if count > FLUSH:
                    yield _line_batch(batch, held)
                    held, count = [], 0
            yield _line_batch(batch, held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "h long, g long, doc_id long, text_hash long, pos int, n int, opens boolean")


def _line_batch(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
    sizes = [len(places) for _, _, _, places, _ in held]
    of = pa.array(np.repeat(np.array([row for row, *_ in held], np.int64), sizes))
    hashes = np.frombuffer(b"".join(d for _, _, d, _, _ in held), "<i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays([
        pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), batch.column("doc_id").take(of), batch.column("text_hash").take(of),
        pa.array([p for _, _, _, places, _ in held for p in places], pa.int32()),
        pa.array(np.repeat(np.array([n for _, n, *_ in held], np.int32), sizes)),
        pa.array([o for *_, opens in held for o in opens], pa.bool_()),
    ], [*_FIELDS, "opens"])


class _Run:
    """The run that is being streamed: its key, its first line, documents so far, lines not yet settled."""

    def __init__(self, key, first):
        self.key, self.first, self.docs, self.held = key, first, 0, []


def _stream(min_docs: int, keep_first: bool):
    """Decide the runs of a sorted partition.

    Gives lines to drop (without hash), lines left open (with their hash), and for each run at
    an edge its number of documents and its first line.
    """

    def rows(part: pa.RecordBatch, hashed: bool) -> pa.RecordBatch:
        none = pa.nulls(part.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) if hashed else none for c in ("h", "g")), *(part.column(c) for c in _FIELDS[2:]), none], [*_FIELDS, "docs"]
        )

    def without(part: pa.RecordBatch, first: tuple) -> np.ndarray:
        """Which lines are not the run's first one (rows of equal address are one line)."""
        same = np.ones(part.num_rows, bool)
        for c, value in zip(("doc_id", "text_hash", "pos"), first):
            column = part.column(c)
            same &= column.is_null().to_numpy(False) if value is None else column.fill_null(0).to_numpy() == value
            if value is not None and column.null_count:
                same &= ~column.is_null().to_numpy(False)
        return ~same

    def settle(run: _Run, edge: bool) -> Iterator[pa.RecordBatch]:
        """The lines held of a run: dropped, left open at an edge, or kept for good."""
        decided = run.docs >= min_docs
        for part in run.held:
            if decided:
                mask = without(part, run.first) if keep_first else np.ones(part.num_rows, bool)
                yield rows(part.filter(pa.array(mask)), False)
            elif edge:
                yield rows(part, True)
        run.held = []

    def summary(run: _Run) -> Iterator[pa.RecordBatch]:
        row = dict(zip(_FIELDS, (*run.key, *run.first)))
        # Whether a decided run's line is the first of all is known only with the neighbours.
        again = [{**row, "docs": None}] if keep_first and run.docs >= min_docs else []
        yield pa.RecordBatch.from_pylist([{**row, "docs": run.docs}, *again], _SCHEMA)

    def stream(batches):
        run, edge = None, True  # the first run of a partition is at its edge
        for batch in batches:
            if not batch.num_rows:
                continue
            h, g = batch.column("h").to_numpy(), batch.column("g").to_numpy()
            starts = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])))
            ends = np.append(starts[1:], len(h))
            counts = np.add.reduceat(batch.column("opens").to_numpy(False).astype(np.int64), starts)
            # Whole runs inside the batch that are too rare need no look.
            wanted = counts >= min_docs
            wanted[[0, -1]] = True
            for k in np.flatnonzero(wanted):
                lo, hi, key = int(starts[k]), int(ends[k]), (int(h[starts[k]]), int(g[starts[k]]))
                part = batch.slice(lo, hi - lo)
                if run is None or run.key != key:
                    if run is not None:
                        yield from settle(run, edge)
                        if edge:
                            yield from summary(run)
                        edge = False
                    run = _Run(key, tuple(part.column(c)[0].as_py() for c in _FIELDS[2:]))
                run.docs += int(counts[k])
                run.held.append(part)
                if run.docs >= min_docs:
                    yield from settle(run, edge)
        if run is not None:
            yield from settle(run, True)
            yield from summary(run)

    return stream


_SCHEMA = pa.schema([
    ("h", pa.int64()), ("g", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("docs", pa.int64()),
])


def _bitmaps(batches):
    """Packed and compressed keep bits, a bit for each line, first line first."""
    for batch in batches:
        packed, dropped = [], []
        for n, gone in zip(batch.column("n").to_pylist(), batch.column("gone")):
            bits = np.ones(n, np.uint8)
            bits[gone.values.to_numpy()] = 0
            dropped.append(n - int(bits.sum()))
            packed.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), batch.column("n").cast(pa.int64()), pa.array(dropped, pa.int64()), pa.array(packed, pa.binary())],
            ["doc_id", "text_hash", "n_lines", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``doc_id, text_hash, n_lines, n_dropped, keep`` of every document that loses a line.

    A key found in at least ``min_docs`` documents loses all its lines, or with ``keep_first``
    all but the first one in order of ``doc_id`` (none first), hash of the text and position.
    Shorter keys stay. ``keep`` is a compressed bitmap with a bit for each line; documents
    without a row keep all lines. Each document row counts, also a repeated one; rows equal in
    id and text have one bitmap. Null and empty texts have one empty line; no rows give none.
    """
    order = ["h", "g", "doc_id", "text_hash", "pos"]
    # Where a row was read only spreads rows of equal address.
    placed = line_rows(docs, min_chars).withColumn("spread", F.spark_partition_id())
    dealt = placed.repartitionByRange(*order, "spread").sortWithinPartitions(*order).drop("spread")
    kinds = "h long, g long, doc_id long, text_hash long, pos int, n int, docs long"
    streamed = cut(dealt.mapInArrow(_stream(min_docs, keep_first), kinds))
    edges = streamed.filter("docs is not null").groupBy("h", "g").agg(
        F.sum("docs").alias("all"), F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "text_hash", "pos")).alias("first")
    ).filter(F.col("all") >= min_docs)
    open_ = streamed.filter("docs is null and h is not null").join(edges, ["h", "g"])
    if keep_first:
        address = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "text_hash", "pos")
        open_ = open_.filter(~address.eqNullSafe(F.col("first")))
    address = ["doc_id", "text_hash", "pos", "n"]
    gone = streamed.filter("docs is null and h is null").select(*address).unionByName(open_.select(*address))
    sets = gone.groupBy("doc_id", "text_hash").agg(F.max("n").alias("n"), F.collect_set("pos").alias("gone"))
    return sets.mapInArrow(_bitmaps, "doc_id long, text_hash long, n_lines long, n_dropped long, keep binary")


def _kept(batches):
    for batch in batches:
        out, lines, dropped = [], [], []
        for text, keep in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
            text = text or ""
            if keep is None:
                lines.append(text.count("\n") + 1)
                dropped.append(0)
                out.append(text)
                continue
            parts = text.split("\n")
            bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(parts)]
            lines.append(len(parts))
            dropped.append(len(parts) - int(bits.sum()))
            out.append("\n".join(parts[i] for i in np.flatnonzero(bits)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(out, pa.string())],
            ["row_", "n_lines", "n_dropped", "kept"],
        )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every document row, with ``n_lines, n_dropped, kept`` (the text that stays)."""
    marks = bitmaps.select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_"), F.col("keep").alias("keep_"))
    rows = docs.select(F.struct(*columns).alias("row_"), F.col("doc_id").cast("long").alias("key_"), F.xxhash64("text").alias("h_"), "text")
    met = rows.join(marks, F.col("key_").eqNullSafe(F.col("id_")) & (F.col("h_") == F.col("hash_")), "left").select("row_", "text", F.col("keep_").alias("keep"))
    kind = rows.schema["row_"].dataType.simpleString()
    return met.mapInArrow(_kept, f"row_ {kind}, n_lines long, n_dropped long, kept string").select("row_.*", "n_lines", "n_dropped", "kept")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, keep_bitmaps(docs), ["doc_id"])
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS t FROM documents),
l AS (SELECT r, doc_id, unnest(t) AS line, generate_subscripts(t, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
c AS (SELECT key AS common FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(common) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (common IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON key = common GROUP BY r, doc_id
"""

"""Fill-in-middle: documents cut in three and written in the order a model learns to fill.

Texts stay UTF-8 bytes. A sparse index holds only the characters that take more than one
byte, with the bytes they have in excess; between them a place in code points and a place in
bytes differ by a constant, so a cut is converted by one binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import table

# Bytes of text that are indexed in one go; a longer document is a slice of its own.
SLICE = 4 << 20
# Shares in 100: of documents that are cut, and of those that begin with the suffix.
CUT, SUFFIX_FIRST = 90, 20
MARKS = ("<P>", "<S>", "<M>")
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Excess:
    """The characters of more than one byte: their places, and bytes in excess up to each."""

    def __init__(self, data: np.ndarray):
        self.bytes = np.flatnonzero(data >= 0xC0)
        lead = data[self.bytes]
        self.total = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0))])
        self.points = self.bytes - self.total[:-1]

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code points before places in bytes that open a character (or the end)."""
        return at - self.total[np.searchsorted(self.bytes, at, "left")]

    def to_bytes(self, at: np.ndarray) -> np.ndarray:
        """Bytes before places in code points."""
        return at + self.total[np.searchsorted(self.points, at, "left")]


def units(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes at which the units of all texts open: runs of letters, and single other characters.

    ``offsets`` are where texts begin; a run of letters never goes on into the next text.
    """
    letter = _LETTER[data]
    opens = letter & ~np.append(False, letter[:-1])
    edges = offsets[offsets < len(data)]
    opens[edges] = letter[edges]
    return np.flatnonzero(opens | ~letter & ((data & 0xC0) != 0x80))


def numbers(key: str) -> list[int]:
    """The first four groups of eight hexadecimal digits of the key's SHA-256."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of runs of rows."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _transform(data: np.ndarray, offsets: np.ndarray, keys: list[str], share: int, suffix_first: int, marks: list[bytes]) -> pa.RecordBatch:
    excess, opens = Excess(data), units(data, offsets)
    bounds = np.searchsorted(opens, offsets)
    opens = np.append(opens, len(data))
    n = np.diff(bounds)
    drawn = np.array([numbers(k) for k in keys], np.int64).reshape(-1, 4)
    cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    # The cut after the last unit is the end of the text, where the next one opens or none does.
    at = np.where(cuts == n[:, None], offsets[1:, None], opens[np.minimum(bounds[:-1, None] + cuts, len(opens) - 1)])
    points = excess.to_points(np.concatenate([offsets[:-1, None], at], axis=1))
    raw, forms, lengths, out = data.tobytes(), [], [], []
    p, s, m = marks
    for row in range(len(keys)):
        lo, hi, (a, b) = int(offsets[row]), int(offsets[row + 1]), at[row].tolist()
        if lo == hi or drawn[row, 2] % 100 >= share or any(raw.find(mark, lo, hi) >= 0 for mark in marks):
            forms.append("plain")
            lengths.append((None, None))
            out.append(raw[lo:hi])
            continue
        lengths.append((int(points[row, 1] - points[row, 0]), int(points[row, 2] - points[row, 1])))
        if drawn[row, 3] % 100 < suffix_first:
            forms.append("spm")
            out.append(b"".join([s, raw[b:hi], p, raw[lo:a], m, raw[a:b]]))
        else:
            forms.append("psm")
            out.append(b"".join([p, raw[lo:a], s, raw[b:hi], m, raw[a:b]]))
    return pa.RecordBatch.from_pydict({
        "n": pa.array(n, pa.int64()), "form": pa.array(forms, pa.string()),
        "prefix_chars": pa.array([c[0] for c in lengths], pa.int64()), "middle_chars": pa.array([c[1] for c in lengths], pa.int64()),
        "output": pa.array(out, pa.binary()).cast(pa.string()),
    })


def fill_in_middle(
    docs: DataFrame, seed: int = 1, share: int = CUT, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document.

    ``n`` counts units (runs of A-Z and a-z, or one other code point). The cuts, whether a
    document is cut and which part comes first follow from the SHA-256 of ``seed:doc_id``, so
    reruns agree; a missing id draws from ``seed:``, and rows that share an id draw alike. A
    text that is null or empty, or holds a mark, is given as it is (null: empty) with the form
    plain and null lengths. Very long texts are a slice of their own. Repeated rows give equal
    rows, no rows give none, and other columns are ignored.
    """
    raw = [m.encode() for m in marks]

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, data, offsets in _slices(batch.column("text")):
                some = ids[first : first + len(offsets) - 1]
                made = _transform(data, offsets, [f"{seed}:{'' if i is None else i}" for i in some], share, suffix_first, raw)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *made.columns], ["doc_id", *made.schema.names])

    kinds = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, kinds)


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    p, s, m = marks
    after = lambda start, end: F.substring_index(F.substring_index(output, end, 1), start, -1)
    last = F.substring_index(output, m, -1)
    psm = F.concat(after(p, s), last, after(s, m))
    spm = F.concat(after(p, m), last, after(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
  ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
  ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

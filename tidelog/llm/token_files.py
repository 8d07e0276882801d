"""Token ids in binary files: frequency-ranked ids in a byte-aligned variable-length code.

The two tables of a written corpus:

* ``blocks``: one row per run of documents in order, with their ids and lengths, the
  control bytes (two bits per token: how many bytes its rank takes, less one) and the data
  bytes (ranks, little-endian, no padding);
* ``index``: the blocks without their bytes, and the number of tokens before each;
* ``ranks``: which token id has which frequency rank.

Written through Spark, so that lost tasks leave nothing behind and any store will do.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.bpe import byte_letters, gather, slices
from tidelog.llm.common import attach, quantiles, table
from tidelog.scratch import fresh_path

VOCABULARY = "word_bpe_49k.json"
END = 1
# Documents per ordered range; ranges are at most RANGES, so their boundaries stay few.
RANGE_ROWS = 5_000
RANGES = 4_096
# Words that a worker remembers before it sorts out those that it has not met again.
WORDS = 300_000


def _low_pattern() -> re.Pattern:
    """The vocabulary's word pattern for texts below U+0300, its classes spelt out, letters tried first.

    Fixed value: the pattern is 's|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+
    """
    low = [chr(c) for c in range(0x300)]
    letters, digits, blanks = ("".join(re.escape(c) for c in low if regex.match(k, c)) for k in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{digits}]|[^{blanks}{letters}{digits}]+")


LOW = _low_pattern()
# Letters that stand for the bytes of a word; line feeds only part the words of a list.
LETTERS = {b: c for b, c in enumerate(byte_letters()) if b != 10}
# Characters that normalisation may change.
HIGH = re.compile("[\u0300-\U0010ffff]")
_LOADED: dict[str, Words] = {}


class _Numbers(dict):
    """Number of each word; a new one gets the next number and waits to be learned."""

    def __init__(self):
        super().__init__()
        self.new: list[str | tuple[str]] = []

    def __missing__(self, word: str | tuple[str]) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Words:
    """The tokenizers library, asked once for each word.

    The vocabulary drops white space and lower-cases letter by letter. Characters below U+0300
    are unchanged by NFC, so a text of them is cut into words here and the library's model
    gives each word's ids. Pieces between blanks with other characters are asked for whole,
    and so is any text with a special token in it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.words, self.ids, self.offsets = _Numbers(), np.empty(0, np.int32), np.zeros(1, np.int64)
        self.old = {}, self.ids, self.offsets

    def age(self) -> None:
        """Begin anew; of the words of before, those that are met again are taken over."""
        if len(self.words) > WORDS:
            self.old = dict(self.words), self.ids, self.offsets
            self.words, self.ids, self.offsets = _Numbers(), np.empty(0, np.int32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        numbers, old_ids, old_offsets = self.old
        new = self.words.new
        where = np.fromiter((numbers.get(w, -1) for w in new), np.int64, len(new))
        unmet = [new[i] for i in np.flatnonzero(where < 0)]
        plain = [w for w in unmet if isinstance(w, str)]
        shown = iter("\n".join(plain).encode().decode("latin-1").translate(LETTERS).split("\n"))
        tokenize, whole = self.tokenizer.model.tokenize, self.tokenizer.encode
        ids: list[int] = []
        ends = []
        for word in unmet:
            ids += [t.id for t in tokenize(next(shown))] if isinstance(word, str) else whole(word[0], add_special_tokens=False).ids
            ends.append(len(ids))
        # What was known and what is new, end to end, then in the order of the new numbers.
        values = np.concatenate([old_ids, np.array(ids, np.int32)])
        offsets = np.concatenate([old_offsets, old_offsets[-1] + np.array(ends, np.int64)])
        where[where < 0] = len(old_offsets) - 1 + np.arange(len(unmet))
        found, counts = gather(values, offsets, where)
        new.clear()
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, found])

    def _numbers(self, text: str) -> np.ndarray:
        if not HIGH.search(text):
            return np.fromiter(map(self.words.__getitem__, LOW.findall(text.lower())), np.int64)
        found: list[int] = []
        for piece in text.replace("\n", " ").split(" "):
            if HIGH.search(piece):
                found.append(self.words[(piece,)])
            else:
                found += map(self.words.__getitem__, LOW.findall(piece.lower()))
        return np.array(found, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.age()
        whole, numbers = {}, []
        for at, text in enumerate(texts):
            if "<|" in text and any(t in text for t in self.special):
                whole[at] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)
                text = ""
            numbers.append(self._numbers(text))
        if self.words.new:
            self._learn()
        return [whole[at] if at in whole else gather(self.ids, self.offsets, n)[0] for at, n in enumerate(numbers)]


def loaded(path: str) -> Words:
    if path not in _LOADED:
        _LOADED[path] = Words(path)
    return _LOADED[path]


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Byte counts of the four values that a control byte describes.
WIDTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    if not len(values):
        return b"", b""
    width = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = width - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    widest = int(width.max())
    used = np.arange(widest, dtype=np.uint8) < width[:, None]
    return control.tobytes(), values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :widest][used].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` values of :func:`pack`, by looking control bytes up in a table."""
    width = WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    widest = int(width.max(initial=1))
    size = 1 if widest == 1 else 2 if widest == 2 else 4
    raw = np.zeros((count, size), np.uint8)
    raw[np.arange(size, dtype=np.uint8) < width[:, None]] = np.frombuffer(data, np.uint8)
    return raw.reshape(-1).view(f"<u{size}").astype(np.int64)


def tokens(docs: DataFrame, bounds: list[int], path: str, end: int) -> DataFrame:
    """``range, doc_id, n, ids`` of every document, ids as little-endian integers."""

    def run(batches: Iterator[pa.RecordBatch]):
        made = loaded(path)
        kind = "<u2" if max(made.size, end + 1) <= 1 << 16 else "<u4"
        edges = np.array(bounds, np.int64)
        for batch in batches:
            at = 0
            for some in slices([t or "" for t in batch.column("text").to_pylist()]):
                found = [np.append(ids, end) for ids in made.encode(some)]
                key = batch.column("doc_id").slice(at, len(some))
                ranges = np.searchsorted(edges, key.fill_null(-(1 << 63)).to_numpy(), "right")
                at += len(some)
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array(ranges, pa.int32()),
                    "doc_id": key,
                    "n": pa.array([len(ids) for ids in found], pa.int32()),
                    "ids": pa.array([ids.astype(kind).tobytes() for ids in found], pa.binary()),
                })

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "range int, doc_id long, n int, ids binary")


def frequencies(staged: DataFrame) -> DataFrame:
    """How often each id occurs, counted per task before anything is shuffled."""

    def run(batches):
        for batch in batches:
            ids = _flat(batch)
            counts = np.bincount(ids) if len(ids) else np.empty(0, np.int64)
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(counts[seen], pa.int64())})

    return staged.select("n", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    """All ids of a batch, end to end."""
    total = int(batch.column("n").to_numpy().sum())
    raw = b"".join(batch.column("ids").to_pylist())
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * total else "<u4")


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> str:
    """Encode all documents and write them to ``folder`` in ascending order of ``doc_id``.

    Null ids come first, repeated ids stand side by side in the order of their tokens. A
    null or empty text has the end id alone. No documents make empty tables.
    """
    path = path or vocabulary()
    spark = docs.sparkSession
    parts = min(RANGES, 1 + docs.select("doc_id").count() // RANGE_ROWS)
    bounds = quantiles(docs, "doc_id", parts)
    inside = Window.partitionBy("range").orderBy("doc_id", "ids")
    placed = tokens(docs, bounds, path, end).withColumn("seq", F.row_number().over(inside))
    placed.write.parquet(f"{folder}/staged")
    staged = spark.read.schema(placed.schema).parquet(f"{folder}/staged")
    # At most one row per vocabulary entry.
    counted = frequencies(staged).orderBy(F.desc("n"), "id").toArrow()
    by_rank = counted.column("id").to_numpy()
    spark.createDataFrame(
        pa.table({"rank": pa.array(range(len(by_rank)), pa.int64()), "id": pa.array(by_rank, pa.int64())}),
        "rank long, id long",
    ).coalesce(1).write.parquet(f"{folder}/ranks")

    def run(batches):
        rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.int64)
        rank[by_rank] = np.arange(len(by_rank))
        for batch in batches:
            # A batch may hold several ranges; each run of one range becomes a block.
            ranges = batch.column("range").to_numpy()
            cuts = np.flatnonzero(np.diff(ranges)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(ranges)]):
                if lo < hi:
                    part = batch.slice(lo, hi - lo)
                    ids = _flat(part)
                    control, data = pack(rank[ids])
                    yield pa.RecordBatch.from_pylist([{
                        "range": int(ranges[lo]), "seq": part.column("seq")[0].as_py(), "n_docs": hi - lo, "n_tokens": len(ids),
                        "doc_ids": part.column("doc_id").to_pylist(), "lengths": part.column("n").to_pylist(),
                        "control": control, "data": data,
                    }], schema)

    schema = pa.schema([
        ("range", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("control", pa.binary()), ("data", pa.binary()),
    ])
    kinds = "range int, seq int, n_docs int, n_tokens long, doc_ids array<long>, lengths array<int>, control binary, data binary"
    staged.mapInArrow(run, kinds).write.parquet(f"{folder}/blocks")
    narrow = spark.read.schema(kinds).parquet(f"{folder}/blocks").select("range", "seq", "n_docs", "n_tokens")
    # Ranges are few; the running sum over blocks is made range by range.
    sums = narrow.groupBy("range").agg(F.sum("n_tokens").alias("words"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("range").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    index = narrow.join(starts, "range").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    index.select("range", "seq", "n_docs", "n_tokens", "start").write.parquet(f"{folder}/index")
    return folder


def read_tokens(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from written files, and ``ids`` if asked for."""
    by_rank = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toArrow().column("id").to_numpy()
    blocks = spark.read.parquet(f"{folder}/blocks")
    index = spark.read.parquet(f"{folder}/index").select("range", "seq", "start")
    found = attach(blocks, index, ["range", "seq"]).select("start", "n_tokens", "doc_ids", "lengths", "control", "data")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens_ = by_rank[unpack(row["control"], row["data"], row["n_tokens"])] if row["n_tokens"] else by_rank[:0]
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = tokens_.astype("<u4")
                parts = [raw[e - n : e] for n, e in zip(lengths, ends)]
                out = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(row["start"] + ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                }
                if ids:
                    out["ids"] = pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    return found.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(spark, write_tokens(table(spark, sf_dir, "documents"), fresh_path(spark, "tokens")))

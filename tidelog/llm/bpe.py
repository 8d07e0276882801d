"""Byte-level BPE by batched numpy merge rounds.

A batch's texts are cut into words by the tokenizer's pattern. Words not met before are laid
out as symbols in one flat array; in each round every word merges its lowest-ranked pair,
found by binary search of all neighbouring pairs among the sorted pair keys. Words stay
known from batch to batch, up to ``WORDS`` of them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
# Words a worker remembers; beyond it the memory starts anew at the next batch.
WORDS = 400_000
# Fixed value: the byte-level word pattern of this family of vocabularies.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_LOADED: dict[str, Bpe] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable bytes stand for themselves, the others for letters from 256 on, in order.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def gather(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``which`` of a ragged table, end to end, and their lengths."""
    lengths = offsets[which + 1] - offsets[which]
    ends = np.cumsum(lengths)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(offsets[which] - (ends - lengths), lengths)
    return values[at], lengths


class _Words(dict):
    """Number of each word; a new word gets the next number and waits to be encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Bpe:
    """A byte-level BPE vocabulary read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        byte_of = {c: b for b, c in enumerate(letters)}
        texts = [b""] * size
        for token, number in vocab.items():
            texts[number] = bytes(byte_of[c] for c in token)
        for token, number in self.special.items():
            texts[number] = token.encode()
        self.size = size
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.byte_offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.first = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.forget()

    def forget(self) -> None:
        self.words = _Words()
        self.ids = np.empty(0, np.int64)
        self.offsets = np.zeros(1, np.int64)
        for token, number in self.special.items():
            # No pattern gives a special token whole, so the key can't clash with a word.
            self.words[("special", token)] = len(self.words)
            self.ids = np.append(self.ids, number)
            self.offsets = np.append(self.offsets, len(self.ids))

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has. No word is empty."""
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        counts = np.zeros(len(words), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        never = len(self.keys)
        while len(symbols):
            pair = symbols[:-1] * self.size + symbols[1:]
            spot = np.minimum(np.searchsorted(self.keys, pair), never - 1)
            known = (self.keys[spot] == pair) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.ranks[spot], never), never)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            if (finished := best == never).any():
                done.append((word[finished], symbols[finished]))
            hit = (rank == best) & ~finished
            # Of pairs that overlap, as in a run of one symbol, every second is merged.
            opens = hit & ~np.append(False, hit[:-1])
            began = np.maximum.accumulate(np.where(opens, np.arange(len(hit)), 0))
            hit &= (np.arange(len(hit)) - began) % 2 == 0
            symbols = np.where(hit, self.made[np.append(spot, 0)], symbols)
            keep = ~finished & ~np.append(False, hit[:-1])
            symbols, word = symbols[keep], word[keep]
        if not done:
            return np.empty(0, np.int64), counts
        # A finished word leaves whole in one round, so a stable sort keeps its ids in order.
        owner, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.words) > WORDS:
            self.forget()
        numbers = []
        for text in texts:
            if self.split is not None and any(t in text for t in self.special):
                found = []
                for part in self.split.split(text):
                    found += [self.words[("special", part)]] if part in self.special else map(self.words.__getitem__, PATTERN.findall(part))
            else:
                found = map(self.words.__getitem__, PATTERN.findall(text))
            numbers.append(np.fromiter(found, np.int64))
        if self.words.new:
            ids, counts = self.merge([w.encode() for w in self.words.new])
            self.words.new.clear()
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])
            self.ids = np.concatenate([self.ids, ids])
        return [gather(self.ids, self.offsets, n)[0] for n in numbers]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, specials included; bytes that are no UTF-8 become U+FFFD."""
        return gather(self.bytes, self.byte_offsets, ids)[0].tobytes().decode("utf-8", "replace")


def loaded(path: str) -> Bpe:
    """The vocabulary, read once by each worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Characters whose words are looked up together, however long single texts are.
SLICE = 4 << 20


def slices(texts: list[str]) -> Iterator[list[str]]:
    some: list[str] = []
    held = 0
    for text in texts:
        some.append(text)
        held += len(text)
        if held > SLICE:
            yield some
            some, held = [], 0
    if some:
        yield some


def encode_documents(docs: DataFrame, path: str | None = None, texts: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, with ``ids`` and
    ``decoded`` as well if ``texts`` is set.

    Ids are those of the tokenizers library with the same file, special tokens recognised,
    none added; hashes are of the ids as little-endian unsigned 32-bit integers, and of the
    decoded text in UTF-8. Null and empty texts have no ids. Each row is worked on alone:
    repeated rows give repeated results, null ids stay null, other columns are ignored. A
    very long text is one row of a batch, a very long word takes part in more rounds.
    """
    path = path or vocabulary()

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            at = 0
            for some in slices([t or "" for t in batch.column("text").to_pylist()]):
                found = bpe.encode(some)
                back = [bpe.decode(ids) for ids in found]
                out = {
                    "doc_id": batch.column("doc_id").slice(at, len(some)),
                    "n_tokens": pa.array([len(ids) for ids in found], pa.int64()),
                    "ids_sha256": [hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in found],
                    "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in back],
                }
                if texts:
                    out |= {"ids": [ids.astype(np.int32) for ids in found], "decoded": back}
                at += len(some)
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * texts
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))

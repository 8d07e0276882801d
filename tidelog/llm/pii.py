"""Personal data in text: fixed patterns, and a character-level LSTM-CRF for other spellings.

The patterns give the base spans. The model, trained here from labelled spans, adds spans
that the patterns miss, such as phone numbers without a plus or cards grouped by dots; a
span is only added if its digits make such a thing at all. Texts are decoded in overlapping
windows; a position's tag is taken from the window in which it stands most centrally, and
spans are built over the whole text. Every such span holds a digit or an at sign, so windows
with neither need no decoding: they cannot give one.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import table
from tidelog.llm.crf import Tagger, char_ids

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the base patterns: same matches, no backtracking over long runs.
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")
WINDOW, STRIDE = 64, 32
# Training: documents looked at, windows kept of each, made-up windows, and steps.
SAMPLE_DOCS, PER_DOC, MADE, STEPS = 1_500, 3, 1_500, 260
_TRAINED: dict[str, Tagger] = {}

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def plausible(kind: str, text: str) -> bool:
    """Whether the digits of a match allow its kind."""
    if kind == "email":
        return text.count("@") == 1 and not text.startswith("@") and not text.endswith("@")
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(_small, parts))
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for match in AT_DOMAIN.finditer(text):
        start = match.start()
        while start > last and LOCAL.match(text, start - 1):
            start -= 1
        if start < match.start():
            last = match.end()
            yield start, last


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start, then kind."""
    if not HINT.search(text):
        return []
    found = [("email", *at) for at in _emails(text)]
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        found += [(kind, *m.span()) for m in pattern.finditer(text) if plausible(kind, m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _tags(length: int, spans: list[Span], start: int) -> list[int]:
    """0 for outside, 1 + 2k and 2 + 2k for the first and further characters of kind k."""
    tags = [0] * length
    for kind, lo, hi in sorted(spans, key=lambda s: -KINDS.index(s[0])):
        for i in range(max(lo, start), min(hi, start + length)):
            tags[i - start] = 1 + 2 * KINDS.index(kind) + (i > lo)
    return tags


def _padded(ids: np.ndarray) -> np.ndarray:
    return np.concatenate([ids, np.zeros(WINDOW - len(ids), np.int64)]) if len(ids) < WINDOW else ids


def _starts(length: int) -> list[int]:
    return list(range(0, max(1, length - WINDOW + STRIDE), STRIDE))


def labelled(docs: DataFrame, sample: int = SAMPLE_DOCS) -> list[tuple[str, list[int]]]:
    """Windows with tags from the base spans of ``sample`` distinct texts, or of all if fewer.

    The texts of the smallest hashes are taken, ``PER_DOC`` windows of each and each text
    once; so what comes to the driver is bounded by ``sample``, whatever the copies.
    """
    texts = docs.select("text", F.xxhash64("text").alias("hash_")).filter("text is not null")
    least = texts.select("hash_").distinct().orderBy("hash_").limit(sample)
    chosen = texts.join(F.broadcast(least), "hash_", "left_semi").select("text").distinct()

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                places = [m.start() for m in HINT.finditer(text)][:: max(1, len(text) // 1000)][:PER_DOC] or [0]
                for place in places:
                    start = max(0, place - STRIDE)
                    cut_ = text[start : start + WINDOW]
                    if cut_:
                        out.append((cut_, _tags(len(cut_), spans, start)))
            yield pa.RecordBatch.from_pydict({"text": pa.array([o[0] for o in out], pa.string()), "tags": pa.array([o[1] for o in out], pa.list_(pa.int32()))})

    rows = chosen.mapInArrow(run, "text string, tags array<int>").toArrow()
    return sorted(zip(rows.column("text").to_pylist(), rows.column("tags").to_pylist()))


def _made(rng: random.Random) -> tuple[str | None, str]:
    """One made-up item and its kind, or a number that is no personal data."""
    def d(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def w(lo: int, hi: int) -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(lo, hi)))

    kind = rng.choice([*KINDS, "phone", "card", None])
    if kind == "email":
        return kind, rng.choice([f"{w(2, 8)}.{d(2)}@{w(3, 7)}{d(1)}.{w(3, 7)}.com", f"{w(2, 9)}@{w(3, 9)}.{w(2, 3)}", f"{w(2, 9)}_{w(2, 6)}@{w(4, 9)}"])
    if kind == "ip":
        return kind, ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        g = rng.choice(["", " ", "-", ".", "  "])
        body = d(15)
        number = body + next(c for c in "0123456789" if luhn(body + c))
        return kind, g.join(number[i : i + 4] for i in range(0, 16, 4))
    if kind == "phone":
        a, b, c = d(3), d(3), d(4)
        return kind, rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{d(2)} {d(3)} {d(6)}", f"({a}){b}-{c}", f"{a}/{b}-{c}"])
    return None, rng.choice([d(rng.randint(1, 8)), f"{d(1)}.{d(1)}", f"20{d(2)}-{d(2)}-{d(2)}", f"{d(1)},{d(3)}.{d(2)}", "".join(rng.choice("0123456789abcdef") for _ in range(32)), f"AKIA{w(4, 8).upper()}{d(3)}", f"@{w(3, 8)}", f"{d(2)}:{d(2)}"])


def made(contexts: list[str], count: int = MADE, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Windows in which made-up items are set into running text."""
    rng, out = random.Random(seed), []
    words = [w for c in contexts for w in c.split() if not HINT.search(w)] or ["the", "of", "and", "call", "mail", "at"]
    for _ in range(count):
        kind, item = _made(rng)
        left = " ".join(rng.choice(words) for _ in range(rng.randint(0, 6))) + " "
        right = rng.choice([" ", ". ", ", "]) + " ".join(rng.choice(words) for _ in range(6))
        left = left[-(WINDOW - min(len(item) + 4, WINDOW - 4)) :]
        text = (left + item + right)[:WINDOW]
        spans = [(kind, len(left), len(left) + len(item))] if kind else []
        out.append((text, _tags(len(text), spans, 0)))
    return out


def train(docs: DataFrame, sample: int = SAMPLE_DOCS, steps: int = STEPS) -> Tagger:
    """Fit on the labelled windows of a bounded sample, and on made-up ones."""
    seen = labelled(docs, sample)
    return fit(seen + made([t for t, _ in seen]), steps)


def fit(windows: list[tuple[str, list[int]]], steps: int = STEPS) -> Tagger:
    key = hashlib.sha256(repr((windows, steps)).encode()).hexdigest()
    if key not in _TRAINED:
        ids = np.stack([_padded(char_ids(t)) for t, _ in windows])
        gold = np.array([g + [0] * (WINDOW - len(g)) for _, g in windows])
        model = Tagger(1 + 2 * len(KINDS))
        model.fit(ids, gold, steps)
        _TRAINED.clear()
        _TRAINED[key] = model
    return _TRAINED[key]


def model_spans(texts: list[str], model: Tagger, batch: int = 2_048) -> list[list[Span]]:
    """Spans that the model finds in each whole text."""
    places, windows = [], []
    for row, text in enumerate(texts):
        hints = sorted({s for m in HINT.finditer(text) for s in ((m.start() // STRIDE) * STRIDE, (m.start() // STRIDE - 1) * STRIDE)})
        allowed = len(_starts(len(text))) * STRIDE
        for start in hints:
            if 0 <= start < allowed:
                places.append((row, start))
                windows.append(_padded(char_ids(text[start : start + WINDOW])))
    out: list[list[Span]] = [[] for _ in texts]
    tags: dict[int, dict[int, tuple[int, int]]] = {}
    for at in range(0, len(windows), batch):
        for (row, start), found in zip(places[at : at + batch], model.decode(np.stack(windows[at : at + batch]))):
            length = len(texts[row])
            held = tags.setdefault(row, {})
            for i in range(min(WINDOW, length - start)):
                # How far from a cut edge; the text's own ends are no cuts.
                depth = min(i if start else WINDOW, WINDOW - i if start + WINDOW < length else WINDOW)
                if (old := held.get(start + i)) is None or depth > old[0]:
                    held[start + i] = depth, int(found[i])
    for row, held in tags.items():
        out[row] = _build(texts[row], held)
    return out


def _build(text: str, held: dict[int, tuple[int, int]]) -> list[Span]:
    spans: list[Span] = []
    kind, lo, last = None, 0, -2

    def close():
        if kind is not None:
            a, b = lo, last + 1
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            if HINT.search(text, a, b) and plausible(KINDS[kind], text[a:b]):
                spans.append((KINDS[kind], a, b))

    for at in sorted(held):
        tag = held[at][1]
        now = (tag - 1) // 2 if tag else None
        if now is None or now != kind or at != last + 1 or tag % 2:
            close()
            kind, lo = now, at
        last = at
    close()
    return spans


def find(texts: list[str], model: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text; the model's never touch a base span."""
    out = []
    for text, extra in zip(texts, model_spans(texts, model)):
        base = base_spans(text)
        added = [s for s in extra if not any(s[1] < b[2] and b[1] < s[2] for b in base)]
        out.append((base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind."""
    parts, at = [], 0
    for kind, lo, hi in spans:
        if lo >= at:
            parts += [text[at:lo], f"<{kind.upper()}>"]
        at = max(at, hi)
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame, model: Tagger, keep: list[str] | None = None) -> DataFrame:
    """Counts of base spans, their digest, all spans and the masked text, next to ``keep``.

    ``n_email, n_ip, n_card, n_phone, base_sha256, spans, masked``; offsets are code points,
    ends exclusive. A null text is read as empty (its masked text stays null); rows are
    worked on alone, so repeated rows repeat and ties can't arise; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand weights
    packed = docs.select(F.struct(*(keep or ["doc_id"])).alias("kept"), F.col("text").alias("text_"))

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column("text_").to_pylist()
            found = find([t or "" for t in texts], model)
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found], pa.string()),
                 pa.array([written(a) for _, a in found], pa.string()),
                 pa.array([None if t is None else masked(t, a) for t, (_, a) in zip(texts, found)], pa.string())],
                ["kept", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "masked"],
            )

    kind = packed.schema["kept"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = packed.mapInArrow(run, f"kept {kind}, {counts}, base_sha256 string, spans string, masked string")
    return found.select("kept.*", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "masked")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs)).select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans")

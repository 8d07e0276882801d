import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import documents, empty, long_text, rows
from tidelog.llm import balltree, bpe, imatch, jaccard, language, licenses, mixing, pii, token_files, urlfilter
from tidelog.scratch import fresh_path


def collect(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# PII

def plain_spans(text):
    found = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        found += [(kind, *m.span()) for m in re.finditer(pattern, text) if kind == "email" or pii.plausible(kind, m[0])]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1b29.@+- ()é%", max_size=60))
def test_possessive_patterns_find_the_same(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.fixture(scope="module")
def tagger():
    return pii.fit(pii.made(["call the office or write a mail to them about this"]), 200)


def test_model_adds_spans_and_leaves_clean_text(tagger):
    held = pii.made(["we met at noon and then went home by train"], 300, seed=99)
    found = [pii.find([t], tagger)[0][1] for t, _ in held]
    right = [bool(f) for (t, g), f in zip(held, found) if any(g)]
    assert sum(right) > 0.7 * len(right)
    assert sum(bool(f) for (t, g), f in zip(held, found) if not any(g)) <= 3
    assert pii.find(["nothing personal in here, not in 2024-01-31"], tagger) == [([], [])]


def test_windows_agree_with_one_text(tagger):
    text = long_text(3_000) + " reach (988) 555-2485 now " + long_text(10)
    assert "phone" in pii.written(pii.find([text], tagger)[0][1])


def test_pii_cases(spark, tagger):
    got = {r["doc_id"]: r for r in pii.scan(documents(spark), tagger, ["doc_id"]).collect()}
    assert got[11]["n_email"] == 1 and got[11]["n_phone"] == 1
    assert got[11]["masked"] == "mail <EMAIL> or <PHONE>"
    assert got[5]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[5]["masked"] is None
    assert pii.scan(empty(spark), tagger).count() == 0
    assert pii.train(empty(spark), steps=2).tags == 9


# Token files and BPE

def test_sample_holds_each_text_once(spark):
    frame = spark.range(4_000).selectExpr("id doc_id", "if(id < 2000, 'a copy of one text', concat('mail x', id, '@host.com')) text")
    for sample in (1, 50, 10_000):
        seen = [t for t, _ in pii.labelled(frame, sample)]
        assert len(set(seen)) == min(sample, 2_001) and max(Counter(seen).values()) <= pii.PER_DOC


def test_stream_code_round_trip():
    values = np.array([0, 255, 256, 65_535, 65_536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1] * 3 + [7])
    assert (token_files.unpack(*token_files.pack(values), len(values)) == values).all()


def test_token_files(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_files.vocabulary())
    folder = token_files.write_tokens(documents(spark), fresh_path(spark, "tokens"))
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_tokens(spark, folder).collect()))
    start, want = 0, []
    for i, text, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(map(repr, (g[1:] for g in got))) == sorted(map(repr, want))
    for at, i, n, _ in got:
        assert at == start
        start += n
    assert [g[1] for g in got][2:] == sorted(g[1] for g in got[2:])
    none = token_files.write_tokens(empty(spark), fresh_path(spark, "tokens"))
    assert token_files.read_tokens(spark, none).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_the_library(text):
    from tokenizers import Tokenizer

    for module in (bpe, token_files):
        library = Tokenizer.from_file(module.vocabulary())
        own = module.loaded(module.vocabulary()).encode([text])[0].tolist()
        assert own == library.encode(text, add_special_tokens=False).ids


def test_bpe_cases(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary())
    want = []
    for i, text, *_ in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert collect(bpe.encode_documents(documents(spark))) == sorted(want, key=repr)
    assert bpe.encode_documents(empty(spark)).count() == 0
    assert bpe.loaded(bpe.vocabulary()).encode(["a" * 2_000])[0].tolist() == library.encode("a" * 2_000).ids


# Top-k

@pytest.mark.parametrize("shard_rows", [10_000, 16])
def test_top_k(spark, shard_rows):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 8]) for i in range(150)]
    data += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [1.0] * 6), (204, [1.0, 2.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    own = balltree.integers(frame)
    got = collect(balltree.top_k(own, own.filter("vec_id % 50 = 0"), shard_rows=shard_rows))
    ints = {i: np.floor(256 * np.array(v)).astype(int) for i, v in data[:150]}
    want = []
    for q in (0, 50, 100):
        best = sorted((-int(ints[q] @ ints[c]), c) for c in ints if c != q)[:5]
        want += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(best)]
    assert got == sorted(want, key=repr)
    assert balltree.top_k(own.limit(0), own.limit(0)).count() == 0


# URL filter

def test_intervals_decide_by_time(spark):
    entries = spark.createDataFrame(
        [("host:a.example.com", "add", "2024-01-10"), ("host:a.example.com", "remove", "2024-02-01"), ("domain:example.org", "add", "2024-01-01"),
         ("domain:example.org", "remove", "2024-01-01"), ("prefix:b.example.net/x", "add", "2024-01-05"), (None, "add", "2024-01-01"), ("host:z", None, "2024-01-01")],
        "key string, action string, listed string",
    )
    data = [
        (1, "http://a.example.com/q", "2024-01-09"), (2, "http://A.example.com:80/q", "2024-01-10"), (3, "http://a.example.com", "2024-02-01"),
        (4, "https://u@b.example.net/x/y", "2024-03-01"), (5, "https://b.example.net/y", "2024-03-01"), (6, "http://w.example.org/", "2024-02-01"),
        (7, None, "2024-01-10"), (8, "no url", "2024-01-10"), (9, "http://a.example.com/q", None), (2, "http://A.example.com:80/q", "2024-01-10"), (None, "", None),
    ]
    captures = spark.createDataFrame([(*d, "x", "y") for d in data], "page_id long, url string, fetched string, key string, rule string")
    got = Counter((r["page_id"], r["blocked"], r["rule"]) for r in urlfilter.judge(captures, entries).collect())
    assert got[2, True, "host:a.example.com"] == 2 and got[4, True, "prefix:b.example.net/x"] == 1
    assert sum(n for (_, blocked, _), n in got.items() if blocked) == 3 and got.total() == len(data)
    assert urlfilter.judge(captures.limit(0), entries.limit(0)).count() == 0


# Jaccard join

def brute(data, words, percent):
    sets = []
    for i, text in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[j : j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()})
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = defaultdict(list)
    for (i, _), r in zip(data, root):
        least[r] += [i] if i is not None else []
    return sorted(((i, len(s), min(least[r], default=None)) for (i, _), s, r in zip(data, sets, root)), key=repr)


def near_copies():
    import random

    rng, out = random.Random(3), []
    for _ in range(60):
        n = rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 150])
        base = [rng.choice("abcdefghijkl") + str(rng.randrange(4 if n < 12 else 40)) for _ in range(n)]
        for _ in range(rng.randrange(1, 7)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + max(1, n // 25))):
                w[rng.randrange(n)] = "x" + str(rng.randrange(5))
            out.append((len(out), " ".join(w)))
    return out


@pytest.mark.parametrize("block", [4_000, 3])
def test_join_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    data = near_copies()
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert collect(jaccard.jaccard_components(frame, 4, 85)) == brute(data, 4, 85)


@pytest.mark.parametrize("block", [4_000, 3])
def test_every_link_is_counted_and_given(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    data = near_copies() + [(1_000, "one two three four five"), (1_001, "ONE two three four five"), (1_002, None)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    found = [{tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set() for w in ((t or "").lower().split() for _, t in data)]
    linked = [(a, b) for b in range(len(data)) for a in range(b) if found[a] and 100 * len(found[a] & found[b]) >= 85 * len(found[a] | found[b])]
    want = Counter(data[k][0] for pair in linked for k in pair)
    assert {r["doc_id"]: r["n_links"] for r in jaccard.jaccard_links(frame, 4, 85).collect()} == {i: want[i] for i, _ in data}
    least = lambda k: next(i for (i, _), s in zip(data, found) if s == found[k])
    pairs = {tuple(sorted((least(a), least(b)))) for a, b in linked if found[a] != found[b]}
    assert collect(jaccard.jaccard_pairs(frame, 4, 85)) == sorted(pairs, key=repr)


def test_join_cases(spark):
    data = [r[:2] for r in rows()]
    assert collect(jaccard.jaccard_components(documents(spark), 4, 85)) == brute(data, 4, 85)
    assert jaccard.jaccard_components(empty(spark)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 900), st.integers(0, 120), st.integers(0, 10_000), st.sampled_from([80, 85]))
def test_linked_sets_share_a_signature(size, change, seed, percent):
    rng = np.random.default_rng(seed)
    one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    two = np.unique(np.concatenate([one[min(change, len(one) - 1) :], rng.integers(0, 1 << 63, change // 2).astype(np.uint64)]))
    both, levels = len(np.intersect1d(one, two)), jaccard.Levels(percent)
    if 100 * both >= percent * (len(one) + len(two) - both):
        (a, tags), (b, more) = levels.signatures(one), levels.signatures(two)
        together = [(t, (np.isin(h[tags_ == t], o)).sum()) for h, tags_, o in ((a, tags, b), (b, more, a)) for t in np.unique(tags_)]
        meet = {int(t) // jaccard.MOST for t in tags} & {int(t) // jaccard.MOST for t in more}
        assert any(all(n >= t % jaccard.MOST for t, n in together if t // jaccard.MOST == level) for level in meet)


# Language

def test_language(spark):
    words = {"xx": ["kata", "lobu", "mine"], "yy": ["grosch", "pfluck", "schtan"]}
    data = [(i, " ".join(words[k][(i + j) % 3] for j in range(12)), k, "s") for i in range(60) for k in [("xx", "yy")[i % 2]]]
    docs = documents(spark, data + [(100, "pfluckig", None, "s"), (101, None, "xx", None), (102, "12 !", "yy", None), (None, "kata", "xx", None)])
    model = language.train(docs)
    marked = docs.withColumn("held_out", language.held_out())
    got = {r["doc_id"]: r for r in language.identify(marked, model, ["doc_id", "held_out"]).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k, _ in data)
    assert got[100]["lang_pred"] == "yy"
    assert got[101]["lang_pred"] == got[102]["lang_pred"] == "und" and got[101]["score"] == 0
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(60)) and not got[None]["held_out"]
    nothing = language.train(empty(spark))
    assert {r["lang_pred"] for r in language.identify(documents(spark), nothing).collect()} == {"und"}


# Mixing

def test_mixing_cases(spark):
    docs = documents(spark)
    got = mixing.mix(docs, block_rows=2).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, size(t)) for i, t, *_ in rows())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert all(r["target"] <= 2 * r["source_size"] for r in got)
    total = sum(r["size"] for r in got)
    assert sum({r["source"]: r["target"] for r in got}.values()) == pytest.approx(1.5 * total)
    assert sum(r["taken"] for r in got) <= 1.5 * total
    assert collect(mixing.mix(docs)) == collect(mixing.mix(docs, block_rows=2))
    assert mixing.mix(empty(spark)).count() == 0


def test_mixing_comes_near_its_targets(spark):
    data = [(i, "w " * (1 + i * 7 % 40), "en", "abcdef"[min(i % 9, 5)]) for i in range(3_000)]
    got = mixing.mix(documents(spark, data), block_rows=100).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 100 for s in target)


# Licences

def test_licences(spark):
    notice = "copyright 2020 Someone\n" + licenses.MIT.upper().replace(",", " ;").replace("SUBLICENSE", "SUB-LICENSE")
    docs = documents(spark, rows() + [(20, notice, "en", "a"), (21, "prose\n\nLicenced under  CC BY NC 4.0\nmore", "en", "a"), (22, "the license of the house", "en", "a")])
    docs = docs.withColumn("text", docs["text"])
    got = {r["doc_id"]: r for r in licenses.scan(docs, licenses.digests(spark)).collect()}
    assert got[20]["whole"] and got[20]["licenses"] == "MIT"
    assert got[13]["licenses"] == "MIT" and not got[13]["whole"]
    assert got[22]["n_hits"] == got[5]["n_hits"] == got[None]["n_hits"] == 0
    assert licenses.scan(docs, licenses.digests(spark)).count() == docs.count()
    assert licenses.scan(empty(spark), licenses.digests(spark)).count() == 0
    hints = re.compile(licenses.HINTS)
    assert all(hints.search(text.lower()) for _, text in licenses.KNOWN)


def test_whole_licences(spark):
    import textwrap

    wrap = lambda text, width=70: "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))
    isc = licenses.ISC.replace("that the above copyright", "that the above\ncopyright")
    held = dict(licenses.whole_texts())
    names = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "MPL-2.0"]
    bare = lambda text: "\n".join(line.strip() for line in text.split("\n"))
    data = [(i, wrap(held[name], 60) if i < 2 else bare(held[name]), "en", "a") for i, name in enumerate(names)]
    data += [(10, isc, "en", "a"), (11, "# Tool\n\nWhat it does.\n\nCopyright (c) 2020 Some One\n\n" + wrap(licenses.MIT) + "\n\nThe end.", "en", "a")]
    data += [(12, "# Tool\n\n" + wrap(held["BSD-2-Clause"]) + "\n\nend", "en", "a"), (13, licenses.MIT.split("\n\n")[2] + " permission", "en", "a")]
    data += [(14, "Copyright The Tool Authors\n\n" + licenses.ISC, "en", "a")]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, data), licenses.digests(spark)).collect()}
    assert [got[i]["licenses"] for i in range(6)] == names and all(got[i]["whole"] for i in range(6))
    assert got[10]["licenses"] == got[14]["licenses"] == "ISC" and got[10]["whole"] and got[14]["whole"]
    assert got[11]["licenses"] == "MIT" and not got[11]["whole"] and got[12]["licenses"] == "BSD-2-Clause" and got[13]["n_hits"] == 0


# Fingerprints

def test_fingerprints(spark):
    docs = documents(spark)
    got = collect(imatch.fingerprints(docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next"))
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = Counter()
    for i, (row, text) in enumerate(zip(order, texts)):
        following, moved = texts[(i + 1) % len(texts)], len(text) // 4
        edited = text[: len(text) - moved] + following[:moved]
        want[row[0], len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter(g[:3] for g in got) == want
    prints = {}
    for (i, text, *_) in rows():
        mine = {g[3] for g in got if g[0] == i and g[1] == len(text or "")}
        assert len(mine) == 1 and prints.setdefault(text or "", mine) == mine
    assert all(0 <= x <= 1 for g in got for x in g[4:])
    assert imatch.fingerprints(empty(spark)).count() == 0


def test_next_rows_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(imatch, "BLOCK_ROWS", 7)
    data = [(i * 3, f"t{i}") for i in range(100)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in imatch.with_next(frame, ["text"]).collect()}
    assert got == {i: data[(k + 1) % 100][1] for k, (i, _) in enumerate(data)}


def test_subsets_cover_the_lexicon(spark):
    in_some = F.exists(F.array(*[imatch._hash(F.array(F.xxhash64("id")), i) for i in range(imatch.SUBSETS)]), lambda h: h.isNotNull())
    assert spark.range(4_000).filter(in_some).count() > 0.75 * 4_000


def test_some_hash_of_a_very_long_text_survives(spark):
    def prints(first):
        used = F.sort_array(F.transform(F.sequence(first, first + 9_999), lambda t: F.xxhash64(t)))
        return imatch._hashes(used)

    got = spark.range(40).select(imatch.likeness(prints(F.col("id") * 100_000), prints(F.col("id") * 100_000 + 2_500)).alias("near"))
    assert sum(r["near"] > 0 for r in got.collect()) > 20

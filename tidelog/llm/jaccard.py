"""Exact n-gram Jaccard join by T-occurrence search.

Two sets of sizes a and b reach the threshold only if they differ in at most
``(a + b) * (100 - percent) / (100 + percent)`` elements. The work is dealt out by that
fact: the hash range is cut into more parts than there can be differences, so that linked
sets agree on the whole content of some part. Sets that agree on as many parts as a link
takes are put in the same cell, and the inverted lists of a cell answer all its queries with DivideSkip: the short
lists are merged, the long ones probed by binary search. No link is lost, and only sets
that may have a link are ever moved.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import table
from tidelog.llm.components import components
from tidelog.llm.shingles import mix, shingle_sets
from tidelog.scratch import cut

# Distinct sets, and shingles, of one block of a cell; a larger cell is searched block
# against block.
BLOCK_SETS = 4_000
BLOCK_SHINGLES = 1_500_000
# Weight of a long list against a short one in DivideSkip.
MU = 0.01
# Postings up to which lists are merged on a heap; longer ones are merged by one sort, or
# counted if there are more postings than sets.
HEAP = 512
NO_ID = -(1 << 63)
# Levels are kept with the number of hashes to share, which is below this.
MOST = 1 << 20
# Rounds in which sets that share too few hashes leave.
ROUNDS = 2


def _node(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    raw = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


class Levels:
    """Size classes ``low..high``; linked sets are in one class or in neighbouring ones."""

    def __init__(self, percent: int):
        self.percent, self.low, self.parts, self.need = percent, [1], [], []
        self._extend(1)

    def high(self, size: int) -> int:
        """Largest size that can be linked with ``size``."""
        return size * 100 // self.percent

    def _extend(self, size: int) -> None:
        while self.low[-1] <= size:
            high = self.high(self.low[-1])
            most = 2 * high * (100 - self.percent) // (100 + self.percent)
            need, spare = self._spare(self.low[-1], most)
            self.parts.append(most + 1 + spare)
            self.need.append(need)
            self.low.append(high + 1)

    @staticmethod
    def _spare(size: int, most: int) -> tuple[int, int]:
        """How much a part must hold, and how many parts may be left out as holding less.

        Two shingles are asked for where a set of this size rarely has more parts with less
        than can be added, else one: a single shingle may be a common phrase.
        """
        for need in (2, 1):
            spare = 1
            for _ in range(20):
                mean = size / (most + 1 + spare)
                weak = (most + 1 + spare) * math.exp(-mean) * (1 + mean * (need - 1))
                spare = math.ceil(weak + 4 * math.sqrt(weak))
                if spare > most / 3:
                    break
            else:
                return need, spare
        return 1, 1 + most.bit_length() // 2 if most else 0

    def of(self, size: int) -> list[int]:
        """The classes in which a set of this size may meet a partner."""
        self._extend(self.high(size))
        own = int(np.searchsorted(self.low, size, "right")) - 1
        return [own, own + 1] if self.high(size) >= self.low[own + 1] else [own]

    def signatures(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One hash for the content of each part that is not weak, that is, holds enough.

        Linked sets differ in at most as many parts as elements, which their sizes bound, so
        they agree on all others, and on at least that many that are not weak less the weak
        ones. Where that leaves none, the weak parts are given as well. With each hash goes its
        level and how many hashes of that level a set must share with a partner.
        """
        mixed = mix(shingles)
        upper = shingles >> np.uint64(32)
        out, tags = [], []
        for level in self.of(len(shingles)):
            parts = self.parts[level]
            part = (upper * np.uint64(parts)) >> np.uint64(32)
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            strong = np.diff(np.append(starts, len(part))) >= self.need[level]
            seed = np.uint64(level << 32)
            found = mix(np.add.reduceat(mixed, starts) ^ mix(part[starts] + seed))
            size = len(shingles)
            partner = min(self.high(size), self.high(self.low[level]))
            differ = (size + partner) * (100 - self.percent) // (100 + self.percent)
            least = int(strong.sum()) - differ
            if least < 1:
                found = np.append(found, mix(np.setdiff1d(np.arange(parts, dtype=np.uint64), part[starts]) + seed))
                least = 1
            else:
                found = found[strong]
            out.append(found)
            tags.append(np.full(len(found), level * MOST + min(least, MOST - 1), np.int32))
        return np.concatenate(out), np.concatenate(tags)


def sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, h, n, d1, d2``: hash of the text, size and 128-bit name of the set of every row."""

    def run(batches):
        for batch in batches:
            n, names = [], []
            for found in shingle_sets(batch.column("text"), words):
                n.append(len(found))
                names.append(_node(found))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "h": batch.column("h"), "n": pa.array(n, pa.int64()),
                "d1": pa.array([a for a, _ in names], pa.int64()), "d2": pa.array([b for _, b in names], pa.int64()),
            })

    return docs.selectExpr("cast(doc_id as long) doc_id", "xxhash64(text) h", "text").mapInArrow(run, "doc_id long, h long, n long, d1 long, d2 long")


def meetings(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``sig, node, tag``: the hashes that sets share; equal sets count once a task.

    A set that shares fewer hashes with others than a link takes has no link, and leaves.
    """

    def run(batches):
        levels, seen = Levels(percent), set()
        for batch in batches:
            held, count = [], 0
            for found in shingle_sets(batch.column("text"), words):
                if not len(found) or (name := _node(found)[0]) in seen:
                    continue
                seen.add(name)
                hashes, tags = levels.signatures(found)
                held.append((hashes.view(np.int64), np.full(len(hashes), name, np.int64), tags))
                count += len(hashes)
                if count > 200_000:
                    yield _marks(held)
                    held, count = [], 0
            if held:
                yield _marks(held)

    marks = docs.select("text").mapInArrow(run, "sig long, node long, tag int")
    shared = cut(_shared(marks).distinct())
    for _ in range(ROUNDS):
        enough = shared.groupBy("node", "tag").count().filter(F.col("count") >= F.col("tag") % MOST).select("node", "tag")
        shared = cut(_shared(shared.join(enough, ["node", "tag"])))
    return shared


def cells(shared: DataFrame) -> DataFrame:
    """``node, cell``: linked sets are in one cell.

    Sets that have a hash in common are put together first. That chains sets which have a
    common phrase here and another one there, so the hashes of each such group are then
    searched for pairs that share as many of one level as both sets need for a link, and only
    those stay together. Hashes are a small part of the shingles.
    """
    least = shared.groupBy("sig").agg(F.min("node").alias("u"))
    edges = shared.join(least, "sig").filter("u <> node").select("u", F.col("node").alias("v")).distinct()
    loose = cut(components(edges).select("node", F.col("root").alias("cell")))
    items = shared.join(loose, "node").groupBy("cell", "node", "tag").agg(F.collect_list("sig").alias("sigs"))
    placed = _blocks(cut(items.withColumn("n", F.size("sigs"))))
    dealt = _paired(placed.select("cell", "node", "tag", "sigs", "blocks", "block"))
    close = dealt.mapInArrow(_meet, "u long, v long")
    return components(close.distinct()).select("node", F.col("root").alias("cell"))


def _shared(marks: DataFrame) -> DataFrame:
    """The hashes that more than one set has."""
    same = Window.partitionBy("sig")
    both = marks.select("*", F.min("node").over(same).alias("lo"), F.max("node").over(same).alias("hi"))
    return both.filter("lo <> hi").select("sig", "node", "tag")


def _marks(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["sig", "node", "tag"])


def _merge(lists: list[np.ndarray], sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of sorted lists in order, and in how many lists each is."""
    total = sum(map(len, lists))
    if total > max(HEAP, sets):
        counts = np.bincount(np.concatenate(lists), minlength=sets)
        ids = np.flatnonzero(counts)
        return ids, counts[ids]
    if total > HEAP:
        return np.unique(np.concatenate(lists), return_counts=True)
    runs = [(k, sum(1 for _ in same)) for k, same in groupby(heapq.merge(*(x.tolist() for x in lists)))]
    return np.array([k for k, _ in runs], np.int64), np.array([n for _, n in runs], np.int64)


class Lists:
    """Inverted lists of the sets from position ``first`` on."""

    def __init__(self, found: list[np.ndarray], first: int = 0):
        owner = np.repeat(np.arange(first, len(found)), [len(x) for x in found[first:]])
        tokens = np.concatenate(found[first:]) if len(found) > first else np.empty(0, np.uint64)
        order = np.argsort(tokens, kind="stable")
        self.sets, self.owner = len(found), owner[order]
        self.names, starts = np.unique(tokens[order], return_index=True)
        self.starts = np.append(starts, len(tokens))

    def sharing(self, tokens: np.ndarray, least: int, fits: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The sets that share at least ``least`` (one or more) of the tokens and fit, and how many."""
        names, starts, owner = self.names, self.starts, self.owner
        spot = np.minimum(np.searchsorted(names, tokens), max(len(names) - 1, 0))
        known = spot[names[spot] == tokens] if len(names) else spot[:0]
        if len(known) < least:
            return _NONE, _NONE
        lengths = starts[known + 1] - starts[known]
        by_length = known[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        skipped = min(least - 1, int(least / (MU * np.log2(longest + 1) + 1)), len(known) - 1)
        short, long = by_length[: len(known) - skipped], by_length[len(known) - skipped :]
        ids, counts = _merge([owner[starts[k] : starts[k + 1]] for k in short], self.sets)
        near = (counts >= least - skipped) & fits(ids)
        ids, counts = ids[near], counts[near]
        if not len(ids):
            return ids, counts
        members = [owner[starts[k] : starts[k + 1]] for k in long]
        if len(ids) * len(long) > sum(map(len, members)):
            # Many candidates: reading the lists is less work than as many probes.
            counts = counts + np.bincount(np.concatenate(members), minlength=self.sets)[ids]
        else:
            for one in members:
                at = np.minimum(np.searchsorted(one, ids), len(one) - 1)
                counts = counts + (one[at] == ids)
        return ids[counts >= least], counts[counts >= least]


_NONE = np.empty(0, np.int64)


def search(found: list[np.ndarray], percent: int, split: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Each set's position with the positions of all sets it is linked to, every pair once.

    With ``split`` only links across that position are looked for: those before it are
    queries, those from it on are indexed. Otherwise all are both, and the later set of a
    pair is given with the earlier. Sets without a link are left out.
    """
    sizes, lists = np.array([len(x) for x in found]), Lists(found, split or 0)
    for query in range(len(found) if split is None else split):
        size = len(found[query])
        fits = lambda ids: (sizes[ids] * percent <= size * 100) & (size * percent <= sizes[ids] * 100) & (split is not None or ids > query)
        # Any partner shares so many.
        ids, counts = lists.sharing(found[query], -(-size * percent // 100), fits)
        others = ids[100 * counts >= percent * (size + sizes[ids] - counts)]
        if len(others):
            yield query, others


def close(found: list[np.ndarray], least: np.ndarray, split: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """As ``search``, for sets that share as many as ``least`` of each of the two says."""
    lists = Lists(found, split or 0)
    for query in range(len(found) if split is None else split):
        ids, counts = lists.sharing(found[query], int(least[query]), lambda ids: ids > query if split is None else np.ones(len(ids), bool))
        others = ids[counts >= least[ids]]
        if len(others):
            yield query, others


def _groups(links: Iterator[tuple[int, np.ndarray]], count: int) -> np.ndarray:
    """The first position that each position is connected to."""
    label = np.arange(count)
    for query, others in links:
        joined = np.unique(label[np.append(others, query)])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    return label


def _cells(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], names: int) -> Iterator[tuple[tuple, dict]]:
    """Rows of each block pair by their first ``names`` columns; they come sorted, and one pair is held at a time."""
    key, rows = None, {}
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("cell", "i", "j")))
        for at, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in columns))):
            if at != key:
                if rows:
                    yield key, rows
                key, rows = at, {}
            rows[row[:names]] = row[names:]
    if rows:
        yield key, rows


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of each block pair that share enough hashes, each with the first it is connected to."""
    for (_, i, j), rows in _cells(batches, ("node", "tag", "side", "sigs"), 2):
        named = sorted(rows.items(), key=lambda r: (r[1][0], r[0]))
        split = None if i == j else sum(side == 0 for _, (side, _) in named)
        least = np.array([max(tag % MOST, 1) for (_, tag), _ in named])
        found = [np.sort(np.array(sigs, np.int64).view(np.uint64)) for _, (_, sigs) in named]
        label = _groups(close(found, least, split), len(named))
        nodes = np.array([node for (node, _), _ in named], np.int64)
        moved = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], ["u", "v"])


def _found(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray]]]]:
    """Sets, their numbers of rows, and their links, of each block pair."""
    for (_, i, j), rows in _cells(batches, ("node", "side", "copies", "shingles"), 1):
        # Queries of the first block before the second; inside one block in order of size.
        named = sorted(rows.items(), key=lambda r: (r[1][0], len(r[1][2]), r[0]))
        split = None if i == j else sum(side == 0 for _, (side, _, _) in named)
        links = search([np.frombuffer(s, np.uint64) for _, (_, _, s) in named], percent, split)
        yield np.array([n for (n,), _ in named], np.int64), np.array([c for _, (_, c, _) in named], np.int64), links


def _connect(percent: int):
    """For each set with a link the first set it is connected to, and how many rows it is linked to."""

    def run(batches):
        for nodes, copies, links in _found(batches, percent):
            total = np.zeros(len(nodes), np.int64)

            def counted():
                for query, others in links:
                    total[query] += copies[others].sum()
                    total[others] += copies[query]
                    yield query, others

            label = _groups(counted(), len(nodes))
            linked = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[linked]), pa.array(nodes[label[linked]]), pa.array(total[linked])], ["u", "v", "links"]
            )

    return run


def _pair(percent: int):
    """Every link, as two sets."""

    def run(batches):
        for nodes, _, links in _found(batches, percent):
            for query, others in links:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(others), nodes[query])), pa.array(nodes[others])], ["u", "v"])

    return run


def _blocks(members: DataFrame) -> DataFrame:
    """``members (cell, node, n, ...)`` with the number of blocks of their cell and their own."""
    totals = members.groupBy("cell").agg(F.count("*").alias("sets"), F.sum("n").alias("all"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("all") / BLOCK_SHINGLES)).cast("int")
    both = members.join(totals, "cell").withColumn("blocks", blocks)
    return both.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def _paired(placed: DataFrame) -> DataFrame:
    """Every row once for each block of its cell, dealt by pairs of blocks ``i <= j``; ``side`` is 1 in the second.

    Any two rows of a cell meet in just one pair.
    """
    rest = [c for c in placed.columns if c not in ("cell", "blocks", "block")]
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), *rest,
    )
    return spread.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")


def _spread(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """The sets of the cells that ``members (cell, node, doc_id, h, copies, n)`` make, dealt to pairs of blocks."""
    placed = _blocks(members).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "h", "cell", "node", "copies", "blocks", "block")

    def run(batches):
        for batch in batches:
            keep, raw = [], []
            names = batch.column("node").to_pylist()
            for at, found in enumerate(shingle_sets(batch.column("text"), words)):
                if len(found) and _node(found)[0] == names[at]:
                    keep.append(at)
                    raw.append(found.tobytes())
            some = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [some.column(c) for c in ("cell", "node", "copies", "blocks", "block")] + [pa.array(raw, pa.binary())],
                ["cell", "node", "copies", "blocks", "block", "shingles"],
            )

    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64("text").alias("h"), "text")
    shipped = texts.join(placed.hint("shuffle_hash"), ["key", "h"]).select("cell", "node", "copies", "blocks", "block", "text").mapInArrow(
        run, "cell long, node long, copies long, blocks int, block int, shingles binary"
    )
    return _paired(shipped)


def _classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sets, the classes of equal sets, and the sets dealt to where they may be linked."""
    named = cut(sets(docs, words))
    classes = named.filter("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("h", "doc_id"), F.min("h")).alias("h"),
        F.first("n").alias("n"), F.count("*").alias("copies"),
    )
    placed = cells(meetings(docs, words, percent)).withColumnRenamed("node", "d1")
    members = cut(placed.join(classes, "d1").select("cell", F.col("d1").alias("node"), "doc_id", "h", "copies", "n"))
    return named, classes, _spread(docs, members, words)


def jaccard_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, h, n_shingles, root, component_id, n_links`` of every row.

    As ``jaccard_links``; ``h`` is ``xxhash64(text)`` and ``root`` stands for the component,
    whatever ids its members have; null where there are no shingles.
    """
    named, classes, dealt = _classes(docs, words, percent)
    links = cut(dealt.mapInArrow(_connect(percent), "u long, v long, links long"))
    merged = components(links).withColumnRenamed("node", "d1")
    total = links.groupBy(F.col("u").alias("d1")).agg(F.sum("links").alias("links"))
    rooted = classes.join(merged, "d1", "left").join(total, "d1", "left")
    known = cut(rooted.select(
        "d1", "d2", "doc_id", F.coalesce("root", "d1").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    ))
    heads = known.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = known.join(heads, "root").select("d1", "d2", "root", "component_id", "links")
    return named.join(of_class, ["d1", "d2"], "left").select(
        "doc_id", "h", F.col("n").alias("n_shingles"), "root",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
    )


def jaccard_links(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every document.

    Documents are linked when ``100 * |A & B| >= percent * |A | B|`` for their sets of
    distinct ``words``-word shingles; a component is named by its smallest ``doc_id``, and
    ``n_links`` counts the other rows a row is linked to, each link verified. Documents with
    equal sets are one class, searched once, and linked to each other. Null, empty and
    blank texts have no shingles and are components of their own; a null ``doc_id`` never
    names a component unless all its members are null. Repeated rows are equal sets, other
    columns are ignored, no rows give no rows.
    """
    return jaccard_groups(docs, words, percent).select("doc_id", "n_shingles", "component_id", "n_links")


def jaccard_pairs(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, other_id``: every link between two different sets, once.

    A set is named by the smallest ``doc_id`` that has it (null if none has one). The rows
    grow with the square of a group of near copies; ``jaccard_links`` only counts them.
    """
    _, classes, dealt = _classes(docs, words, percent)
    pairs = dealt.mapInArrow(_pair(percent), "u long, v long")
    ids = classes.select(F.col("d1").alias("u"), F.col("doc_id").alias("a")), classes.select(F.col("d1").alias("v"), F.col("doc_id").alias("b"))
    return pairs.join(ids[0], "u").join(ids[1], "v").select(F.least("a", "b").alias("doc_id"), F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(None)).otherwise(F.greatest("a", "b")).alias("other_id"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document, as in ``jaccard_links``."""
    return jaccard_groups(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(table(spark, sf_dir, "documents"), words=4, percent=85)

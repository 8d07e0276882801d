"""Cutting a log into segments (RET-1): a running total that restarts at every roll.

A record starts a new segment when the open one already holds ``segment_bytes`` or the
record is ``segment_ms`` younger than its first record. Where a segment starts depends on
where the one before it started, so this is a sequential fold, and a topic partition can
hold a third of all records. It is made parallel like this:

* the log is cut into blocks of consecutive offsets;
* each block is reduced, on its own, to a table saying which segment is open at its end
  for every record that may be the first to roll in it;
* tables of neighbouring blocks are combined, a few at a time, until one is left per
  topic partition, and the open segment is then handed back down to every block;
* each block finds its segments from the open segment it was given.

A table never has more entries than fit into one segment, and records travel through this
as four numbers, without keys and values.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators.blocks import before, block_id
from tidelog.operators.lookup import lookup
from tidelog.schemas import struct
from tidelog.operators.settings import settings
from tidelog.scratch import cut

ADDRESS = ["topic", "partition"]
NO_LIMIT = 1 << 60
LEAF = 1 << 16
FAN = 16

_LIMITS = "seg_bytes bigint, seg_ms bigint"
_NODE = struct(
    f"topic string, partition int, node bigint, {_LIMITS}, total bigint, tmax bigint, "
    "es array<bigint>, er array<bigint>, ob array<bigint>, oz array<bigint>, ot array<bigint>"
)
_STATE = struct(
    "topic string, partition int, node bigint, in_base bigint, in_size bigint, in_ts bigint"
)
_PART = struct(
    f"topic string, partition int, {_LIMITS}, segment_base bigint, n bigint, n_bytes bigint, "
    "from_offset bigint, from_ts bigint, to_offset bigint, max_ts bigint"
)


class _Table(NamedTuple):
    """What a run of records does to the segment that is open when it begins.

    Entry ``i`` is taken when the first roll happens there: ``es`` bytes of the run before
    it, ``er`` latest time up to it, and the segment open at the end of the run (base
    offset, bytes, first time).
    """

    es: np.ndarray
    er: np.ndarray
    ob: np.ndarray
    oz: np.ndarray
    ot: np.ndarray
    total: int
    tmax: int

    def after(self, base, size, ts, seg_bytes, seg_ms):
        """The open segments after this run, for arrays of open segments before it."""
        i = np.minimum(
            np.searchsorted(self.es, seg_bytes - size, "left"),
            np.searchsorted(self.er, ts + seg_ms, "left"),
        )
        hit = i < len(self.es)
        i = np.where(hit, i, 0)
        return (
            np.where(hit, self.ob[i], base),
            np.where(hit, self.oz[i], size + self.total),
            np.where(hit, self.ot[i], ts),
        )


def _shrink(t: _Table, seg_bytes: int) -> _Table:
    """Drop entries that cannot be first, and all but the last of equal neighbours."""
    keep = int(np.searchsorted(t.es, seg_bytes, "left")) + 1
    cols = [c[:keep] for c in t[:5]]
    distinct = np.append(cols[2][1:] != cols[2][:-1], True)
    return _Table(*[c[distinct] for c in cols], t.total, t.tmax)


def _first_at_least(ts: np.ndarray, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each ``start`` the first index from it on with ``ts >= limit``, else ``len(ts)``."""
    n = len(ts)
    if n < 2 or np.all(ts[1:] >= ts[:-1]):
        return np.maximum(np.searchsorted(ts, limit, "left"), start)
    tops = [ts]
    while 2 * (1 << (len(tops) - 1)) <= n:
        top, half = tops[-1], 1 << (len(tops) - 1)
        tops.append(np.maximum(top[:-half], top[half:]))
    at = start.copy()
    for p in range(len(tops) - 1, -1, -1):
        fits = at + (1 << p) <= n
        skip = fits & (tops[p][np.where(fits, at, 0)] < limit)
        at = np.where(skip, at + (1 << p), at)
    return at


def _rolls(size: np.ndarray, ts: np.ndarray, seg_bytes: int, seg_ms: int):
    """Bytes before each record, and for each record the next start if a segment starts there."""
    ahead = np.cumsum(size) - size
    here = np.arange(len(size))
    by_size = np.searchsorted(ahead, ahead + seg_bytes, "left")
    by_time = _first_at_least(ts, here + 1, ts + seg_ms)
    return ahead, np.minimum(by_size, by_time)


def _arrays(pdf: pd.DataFrame):
    pdf = pdf.sort_values("offset")
    cols = [pdf[c].to_numpy(np.int64) for c in ("offset", "size", "ts")]
    return (*cols, int(pdf["seg_bytes"].iloc[0]), int(pdf["seg_ms"].iloc[0]))


def _leaf(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    offset, size, ts, seg_bytes, seg_ms = _arrays(pdf)
    ahead, following = _rolls(size, ts, seg_bytes, seg_ms)
    n, total = len(size), int(size.sum())
    last = np.where(following < n, following, np.arange(n))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    table = _Table(
        ahead, np.maximum.accumulate(ts), offset[last], total - ahead[last], ts[last],
        total, int(ts.max()),
    )
    return _row(key, _shrink(table, seg_bytes), seg_bytes, seg_ms)


def _row(key, t: _Table, seg_bytes: int, seg_ms: int) -> pd.DataFrame:
    values = [*key, seg_bytes, seg_ms, t.total, t.tmax, *t[:5]]
    return pd.DataFrame({f.name: [v] for f, v in zip(_NODE, values)})


def _table(row) -> _Table:
    cols = [np.asarray(getattr(row, c), dtype=np.int64) for c in ("es", "er", "ob", "oz", "ot")]
    return _Table(*cols, int(row.total), int(row.tmax))


def _combine(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    rows = list(pdf.sort_values("node").itertuples())
    seg_bytes, seg_ms = int(rows[0].seg_bytes), int(rows[0].seg_ms)
    whole = _table(rows[-1])
    for row in rows[-2::-1]:
        left = _table(row)
        outs = whole.after(left.ob, left.oz, left.ot, seg_bytes, seg_ms)
        later = (left.total + whole.es, np.maximum(left.tmax, whole.er), *whole[2:5])
        joined = [np.concatenate(c) for c in zip((left.es, left.er, *outs), later)]
        whole = _shrink(
            _Table(*joined, left.total + whole.total, max(left.tmax, whole.tmax)), seg_bytes
        )
    return _row(key, whole, seg_bytes, seg_ms)


def _hand_down(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    rows = list(pdf.sort_values("node").itertuples())
    state = tuple(np.array([v], np.int64) for v in (rows[0].in_base, rows[0].in_size, rows[0].in_ts))
    out = []
    for row in rows:
        out.append((row.topic, row.partition, row.node, *[int(v[0]) for v in state]))
        state = _table(row).after(*state, int(row.seg_bytes), int(row.seg_ms))
    return pd.DataFrame(out, columns=_STATE.names)


def _cut_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    offset, size, ts, seg_bytes, seg_ms = _arrays(pdf)
    base, held, first = (int(pdf[c].iloc[0]) for c in ("in_base", "in_size", "in_ts"))
    ahead, following = _rolls(size, ts, seg_bytes, seg_ms)
    n = len(size)
    roll = (held + ahead >= seg_bytes) | (ts >= first + seg_ms)
    at = int(np.argmax(roll)) if roll.any() else n
    starts = [] if at == 0 else [0]
    bases = [] if at == 0 else [base]
    jumps = following.tolist()
    while at < n:
        starts.append(at)
        bases.append(int(offset[at]))
        at = jumps[at]
    cuts = np.array(starts)
    ends = np.append(cuts[1:], n)
    return pd.DataFrame({
        "topic": key[0], "partition": key[1], "seg_bytes": seg_bytes, "seg_ms": seg_ms,
        "segment_base": bases, "n": ends - cuts, "n_bytes": np.add.reduceat(size, cuts),
        "from_offset": offset[cuts], "from_ts": ts[cuts],
        "to_offset": offset[ends - 1], "max_ts": np.maximum.reduceat(ts, cuts),
    })


def _opened(frame: DataFrame) -> DataFrame:
    """Before the first record nothing is open: as good as a full segment."""
    return (
        frame.withColumn("in_base", F.lit(-1).cast("bigint"))
        .withColumn("in_size", F.col("seg_bytes"))
        .withColumn("in_ts", F.lit(-NO_LIMIT).cast("bigint"))
    )


def segment_table(
    log: DataFrame, config: DataFrame, now_ms: int, leaf: int = LEAF, fan: int = FAN
) -> DataFrame:
    """One row per segment: ids, offsets, bytes, times, and whether it is still open at ``now_ms``.

    A setting that is null or -1 never triggers a roll; a topic without settings has the broker's. Record size is the size of the value.
    """
    limits = settings(log, config, ["segment_bytes", "segment_ms"]).select(
        "topic",
        F.coalesce("segment_bytes", F.lit(NO_LIMIT)).cast("bigint").alias("seg_bytes"),
        F.coalesce("segment_ms", F.lit(NO_LIMIT)).cast("bigint").alias("seg_ms"),
    )
    records = lookup(
        log.select(
            *ADDRESS, "offset",
            F.coalesce(F.octet_length("value"), F.lit(0)).cast("bigint").alias("size"),
            F.unix_millis("timestamp").alias("ts"),
        ),
        limits, ["topic"],
    ).withColumn("node", block_id("offset", leaf))
    by = [*ADDRESS, "node"]

    top = records.agg(F.max("node")).first()[0] or 0
    if top == 0:
        entered = _opened(records)
    else:
        records = cut(records)
        levels = [cut(records.groupBy(*by).applyInPandas(_leaf, _NODE))]
        while top >= fan:
            top //= fan
            parents = levels[-1].groupBy(*ADDRESS, F.expr(f"node div {fan}L").alias("parent"))
            levels.append(cut(parents.applyInPandas(_combine, _NODE)))
        # All topmost nodes of a partition, at most ``fan`` of them, form one group.
        group = F.lit(0).cast("bigint")
        states = _opened(levels[-1]).groupBy(*ADDRESS, group.alias("parent")).applyInPandas(
            _hand_down, _STATE
        )
        for level in levels[-2::-1]:
            given = states.withColumnRenamed("node", "parent")
            states = (
                level.withColumn("parent", F.expr(f"node div {fan}L"))
                .join(given, [*ADDRESS, "parent"])
                .groupBy(*ADDRESS, "parent")
                .applyInPandas(_hand_down, _STATE)
            )
        entered = records.join(states, by)
    parts = entered.groupBy(*by).applyInPandas(_cut_block, _PART)
    whole = parts.groupBy(*ADDRESS, "segment_base").agg(
        F.sum("n").cast("bigint").alias("n_records"),
        F.sum("n_bytes").cast("bigint").alias("n_bytes"),
        F.min_by("from_ts", "from_offset").alias("first_ms"),
        F.max("max_ts").alias("last_ms"),
        F.max("to_offset").alias("last_offset"),
        F.max("seg_bytes").alias("_bytes"),
        F.max("seg_ms").alias("_ms"),
    )
    return _numbered(whole, now_ms)


def _numbered(whole: DataFrame, now_ms: int) -> DataFrame:
    # Windows over segments, of which there is one per ``segment_bytes`` of log.
    order = Window.partitionBy(*ADDRESS).orderBy("segment_base")
    is_last = F.lead("segment_base").over(order).isNull()
    open_still = (F.col("n_bytes") < F.col("_bytes")) & (F.lit(now_ms) < F.col("first_ms") + F.col("_ms"))
    return whole.select(
        *ADDRESS, (F.row_number().over(order) - 1).cast("bigint").alias("segment_id"),
        "segment_base", "last_offset", "n_records", "n_bytes", "first_ms", "last_ms",
        (is_last & open_still).alias("is_active"),
    )


def segments(log: DataFrame, config: DataFrame, now_ms: int, table: DataFrame | None = None) -> DataFrame:
    """RET-1: every record with ``segment_id``, ``segment_base`` and ``is_active``.

    A segment is carried forward from its first record inside blocks of the log, with its id
    and state, so no task sees a whole partition, and none a whole segment.
    """
    table = segment_table(log, config, now_ms) if table is None else table
    # Structs compare by their first field, so the latest start is the largest one.
    starts = table.select(*ADDRESS, F.col("segment_base").alias("offset"), F.struct("segment_base", "segment_id", "is_active").alias("_start"))
    marked = log.join(starts, [*ADDRESS, "offset"], "left")
    placed = before(marked, ADDRESS, "offset", {"_segment": ("max", "_start")}, inclusive=True)
    return placed.where("_segment is not null").select(*log.columns, "_segment.*")

"""Stateful streaming operators.  State lives in the state store (checkpointed),
never in a driver object.

* ``dgim_stream`` (T4) - DGIM per stream key;
* ``window_counts_stream`` (T3) - exact counts of the last bits per key, from a
  ring of bits;
* ``decay_stream`` (T5) - a decaying weight per mention, read and written only when
  the mention arrives, with timers that expire it.

The rows of a key arrive in any order, so a micro-batch's rows of the key are
sorted first; their number is bounded by the trigger's rate limit
(``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupStateTimeout

from netstream.functions.dgim import WINDOW_N, AsWritten, Totals, buckets_of, oldest_size
from netstream.operators.decay import DECAY_C

_AW_OUT = ("key LONG, seq LONG, real_count LONG, n_buckets LONG, bucket_sum LONG, "
           "discarded LONG, estimate DOUBLE")
_AW_STATE = ("t", "ones", "rest", "newest", "discarded")
_PB_OUT = "key LONG, seq LONG, n_buckets LONG, bucket_sum LONG, estimate LONG"
_PB_STATE = ("t", "total", "recent")
SLOTS = 512  # of keys by hash: a call of Python and a row of the store per slot, not per key (a checkpoint keeps it)


def _in_order(pdfs: Iterator[pd.DataFrame], *others: str) -> tuple[np.ndarray, ...]:
    """``(seq, bit, *others)`` of a key's rows in a micro-batch by ``seq``."""
    parts = [[p[c].to_numpy() for c in ("seq", "bit", *others)] for p in pdfs]
    seqs, bits, *rest = parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts))
    order = np.argsort(seqs, kind="stable")
    return seqs[order], (bits[order] == 1).astype(np.uint8), *(c[order] for c in rest)


def _keyed(key: tuple, **columns: np.ndarray) -> pd.DataFrame:
    """Rows of one key; a NULL key is a stream of its own."""
    n = len(columns["seq"])
    own = pd.array([None] * n, dtype="Int64") if pd.isna(key[0]) else np.full(n, int(key[0]))
    return pd.DataFrame({"key": own, **columns}, copy=False)


def dgim_stream(bits: DataFrame, mode: str = "published", n: int = WINDOW_N) -> DataFrame:
    """DGIM state after every bit, on a stream of ``(key, seq, bit)``.  Across
    batches the state store carries the state of a key: the total of its buckets
    and its last ``n`` bits (published), or the buckets' numeral (as written).
    A row of the store holds the states of a slot's keys (``states_by_key`` tells
    them apart): a call per key would cost milliseconds however few bits it has.
    Output rows have the batch schema of ``netstream.operators.bits.dgim``;
    output mode ``append``.  As written, a column ``epoch`` stays with its bits.
    """
    if mode not in ("as_written", "published"):
        raise ValueError("mode must be 'as_written' or 'published'")
    epoch = [c for c in ("epoch",) if c in bits.columns and mode == "as_written"]

    def published(held, seqs, bits_):
        t, total, recent = held or (0, 0, b"")
        fold = Totals(n, t, total, recent)
        total = fold.feed(bits_)
        return (fold.t, fold.total, fold.recent.tobytes()), total

    def published_out(totals):
        total = np.concatenate(totals)
        return {"n_buckets": buckets_of(total), "bucket_sum": total, "estimate": total - oldest_size(total) // 2}

    def as_written(held, seqs, bits_):
        st, out = AsWritten(n, *(held or ())), []
        for b in bits_.tolist():
            st.step(b)
            out.append((st.ones, st.rest.bit_count() + st.newest, st.rest + st.newest, st.discarded, st.estimate()))
        return st.state(), out

    def as_written_out(rows):
        names = ("real_count", "n_buckets", "bucket_sum", "discarded", "estimate")
        return dict(zip(names, zip(*(r for of_key in rows for r in of_key))))

    fold, out, out_schema, names = ((as_written, as_written_out, _AW_OUT + "".join(f", {c} LONG" for c in epoch), _AW_STATE)
                                    if mode == "as_written" else (published, published_out, _PB_OUT, _PB_STATE))

    def slot(_, pdfs, state):
        parts = [[p[c].to_numpy() for c in ("key", "none", "seq", "bit", *epoch)] for p in pdfs]
        keys, none, seqs, bits_, *epochs = parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts))
        order = np.lexsort((seqs, keys, none))
        keys, none, seqs, bits_ = keys[order], none[order], seqs[order], (bits_[order] == 1).astype(np.uint8)
        states = _unpacked(state.get, names) if state.exists else {}
        begin = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (none[1:] != none[:-1])))
        found = []
        for a, b in zip(begin, np.append(begin[1:], len(keys))):
            key = None if none[a] else int(keys[a])
            states[key], rows = fold(states.get(key), seqs[a:b], bits_[a:b])
            found.append(rows)
        state.update(_packed(states, names, n))
        yield pd.DataFrame({"key": pd.arrays.IntegerArray(keys.astype(np.int64), none.astype(bool)), "seq": seqs, **out(found),
                            **dict(zip(epoch, (e[order] for e in epochs)))}, copy=False)

    key = F.col("key").cast("long")
    slots = bits.select(F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("slot"), F.coalesce(key, F.lit(0).cast("long")).alias("key"),
                        key.isNull().alias("none"), "seq", "bit", *epoch)
    return slots.groupBy("slot").applyInPandasWithState(
        slot, out_schema, "n LONG, keys BINARY, none BINARY" + "".join(f", {c} BINARY" for c in names), "append", GroupStateTimeout.NoTimeout)


def _packed(states: dict, names: tuple, n: int) -> tuple:
    """The states of a slot's keys as arrays; the last bits of a key fill ``n`` bytes."""
    columns = [b"".join(v.ljust(n, b"\0") for v in c) if name == "recent" else np.array(c, np.int64).tobytes()
               for name, c in zip(names, zip(*states.values()))]
    return (n, np.array([k or 0 for k in states], np.int64).tobytes(), np.array([k is None for k in states], bool).tobytes(), *columns)


def _unpacked(value: tuple, names: tuple) -> dict:
    """``{key: state}`` of a slot, as ``_packed`` put them."""
    n, keys, none, *columns = value
    t = np.frombuffer(columns[names.index("t")], np.int64).tolist()
    columns = [[c[i * n:i * n + min(k, n)] for i, k in enumerate(t)] if name == "recent" else np.frombuffer(c, np.int64).tolist()
               for name, c in zip(names, columns)]
    keys = [None if none_ else k for k, none_ in zip(np.frombuffer(keys, np.int64).tolist(), np.frombuffer(none, bool).tolist())]
    return dict(zip(keys, zip(*columns)))


def states_by_key(states: DataFrame) -> DataFrame:
    """The store's rows per slot as rows per key: ``(key, value, partition_id)``."""
    names = tuple(states.select("value.groupState.*").columns[3:])

    def rows(pdfs):
        for pdf in pdfs:
            for partition, *value in pdf.itertuples(index=False):
                held = _unpacked(tuple(value), names)
                yield pd.DataFrame({"key": pd.array(list(held), dtype="Int64"), "n": value[0],
                                    **dict(zip(names, zip(*held.values()))), "partition_id": partition})

    schema = "key LONG, n LONG, " + "".join(f"{c} {'BINARY' if c == 'recent' else 'LONG'}, " for c in names) + "partition_id INT"
    flat = states.select("partition_id", "value.groupState.*").mapInPandas(rows, schema)
    return flat.select(F.struct("key").alias("key"), F.struct(F.struct("n", *names).alias("groupState")).alias("value"), "partition_id")


RING_STATE = "t LONG, ones LONG, held INT, ring BINARY"


def window_counts_stream(bits: DataFrame, windows: dict[str, int]) -> DataFrame:
    """Exact ones among the last ``w`` bits for each ``name -> w``, and since
    the start, after every bit of a stream ``(key, seq, bit)`` (equal to the batch
    ``ones_counts``).  A key's state is its position, its ones so far and a ring of
    its last bits, eight to a byte: ``max(w) / 8`` bytes however long the stream."""
    reach = max(windows.values(), default=1)

    def count(key, pdfs, state):
        seqs, bits_ = _in_order(pdfs)
        t, ones, held, ring = state.get if state.exists else (0, 0, 0, b"")
        before = np.unpackbits(np.frombuffer(ring, np.uint8), count=held)
        every = np.concatenate([before, bits_])
        running = np.append(0, np.cumsum(every, dtype=np.int64))
        at = np.arange(held, len(every)) + 1
        found = {name: running[at] - running[np.maximum(at - w, 0)] for name, w in windows.items()}
        kept = every[max(0, len(every) - reach):]
        state.update((t + len(bits_), ones + int(bits_.sum()), len(kept), np.packbits(kept).tobytes()))
        yield _keyed(key, seq=seqs, pos=t + 1 + np.arange(len(bits_)), ones_running=ones + running[at] - running[held], **found)

    schema = "key LONG, seq LONG, pos LONG, ones_running LONG" + "".join(f", `{name}` LONG" for name in windows)
    return bits.select("key", "seq", "bit").groupBy("key").applyInPandasWithState(
        count, schema, RING_STATE, "append", GroupStateTimeout.NoTimeout)


class _Decay(StatefulProcessor):
    """Weights of the mentions of a slot at their last arrivals: a map from mention to
    weight, of which a micro-batch reads and writes its own mentions only."""

    def __init__(self, lam: float, drop_below: float, epoch_rows: int):
        self.lam, self.drop_below, self.epoch_rows = lam, drop_below, epoch_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getMapState("weight", "mention STRING", "weight DOUBLE, seq LONG")

    def _expires(self, weight: float, last: int) -> int:
        """The first end of an epoch, from the last arrival's on, at which the
        weight is below the threshold."""
        epoch = last // self.epoch_rows
        if weight >= self.drop_below > 0:
            reach = last + math.log(weight / self.drop_below) / self.lam
            epoch = max(epoch, int((reach + 1) // self.epoch_rows) - 1)
        while weight * math.exp(-self.lam * ((epoch + 1) * self.epoch_rows - 1 - last)) >= self.drop_below:
            epoch += 1
        return (epoch + 1) * self.epoch_rows - 1

    def handleInputRows(self, key, rows, timerValues):
        rows = pd.concat(list(rows), ignore_index=True)
        out, ends = [], []
        for mention, seqs in rows.groupby("mention", sort=False, dropna=False)["seq"]:
            seqs = np.sort(seqs.to_numpy())
            if pd.isna(mention):  # arrivals without a mention only make the clock go on
                out.append((None, None, int(seqs[-1]), int(seqs[-1]) // self.epoch_rows))
                continue
            weight, last = self.state.getValue((mention,)) or (0.0, int(seqs[0]))
            for own in np.split(seqs, np.flatnonzero(np.diff(seqs // self.epoch_rows)) + 1):
                epoch, end = int(own[0]) // self.epoch_rows, int(own[-1])
                if epoch > last // self.epoch_rows and \
                        weight * math.exp(-self.lam * (epoch * self.epoch_rows - 1 - last)) < self.drop_below:
                    weight = 0.0
                weight = weight * math.exp(-self.lam * (end - last)) + float(np.exp(-self.lam * (end - own)).sum())
                last = end
                out.append((mention, weight, last, epoch))
            self.state.updateValue((mention,), (weight, last))
            if self.drop_below > 0:
                ends.append(self._expires(weight, last))
        if ends:
            self.handle.registerTimer(1000 * (min(ends) + 1))  # at the clock of that seq
        yield pd.DataFrame(out, columns=["mention", "weight", "seq", "epoch"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """A timer stands for the mentions of the slot: all that have expired by now leave,
        the next one to expire has the next timer."""
        now, ends = timerValues.getCurrentWatermarkInMs(), []
        for (mention,), (weight, last) in list(self.state.iterator()):
            end = self._expires(weight, last)
            if 1000 * (end + 1) <= now:
                self.state.removeKey((mention,))
            else:
                ends.append(end)
        if ends:
            self.handle.registerTimer(1000 * (min(ends) + 1))
        yield from ()

    def close(self) -> None:
        pass


DECAY_OUT = "mention STRING, weight DOUBLE, seq LONG, epoch LONG"


def decay_stream(mentions: DataFrame, epoch_rows: int, c: float = DECAY_C, drop_below: float = 0.0) -> DataFrame:
    """Published decaying window over a stream ``(seq, mention)``, one state per
    mention: ``(mention, weight, seq, epoch)`` with the weight at the mention's last
    arrival ``seq`` in each epoch of ``epoch_rows`` arrivals.

    A weight decays when it is read, so a micro-batch reads and writes the state of
    its own mentions only, however many were ever seen.  A weight that is below
    ``drop_below`` at the end of an epoch counts as dropped from then on; an
    event-time timer (the clock is ``seq + 1``, one second each) takes its state out of
    the store.  Mentions share calls and timers by slot.  Needs the RocksDB state store;
    rows without a mention give a row with a null weight, which tells how far the clock
    went."""
    slot = F.pmod(F.xxhash64("mention"), F.lit(SLOTS)).alias("slot")
    clocked = mentions.select(slot, "mention", "seq", F.timestamp_seconds(F.col("seq") + 1).alias("at")).withWatermark("at", "0 seconds")
    return clocked.groupBy("slot").transformWithStateInPandas(
        _Decay(-math.log1p(-c), drop_below, epoch_rows), DECAY_OUT, "Append", "EventTime")

"""M4: count-window drift as a stateful stream, keyed (M5: one key's scores in
order).

``count_window_drift_stream`` takes rows as they arrive, ordered by (event
time, id) inside each micro-batch. ``ordered_count_window_drift_stream`` takes
them from unordered files or partitions: a key's rows wait in its state until
the watermark has passed them and are then released in (event time, id) order,
by new rows or by a timer, so the windows are those of the ordered log
whatever the order of arrival. The buffer of a key holds what it received
within the watermark's delay. Rows behind the watermark are dropped.

Per key the state is the running moments of every successful score so far
(n, Σ(x−c), Σ(x−c)²; c = 0.5) plus the open window's scores (at most ``n``
values). Each completed window emits one row with the same definition as the
batch operator D5; the incomplete window stays in state. What a task takes of a
key is one micro-batch's rows, so it is bounded by the trigger
(``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``), not by the table; the step
is vectorised (cumulative sums and a reshape into windows).

The ordered stream packs a task's rows into one Arrow batch per bucket of keys
(a hash) and keeps the state by bucket: the keys' moments and the waiting rows,
an Arrow batch each. Spark hands a group's state over once per 10,000 input
rows, so packed rows meet it once, and a micro-batch costs a call per bucket and
a sort of its rows, not a call per key. The global form of the reference is one
key (one task); keyed by symbol it spreads over the cluster, and the batch D5
over the log table is the scalable global form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from vigil.operators.drift import COUNT_WINDOW, STD_FLOOR

CENTER = 0.5
STATE_SCHEMA = ("n_all long, s_all double, ss_all double, window_no long, "
                "win_scores array<double>, win_last_us long")


def _output_schema(key: str, key_type: str) -> str:
    return (f"{key} {key_type}, window_no long, ts_us long, drift_score double, "
            "mean_score double, std_score double, window_size int")


def _step(n: int, key: str):
    """One key's micro-batch, vectorised: the running moments are sequential
    cumulative sums continuing the stored ones, completed windows are found
    by position (the open window's scores come first), and only the new
    incomplete window goes back into state."""
    def fn(k, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.exists:
            n_all, s_all, ss_all, window_no, win, last_us = state.get
        else:
            n_all, s_all, ss_all, window_no, win, last_us = 0, 0.0, 0.0, 0, [], 0
        batch = pd.concat(list(pdfs), ignore_index=True)      # bounded by the trigger size
        batch = batch.sort_values(["ts_us", "id"], kind="mergesort")
        out, now = _advance(n, (n_all, s_all, ss_all, window_no, win, last_us),
                            batch["score"].to_numpy(dtype=np.float64), batch["ts_us"].to_numpy(dtype=np.int64))
        state.update((*now[:4], now[4].tolist(), now[5]))
        yield _frame(n, key, [] if out is None else [(k[0], out)])
    return fn


def _frame(n: int, key: str, windows: list[tuple]) -> pd.DataFrame:
    """The windows of ``_advance`` of each (key value, windows) as output rows."""
    cols = [key, "window_no", "ts_us", "drift_score", "mean_score", "std_score", "window_size"]
    if not windows:
        return pd.DataFrame(columns=cols)
    values = [v for v, w in windows for _ in range(len(w[0]))]
    parts = [np.concatenate(p) for p in zip(*(w for _, w in windows))]
    return pd.DataFrame(dict(zip(cols, [values, *parts, np.full(len(values), n, dtype=np.int32)])))


def _advance(n: int, held: tuple, x: np.ndarray, t: np.ndarray) -> tuple[tuple | None, tuple]:
    """The windows that the scores ``x`` (in order, at ``t``) complete (number,
    time, drift, mean, deviation; None without any), and the state after them."""
    n_all, s_all, ss_all, window_no, win, last_us = held
    m, p = len(x), len(win)
    xc = x - CENTER
    # Σ(x−c) and Σ(x−c)² over every score so far, added in arrival order.
    s_run = np.cumsum(np.r_[s_all, xc])[1:]
    ss_run = np.cumsum(np.r_[ss_all, xc * xc])[1:]
    n_run = n_all + np.arange(1, m + 1)
    scores = np.r_[np.asarray(win, dtype=np.float64), x]
    times = np.r_[np.full(p, last_us, dtype=np.int64), t]
    done = (p + m) // n
    out = None
    if done:
        w = scores[:done * n].reshape(done, n)
        end = np.arange(1, done + 1) * n - p - 1           # batch row closing each window
        g_n, g_s, g_ss = n_run[end], s_run[end], ss_run[end]
        mean_c = g_s / g_n
        g_std = np.sqrt(np.maximum(g_ss / g_n - mean_c * mean_c, 0.0))
        g_std[g_std == 0] = STD_FLOOR
        w_mean = np.cumsum(w, axis=1)[:, -1] / n           # sequential, as the SQL sum
        keep = g_n >= 2
        if keep.any():
            out = ((window_no + np.arange(done))[keep], times[:done * n].reshape(done, n).max(axis=1)[keep],
                   (np.abs((w_mean - CENTER) - mean_c) / g_std)[keep], w_mean[keep], w.std(axis=1)[keep])
        window_no += done
    rest = scores[done * n:]
    last_us = int(times[done * n:].max()) if len(rest) else 0
    return out, (n_all + m, float(s_run[-1]) if m else s_all, float(ss_run[-1]) if m else ss_all,
                 window_no, rest, last_us)


def count_window_drift_stream(scored: DataFrame, key: str = "symbol", n: int = COUNT_WINDOW,
                              score_col: str = "fraud_score", ts_col: str = "ts",
                              id_col: str = "id") -> DataFrame:
    """Streaming D5 per ``key`` (append output mode). Failed scores (< 0) are
    dropped first, as in the live reader."""
    key_type = scored.schema[key].dataType.simpleString()
    staged = scored.where(F.col(score_col) >= 0).select(
        key, F.col(score_col).cast("double").alias("score"),
        F.unix_micros(F.col(ts_col).cast("timestamp")).alias("ts_us"),
        F.col(id_col).cast("long").alias("id"))
    out = staged.groupBy(key).applyInPandasWithState(
        _step(n, key), _output_schema(key, key_type), STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout)
    return out.select(key, "window_no", F.timestamp_micros("ts_us").alias("ts"),
                      "drift_score", "mean_score", "std_score", "window_size")


ORDERED_STATE_SCHEMA = "held binary, wait binary, line long"
STATE_BUCKETS = 512           # hash classes of keys; null keys have one of their own
PACK_ROWS = 1 << 18           # rows a task packs at a time
_HELD = pa.schema([("n_all", pa.int64()), ("s_all", pa.float64()), ("ss_all", pa.float64()), ("window_no", pa.int64()),
                   ("win", pa.list_(pa.float64())), ("last_us", pa.int64())])

_WAIT = pa.schema([("at", pa.int32()), ("us", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as parts:
        return parts.read_next_batch()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, key, us, id, score) -> per bucket its latest time and its
    successful scores as one Arrow batch, ``PACK_ROWS`` rows at a time."""
    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        order = np.argsort(table["_bucket"].to_numpy(), kind="stable")
        rows = table.take(order).combine_chunks().to_batches()[0]
        bucket, us = rows.column("_bucket").to_numpy(), rows.column("us").to_numpy()
        starts = np.append(0, np.flatnonzero(np.diff(bucket)) + 1)
        ends = np.append(starts[1:], len(bucket))
        blobs = []
        for start, end in zip(starts, ends):
            part = rows.slice(start, end - start).drop_columns(["_bucket"])
            blobs.append(_packed(part.filter(pc.greater_equal(part.column("score"), 0.0))))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[starts], pa.int32()), pa.array(np.maximum.reduceat(us, starts), pa.timestamp("us", "UTC")),
             pa.array(blobs, pa.binary())], ["_bucket", "at", "rows"])

    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= PACK_ROWS:
            yield flush(held)
            held, count = [], 0
    if held:
        yield flush(held)


def _ordered_step(n: int, key: str):
    """One bucket's micro-batch or timer: new rows join the waiting ones, those
    the watermark has passed go on in (event time, id) order of their key. A
    waiting row names its key by the position among the bucket's keys."""
    def fn(_, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        values, held, waits, line = [], [], [], -2**63
        if state.exists:
            *tables, line = state.get
            keys, wait = (_unpacked(bytes(t)) for t in tables)
            values = keys.column("value").to_pylist()
            held = list(zip(*(keys.column(c).to_numpy(zero_copy_only=False) for c in _HELD.names)))
            waits.append([wait.column(c).to_numpy() for c in _WAIT.names])
        place = {v: i for i, v in enumerate(values)}
        new = []
        for part in pdfs:                                      # bounded by the trigger size; empty on a timer
            if len(part) and not state.hasTimedOut:
                new += [_unpacked(bytes(blob)) for blob in part["rows"]]
        if sum(b.num_rows for b in new):
            rows = pa.Table.from_batches(new).combine_chunks().to_batches()[0]
            # Behind what this bucket has released already.
            rows = rows.filter(pa.array(-(-rows.column("us").to_numpy() // 1000) >= line))
            told = rows.column("key").dictionary_encode()
            found = [*told.dictionary.to_pylist(), *([None] if told.null_count else [])]
            at = np.array([place.setdefault(v, len(place)) for v in found], dtype=np.int32)
            waits.append([at[told.indices.fill_null(len(found) - 1).to_numpy()],
                          *(rows.column(c).to_numpy() for c in _WAIT.names[1:])])
        if not place:
            return
        values = list(place)
        held += [(0, 0.0, 0.0, 0, (), 0)] * (len(values) - len(held))
        at, us, ids, scores = (np.concatenate(p) for p in zip(*waits))
        order = np.lexsort((ids, us, at))
        at, us, ids, scores = at[order], us[order], ids[order], scores[order]
        watermark = state.getCurrentWatermarkMs()
        millis = -(-us // 1000)
        free = millis < watermark                              # everything before the watermark
        stays, windows, start = ~free, [], 0
        gone, x, t = at[free], scores[free], us[free]
        for end in np.append(np.flatnonzero(np.diff(gone)) + 1, len(gone)) if len(gone) else ():
            i = gone[start]
            out, held[i] = _advance(n, held[i], x[start:end], t[start:end])
            if out is not None:
                windows.append((values[i], out))
            start = end
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held), _HELD)]
        state.update((_packed(pa.RecordBatch.from_arrays([pa.array(values), *columns], ["value", *_HELD.names])),
                      _packed(pa.RecordBatch.from_arrays(
                          [pa.array(c[stays], f.type) for c, f in zip((at, us, ids, scores), _WAIT)], schema=_WAIT)),
                      max(int(watermark), line)))
        if stays.any():
            state.setTimeoutTimestamp(max(int(millis[stays].min()), int(watermark) + 1))
        if windows:
            yield _frame(n, key, windows)
    return fn


def ordered_count_window_drift_stream(scored: DataFrame, delay: str, key: str = "symbol", n: int = COUNT_WINDOW,
                                      score_col: str = "fraud_score", ts_col: str = "ts",
                                      id_col: str = "id") -> DataFrame:
    """Streaming D5 per ``key`` over rows in any order within ``delay`` (append
    output mode). Failed scores (< 0) make no window but move the watermark, so
    a heartbeat of that kind releases the end of a log. Null times are left out."""
    key_type = scored.schema[key].dataType.simpleString()
    bucket = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(STATE_BUCKETS))).cast("int")
    staged = scored.where(F.col(ts_col).isNotNull()).select(
        bucket.alias("_bucket"), F.col(key).alias("key"), F.unix_micros(F.col(ts_col).cast("timestamp")).alias("us"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-2**63)).alias("id"),
        F.coalesce(F.col(score_col).cast("double"), F.lit(-1.0)).alias("score"))
    # The latest time of each pack is that of its rows, so the watermark is too.
    packed = staged.mapInArrow(_pack, "_bucket int, at timestamp, rows binary").withWatermark("at", delay)
    out = packed.groupBy("_bucket").applyInPandasWithState(
        _ordered_step(n, key), _output_schema(key, key_type), ORDERED_STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select(key, "window_no", F.timestamp_micros("ts_us").alias("ts"),
                      "drift_score", "mean_score", "std_score", "window_size")

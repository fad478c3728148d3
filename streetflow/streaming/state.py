"""Keyed state: the last readings of each sensor and the vehicles each camera has seen.

Inside a batch the rows of a sensor or camera are put in time order; across batches they count in the order
they arrive, as topics keyed by sensor or camera deliver them. Sensors are split by hash in parts, each with one state: a
call of the state costs the same for one sensor as for thousands. The rows of one part in one batch
are bounded by the source's limit per trigger, the state of a sensor by twelve values.
"""

from __future__ import annotations

from collections.abc import Iterator
from tempfile import TemporaryFile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streetflow.operators.validate import drop_missing
from streetflow.operators.windows import (
    HISTORY_ROWS, LAGS, ROLLING_ROWS, UNIQUE_WINDOW_SEC, calendar_columns, newest_rows, tail_window,
)
from streetflow.session import stage

# RocksDB keeps state outside the executor's heap and is what stateful processors need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Warm start minutes, long enough for twelve readings at five-minute steps.
WARM_START_MINUTES = 60.0
# Fixed value: the reason of a reading whose sensor has too short a past.
WARMING_UP = "warming_up"

# Readings of a key whose features are computed together.
PIECE_ROWS = 100_000
# Parts of the sensors' state, and number of lanes of the messages that don't reach it.
SENSOR_PARTS = 256
LANES = 64

LAG_SCHEMA = ("sensor_id string, ts timestamp, speed double, "
              + ", ".join(f"{name} double" for name in LAGS) + ", rolling_mean_30min double")
# Kinds of changes at a camera, and their rows between the two steps of its counts.
ARRIVAL, FRAME, DEPARTURE = 0, 1, 2
CHANGE_SCHEMA = "camera_id string, shard int, frame_id string, t bigint, kind int, delta bigint, new bigint"
FRAME_SCHEMA = pa.schema([("frame_id", pa.string()), ("t", pa.int64())])
CAMERA_PARTS = 32
# Pieces in which a part keeps the vehicles it ever saw; one is read and written at once.
EVER_PIECES = 32
COUNT_SCHEMA = ("camera_id string, frame_id string, ts timestamp, unique_count_5min bigint,"
                " unique_count_session bigint")


def use_state_store(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _gathered(rows: Iterator[pd.DataFrame], *names: str) -> list[np.ndarray]:
    """The named columns of a key's rows in one batch as plain arrays.

    A chunk's frame is let go as soon as its columns are taken.
    """
    chunks = [[chunk[c].to_numpy() for c in names] for chunk in rows]
    return [np.concatenate(parts) for parts in zip(*chunks)]


def _in_order(of: np.ndarray, ts: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Places of the rows by sensor, time and tie, missing ones last; ties are ranked only where rows share sensor and time."""
    order = np.lexsort((ts, of))
    at = ts[order].view(np.int64)
    if ((np.diff(of[order]) == 0) & (np.diff(at) == 0)).any():
        rank = pd.factorize(tie, sort=True)[0]
        order = np.lexsort((np.where(rank < 0, len(rank), rank), ts, of))
    return order


def _pieces(past: np.ndarray, speeds: np.ndarray, past_of: np.ndarray | None = None,
            of: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, int, dict[str, np.ndarray]]]:
    """Walk readings in pieces, each with the speeds of its sensor before it.

    `past_of` and `of` number the sensors of the past and of the readings, which come in that order; without them all are of one. Gives for
    each piece its rows, those with too short a past first, how many these are, and the lags and means of the others.
    """
    least = max(LAGS.values())
    if of is None:
        past_of, of = np.zeros(len(past), np.int64), np.zeros(len(speeds), np.int64)
    owner = np.concatenate([past_of, of])
    order = np.argsort(owner, kind="stable")
    known, owner = np.concatenate([past, speeds])[order], owner[order]
    place = np.flatnonzero(order >= len(past))
    before = place - np.searchsorted(owner, of)
    for low in range(0, len(speeds), PIECE_ROWS):
        own = np.arange(low, min(low + PIECE_ROWS, len(speeds)))
        early = before[own] < least
        at = place[own[~early]]
        out = {name: known[at - back] for name, back in LAGS.items()}
        # as in batch: means leave missing speeds out
        recent = np.array([known[at - i] for i in range(1, ROLLING_ROWS + 1)])
        there = ~np.isnan(recent)
        with np.errstate(invalid="ignore"):
            out["rolling_mean_30min"] = np.where(there, recent, 0).sum(axis=0) / there.sum(axis=0)
        yield np.concatenate([own[early], own[~early]]), int(early.sum()), out


class RecentSpeeds(StatefulProcessor):
    """Lag features of a reading from the twelve readings of its sensor before it, for the sensors of a part."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._recent = handle.getValueState("recent", "sensors array<string>, counts array<int>, speeds array<double>")

    def _known(self, sensors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The names of the part's sensors and of these, the stored speeds, and the numbers of the sensors of both."""
        names, counts, past = self._recent.get() or ([], [], [])
        codes, names = pd.factorize(np.concatenate([np.array(names, object), sensors]), use_na_sentinel=False)
        return names, np.asarray(past, float), np.repeat(np.arange(len(counts)), counts), codes[len(counts):]

    def _remember(self, names: np.ndarray, owner: np.ndarray, speeds: np.ndarray) -> None:
        """Store the last speeds of each sensor; a sensor's are in order of time."""
        order = np.argsort(owner, kind="stable")
        owner, speeds = owner[order], speeds[order]
        last = np.arange(len(owner)) >= np.searchsorted(owner, owner, side="right") - HISTORY_ROWS
        counts = np.bincount(owner[last], minlength=len(names))
        self._recent.update(([None if pd.isna(x) else x for x in names], counts.tolist(), speeds[last].tolist()))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N803
        names, past, past_of, of = self._known(initialState["sensor_id"].to_numpy(object))
        own = [np.asarray(s, dtype=float) for s in initialState["speeds"]]
        self._remember(names, np.concatenate([past_of, np.repeat(of, [len(s) for s in own])]), np.concatenate([past, *own]))

    def _features(self, rows: Iterator[pd.DataFrame], tie: str, *names: str) -> Iterator[tuple[dict[str, np.ndarray], int, dict[str, np.ndarray]]]:
        """Pieces of the readings of a batch: their columns, those with too short a past first, how many these are, and the lags of the others."""
        taken = ("sensor_id", "ts", "speed", *dict.fromkeys((tie, *names)))
        columns = dict(zip(taken, _gathered(rows, *taken)))
        sensors, past, past_of, of = self._known(columns.pop("sensor_id"))
        order = _in_order(of, columns["ts"], columns[tie])
        of, columns = of[order], {name: columns[name][order] for name in ("ts", "speed", *names)}
        columns["speed"] = columns["speed"].astype(float)
        self._remember(sensors, np.concatenate([past_of, of]), np.concatenate([past, columns["speed"]]))
        for own, short, lags in _pieces(past, columns["speed"], past_of, of):
            yield {"sensor_id": sensors[of[own]], **{name: values[own] for name, values in columns.items()}}, short, lags

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for own, short, lags in self._features(rows, "tie"):
            # readings with a missing feature are dropped
            yield pd.DataFrame({**{name: values[short:] for name, values in own.items()}, **lags}).dropna(subset=[*LAGS, "rolling_mean_30min"])

    def close(self) -> None:
        pass


class TaggedSpeeds(RecentSpeeds):
    """As RecentSpeeds, but every message leaves: with its features, or with the reason why it has none (A10, V9)."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:
            for chunk in rows:
                yield chunk[["sensor_id", "ts", "speed", "timestamp", "reason"]].assign(**dict.fromkeys((*LAGS, "rolling_mean_30min"), np.nan))
            return
        for own, short, lags in self._features(rows, "timestamp", "timestamp"):
            early = np.full(short, np.nan)
            lags = {name: np.concatenate([early, values]) for name, values in lags.items()}
            missing = np.isnan(np.array(list(lags.values()))).any(axis=0)
            yield pd.DataFrame({**own, "reason": np.where(missing, WARMING_UP, None), **lags})


def warm_state(readings: DataFrame, minutes: float = WARM_START_MINUTES, used: Observation | None = None) -> DataFrame:
    """`(sensor_id, speeds)`: what each sensor last read, oldest first.

    Stored at once: the state of a stream must not depend on what the table holds later. `used` then has the
    readings in the state as `rows` and the sensors as `sensors`.
    """
    clean = drop_missing(readings.select("sensor_id", "ts", "speed"), "sensor_id", "ts", "speed")
    recent = newest_rows(tail_window(clean, "ts", minutes), "sensor_id", "ts", "speed")
    entries = F.array_sort(F.collect_list(F.struct("ts", F.col("speed").cast("double").alias("speed"))))
    state = recent.groupBy("sensor_id").agg(F.transform(entries, lambda e: e["speed"]).alias("speeds"))
    if used is not None:
        state = state.observe(used, F.coalesce(F.sum(F.size("speeds")), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("sensors"))
    return stage(state)


def _part(parts: int) -> Column:
    """The part of the sensors' state that has a sensor."""
    return F.pmod(F.xxhash64("sensor_id"), F.lit(parts)).cast("int")


def stream_features(readings: DataFrame, tie: str, warm: DataFrame | None = None, parts: int = SENSOR_PARTS) -> DataFrame:
    """The seven features of each reading of a stream; warming-up readings give none.

    `readings(sensor_id, ts, speed)`; `tie` orders readings of one time. `warm` primes a
    stream on a new checkpoint; a restarted one goes on with its own state, and needs the same number of `parts`.
    """
    use_state_store(readings.sparkSession)
    keyed = readings.select(_part(parts).alias("part"), "sensor_id", "ts", F.col("speed").cast("double").alias("speed"),
                            F.col(tie).alias("tie")).groupBy("part")
    lagged = keyed.transformWithStateInPandas(
        RecentSpeeds(), outputStructType=LAG_SCHEMA, outputMode="Append", timeMode="None",
        initialState=None if warm is None else warm.select(_part(parts).alias("part"), "sensor_id", "speeds").groupBy("part"))
    return lagged.withColumns(calendar_columns(F.col("ts")))


def tagged_features(rows: DataFrame, warm: DataFrame | None = None, parts: int = SENSOR_PARTS) -> DataFrame:
    """Every row of a stream `(sensor_id, ts, speed, timestamp, reason)` with its features or the reason why it has none.

    Rows that have a reason already go past the sensors' state, in lanes of their own, so that many bad messages don't meet in one task.
    """
    use_state_store(rows.sparkSession)
    lane = (-1 - F.pmod(F.xxhash64("timestamp", "sensor_id", "ts", "speed"), F.lit(LANES))).cast("int")
    keyed = rows.select(F.when(F.col("reason").isNull(), _part(parts)).otherwise(lane).alias("lane"), "sensor_id", "ts",
                        F.col("speed").cast("double").alias("speed"), "timestamp", "reason").groupBy("lane")
    if warm is not None:
        warm = warm.select(_part(parts).alias("lane"), "sensor_id", "speeds").groupBy("lane")
    tagged = keyed.transformWithStateInPandas(
        TaggedSpeeds(), outputStructType=f"timestamp string, reason string, {LAG_SCHEMA}", outputMode="Append", timeMode="None", initialState=warm)
    return tagged.withColumns(calendar_columns(F.col("ts")))


def _frames_aside(rows: Iterator[pd.DataFrame], file) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int | None]:
    """The changes among a camera's rows as arrays (t, kind, delta, new), and the time of its latest frame; its frames go to a local file.

    A frame's count needs changes that may come after it, and its text is many times as large as a change.
    """
    kept, latest = [], None
    with pa.ipc.new_stream(file, FRAME_SCHEMA) as out:
        for chunk in rows:
            is_frame = (chunk["kind"] == FRAME).to_numpy()
            if is_frame.any():
                own = chunk[is_frame]
                out.write_batch(pa.RecordBatch.from_pandas(own[["frame_id", "t"]], FRAME_SCHEMA, preserve_index=False))
                latest = int(own["t"].max()) if latest is None else max(latest, int(own["t"].max()))
            kept.append([chunk[c].to_numpy()[~is_frame].astype(kind) for c, kind in (("t", np.int64), ("kind", np.int8), ("delta", np.int64), ("new", np.int64))])
    return *(np.concatenate(parts) for parts in zip(*kept)), latest


class VehicleChanges(StatefulProcessor):
    """First of two steps of the counts: which vehicles come and go, by camera and part of its vehicles.

    A sighting after a longer gap than the window is an arrival; each vehicle leaves a window's length after its last
    sighting, which is announced at once and taken back if it is seen again before. The window state holds the
    vehicles a part saw within the window when it was last seen, the session state every
    vehicle ever seen, which grows with the traffic: that is what a count since the start means. It is asked
    only for arrivals, and in pieces: a call of the state for each vehicle would cost more than all else. Frames pass through.
    """

    def __init__(self, width: int):
        self._width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._recent = handle.getValueState("recent", "ids array<bigint>, last array<bigint>")
        self._ever = handle.getMapState("ever", "piece int", "ids binary")

    def _unseen(self, ids: np.ndarray) -> np.ndarray:
        """Which of the distinct ids the part never saw; from now on it has seen them."""
        piece = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(EVER_PIECES)
        unseen = np.zeros(len(ids), bool)
        order = np.argsort(piece, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(piece[order])) + 1) if len(ids) else ():
            at = (int(piece[own[0]]),)
            stored = self._ever.getValue(at)
            known = np.frombuffer(stored[0], np.int64) if stored else np.zeros(0, np.int64)
            unseen[own] = ~np.isin(ids[own], known)
            if unseen[own].any():
                self._ever.updateValue(at, (np.union1d(known, ids[own]).tobytes(),))
        return unseen

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        camera, part = key
        if part < 0:
            # frames without a camera are not brought together
            shard = part if camera is None else 0
            for chunk in rows:
                yield pd.DataFrame({"camera_id": camera, "shard": shard, "frame_id": chunk["frame_id"], "t": chunk["t"], "kind": FRAME, "delta": 0, "new": 0})
            return
        ids, times = (np.concatenate(x) for x in zip(*[(chunk["id"].to_numpy(), chunk["t"].to_numpy()) for chunk in rows]))
        stored = self._recent.get()
        old_ids, old_last = (np.asarray(x, dtype=np.int64) for x in stored) if stored else (np.zeros(0, np.int64),) * 2
        # a sighting that comes late counts as of the last one
        place = np.searchsorted(old_ids, ids).clip(max=max(len(old_ids) - 1, 0))
        if len(old_ids):
            times = np.where(old_ids[place] == ids, np.maximum(times, old_last[place]), times)
        newest = times.max()
        # the last sighting of earlier batches stands before the new ones
        every, at = np.concatenate([old_ids, ids]), np.concatenate([old_last, times])
        known = np.arange(len(every)) < len(old_ids)
        order = np.lexsort((~known, at, every))
        every, at, known = every[order], at[order], known[order]
        same = np.append(every[1:] == every[:-1], False)
        before = np.append(False, same[:-1])
        gap = np.append(0, np.diff(at)) if len(at) else at
        near = before & (gap <= self._width)
        again = np.append(near[1:], False)
        come = ~near & ~known
        leave = ~again & ~known
        back = known & again  # announced by an earlier batch
        first = come & ~before
        new = np.zeros(len(every), np.int64)
        new[first] = self._unseen(every[first])
        last = ~same & (at >= newest - self._width)
        self._recent.update((every[last].tolist(), at[last].tolist()))
        out = [(at[come], ARRIVAL, 1, new[come]), (at[leave] + self._width, DEPARTURE, -1, 0), (at[back] + self._width, DEPARTURE, 1, 0)]
        rows = pd.concat([pd.DataFrame({"t": t, "kind": kind, "delta": delta, "new": n}) for t, kind, delta, n in out])
        rows = rows.groupby(["t", "kind"], as_index=False).sum()
        yield rows[(rows["delta"] != 0) | (rows["new"] != 0)].assign(camera_id=camera, shard=0, frame_id=None)[
            ["camera_id", "shard", "frame_id", "t", "kind", "delta", "new"]]

    def close(self) -> None:
        pass


class CameraTotals(StatefulProcessor):
    """Second step: running sums of a camera's changes at each of its frames.

    It sees a frame as one number and a batch's vehicles as summed changes; the frames' texts wait in a file of the task. At one
    instant arrivals come before the frame and departures after it. Departures that no frame has reached yet are kept.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._totals = handle.getValueState("totals", "inside bigint, session bigint, times array<bigint>, deltas array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        with TemporaryFile() as frames:
            t, kind, delta, new, latest = _frames_aside(rows, frames)
            stored = self._totals.get()
            inside, session, times, deltas = stored if stored else (0, 0, [], [])
            arrivals, departures = (np.flatnonzero(kind == k) for k in (ARRIVAL, DEPARTURE))
            arrivals = arrivals[np.argsort(t[arrivals], kind="stable")]
            leave_t = np.concatenate([np.asarray(times, np.int64), t[departures]])
            leave_d = np.concatenate([np.asarray(deltas, np.int64), delta[departures]])
            order = np.argsort(leave_t, kind="stable")
            leave_t, leave_d = leave_t[order], leave_d[order]
            # sums over the changes before each frame
            came = np.concatenate([[0], np.cumsum(delta[arrivals])])
            seen = np.concatenate([[0], np.cumsum(new[arrivals])])
            left = np.concatenate([[0], np.cumsum(leave_d)])
            come_t = t[arrivals]
            # all arrivals of the batch count from now on; departures wait for a frame that is later
            done = 0 if latest is None else int(np.searchsorted(leave_t, latest, side="left"))
            pending = pd.Series(leave_d[done:]).groupby(leave_t[done:]).sum()
            pending = pending[pending != 0]
            self._totals.update((int(inside + came[-1] + left[done]), int(session + seen[-1]), [int(x) for x in pending.index], [int(x) for x in pending]))
            if latest is None:
                return
            frames.seek(0)
            for piece in pa.ipc.open_stream(frames):
                at = piece.column("t").to_numpy()
                upto = np.searchsorted(come_t, at, side="right")
                gone = np.searchsorted(leave_t, at, side="left")
                yield pd.DataFrame({"camera_id": key[0], "frame_id": piece.column("frame_id").to_pandas(), "ts": pd.to_datetime(at, unit="us"),
                                    "unique_count_5min": inside + came[upto] + left[gone], "unique_count_session": session + seen[upto]})

    def close(self) -> None:
        pass


def stream_counts(frames: DataFrame, seconds: float = UNIQUE_WINDOW_SEC, parts: int = CAMERA_PARTS) -> DataFrame:
    """Both counts at each frame of a stream `(camera_id, frame_id, ts, track_ids)`.

    A camera's vehicles are split in `parts`, which keep who was seen in tasks of their own; what a camera's own task gets
    are its frames and their changes. Frames without a camera have counts of 0.
    """
    use_state_store(frames.sparkSession)
    t = F.unix_micros("ts")
    sighting = lambda x: F.struct(F.pmod(F.xxhash64(x), F.lit(parts)).cast("int").alias("part"), x.alias("id"))
    ids = F.array_distinct(F.filter(F.coalesce(F.when(F.col("camera_id").isNotNull(), F.col("track_ids")).cast("array<bigint>"), F.array().cast("array<bigint>")), lambda x: x.isNotNull()))
    lane = (-1 - F.pmod(F.xxhash64("frame_id", t), F.lit(parts))).cast("int")
    # without nulls, which would make pandas turn ids into fractions
    own = F.array(F.struct(lane.alias("part"), F.lit(0).cast("bigint").alias("id")))
    rows = frames.select("camera_id", "frame_id", t.alias("t"), F.explode(F.concat(F.transform(ids, sighting), own)).alias("x"))
    rows = rows.select("camera_id", F.when(F.col("x.part") < 0, F.col("frame_id")).alias("frame_id"), "t", "x.*")
    changes = rows.groupBy("camera_id", "part").transformWithStateInPandas(
        VehicleChanges(round(seconds * 1_000_000)), outputStructType=CHANGE_SCHEMA, outputMode="Append", timeMode="None")
    return changes.groupBy("camera_id", "shard").transformWithStateInPandas(
        CameraTotals(), outputStructType=COUNT_SCHEMA, outputMode="Append", timeMode="None")

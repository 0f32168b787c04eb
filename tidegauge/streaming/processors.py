"""Stateful processors, one per operator, for ``transformWithStateInPandas``.

Spark hands a processor the rows one key got in one micro-batch, in no
particular order; each sorts them by ``seq`` and works on whole columns. What a
key holds between batches is one value, or one small entry per open window.

Late rows reach a processor as all others do (see ``jobs._all_rows``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegauge.functions.scalar import FIRE_TEXT, RISE_TEXT
from tidegauge.functions.timeops import NO_WATERMARK


def _in_order(chunks: Iterator[pd.DataFrame], *columns: str) -> pd.DataFrame:
    rows = pd.concat(list(chunks), ignore_index=True)
    return rows.sort_values(list(columns) or ["seq"], kind="stable", ignore_index=True)


def _watermark(timer_values) -> int:
    """Spark's watermark, which is 0 before there is one."""
    return timer_values.getCurrentWatermarkInMs() or NO_WATERMARK


class _Value(StatefulProcessor):
    """Keeps one row of state named ``value``."""

    state_schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", self.state_schema)

    def _get(self):
        return self.value.get() if self.value.exists() else None

    def close(self) -> None:
        pass


class NameCounter(_Value):
    schema = "seq long, name string, count long"
    state_schema = "count long"

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows)
        known = self._get()
        start = known[0] if known else 0
        counts = np.arange(start + 1, start + len(batch) + 1)
        self.value.update((int(counts[-1]),))
        yield pd.DataFrame({"seq": batch["seq"], "name": key[0], "count": counts})


class RollingSum(_Value):
    schema = "f0 long, f1 long, f2 int"
    state_schema = "total long, first int"

    def __init__(self, order: list[str]):
        self.order = order

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows, *self.order)
        total, first = self._get() or (0, int(batch["f2"].iloc[0]))
        sums = batch["f1"].to_numpy(dtype="int64").cumsum() + total
        self.value.update((int(sums[-1]), first))
        yield pd.DataFrame({"f0": key[0], "f1": sums, "f2": np.int32(first)}, index=batch.index)


class RollingMaxRecord(_Value):
    schema = "seq long, id string, timestamp long, temperature double"
    state_schema = "timestamp long, temperature double"

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows)
        times = batch["timestamp"].to_numpy()
        values = batch["temperature"].to_numpy()
        known = self._get()
        if known:
            times, values = np.r_[known[0], times], np.r_[known[1], values]
        # of equal temperatures the newest row is the record
        best = np.maximum.accumulate(values)
        at = np.maximum.accumulate(np.where(values == best, np.arange(len(values)), 0))
        self.value.update((int(times[at[-1]]), float(values[at[-1]])))
        at = at[-len(batch):]
        yield pd.DataFrame(
            {"seq": batch["seq"], "id": key[0], "timestamp": times[at], "temperature": values[at]}
        )


class ChangeAlert(_Value):
    schema = "id string, temperature double, diff double"
    state_schema = "temperature double"

    def __init__(self, threshold: float):
        self.threshold = threshold

    def handleInputRows(self, key, rows, timerValues):
        values = _in_order(rows)["temperature"].to_numpy()
        known = self._get()
        self.value.update((float(values[-1]),))
        yield _changes(key[0], values, np.r_[known[0] if known else np.nan, values[:-1]],
                       self.threshold)


def _changes(key: str, values, before, threshold: float) -> pd.DataFrame:
    diff = np.abs(values - before)
    hit = diff > threshold
    return pd.DataFrame({"id": key, "temperature": values[hit], "diff": diff[hit]})


class SelfCleaningAlert(_Value):
    schema = ChangeAlert.schema
    state_schema = "temperature double, timestamp long, timer long"

    def __init__(self, threshold: float, ttl_ms: int):
        self.threshold = threshold
        self.ttl_ms = ttl_ms

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows)
        values, times = batch["temperature"].to_numpy(), batch["timestamp"].to_numpy()
        before = np.r_[np.nan, values[:-1]]
        seen = np.r_[0, times[:-1]]
        known = self._get()
        if known:
            before[0], seen[0] = known[0], known[1]
            self.handle.deleteTimer(known[2])
        now = _watermark(timerValues)
        # rows come before due timers, so a value past its time is ignored here
        before[seen + self.ttl_ms <= now] = np.nan
        timer = int(times[-1]) + self.ttl_ms
        self.handle.registerTimer(timer)
        self.value.update((float(values[-1]), int(times[-1]), timer))
        yield _changes(key[0], values, before, self.threshold)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.value.clear()
        return iter([])


class RiseMonitor(_Value):
    """Timers run on the clock of the cluster, one reading of it per batch."""

    schema = "id string, timestamp long, message string"
    state_schema = "temperature double, timer long"

    def __init__(self, duration_ms: int):
        self.duration_ms = duration_ms

    def handleInputRows(self, key, rows, timerValues):
        values = _in_order(rows)["temperature"].to_numpy()
        before, timer = self._get() or (None, None)
        now = timerValues.getCurrentProcessingTimeInMs()
        warned = []
        if timer is not None and timer <= now:
            # due before these rows came
            self.handle.deleteTimer(timer)
            warned.append(timer)
            timer = None
        steps = np.sign(np.diff(values if before is None else np.r_[before, values]))
        falls = np.flatnonzero(steps < 0)
        if falls.size and timer is not None:
            self.handle.deleteTimer(timer)
            timer = None
        climbed = steps[falls[-1] + 1:] if falls.size else steps
        if timer is None and (climbed > 0).any():
            timer = now + self.duration_ms
            self.handle.registerTimer(timer)
        self.value.update((float(values[-1]), timer))
        if warned:
            yield self._warnings(key[0], warned)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due = expiredTimerInfo.getExpiryTimeInMs()
        before, timer = self._get()
        if timer == due:
            self.value.update((before, None))
            yield self._warnings(key[0], [due])

    @staticmethod
    def _warnings(key: str, times: list[int]) -> pd.DataFrame:
        text = RISE_TEXT[0] + key + RISE_TEXT[1]
        return pd.DataFrame(
            {"id": [key] * len(times), "timestamp": times, "message": [text] * len(times)}
        )


class SwitchFilter(_Value):
    """Rows of kind 0 are switches (with ``until``), rows of kind 1 readings."""

    schema = "seq long, id string, timestamp long, temperature double"
    state_schema = "until long"

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows, "seq", "kind")
        known = self._get()
        ends = batch["until"].fillna(NO_WATERMARK).astype("int64").to_numpy()
        on_until = np.maximum.accumulate(np.r_[known[0] if known else NO_WATERMARK, ends])[1:]
        self.value.update((int(on_until[-1]),))
        passed = batch[(batch["kind"] == 1) & (batch["timestamp"] < on_until)]
        yield passed[["seq", "id", "timestamp", "temperature"]]


class FireAlert(_Value):
    """One bucket of readings, with its own copy of the shared smoke level."""

    schema = "message string, timestamp long"
    state_schema = "level string"

    def __init__(self, above: float):
        self.above = above

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows)
        known = self._get()
        levels = batch["level"].ffill().fillna(known[0] if known else "LOW")
        self.value.update((str(levels.iloc[-1]),))
        hit = batch[(levels == "HIGH") & (batch["temperature"] > self.above)]
        yield pd.DataFrame({"message": FIRE_TEXT + hit["text"], "timestamp": hit["timestamp"]})


class LateTagger(StatefulProcessor):
    """Marks rows behind the watermark; keeps no state.

    With ``size_ms``, a row is late only if its window had closed.
    """

    schema = "seq long, id string, timestamp long, temperature double, is_late boolean"

    def __init__(self, size_ms: int | None = None, inclusive: bool = False):
        self.size_ms = size_ms
        # a bounded watermark is one millisecond below what Spark declares
        self.below_ms = 0 if inclusive else 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        now = _watermark(timerValues) - self.below_ms
        for chunk in rows:
            tagged = chunk[["seq", "id", "timestamp", "temperature"]]
            times = tagged["timestamp"]
            if self.size_ms is None:
                late = times < now
            else:
                late = times - times % self.size_ms + self.size_ms - 1 <= now
            yield tagged.assign(is_late=late)

    def close(self) -> None:
        pass


class _Windows(StatefulProcessor):
    """Keeps a count per open window, in a map from window end."""

    count_schema = ""

    def __init__(self, size_ms: int):
        self.size_ms = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "end_ts long", self.count_schema)

    def _arrivals(self, rows) -> Iterator[tuple[int, int]]:
        """Window ends of a batch, with the number of rows of each."""
        counts = Counter()
        for chunk in rows:
            times = chunk["timestamp"]
            counts.update((times - times % self.size_ms + self.size_ms).value_counts().to_dict())
        return ((int(end), int(n)) for end, n in counts.items())

    def close(self) -> None:
        pass


class UpdatingCount(_Windows):
    """First and updated counts per window, with allowed lateness."""

    schema = "id string, end_ts long, cnt long, tag string"
    count_schema = "cnt long, fired boolean"

    def __init__(self, size_ms: int, lateness_ms: int):
        super().__init__(size_ms)
        self.lateness_ms = lateness_ms

    def handleInputRows(self, key, rows, timerValues):
        now = _watermark(timerValues)
        for end, arrived in self._arrivals(rows):
            if now >= end + self.lateness_ms:
                continue
            count, fired = self.windows.getValue((end,)) or (0, False)
            if not count:
                self.handle.registerTimer(end)
                self.handle.registerTimer(end + self.lateness_ms)
            total = count + arrived
            if now >= end:
                # pending first result, then one more for each late row
                start = count + 1 if fired else max(count, 1)
                yield self._results(key[0], end, range(start, total + 1), fired)
                fired = True
            self.windows.updateValue((end,), (total, fired))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due = expiredTimerInfo.getExpiryTimeInMs()
        pending = self.windows.getValue((due,)) if self.windows.containsKey((due,)) else None
        if pending and not pending[1]:
            self.windows.updateValue((due,), (pending[0], True))
            yield self._results(key[0], due, [pending[0]], False)
        over = due - self.lateness_ms
        if self.windows.containsKey((over,)):
            count, fired = self.windows.getValue((over,))
            self.windows.removeKey((over,))
            if not fired:
                yield self._results(key[0], over, [count], False)

    @staticmethod
    def _results(key: str, end: int, counts, fired: bool) -> pd.DataFrame:
        counts = list(counts)
        tags = ["update"] * len(counts)
        if tags and not fired:
            tags[0] = "first"
        return pd.DataFrame({"id": key, "end_ts": end, "cnt": counts, "tag": tags})


class EarlyCount(_Windows):
    """Counts of open windows at each tick the watermark passes, then finals."""

    schema = "id string, end_ts long, eval_time long, cnt long"
    count_schema = "cnt long"

    def __init__(self, size_ms: int, tick_ms: int):
        super().__init__(size_ms)
        self.tick_ms = tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.evaluated = handle.getValueState("evaluated", "watermark long")

    def handleInputRows(self, key, rows, timerValues):
        now = _watermark(timerValues)
        for end, arrived in self._arrivals(rows):
            if now >= end:
                continue
            known = self.windows.getValue((end,))
            self.windows.updateValue((end,), ((known[0] if known else 0) + arrived,))
            if not known:
                self._set_timers(now, end)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = _watermark(timerValues)
        results = []
        if self._evaluates(now):
            for (end,), (count,) in list(self.windows.iterator()):
                results.append((key[0], end, now - 1, count))
                if now >= end:
                    self.windows.removeKey((end,))
                else:
                    self._set_timers(now, end)
        if results:
            yield pd.DataFrame(results, columns=["id", "end_ts", "eval_time", "cnt"])

    def _evaluates(self, now: int) -> bool:
        """One evaluation per watermark, however many timers it makes due."""
        if self.evaluated.exists() and self.evaluated.get()[0] >= now:
            return False
        self.evaluated.update((now,))
        return True

    def _set_timers(self, now: int, end: int) -> None:
        self.handle.registerTimer(end)
        # without a watermark, the first one there is makes a tick
        tick = 1 if now == NO_WATERMARK else now - now % self.tick_ms + self.tick_ms
        if tick < end:
            self.handle.registerTimer(tick)


class LatestValue(_Value):
    """The newest window result of a key, kept for look-up."""

    schema = "id string, end_ts long, temperature double"
    state_schema = "end_ts long, temperature double"

    def handleInputRows(self, key, rows, timerValues):
        batch = _in_order(rows, "end_ts").iloc[-1]
        known = self._get()
        if not known or known[0] <= batch["end_ts"]:
            self.value.update((int(batch["end_ts"]), float(batch["temperature"])))
        end_ts, temperature = self._get()
        yield pd.DataFrame({"id": [key[0]], "end_ts": [end_ts], "temperature": [temperature]})

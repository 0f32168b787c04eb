"""Plain row-by-row state machines to test against. Not part of the library."""

from collections import defaultdict

LOW = -9223372036854775807


def with_watermarks(rows, bound, step=None):
    """(row, watermark before it) for (seq, id, t, v) rows in arrival order."""
    best, shown, current = LOW, LOW, None
    out = []
    for row in rows:
        if step is not None and row[0] // step != current:
            shown, current = best, row[0] // step
        out.append((row, best if step is None else shown))
        best = max(best, row[2] - bound - 1)
    return out


def updates(rows, size, lateness, bound, step=None):
    counts, fired, out = defaultdict(int), set(), []
    closed = set()
    for (_, key, t, _), wm in with_watermarks(rows, bound, step):
        for window in [w for w in counts if w not in fired and wm >= w[1] - 1]:
            fired.add(window)
            out.append((*window, counts[window], "first"))
        end = t - t % size + size
        if wm >= end - 1 + lateness:
            continue
        window = (key, end)
        counts[window] += 1
        if wm >= end - 1:
            out.append((*window, counts[window], "update" if window in fired else "first"))
            fired.add(window)
    closed = [w for w in counts if w not in fired]
    return out + [(*w, counts[w], "first") for w in closed]


def changes(rows, threshold, ttl=None, bound=0, step=None):
    last, out = {}, []
    for (_, key, t, v), wm in with_watermarks(rows, bound, step):
        if ttl is not None:
            last = {k: s for k, s in last.items() if wm < s[1] + ttl}
        if key in last and abs(v - last[key][0]) > threshold:
            out.append((key, v, abs(v - last[key][0])))
        last[key] = (v, t)
    return out


def rises(rows, duration):
    last, timers, out = {}, {}, []

    def fire(now):
        for key, due in sorted(timers.items()):
            if due is not None and due <= now:
                out.append((key, due))
                timers[key] = None

    for _, key, t, v in rows:
        fire(t)
        before, last[key] = last.get(key), v
        if before is None:
            continue
        if v < before:
            timers[key] = None
        elif v > before and timers.get(key) is None:
            timers[key] = t + duration
    fire(max(r[2] for r in rows))
    return out


def early(rows, size, tick, bound):
    counts, out = defaultdict(int), []
    best = LOW
    for _, key, t, _ in rows:
        end = t - t % size + size
        if best < end - 1:
            counts[key, end] += 1
        after = max(best, t - bound - 1)
        ticked = best == LOW or after // tick > best // tick
        for window in list(counts):
            if after >= window[1] - 1:
                out.append((*window, after, counts.pop(window)))
            elif ticked:
                out.append((*window, after, counts[window]))
        best = after
    return out


def early_in_steps(steps, size, tick, bound):
    """The same where the watermark moves after each step only."""
    counts, out = defaultdict(int), []
    best, shown = LOW, LOW
    for rows in steps:
        for _, key, t, _ in rows:
            end = t - t % size + size
            if shown < end - 1:
                counts[key, end] += 1
            best = max(best, t - bound - 1)
        ticked = shown == LOW or (best + 1) // tick > (shown + 1) // tick
        for window in list(counts):
            if best >= window[1] - 1:
                out.append((*window, best, counts.pop(window)))
            elif ticked:
                out.append((*window, best, counts[window]))
        shown = best
    return out


def forwarded(rows):
    """(seq, key, t, duration or None) rows; numbers of the readings let through."""
    until, out = {}, []
    for seq, key, t, duration in rows:
        if duration is not None:
            until[key] = max(until.get(key, LOW), t + duration)
        elif t < until.get(key, LOW):
            out.append(seq)
    return out

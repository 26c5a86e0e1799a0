"""What the operators should return, stated over lists of rows with plain loops.

Anchors are (id, device, time), activity (device, time, status, error), the state
log (device, seq, time, status), periods (name, direction, seconds); times are naive.
"""

from collections import Counter
from datetime import datetime

EPOCH = datetime(1970, 1, 1)


def seconds(time):
    micros = (time - EPOCH) // (datetime.resolution)
    return -(-micros // 1_000_000) if micros < 0 else micros // 1_000_000


def in_period(anchor_time, event_time, direction, length):
    if direction == "before":
        return (
            anchor_time >= event_time and seconds(anchor_time) - seconds(event_time) <= length
        )
    return anchor_time <= event_time and seconds(event_time) - seconds(anchor_time) <= length


def pairs(anchors, activity, direction, length):
    return [
        (anchor, event)
        for anchor in anchors
        for event in activity
        if None not in (anchor[1], anchor[2], event[1])
        and anchor[1] == event[0]
        and in_period(anchor[2], event[1], direction, length)
    ]


def profile(anchors, activity, periods):
    """Rows (id, period, total, status, n_status, error, n_error)."""
    rows = []
    for name, direction, length in periods:
        found = [(a[0], e[2], e[3]) for a, e in pairs(anchors, activity, direction, length)]
        total = Counter(i for i, _, _ in found)
        by_status = Counter((i, s) for i, s, _ in found)
        by_error = Counter((i, e) for i, _, e in found)
        rows += [
            (i, name, total[i], s, by_status[i, s], e, by_error[i, e]) for i, s, e in set(found)
        ]
    return rows


def multi_period(anchors, activity, periods):
    counted = profile([a for a in anchors if a[0] is not None], activity, periods)
    seen = {row[:2] for row in counted}
    empty = {
        (a[0], p[0], None, None, None, None, None) for a in anchors for p in periods
    }
    return counted + [row for row in empty if row[:2] not in seen]


def neighbours(anchors, activity):
    rows = {}
    for i, device, time in anchors:
        if device is None or time is None:
            continue
        times = [e[1] for e in activity if e[0] == device and e[1] is not None]
        previous, following = rows.setdefault(i, ([], []))
        previous += [t for t in times if t <= time]
        following += [t for t in times if t >= time]
    return [
        (i, max(p, default=None), min(f, default=None)) for i, (p, f) in rows.items() if p or f
    ]


def _ranked(report):
    _, seq, time, status = report
    return (time, seq is not None, seq, status is not None, status or "")


def changes(log):
    """Rows (device, seq, time, status, change time)."""
    rows = []
    known = [r for r in log if r[0] is not None and r[2] is not None]
    for device in {r[0] for r in known}:
        before = None
        for report in sorted((r for r in known if r[0] == device), key=_ranked):
            same = before is not None and before[3] is not None and before[3] == report[3]
            rows.append((*report, None if same else report[2]))
            before = report
    return rows


def state(anchors, log):
    """Rows (id, device, status, since)."""
    found = {}
    changed = [r for r in changes(log) if r[4] is not None]
    for i, device, time in anchors:
        if device is None or time is None:
            continue
        for r in changed:
            if r[0] == device and r[4] <= time:
                kept = found.get((i, device))
                if kept is None or _ranked(r[:4]) > _ranked(kept[:4]):
                    found[i, device] = r
    return [(i, device, r[3], r[4]) for (i, device), r in found.items()]


def context(anchors, activity, log):
    """Rows (id, status, since, previous, next); a missing id never matches."""
    around = {row[0]: row[1:] for row in neighbours(anchors, activity)}
    states = state(anchors, log)
    rows = [
        (i, status, since, *(around.get(i, (None, None)) if i is not None else (None, None)))
        for i, _, status, since in states
    ]
    with_state = {row[0] for row in states if row[0] is not None}
    return rows + [(i, None, None, *n) for i, n in around.items() if i not in with_state]


def report(anchors, activity, log, periods):
    by_id = {}
    for row in context(anchors, activity, log):
        if row[0] is not None:
            by_id.setdefault(row[0], []).append(row[1:])
    return [
        (row[0], *around, *row[1:])
        for row in multi_period(anchors, activity, periods)
        for around in by_id.get(row[0], [(None, None, None, None)])
    ]

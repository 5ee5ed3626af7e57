"""Windows that close by the clock alone."""

import random
import time

import pytest

from sensorstream.plans.overheat import TIMER, overheat, start_overheat
from sensorstream.sources.files import read_file_log
from sensorstream.streaming.clock import Panes, _mean
from sensorstream.streaming.sinks import read_batches
from test_streaming import append


@pytest.mark.parametrize("size,slide", [(10, 1), (10, 3), (4, 10), (6, 6)])
def test_panes_equal_brute_force(size, slide):
    rng = random.Random(size * slide)
    held, sent, got, now = None, [], {}, 1000
    for _ in range(120):
        panes = Panes(size, slide, 89.0, held)
        for _ in range(rng.randint(0, 3)):
            now += rng.randint(0, 2)
            sent.append((now, rng.choice([88.5, 90.0, 95.25])))
            panes.add(now, sent[-1][1], f"{now:08}")
        now += rng.choice([0, 1, 5, 20])
        for start, row in panes.close(now):
            assert start not in got and start + size <= now
            got[start] = row
        held = panes.text()
    wanted = {}
    for at, value in sent:
        start = at - at % slide
        while start > at - size:
            wanted.setdefault(start, []).append((at, value))
            start -= slide
    wanted = {s: rows for s, rows in wanted.items() if s + size <= now}
    assert set(got) == set(wanted)
    for start, rows in wanted.items():
        total, n, above, first, last = got[start]
        assert (float(total), n, above) == (sum(v for _, v in rows), len(rows), all(v > 89 for _, v in rows))
        assert (int(first), int(last)) == (rows[0][0], rows[-1][0])


def test_means_and_what_is_no_number():
    panes = Panes(10, 10, 89.0)
    for value in (0.1, 0.2, 0.0015):
        panes.add(5, value, "a")
    ((_, (total, n, *_)),) = panes.close(10)
    assert _mean(total, n) == 0.101 and panes.next_end() is None
    panes.add(15, float("nan"), "a")
    panes.add(15, 1.0, "a")
    ((_, (total, n, above, *_)),) = panes.close(20)
    assert _mean(total, n) != _mean(total, n) and not above
    panes.add(3, 1.0, "late clock")  # counts in the earliest open window
    assert panes.next_end() == 30


def wait_for(found, seconds=90):
    until = time.time() + seconds
    while time.time() < until:
        if found():
            return True
        time.sleep(0.3)
    return False


def test_windows_close_while_no_data_come(spark, folder):
    path, out = folder("log"), folder("out")
    append(spark, path, [(k, s, 91 + k) for s in range(6) for k in (2, 3)], 0)
    messages = read_file_log(spark, path, streaming=True)
    job = {"time": TIMER, "size": "2 seconds", "slide": "1 second", "mean_type": "double"}
    schema = overheat(messages, **job).schema
    begun = time.time()
    query = start_overheat(messages, out, name="timer", checkpoint=folder("cp"), every="200 milliseconds", **job)

    def rows():
        try:
            return read_batches(spark, out, schema).collect()
        except Exception:
            return []  # no batch is written yet

    try:
        # Each reading counts in two windows; none of them ends before the readings have come.
        assert wait_for(lambda: sum(r.n for r in rows()) == 24)
        append(spark, path, [(2, 9, 10)], 1)
        assert wait_for(lambda: sum(r.n for r in rows()) == 26)
    finally:
        query.stop()
    found = rows()
    bounds = [(r.sensor_id, r.window_start) for r in found]
    assert len(set(bounds)) == len(bounds)
    assert all(begun < r.window_end.timestamp() <= time.time() for r in found)
    assert all((r.window_end - r.window_start).total_seconds() == 2 for r in found)
    early = [r for r in found if r.mean_temp > 50]
    assert all(r.mean_temp == 91 + r.sensor_id and r.hot and r.overheat_constant for r in early)
    assert {r.last_ts[-2:] for r in early} <= {f"{s:02}" for s in range(6)}
    late = [r for r in found if r.mean_temp == 10]
    assert len(late) == 2 and not any(r.hot for r in late)


def test_a_batch_has_no_timer(spark, messages):
    with pytest.raises(ValueError, match="stream"):
        overheat(messages(["{}"]), time=TIMER)


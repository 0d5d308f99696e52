"""The per-key state function of the sensor stream, driven directly with a
stand-in for GroupState (deterministic: no clock, no query)."""

import pandas as pd

from spindle.streaming.sensor import _state_fn


class FakeState:
    def __init__(self):
        self.value, self.timed_out, self.timeout = None, False, None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    @property
    def hasTimedOut(self):
        return self.timed_out

    def update(self, v):
        self.value = tuple(v)

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def _run(fn, state, rows):
    chunks = [pd.DataFrame(c, columns=["session_id", "heart_rate", "calorie"]) for c in rows]
    return [df.iloc[0].to_dict() for df in fn(("k",), iter(chunks), state)]


def test_chunks_are_summed_before_the_reset_test():
    fn, st = _state_fn(True, "keep"), FakeState()
    # two chunks of one batch: (-1,-1) plus (0,0) sums to (-1,-1) -> reset
    assert _run(fn, st, [[("k", 70, 2)], [("k", 80, 4)]])[0]["total_hr"] == 150
    out = _run(fn, st, [[("k", -1, -1)], [("k", 0, 0)]])[0]
    assert (out["total_hr"], out["total_cal"], out["total_n"]) == (0, 0, 1)


def test_idle_timeout_drops_state():
    fn, st = _state_fn(True, "keep", idle_timeout_ms=60_000), FakeState()
    _run(fn, st, [[("k", 70, 2)]])
    assert st.exists and st.timeout == 60_000
    st.timed_out = True
    assert _run(fn, st, []) == [] and not st.exists


def test_truncating_average_of_negative_totals():
    fn, st = _state_fn(True, "keep"), FakeState()
    out = _run(fn, st, [[("k", -2, -2), ("k", -1, 0)]])[0]   # totals (-3, -2) over 2 readings
    assert (out["avg_hr"], out["avg_cal"]) == (-1, -1)

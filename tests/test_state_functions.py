"""The detector state functions equal the literal state machines, flags and
held state alike, for rows in order and for late ones."""

import random
import time

import numpy as np
import pandas as pd
import pytest

from pulsehouse import config
from pulsehouse.streaming import detectors as D

A1 = dict(min_comments=config.A1_MIN_COMMENTS, max_gap_ms=config.A1_MAX_GAP_MS,
          window_ms=config.A1_WINDOW_MS, dup_text=config.A1_DUP_TEXT)


def _batch(rng, start_t, n, users, items, types, eid0):
    rows, t = [], start_t
    for i in range(n):
        t += rng.choices([0, 150, 900, 2000, 3000, 10001, 70000],
                         [4, 8, 4, 2, 1, 0.3, 0.3])[0]
        et = rng.choices(types, [8, 2, 1])[0]
        rows.append((eid0 + i, rng.randrange(users), rng.randrange(items), et, t,
                     rng.choice(["a", "b", None])))
    pdf = pd.DataFrame(rows, columns=["event_id", "user_id", "item_id", "event_type", "t_ms",
                                      "comment_text"])
    return pdf.sort_values(["t_ms", "event_id"], kind="stable"), t


def _view(held):
    """{key: [(time, value)]} of held arrays or of the state machine's map."""
    if isinstance(held, dict):
        return {k: list(h.items) for k, h in held.items() if len(h)}
    out = {}
    rows = (((u, i), t, x) for u, i, t, x in zip(*held)) if isinstance(held, D.A1Held) else (
        (u, t, i) for u, t, i in zip(*held))
    for k, t, v in rows:
        out.setdefault(k, []).append((t, v))
    return out


def _late(pdf, rng, share=0.1):
    """Some rows 30-90 s back, as the producer sends them."""
    back = [rng.randint(30_000, 90_000) if rng.random() < share else 0 for _ in range(len(pdf))]
    pdf = pdf.assign(t_ms=pdf["t_ms"] - back)
    return pdf.sort_values(["t_ms", "event_id"], kind="stable")


@pytest.mark.parametrize("late", [False, True])
@pytest.mark.parametrize("seed", range(6))
def test_a1_batches_equal_the_state_machine(seed, late):
    rng = random.Random(seed)
    held, state, t, any_ = D.A1Held.of(), {}, 100_000, False
    for k in range(5):
        b, t = _batch(rng, t, 300, 3, 3, ["comment", "like", "enter_item"], 1000 * k)
        b = _late(b, rng) if late else b
        flags, held = D.a1_batch(b, held, **A1)
        want, state = D._a1_loop(b, state, A1)
        assert np.array_equal(flags, want)
        assert _view(held) == _view(state)
        any_ |= want.any()
    assert any_


@pytest.mark.parametrize("late", [False, True])
@pytest.mark.parametrize("seed", range(6))
def test_a2_batches_equal_the_state_machine(seed, late):
    rng = random.Random(100 + seed)
    held, state, t, any_ = D.A2Held.of(), {}, 100_000, False
    for k in range(5):
        rows = []
        for i in range(500):
            t += rng.choices([0, 20, 50, 100, 2000], [3, 4, 4, 2, 0.3])[0]
            rows.append((1000 * k + i, rng.randrange(2), rng.randrange(20), "like", t))
        b = pd.DataFrame(rows, columns=["event_id", "user_id", "item_id", "event_type", "t_ms"])
        b = _late(b, rng) if late else b
        keep, held = D.a2_batch(b, held, 5000, 15)
        want, state = D._a2_loop(b, state, 5000, 15)
        assert np.array_equal(keep, want)
        assert _view(held) == _view(state)
        any_ |= want.any()
    assert any_


def test_empty_batches():
    none = pd.DataFrame({"event_id": [], "user_id": [], "item_id": [], "event_type": [], "t_ms": [],
                         "comment_text": []})
    assert len(D.a1_batch(none, D.A1Held.of(), **A1)[0]) == 0
    assert len(D.a2_batch(none, D.A2Held.of(), 5000, 15)[1].t) == 0
    held = D.A2Held.of([1], [5], [7])
    assert _view(D.a2_batch(none, held, 5000, 15)[1]) == {1: [(5, 7)]}


def test_many_keys_are_no_slower_than_the_state_machine():
    rng = np.random.default_rng(0)
    n = 40_000
    b = pd.DataFrame({
        "event_id": np.arange(n), "user_id": rng.integers(0, 2000, n),
        "item_id": rng.integers(0, 20, n), "t_ms": np.arange(n) * 5, "event_type": "comment",
        "comment_text": "x"})
    held, state, fast, slow = D.A1Held.of(), {}, 0.0, 0.0
    for part in np.array_split(b, 4):
        a = time.perf_counter()
        flags, held = D.a1_batch(part, held, **A1)
        c = time.perf_counter()
        want, state = D._a1_loop(part, state, A1)
        fast, slow = fast + c - a, slow + time.perf_counter() - c
        assert np.array_equal(flags, want)
    assert fast < slow

"""The stream's rule takes a micro-batch slice by slice."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd

from tests.test_rotation import consumed
from wardflow.streaming import rotation


class Kept:
    exists = False

    def update(self, values):
        self.get, self.exists = values, True


def test_slices_of_a_micro_batch(monkeypatch):
    """No slice grows with the micro-batch, also when parts come in any order and times repeat."""
    monkeypatch.setattr(rotation, "SLICE", 128)
    draw, times, t = random.Random(3), [], 0.0
    for _ in range(6000):
        t += draw.choice([0, 0, 0.5, 1, 3, 12])
        times.append(t)
    rows = pd.DataFrame({"id": range(6000), "_at": [round(s * 1e6) for s in times]}).sample(frac=1, random_state=1)
    rows = pd.concat([rows, pd.DataFrame({"id": [-1], "_at": [np.nan]})])
    parts = [rows.iloc[k : k + 500] for k in range(0, len(rows), 500)]
    state = Kept()
    found = list(rotation._rule(["id"], ["id"], 9, 20_000_000, 10_000_000)(None, iter(parts), state))
    assert max(map(len, found)) < 2000
    numbers = pd.concat(found).set_index("id")["batch_id"]
    assert pd.isna(numbers[-1])
    assert numbers.drop(-1).sort_index().tolist() == consumed(times, 9, 20, 10)
    assert state.get[3] == round(times[-1] * 1e6)

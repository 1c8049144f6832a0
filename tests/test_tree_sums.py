"""What a task hands on of its blocks."""

from types import SimpleNamespace

import numpy as np
import pandas as pd

from delaykit.operators import trees


def test_a_task_hands_on_each_sum_once():
    random = np.random.default_rng(3)
    n, rules = 50, trees.Rules()
    frame = pd.DataFrame(
        [
            {"n": n, "bins": random.integers(0, 4, (2, n)).astype(np.uint8).tobytes(),
             "labels": random.integers(0, 3, (1, n)).astype(np.int64).tobytes(), "y": random.normal(size=n).tobytes(),
             "w": np.ones(n).tobytes(), "part": np.zeros(n, dtype=np.int16).tobytes(), "block": block}
            for block in range(6)
        ]
    )
    member = trees.Member(0, 0, None, 0.0, trees.Tree(), [])
    member.tree.add()
    member.open = {0: (6.0 * n, 0)}
    sent = SimpleNamespace(value=[member])
    found = pd.concat(trees._cells(sent, rules, 2, 1, 0)(iter([frame[:3], frame[3:]])))
    assert not found.duplicated(["member", "node", "feature", "key"]).any()
    assert found.groupby("feature")["n"].sum().tolist() == [6.0 * n] * 3
    y = np.concatenate([np.frombuffer(x) for x in frame["y"]])
    np.testing.assert_allclose(found.groupby("feature")["g"].sum(), -y.sum())
    bins = np.hstack([np.frombuffer(x, dtype=np.uint8).reshape(2, n) for x in frame["bins"]])
    own = found[found["feature"] == 1].sort_values("key")
    np.testing.assert_allclose(own["g"], np.bincount(bins[1], -y))

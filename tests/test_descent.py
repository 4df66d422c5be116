"""Training epoch by epoch against a plain loop over all windows."""

import numpy as np
import pytest

from demandtide.operators import descent
from tests.conftest import ordered, season


def plain(values, epochs, length, rate):
    """Adam on the windows themselves, and both losses after each step."""
    parts = {"train": [], "test": []}
    for y in values:
        cut = int(len(y) * 0.8)
        spread = y[:cut].std(ddof=1)
        z = (y - y[:cut].mean()) / spread if spread > 0 else np.zeros(len(y))
        for name, part in (("train", z[:cut]), ("test", z[cut:])):
            parts[name] += [(np.concatenate([[1], part[i - length : i]]), part[i]) for i in range(length, len(part))]
    x, t = (np.array(v) for v in zip(*parts["train"]))
    b, speed, square, out = np.zeros(length + 1), 0, 0, []
    for k in range(1, epochs + 1):
        g = 2 * x.T @ (x @ b - t) / len(t)
        speed, square = 0.9 * speed + 0.1 * g, 0.999 * square + 0.001 * g * g
        b = b - rate * (speed / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.999**k)) + 1e-8)
        out.append([np.mean([(r @ b - v) ** 2 for r, v in parts[name]]) if parts[name] else None for name in ("train", "test")])
    return b, out


@pytest.mark.parametrize("block", [4032, 50])
def test_epochs_equal_a_plain_loop(make_series, block):
    values = {"a": season(300, 1), "b": season(200, 2) ** 2, "flat": np.full(150, 3.0)}
    got = ordered(descent.fit_epochs(make_series(values).drop("cut"), ["k"], length=12, epochs=20, block=block), keys=("epoch",))
    weights, losses = plain(values.values(), 20, 12, descent.RATE)
    np.testing.assert_allclose(got[["train_loss", "test_loss"]], losses, rtol=1e-8)
    np.testing.assert_allclose(got.weights.iloc[-1], weights, rtol=1e-8)
    assert got.train_loss.iloc[-1] < got.train_loss.iloc[0]


def test_artifact_forecasts_as_the_model_does(spark, make_series, tmp_path):
    series = make_series({"a": season(400, 1), "b": season(300, 2)}).drop("cut")
    epochs = descent.fit_epochs(series, ["k"], epochs=30)
    descent.save_epochs(epochs, f"{tmp_path}/m")
    again = descent.load_epochs(spark, f"{tmp_path}/m")
    one, two = (ordered(descent.epoch_forecast(series, e, ["k"]), "pred", keys=("k", "idx")) for e in (epochs, again))
    np.testing.assert_allclose(one, two)
    assert len(two) == 80 - 24 + 60 - 24
    history = descent.loss_history(again).collect()
    assert {(r.split, r.iteration) for r in history} == {(s, i) for s in ("train", "test") for i in range(1, 31)}


def test_no_window_means_no_epochs_and_no_test_part_no_test_loss(make_series):
    assert descent.fit_epochs(make_series(season(20)).drop("cut")).collect() == []
    short = descent.fit_epochs(make_series(season(60)).drop("cut"), epochs=2)
    assert [r.test_loss for r in short.collect()] == [None, None]
    assert {r.split for r in descent.loss_history(short).collect()} == {"train"}


def test_another_column_as_target(make_series):
    series = make_series(season(300)).drop("cut")
    two = descent.fit_epochs(series.withColumn("w", series.y * 2 + 1), value="w", epochs=3).collect()
    assert [r.train_loss for r in descent.fit_epochs(series, epochs=3).collect()] == pytest.approx([r.train_loss for r in two])

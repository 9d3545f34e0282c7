"""Boosting in stages against a plain loop over rows."""

import numpy as np
import pytest

from tablecraft.ml import boosting
from tablecraft.ml.boosting import LogisticLoss, SquaredLoss, StagedBoost


@pytest.fixture(scope="module")
def noisy(spark):
    draw = np.random.default_rng(8)
    x = draw.integers(0, 7, (300, 3)).astype(float)
    y = np.sin(x[:, 0]) * 3 + x[:, 1] - 0.2 * x[:, 2] ** 2 + draw.normal(0, 1.0, 300)
    k = (y > np.median(y)).astype(float)
    df = spark.createDataFrame([(i, a.tolist(), float(b), float(c), i % 3) for i, (a, b, c) in enumerate(zip(x, y, k))],
                               "id long, features array<double>, label double, half double, fold int").repartition(3).cache()
    return df, x, y, k


def plain(x, y, train, rounds, rate, depth, logistic):
    """(mean validation loss after each tree, predictions), tree by tree on single rows."""
    rows = np.flatnonzero(train)
    mean = y[rows].mean()
    f, errors = np.full(len(y), np.log(mean / (1 - mean)) if logistic else mean), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f)) if logistic else f
        leaf = grow_all(x, y - p, rows, depth)
        for at in {tuple(v) for v in leaf.values()}:
            inside = [r for r in rows if leaf[r] == list(at)]
            rest = (y - p)[inside].sum()
            steep = (p * (1 - p))[inside].sum() if logistic else len(inside)
            for r in range(len(y)):
                if leaf[r] == list(at):
                    f[r] += rate * rest / steep
        held = ~train
        loss = y * np.logaddexp(0, -f) + (1 - y) * np.logaddexp(0, f) if logistic else (y - f) ** 2
        errors.append(loss[held].mean())
    return np.array(errors), f


def grow_all(x, rest, rows, depth):
    """The leaf of every row (as the list of sides taken) in the tree that fits ``rest`` on some rows."""
    leaf = {r: [] for r in range(len(x))}

    def split(at, everything, left):
        if not left:
            return
        base = rest[at].sum() ** 2 / len(at)
        best, found = base + 1e-9 * max(abs(base), 1e-12), None
        for f in range(x.shape[1]):
            for v in np.unique(x[at, f])[:-1]:
                low = at[x[at, f] <= v]
                score = rest[low].sum() ** 2 / len(low) + (rest[at].sum() - rest[low].sum()) ** 2 / (len(at) - len(low))
                if score > best + 1e-12 * abs(best):
                    best, found = score, (f, v)
        if found is None:
            return
        f, v = found
        for side in (0, 1):
            inside = everything[(x[everything, f] > v) == side]
            for r in inside:
                leaf[r].append(side)
            split(at[(x[at, f] > v) == side], inside, left - 1)

    split(rows, np.arange(len(x)), depth)
    return leaf


@pytest.mark.parametrize("logistic", [False, True])
def test_stages_equal_a_loop_over_rows(noisy, monkeypatch, logistic):
    df, x, y, k = noisy
    monkeypatch.setattr(boosting, "WRITTEN", 3)
    label = "half" if logistic else "label"
    model = StagedBoost(7, 2, 0.3, LogisticLoss if logistic else SquaredLoss).fit(df.where("fold > 0"), df.where("fold = 0"), label=label)
    errors, f = plain(x, k if logistic else y, np.arange(300) % 3 > 0, 7, 0.3, 2, logistic)
    assert np.allclose(model.errors, errors) and model.best == int(np.argmin(errors)) + 1
    got = [r.prediction for r in model.transform(df).orderBy("id").collect()]
    assert np.allclose(got, f > 0 if logistic else f)


def test_patience_ends_the_search_and_best_is_kept(noisy):
    df, _, _, _ = noisy
    whole = StagedBoost(60, 2, 0.5).fit(df.where("fold > 0"), df.where("fold = 0"))
    early = StagedBoost(60, 2, 0.5, patience=5).fit(df.where("fold > 0"), df.where("fold = 0"))
    assert len(whole.errors) == 60 and len(early.errors) < 60
    assert early.errors == whole.errors[: len(early.errors)]
    assert early.best == int(np.argmin(early.errors)) + 1 and len(early.keep_best().trees) == early.best


def test_no_rows_and_constant_columns(spark):
    none = spark.createDataFrame([], "features array<double>, label double")
    assert StagedBoost(3).fit(none).transform(none).count() == 0
    flat = spark.createDataFrame([([1.0], 4.0), ([1.0], 6.0), ([None], None)], "features array<double>, label double")
    assert [r.prediction for r in StagedBoost(3).fit(flat).transform(flat).collect()] == [5.0] * 3

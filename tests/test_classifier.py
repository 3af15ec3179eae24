"""The boosted trees against a plain version, and their files, losses and scores."""

import math

import numpy as np
import pyarrow as pa
import pytest

from kinlink.operators import classifier as c
from kinlink.operators.features import FEATURES


def table(n: int = 300, seed: int = 3, values: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Rounded features; the label needs two of them together."""
    r = np.random.default_rng(seed)
    x = r.integers(0, values, (n, len(FEATURES))) / (values - 1)
    x[:, 5] = 0.25
    y = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.5)) | (r.random(n) < 0.05)
    return x, y.astype(float)


def plain_tree(x, y, logit):
    """Level by level, every border of every feature tried over all rows."""
    p = 1 / (1 + np.exp(-logit))
    g, h = p - y, p * (1 - p)
    groups, chosen = [np.arange(len(y))], []
    worth = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + c.L2)
    for _ in range(c.DEPTH):
        tried = []
        for f in range(x.shape[1]):
            seen = sorted(set(x[:, f]))
            for low, high in zip(seen, seen[1:]):
                border = (low + high) / 2
                tried.append((sum(worth(k[x[k, f] > border]) + worth(k[x[k, f] <= border]) for k in groups), f, border))
        best = max(tried, key=lambda t: t[0])
        if best[0] - sum(map(worth, groups)) <= 1e-9:
            break
        chosen.append(best)
        groups = [part for k in groups for part in (k[x[k, best[1]] <= best[2]], k[x[k, best[1]] > best[2]])]
    after = logit.copy()
    for k in groups:
        after[k] -= c.RATE * g[k].sum() / (h[k].sum() + c.L2)
    return chosen, after


def test_trees_are_those_of_a_plain_version():
    x, y = table(values=100)
    model = c.boost(x, y, 4)
    logit = np.full(len(y), model.bias)
    assert model.bias == pytest.approx(math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    for tree, staged in zip(model.trees, model.stages(x), strict=True):
        chosen, logit = plain_tree(x, y, logit)
        assert [(f, border) for _, f, border in chosen] == list(zip(tree.features, tree.borders, strict=True))
        assert np.diff([worth for worth, _, _ in chosen]) == pytest.approx(tree.gains[1:])
        assert staged == pytest.approx(logit)


def test_pairs_of_features_are_learnt_and_held_out_rows_scored():
    model = c.boost(*table(2000), 80)
    x, y = table(2000, seed=4)
    assert ((model.logit(x) > 0) == (y > 0)).mean() > 0.93


def test_fewer_trees_are_the_first_ones_and_files_keep_them(tmp_path):
    x, y = table()
    model = c.boost(x, y, 12)
    assert model.first(5) == c.boost(x, y, 5)
    c.save(model, tmp_path / "m")
    assert c.load(tmp_path / "m") == model
    assert sum(c.importance(model).values()) == pytest.approx(1)


def test_without_rows_labels_or_differences_there_are_no_trees():
    x, y = table(20)
    none = c.boost(np.empty((0, len(FEATURES))), np.empty(0), 5)
    assert none == c.Trees(0.0, [])
    assert c.boost(x, np.ones(20), 5).trees == [] and c.boost(x, np.ones(20), 5).bias > 0
    assert c.boost(np.ones_like(x), y, 5).trees == []
    assert sum(c.importance(none).values()) == 0


@pytest.fixture
def pairs(spark):
    x, y = table()
    rows = [(f"r{i}", f"t{i}", int(label), *map(float, row)) for i, (row, label) in enumerate(zip(x, y, strict=True))]
    columns = ["ref_id string", "target_id string", "label int", *[f"{f} double" for f in FEATURES]]
    return spark.createDataFrame(rows, ", ".join(columns)).repartition(5), x, y


def test_distributed_losses_and_scores_equal_the_plain_ones(spark, pairs):
    df, x, y = pairs
    model = c.fit(df, 10)
    assert model == c.fit(df.repartition(3, "target_id"), 10)
    by_hand = [np.logaddexp(0, np.where(y > 0, -1, 1) * logit).mean() for logit in model.stages(x)]
    assert c.losses(model, df) == pytest.approx(by_hand, abs=1e-9)
    assert c.best_iterations(model, df) == int(np.argmin(by_hand)) + 1
    assert c.best_iterations(model, df.limit(0)) == 10
    found = {r.ref_id: r.probability for r in c.score(model, df).collect()}
    known = c.score(model, df.limit(0)).columns
    assert known == [*df.columns, "probability"]
    order = [int(k[1:]) for k in found]
    assert list(found.values()) == pytest.approx((1 / (1 + np.exp(-model.logit(x))))[order].tolist())


def test_a_bounded_sample_teaches_and_missing_features_fail(spark, pairs):
    df, _, _ = pairs
    few = c.fit(df, 3, most_pairs=100)
    assert few == c.fit(df.repartition(2), 3, most_pairs=100) != c.fit(df, 3)
    broken = df.selectExpr("* except (name_exact)", "cast(null as double) as name_exact")
    with pytest.raises(Exception, match="not finite"):
        c.fit(broken, 3)


def test_patience(monkeypatch):
    for seen, patience, best in (([5, 4, 3, 3, 2], 2, 5), ([5, 4, 6, 6, 1], 2, 2), ([1.0], 50, 1)):
        monkeypatch.setattr(c, "losses", lambda model, tuning, seen=seen: seen)
        assert c.best_iterations(None, None, patience) == best


def many(spark, n: int):
    """More different values than borders, and as many pairs as asked for."""
    x, y = table(n, values=1000)
    columns = {"ref_id": [f"r{i}" for i in range(n)], "target_id": ["t"] * n, "label": y.astype(int)}
    return spark.createDataFrame(pa.table(columns | dict(zip(FEATURES, x.T, strict=True)))), x, y


def test_every_pair_teaches(spark):
    df, x, y = many(spark, 130_000)
    model = c.fit(df, 2)
    assert model.bias == np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    assert model == c.boost(x, y, 2)


def test_spark_and_this_process_make_the_same_trees(spark, monkeypatch):
    df, x, y = many(spark, 3_000)
    monkeypatch.setattr(c, "BLOCK", 400)
    here = c.fit(df, 11)
    monkeypatch.setattr(c, "MOST_HELD", 0)
    monkeypatch.setattr(c, "FRESH", 8)
    assert c.fit(df.repartition(7), 11) == here == c.boost(x, y, 11)
    assert len(here.trees) == 11

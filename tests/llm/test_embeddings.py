"""Embedding near-dedup against cosines of all pairs and a plain search."""

import math
import random

import numpy as np
import pytest

from regionflow.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def plain(rows, threshold):
    good = []
    for k, (_, v, label, *_) in enumerate(rows):
        fine = label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        good.append(np.array(np.float32(v), np.float64) if fine else None)
    near = {k: [] for k in range(len(rows))}
    for i, a in enumerate(good):
        for j, b in enumerate(good):
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / (math.sqrt(a @ a) * math.sqrt(b @ b)) >= threshold:
                    near[i].append(j)
    out = []
    for k, r in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((r[0], len(near[k]), low, r[0] is not None and r[0] == low))
    return sorted(out, key=repr)


def vectors(rng, n, d=24):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            base = rng.choice(rows)
            scale, noise = rng.choice([1, 1, 3.5, 1e-6]), rng.choice([0, 0.01, 0.03, 0.05])
            v = [scale * (x + rng.gauss(0, noise)) if x is not None else 0.5 for x in base[1]]
            rows.append((i, v, base[2], ""))
        else:
            rows.append((i, [rng.gauss(0.3, 1) for _ in range(rng.choice([d, d, d, 5]))], rng.choice([0, 0, 0, 1, 2]), ""))
    return rows


ODD = [
    (900, None, 0, ""), (901, [], 0, ""), (902, [0.0] * 24, 0, ""), (903, [1.0, None] + [0.5] * 22, 0, ""), (904, [1.0, float("nan")] + [0.5] * 22, 0, ""),
    (905, [1.0, float("inf")] + [0.5] * 22, 0, ""), (906, [1.0] * 24, None, ""), (907, [1.0] * 24, None, ""), (908, [3e38] * 24, 0, ""), (909, [1e-44] * 24, 0, ""),
    (910, [1.0], 0, ""), (911, [2.0], 0, ""), (912, [-2.0], 0, ""), (None, [1.0], 0, ""), (None, None, None, ""), (None, [7.0, 0.0], 5, ""), (913, [0.0, 1.0], 5, ""), (914, [-0.0, 2.0], 5, ""),
]


@pytest.mark.parametrize("rows_of_tile, threshold", [(5, 0.98), (2048, 0.98), (7, 0.5)])
def test_links_and_components_equal_those_of_all_pairs(spark, monkeypatch, rows_of_tile, threshold):
    monkeypatch.setattr(E, "TILE_ROWS", rows_of_tile)
    monkeypatch.setattr(E, "TILE_NUMBERS", 1)
    monkeypatch.setattr(E, "ROWS", 6)
    rng = random.Random(rows_of_tile)
    rows = vectors(rng, 150) + ODD
    rows += [rows[3]] * 20 + [(1000 + i, rows[4][1], rows[4][2], "") for i in range(20)]  # repeated rows and copies
    rng.shuffle(rows)
    got = E.near_vectors(spark.createDataFrame(rows, SCHEMA), threshold=threshold)
    assert got.columns == ["id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, threshold)


def test_no_usable_vectors(spark):
    got = E.near_vectors(spark.createDataFrame(ODD[:4], SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == [(i, 0, i, True) for i in range(900, 904)]
    assert E.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pruning_loses_no_link():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 70))
    x = np.concatenate([base + rng.normal(scale=s, size=base.shape) for s in (0, 0.1, 0.2, 0.25)])
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    turned = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :32]
    for threshold in (0.9, 0.98, 0.2):
        want = x @ x.T >= threshold
        got = np.concatenate([hits for _, hits in E.linked(x, x, x @ turned, x @ turned, threshold)])
        assert (got == want).all()

"""K-Means in fixed point: equal for every layout, equal to plain Python steps."""

import math
import random
from fractions import Fraction

import pytest

from basketry.operators import kmeans as km

COLS = ("r", "p")


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "id int, r int, p int").repartition(parts)


def blobs(seed=1, n=400):
    rng = random.Random(seed)
    return [(i, int(rng.gauss(*rng.choice([(0, 9), (300, 20), (900, 40)]))), max(1, int(rng.gauss(5, 3)))) for i in range(n)]


def plain(rows, scale, centers, max_iter):
    unit = [[math.floor((v - m) / s * km.UNIT + .5) if s else 0 for v, m, s in zip(r[1:], scale.mean, scale.std)] for r in rows]
    centers = [list(c) for c in centers]

    def near(z):
        return min((sum((a - b) ** 2 for a, b in zip(z, c)), j) for j, c in enumerate(centers))

    for _ in range(max_iter):
        own, new = [near(z)[1] for z in unit], []
        for j, c in enumerate(centers):
            mine = [z for z, o in zip(unit, own) if o == j]
            new.append([math.floor(Fraction(sum(x), len(mine)) + Fraction(1, 2)) for x in zip(*mine)] if mine else c)
        if new == centers:
            break
        centers = new
    return [tuple(c) for c in centers], [near(z)[1] for z in unit], sum(near(z)[0] for z in unit) / km.UNIT ** 2


def test_centres_do_not_depend_on_layout(spark):
    rows = blobs()
    fits = [km.fit_all(frame(spark, rows[::step], parts), [2, 3, 5], COLS) for parts, step in ((1, 1), (4, -1), (8, 1))]
    assert fits[0] == fits[1] == fits[2]


def test_equals_plain_steps_from_the_same_seeds(spark):
    rows = blobs(2)
    df = frame(spark, rows)
    scale = km.scale_of(df, COLS)
    first = km.seeds(km.points(df, scale), 2, 4)
    assert len(set(first)) == 4
    model = km.fit(df, 4, COLS)
    centers, labels, cost = plain(rows, scale, first, 20)
    assert list(model.centers) == centers and model.cost == pytest.approx(cost, abs=1e-9)
    assert {r.id: r.Cluster for r in km.assign(df, model).collect()} == {r[0]: j for r, j in zip(rows, labels)}
    assert km.checks(km.assign(df, model), model).first().Mal_Asignados == 0
    assert sum(model.sizes) == len(rows) and model.sizes == tuple(labels.count(j) for j in range(4))


def test_seeds_of_fewer_clusters_come_first(spark):
    df = frame(spark, blobs(3))
    pts = km.points(df, km.scale_of(df, COLS))
    cand = km.candidates(pts, 2, 5, 42)
    assert len(cand) == len(set(cand)) == 1 + 2 * 5 * km.ROUNDS
    fits = km.fit_all(df, [2, 5], COLS, max_iter=0)
    assert fits[5].centers[:2] == fits[2].centers


def test_planted_blobs_are_found(spark):
    rows = [(i, x + i % 3, y + i % 2) for i, (x, y) in enumerate([(0, 0), (1000, 0), (0, 1000), (1000, 1000)] * 30)]
    model = km.fit(frame(spark, rows), 4, COLS)
    got = {r.id: r.Cluster for r in km.assign(frame(spark, rows), model).collect()}
    assert len({(i % 4, j) for i, j in got.items()}) == 4
    assert km.silhouette(frame(spark, rows), model).first().Silhouette > 0.99


def test_constant_features_nulls_few_points_and_none(spark):
    rows = [(0, 7, 1), (1, 7, 2), (2, 7, 1), (3, None, 4)]
    df = frame(spark, rows)
    model = km.fit(df, 4, COLS)
    assert len(model.centers) == 2 and model.cost == 0  # two distinct points, two clusters
    got = {r.id: r.Cluster for r in km.assign(df, model).collect()}
    assert got[0] == got[2] != got[1] and got[3] is None
    none = frame(spark, [])
    model = km.fit(none, 4, COLS)
    assert model.centers == () and km.assign(none, model).count() == 0
    assert km.silhouette(none, model).first().Clientes == 0


def test_silhouette_equals_brute_force(spark):
    rows = blobs(4, 90)
    df = frame(spark, rows)
    model = km.fit(df, 3, COLS)
    lab = {r.id: r.Cluster for r in km.assign(df, model).collect()}
    z = {r[0]: [(v - m) / s for v, m, s in zip(r[1:], model.scale.mean, model.scale.std)] for r in rows}
    total = 0.0
    for i in z:
        far = {}
        for j in z:
            if i != j:
                far.setdefault(lab[j], []).append(sum((a - b) ** 2 for a, b in zip(z[i], z[j])))
        a = sum(far[lab[i]]) / len(far[lab[i]]) if lab[i] in far else None
        b = min(sum(v) / len(v) for j, v in far.items() if j != lab[i])
        total += 0 if a is None else (b - a) / max(a, b)
    assert km.silhouette(df, model).first().Silhouette == pytest.approx(total / len(z), abs=2e-5)

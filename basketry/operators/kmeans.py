"""K-Means whose result does not depend on how the data lie.

MLlib's fit draws its seeds per partition and adds doubles in arrival order, so labels
and costs change with the layout.  Here every step is exact or decided by content:

* Features are standardised with a mean and a deviation from exact decimal sums and
  held as whole numbers of 1 / ``UNIT`` (fixed point).  Rows with equal features
  become one weighted point, counted once, and every later pass reads those points only.
* Seeds: k-means|| with races in place of random draws.  In a round each point's key
  is -ln(u) / (weight * squared distance to the nearest candidate), u being a hash of the
  point and the round; the ``2 k`` smallest keys are a weighted draw without
  replacement, the same one wherever the rows stand.  The candidates (at most
  1 + 2 k * rounds) are weighted by the points next to them and reduced to k by the same
  race (k-means++).  The seeds of fewer clusters are the first of those of more.
* Steps: squared distances are whole numbers, ties go to the smallest index, sums are
  decimals of 38 digits, centres are rounded to whole units.  All numbers of clusters that
  are wanted are fitted in one pass per step; one row per cluster reaches the driver.
  A cluster without points keeps its centre.  Steps end when no centre moves.

Whole-number overflow raises an error (ANSI arithmetic): it takes a deviation of 10^3
standard deviations.  Rows with a null feature take no part in the fit and get a null
cluster.  Fewer distinct points than clusters give as many clusters as points.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.labels import rnd

UNIT = 1_000_000
ROUNDS = 2
Center = tuple[int, ...]


@dataclass(frozen=True)
class Scale:
    cols: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]


@dataclass(frozen=True)
class Fit:
    scale: Scale
    centers: tuple[Center, ...]  # whole units in z-space
    sizes: tuple[int, ...]
    cost: float
    steps: int


# ---------------------------------------------------------------- points
def scale_of(rf: DataFrame, cols) -> Scale:
    """Mean and sample deviation of each feature from exact sums (features to four decimals)."""
    d = {c: F.col(c).cast("decimal(16,4)") for c in cols}
    known = rf.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    row = known.agg(F.count(F.lit(1)).alias("n"), *[F.sum(d[c]).alias(f"s{i}") for i, c in enumerate(cols)],
                    *[F.sum(d[c] * d[c]).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    n, mean, std = row["n"], [], []
    for i in range(len(cols)):
        s, q = Fraction(row[f"s{i}"] or 0), Fraction(row[f"q{i}"] or 0)
        mean.append(float(s / n) if n else 0.0)
        std.append(math.sqrt((n * q - s * s) / (n * (n - 1))) if n > 1 else 0.0)
    return Scale(tuple(cols), tuple(mean), tuple(std))


def _units(scale: Scale) -> list[Column]:
    """Each feature in whole units of its z-score; a constant feature is 0."""
    out = []
    for c, m, s in zip(scale.cols, scale.mean, scale.std):
        z = (F.col(c).cast("double") - F.lit(m)) / F.lit(s) if s > 0 else F.col(c).cast("double") * F.lit(0.0)
        out.append(F.floor(z * F.lit(float(UNIT)) + F.lit(0.5)).cast("long"))
    return out


def points(rf: DataFrame, scale: Scale) -> DataFrame:
    """Distinct points z0, z1, ... with their weight w."""
    z = [u.alias(f"z{i}") for i, u in enumerate(_units(scale))]
    return rf.select(*z).na.drop().groupBy(*[f"z{i}" for i in range(len(z))]).agg(F.count(F.lit(1)).alias("w"))


def _z(dims: int) -> list[Column]:
    return [F.col(f"z{i}") for i in range(dims)]


def _squared(z: list[Column], center: Center) -> Column:
    return reduce(lambda a, b: a + b, [(x - F.lit(int(c))) * (x - F.lit(int(c))) for x, c in zip(z, center)])


def _nearest(dims: int, centers) -> str:
    """SQL text of struct(d, j): squared distance to the nearest centre, and its index (ties: the smallest).

    The centres are one array constant, so the steps of a fit share their generated code.
    """
    table = ", ".join("struct(" + ", ".join(f"{int(v)}L AS c{i}" for i, v in enumerate(c)) + f", {j} AS j)"
                      for j, c in enumerate(centers))
    far = " + ".join(f"(z{i} - c.c{i}) * (z{i} - c.c{i})" for i in range(dims))
    return f"array_min(transform(array({table}), c -> struct({far} AS d, c.j AS j)))"


def _nearest_unrolled(z: list[Column], centers) -> Column:
    """The same for one pass over many rows: the centres are written into the generated code."""
    return F.array_min(F.array(*[F.struct(_squared(z, c).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(centers)]))


# ---------------------------------------------------------------- seeds
def _race(z: list[Column], seed: int, tag: str, weight: Column) -> Column:
    """Key of an exponential race: the smallest keys are a draw by ``weight``."""
    text = F.concat_ws(":", F.lit(f"{seed}:{tag}"), *z)
    u = (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(2.0 ** 32)
    return -F.log(u) / weight


def candidates(pts: DataFrame, dims: int, k: int, seed: int, rounds: int = ROUNDS) -> list[Center]:
    """k-means||: the first winner by weight, then 2 k winners a round by weight times squared distance."""
    z, w = _z(dims), F.col("w").cast("double")

    def winners(frame, key, n):
        rows = frame.select(*z, key.alias("_key")).orderBy("_key", *[f"z{i}" for i in range(dims)]).limit(n).collect()
        return [tuple(r[:dims]) for r in rows]

    found = winners(pts, _race(z, seed, "0", w), 1)
    for r in range(1, rounds + 1):
        if not found:
            break
        far = pts.withColumn("_d", F.expr(_nearest(dims, found))["d"]).where(F.col("_d") > 0)
        found += winners(far, _race(z, seed, str(r), w * F.col("_d").cast("double")), 2 * k)
    return found


def seeds(pts: DataFrame, dims: int, k: int, seed: int = 42, rounds: int = ROUNDS) -> list[Center]:
    """At most ``k`` seeds, the seeds of fewer clusters being the first of these."""
    cand = candidates(pts, dims, k, seed, rounds)
    if not cand:
        return []
    z = _z(dims)
    weight = {r["j"]: r["w"] for r in pts.select(F.expr(_nearest(dims, cand))["j"].alias("j"), "w").groupBy("j")
              .agg(F.sum("w").alias("w")).collect()}  # one row per candidate
    spark = pts.sparkSession
    # the candidates as a small frame: the race is computed by the same functions as above
    small = spark.createDataFrame([(j, float(weight.get(j, 0)), *c) for j, c in enumerate(cand)],
                                  "j int, w double, " + ", ".join(f"z{i} long" for i in range(dims)))
    u = {r["j"]: [r[f"u{s}"] for s in range(k)] for r in small.select(
        "j", *[_race(z, seed, f"s{s}", F.lit(1.0)).alias(f"u{s}") for s in range(k)]).collect()}
    chosen: list[int] = []
    for s in range(k):
        best = None
        for j, c in enumerate(cand):
            d = min((sum((a - b) ** 2 for a, b in zip(c, cand[i])) for i in chosen), default=1)
            mass = float(weight.get(j, 0)) * float(d)
            if mass > 0 and (best is None or (u[j][s] / mass, j) < best):
                best = (u[j][s] / mass, j)
        if best is None:
            break
        chosen.append(best[1])
    return [cand[j] for j in chosen]


# ---------------------------------------------------------------- steps
def _sums(pts: DataFrame, dims: int, fits: list[list[Center]], cost: bool = False) -> dict[tuple[int, int], tuple]:
    """(fit, cluster) -> (points' weight, sum of each unit, with ``cost`` the sum of squared distances), all exact;
    a row per cluster."""
    z = _z(dims)
    w = F.col("w").cast("decimal(18,0)")
    each = ", ".join(f"struct({g} AS g, {_nearest(dims, centers)} AS n)" for g, centers in enumerate(fits))
    flat = pts.select("w", *z, F.expr(f"explode(array({each}))").alias("a")).select("w", *z, "a.g", "a.n.j", "a.n.d")
    rows = flat.groupBy("g", "j").agg(
        F.sum("w").alias("n"), *[F.sum(w * x.cast("decimal(19,0)")).alias(f"s{i}") for i, x in enumerate(z)],
        *([F.sum(w * F.col("d").cast("decimal(19,0)")).alias("c")] if cost else [])).collect()
    return {(r["g"], r["j"]): (r["n"], [int(r[f"s{i}"]) for i in range(dims)], int(r["c"]) if cost else 0) for r in rows}


def fit_all(rf: DataFrame, ks, cols, seed: int = 42, max_iter: int = 20, rounds: int = ROUNDS,
            stage: Callable[[DataFrame, str], DataFrame] | None = None) -> dict[int, Fit]:
    """One fit per number of clusters, all in the same passes over the weighted points.

    ``stage`` (frame, name -> frame) writes the points once; without it they are kept in memory
    and on disk while the fits run.
    """
    ks, scale, dims = sorted(ks), scale_of(rf, cols), len(cols)
    # every step is a job over the points: at least one partition per core
    pts = points(rf, scale).repartition(rf.sparkSession.sparkContext.defaultParallelism, *[f"z{i}" for i in range(dims)])
    pts = stage(pts, "points") if stage else pts.persist()
    try:
        first = seeds(pts, dims, max(ks), seed, rounds)
        fits, steps = [first[:k] for k in ks], 0
        open_fits = [g for g, c in enumerate(fits) if c]
        while open_fits and steps < max_iter:
            got = _sums(pts, dims, [fits[g] for g in open_fits])
            moved = []
            for at, g in enumerate(open_fits):
                new = [tuple((2 * s + got[at, j][0]) // (2 * got[at, j][0]) for s in got[at, j][1]) if (at, j) in got else c
                       for j, c in enumerate(fits[g])]
                if new != fits[g]:
                    fits[g] = new
                    moved.append(g)
            open_fits, steps = moved, steps + 1
        full = [g for g, c in enumerate(fits) if c]
        last = _sums(pts, dims, [fits[g] for g in full], cost=True) if full else {}
        out = {}
        for g, k in enumerate(ks):
            mine = [last.get((full.index(g), j), (0, [], 0)) if g in full else (0, [], 0) for j in range(len(fits[g]))]
            out[k] = Fit(scale, tuple(fits[g]), tuple(m[0] for m in mine), sum(m[2] for m in mine) / UNIT ** 2, steps)
        return out
    finally:
        if not stage:
            pts.unpersist()


def fit(rf: DataFrame, k: int = 4, cols=(), seed: int = 42, max_iter: int = 20, stage=None) -> Fit:
    return fit_all(rf, [k], cols, seed, max_iter, stage=stage)[k]


# ---------------------------------------------------------------- results
def assign(rf: DataFrame, model: Fit, out: str = "Cluster") -> DataFrame:
    """``rf`` plus the index of the nearest centre: a map over the rows, no shuffle."""
    if not model.centers:
        return rf.withColumn(out, F.lit(None).cast("int"))
    names = [f"_u{i}" for i in range(len(model.scale.cols))]
    units = rf.withColumns(dict(zip(names, _units(model.scale))))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    return units.withColumn(out, F.when(known, _nearest_unrolled([F.col(c) for c in names], model.centers)["j"])).drop(*names)


def elbow(rf: DataFrame, ks, cols, seed: int = 42, max_iter: int = 20, stage=None) -> DataFrame:
    """Cost (sum of squared z-distances to the own centre) for each number of clusters."""
    fits = fit_all(rf, ks, cols, seed, max_iter, stage=stage)
    cost = rnd("Costo", 4).alias("Costo")
    return rf.sparkSession.createDataFrame([(k, f.cost) for k, f in fits.items()], "K int, Costo double").select("K", cost)


def centroids(spark, model: Fit) -> DataFrame:
    """Centres in original units (centre * deviation + mean); one row per cluster."""
    s = model.scale
    rows = [(j, *[float(c) / UNIT * d + m for c, m, d in zip(center, s.mean, s.std)])
            for j, center in enumerate(model.centers)]
    out = spark.createDataFrame(rows, "Cluster int, " + ", ".join(f"`{c}` double" for c in s.cols))
    return out.select("Cluster", *[rnd(c, 6).alias(c) for c in s.cols])


def silhouette(rf: DataFrame, model: Fit) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, in the same fixed point: rows, Clientes and Silhouette.

    A point's mean squared distance to a cluster follows from the cluster's size, sum and sum of squares, so one
    row per cluster meets each weighted point.  A point alone in its cluster counts 0.
    """
    dims, spark = len(model.scale.cols), rf.sparkSession
    z = _z(dims)
    pts = points(rf, model.scale)
    if not model.centers:
        return spark.createDataFrame([(0, None)], "Clientes long, Silhouette double")
    got = pts.select("w", *z, F.expr(_nearest(dims, model.centers))["j"].alias("j")).groupBy("j").agg(
        F.sum("w").alias("n"), *[F.sum(F.col("w").cast("decimal(18,0)") * x.cast("decimal(19,0)")).alias(f"s{i}")
                                 for i, x in enumerate(z)],
        F.sum(F.col("w").cast("decimal(18,0)") * _squared(z, (0,) * dims).cast("decimal(19,0)")).alias("q")).collect()
    sq = _squared(z, (0,) * dims).cast("double")
    own, table = F.col("_j"), {r["j"]: r for r in got}

    def total(r):
        dot = reduce(lambda a, b: a + b, [F.lit(float(r[f"s{i}"])) * x.cast("double") for i, x in enumerate(z)])
        return F.lit(float(r["n"])) * sq + F.lit(float(r["q"])) - F.lit(2.0) * dot

    def at_own(value):
        out = F.lit(None).cast("double")
        for j, r in table.items():
            out = F.when(own == j, value(j, r)).otherwise(out)
        return out

    a = at_own(lambda j, r: F.try_divide(total(r), F.lit(float(r["n"] - 1))))
    b = at_own(lambda j, r: F.array_min(F.array(F.lit(None).cast("double"), *[
        total(x) / F.lit(float(x["n"])) for i, x in table.items() if i != j])))
    n_own = at_own(lambda j, r: F.lit(float(r["n"])))
    s = F.when(F.col("_n") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")),
                                                           F.lit(0.0)))
    each = pts.withColumn("_j", F.expr(_nearest(dims, model.centers))["j"]).select("w", a.alias("_a"), b.alias("_b"), n_own.alias("_n"))
    whole = F.floor(s * F.lit(1e9) + F.lit(0.5)).cast("decimal(19,0)") * F.col("w").cast("decimal(18,0)")
    return each.agg(F.sum("w").alias("Clientes"), F.sum(whole).alias("_s")).select(
        F.coalesce("Clientes", F.lit(0)).cast("long").alias("Clientes"),
        rnd(F.col("_s").cast("double") / F.lit(1e9) / F.col("Clientes").cast("double"), 6).alias("Silhouette"))


def checks(labelled: DataFrame, model: Fit) -> DataFrame:
    """Facts that any right fit has: rows with a strictly nearer centre (0), rows, and clusters used."""
    units = labelled.withColumns({f"z{i}": u for i, u in enumerate(_units(model.scale))})
    z = _z(len(model.scale.cols))
    all_d = F.array(*[_squared(z, c) for c in model.centers])
    return units.withColumn("_d", all_d).agg(
        F.sum(F.when(F.array_min("_d") < F.element_at("_d", F.col("Cluster") + 1), 1).otherwise(0)).alias("Mal_Asignados"),
        F.count(F.lit(1)).alias("Clientes"), F.count_distinct("Cluster").alias("Clusters"))

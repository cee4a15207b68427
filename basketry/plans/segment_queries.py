"""Registered segmentation queries (scaling, K-Means, profiles, labels)."""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from basketry.functions.labels import rnd
from basketry.operators import basket as bk
from basketry.operators import kmeans as km
from basketry.operators import profile as pf
from basketry.operators import segment as sg
from basketry.plans import facts
from basketry.plans.basket_queries import _MINING_CTES
from basketry.plans.facts import sales
from basketry.plans.registry import register, with_sales
from basketry.plans.session import fresh_path

K, SEED, MAX_ITER = 4, 42, 20
ELBOW_KS = range(2, 7)
# Given centres in z-space for the exact assignment test.
FIXED_CENTERS = ((-1.0, -0.5), (-1.0, 1.0), (1.0, -0.5), (1.0, 1.0))

_LOCK = threading.RLock()
_FITS: dict = {}


def _rf(spark, sf):
    return facts.rf_facts(spark, sf)


_Z_CTES = (
    """rf AS (SELECT ID_Tienda, ID_Transaccion,
      CAST(date_diff('day', max(Fecha), (SELECT max(Fecha) + 1 FROM sales)) AS INTEGER) AS Recencia_Dias,
      count(*) AS Productos_Comprados FROM sales GROUP BY ID_Tienda, ID_Transaccion)""",
    """z AS (SELECT *, (Recencia_Dias - (SELECT avg(Recencia_Dias) FROM rf)) / (SELECT stddev_samp(Recencia_Dias) FROM rf)
          AS zr, (Productos_Comprados - (SELECT avg(Productos_Comprados) FROM rf))
          / (SELECT stddev_samp(Productos_Comprados) FROM rf) AS zp FROM rf)""",
)


def _dist(j: int) -> str:
    cr, cp = FIXED_CENTERS[j]
    return f"((zr - ({cr})) * (zr - ({cr})) + (zp - ({cp})) * (zp - ({cp})))"


_ASSIGN_CTE = f"""asg AS (SELECT *, CAST(CASE
      WHEN {_dist(0)} <= {_dist(1)} AND {_dist(0)} <= {_dist(2)} AND {_dist(0)} <= {_dist(3)} THEN 0
      WHEN {_dist(1)} <= {_dist(2)} AND {_dist(1)} <= {_dist(3)} THEN 1
      WHEN {_dist(2)} <= {_dist(3)} THEN 2 ELSE 3 END AS INTEGER) AS Cluster FROM z)"""
_PROFILE_CTE = """prof AS (SELECT Cluster, count(*) AS Num_Clientes, round(avg(Recencia_Dias), 2) AS Recencia_Media,
      round(quantile_cont(Recencia_Dias, 0.5), 2) AS Recencia_Mediana,
      round(avg(Productos_Comprados), 2) AS Productos_Media,
      round(quantile_cont(Productos_Comprados, 0.5), 2) AS Productos_Mediana FROM asg GROUP BY Cluster)"""


@register("scaled_features", with_sales(*_Z_CTES, select="""
SELECT ID_Tienda, ID_Transaccion, round(zr, 6) AS Z_Recencia_Dias, round(zp, 6) AS Z_Productos_Comprados FROM z"""),
          "J6")
def scaled_features(spark, sf):
    _, scaled = sg.scale(_rf(spark, sf))
    z = sg.zscores(scaled)
    return z.select("ID_Tienda", "ID_Transaccion", *[rnd(f"Z_{c}", 6).alias(f"Z_{c}") for c in sg.FEATURES])


@register("assign_fixed_centroids", with_sales(*_Z_CTES, _ASSIGN_CTE, select="""
SELECT ID_Tienda, ID_Transaccion, Cluster FROM asg"""), "J13")
def assign_fixed_centroids(spark, sf):
    return sg.assign(_rf(spark, sf), FIXED_CENTERS).select("ID_Tienda", "ID_Transaccion", "Cluster")


@register("cluster_profile_fixed", with_sales(*_Z_CTES, _ASSIGN_CTE, _PROFILE_CTE, select="SELECT * FROM prof"),
          "J9")
def cluster_profile_fixed(spark, sf):
    return sg.cluster_profile(sg.assign(_rf(spark, sf), FIXED_CENTERS))


_ADVICE_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sg.ADVICE.items())
_R, _U, _N = sg.DASHBOARD_RULE


_LABEL_SELECT = f"""
SELECT *, CASE Segmento {_ADVICE_SQL} END AS Accion FROM (SELECT *, CASE
    WHEN Recencia_Media < {_R} AND Productos_Media > {_U} THEN '{_N[0]}'
    WHEN Recencia_Media < {_R} AND Productos_Media <= {_U} THEN '{_N[1]}'
    WHEN Recencia_Media >= {_R} AND Productos_Media > {_U} THEN '{_N[2]}'
    ELSE '{_N[3]}' END AS Segmento FROM prof) x"""


@register("segment_labels", with_sales(*_Z_CTES, _ASSIGN_CTE, _PROFILE_CTE, select=_LABEL_SELECT), "J10 L6")
def segment_labels(spark, sf):
    return sg.label_clusters(sg.cluster_profile(sg.assign(_rf(spark, sf), FIXED_CENTERS)))


# ------------------------------------------------------------- fitted K-Means, in SQL as well
_MAX_K = max(ELBOW_KS)


def _race_sql(tag: str, weight: str) -> str:
    u = f"(CAST('0x' || substr(md5('{SEED}:{tag}:' || x || ':' || y), 1, 8) AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4294967296.0::DOUBLE"
    return f"(-ln({u}) / CAST({weight} AS DOUBLE))"


_SQ = "((p.x - c.{0}) * (p.x - c.{0}) + (p.y - c.{1}) * (p.y - c.{1}))"


def _kmeans_ctes(ks) -> list[str]:
    """The whole fit: fixed-point z-scores, weighted points, k-means|| races, k-means++ over the candidates, Lloyd steps."""
    k, rounds = max(ks), km.ROUNDS
    out = [_Z_CTES[0],
        """st AS (SELECT CAST(count(*) AS HUGEINT) AS n, CAST(sum(Recencia_Dias) AS HUGEINT) AS sr,
          CAST(sum(CAST(Recencia_Dias AS HUGEINT) * Recencia_Dias) AS HUGEINT) AS qr, CAST(sum(Productos_Comprados) AS HUGEINT) AS sp,
          CAST(sum(CAST(Productos_Comprados AS HUGEINT) * Productos_Comprados) AS HUGEINT) AS qp FROM rf)""",
        """sc AS (SELECT CAST(sr AS DOUBLE) / CAST(n AS DOUBLE) AS mr, CAST(sp AS DOUBLE) / CAST(n AS DOUBLE) AS mp,
          sqrt(CAST(n * qr - sr * sr AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) AS dr,
          sqrt(CAST(n * qp - sp * sp AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) AS dp FROM st)""",
        f"""fz AS (SELECT rf.*, CAST(floor((Recencia_Dias - mr) / dr * {km.UNIT}.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS x,
          CAST(floor((Productos_Comprados - mp) / dp * {km.UNIT}.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS y FROM rf, sc)""",
        "pts AS (SELECT x, y, CAST(count(*) AS BIGINT) AS w FROM fz GROUP BY x, y)",
        f"cand0 AS (SELECT x, y, CAST(0 AS BIGINT) AS j FROM pts ORDER BY {_race_sql('0', 'w')}, x, y LIMIT 1)"]
    for r in range(1, rounds + 1):
        before = " UNION ALL ".join(f"SELECT * FROM cand{i}" for i in range(r))
        out += [f"far{r} AS (SELECT p.x, p.y, p.w, min({_SQ.format('x', 'y')}) AS d FROM pts p, ({before}) c GROUP BY ALL)",
                f"""cand{r} AS (SELECT x, y, {1 + 2 * k * (r - 1)} - 1 + row_number() OVER (ORDER BY key, x, y) AS j FROM (
          SELECT x, y, {_race_sql(str(r), 'w::DOUBLE * d::DOUBLE')} AS key FROM far{r} WHERE d > 0 ORDER BY key, x, y LIMIT {2 * k}))"""]
    out += ["cand AS (" + " UNION ALL ".join(f"SELECT * FROM cand{i}" for i in range(rounds + 1)) + ")",
            f"""cw AS (SELECT cand.j, cand.x, cand.y, CAST(sum(w) AS DOUBLE) AS w FROM cand JOIN (
          SELECT w, c.j, row_number() OVER (PARTITION BY p.x, p.y ORDER BY {_SQ.format('x', 'y')}, c.j) AS o FROM pts p, cand c) t
          ON t.j = cand.j AND o = 1 GROUP BY ALL)""",
            f"seed0 AS (SELECT x, y, 0 AS s FROM cw ORDER BY {_race_sql('s0', 'w')}, j LIMIT 1)"]
    for i in range(1, k):
        before = " UNION ALL ".join(f"SELECT * FROM seed{m}" for m in range(i))
        out.append(f"""seed{i} AS (SELECT x, y, {i} AS s FROM (
          SELECT p.x, p.y, p.j, p.w, min({_SQ.format('x', 'y')}) AS d FROM cw p, ({before}) c GROUP BY ALL)
          WHERE d > 0 ORDER BY {_race_sql(f's{i}', 'w * d::DOUBLE')}, j LIMIT 1)""")
    near = _SQ.format("cx", "cy")
    new = ("(({0} * 2 + n) - ((({0} * 2 + n) % (2 * n)) + 2 * n) % (2 * n)) // (2 * n)").format
    out += ["seeds AS (" + " UNION ALL ".join(f"SELECT * FROM seed{m}" for m in range(k)) + ")",
            f"""lloyd(it, K, j, cx, cy) AS (
          SELECT 0, K, s, x, y FROM seeds, (VALUES {', '.join(f'({x})' for x in ks)}) v(K) WHERE s < K
          UNION ALL
          SELECT it + 1, K, j, CASE WHEN n = 0 THEN cx ELSE CAST({new('sx')} AS BIGINT) END,
                 CASE WHEN n = 0 THEN cy ELSE CAST({new('sy')} AS BIGINT) END
          FROM (SELECT it, K, j, cx, cy, CAST(sum(CASE WHEN o = 1 THEN w ELSE 0 END) AS HUGEINT) AS n,
                       CAST(sum(CASE WHEN o = 1 THEN CAST(w AS HUGEINT) * x ELSE 0 END) AS HUGEINT) AS sx,
                       CAST(sum(CASE WHEN o = 1 THEN CAST(w AS HUGEINT) * y ELSE 0 END) AS HUGEINT) AS sy
                FROM (SELECT c.*, p.x, p.y, p.w, row_number() OVER (PARTITION BY c.K, p.x, p.y ORDER BY {near}, c.j) AS o
                      FROM lloyd c, pts p) GROUP BY it, K, j, cx, cy) WHERE it < {MAX_ITER})""",
            f"""own AS (SELECT * FROM (SELECT p.x, p.y, p.w, c.K, c.j, {near} AS d,
          row_number() OVER (PARTITION BY c.K, p.x, p.y ORDER BY {near}, c.j) AS o FROM pts p, (SELECT * FROM lloyd WHERE it = {MAX_ITER}) c)
          WHERE o = 1)"""]
    return out


_LABELLED_CTE = "asg AS (SELECT fz.*, CAST(own.j AS INTEGER) AS Cluster FROM fz JOIN own USING (x, y))"


def _kmeans_sql(*ctes: str, select: str, ks=(K,)) -> str:
    return with_sales(*_kmeans_ctes(ks), *ctes, select=select).replace("WITH", "WITH RECURSIVE", 1)


def _stage(spark):
    def stage(df, name):
        path = fresh_path(spark, f"kmeans-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return stage


def _fit(spark, sf):
    """K-Means fitted once per session; labelled rows written to scratch."""
    key = facts._key(spark, sf)
    with _LOCK:
        hit = _FITS.get(key)
        if hit is None:
            rf = _rf(spark, sf)
            model = km.fit(rf, K, sg.FEATURES, SEED, MAX_ITER, _stage(spark))
            path = fresh_path(spark, "clusters")
            km.assign(rf, model).write.parquet(path)
            hit = (model, path)
            _FITS[key] = hit
    model, path = hit
    return model, spark.read.parquet(path)


@register("kmeans_elbow", _kmeans_sql(ks=tuple(ELBOW_KS), select=f"""
SELECT CAST(K AS INTEGER) AS K, round(CAST(sum(CAST(w AS HUGEINT) * d) AS DOUBLE) / {km.UNIT ** 2}.0::DOUBLE, 4) AS Costo
FROM own GROUP BY K"""), "J7")
def kmeans_elbow(spark, sf):
    return km.elbow(_rf(spark, sf), ELBOW_KS, sg.FEATURES, SEED, MAX_ITER, _stage(spark))


@register("kmeans_clusters", _kmeans_sql(_LABELLED_CTE, select="""
SELECT ID_Tienda, ID_Transaccion, Recencia_Dias, Productos_Comprados, Cluster FROM asg"""), "J8")
def kmeans_clusters(spark, sf):
    _, clustered = _fit(spark, sf)
    return clustered.select("ID_Tienda", "ID_Transaccion", *sg.FEATURES, "Cluster")


@register("cluster_profile", _kmeans_sql(_LABELLED_CTE, _PROFILE_CTE, select=_LABEL_SELECT), "J9")
def cluster_profile(spark, sf):
    _, clustered = _fit(spark, sf)
    return sg.label_clusters(sg.cluster_profile(clustered))


@register("kmeans_centroids", _kmeans_sql(select=f"""
SELECT CAST(j AS INTEGER) AS Cluster, round(cx::DOUBLE / {km.UNIT}.0::DOUBLE * dr + mr, 6) AS Recencia_Dias,
       round(cy::DOUBLE / {km.UNIT}.0::DOUBLE * dp + mp, 6) AS Productos_Comprados
FROM lloyd, sc WHERE it = {MAX_ITER}"""), "J11")
def kmeans_centroids(spark, sf):
    model, _ = _fit(spark, sf)
    return km.centroids(spark, model)


@register("kmeans_silhouette", _kmeans_sql(
    """cl AS (SELECT j, CAST(sum(w) AS DOUBLE) AS n, CAST(sum(CAST(w AS HUGEINT) * x) AS DOUBLE) AS sx,
          CAST(sum(CAST(w AS HUGEINT) * y) AS DOUBLE) AS sy, CAST(sum(CAST(w AS HUGEINT) * (x * x + y * y)) AS DOUBLE) AS q
          FROM own GROUP BY j)""",
    """d AS (SELECT own.x, own.y, own.w, cl.j = own.j AS mine, cl.n,
          cl.n * CAST(own.x * own.x + own.y * own.y AS DOUBLE) + cl.q - 2.0::DOUBLE * (cl.sx * own.x::DOUBLE + cl.sy * own.y::DOUBLE) AS t
          FROM own, cl)""",
    """ab AS (SELECT x, y, w, max(CASE WHEN mine THEN n END) AS n, max(CASE WHEN mine THEN t / nullif(n - 1, 0) END) AS a,
          min(CASE WHEN NOT mine THEN t / n END) AS b FROM d GROUP BY x, y, w)""",
    select=f"""SELECT {K} AS K, round(CAST(sum(CAST(w AS HUGEINT) * CAST(floor(s * 1e9::DOUBLE + 0.5::DOUBLE) AS BIGINT)) AS DOUBLE)
       / 1e9::DOUBLE / CAST(sum(w) AS DOUBLE), 6) AS Silhouette
FROM (SELECT w, CASE WHEN n = 1 THEN 0.0::DOUBLE ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0::DOUBLE) END AS s FROM ab)"""), "J12")
def kmeans_silhouette(spark, sf):
    model, _ = _fit(spark, sf)
    return km.silhouette(_rf(spark, sf), model).select(F.lit(K).alias("K"), "Silhouette")


@register("cluster_points", with_sales(*_Z_CTES, _ASSIGN_CTE, select="""
SELECT ID_Tienda, ID_Transaccion, Recencia_Dias, Productos_Comprados, Cluster FROM asg"""), "J14")
def cluster_points(spark, sf):
    return sg.cluster_points(sg.assign(_rf(spark, sf), FIXED_CENTERS))


@register("cluster_points_fitted", _kmeans_sql(_LABELLED_CTE, select="""
SELECT ID_Tienda, ID_Transaccion, Recencia_Dias, Productos_Comprados, Cluster FROM asg"""), "J14")
def cluster_points_fitted(spark, sf):
    _, clustered = _fit(spark, sf)
    return sg.cluster_points(clustered)


@register("cluster_cost_fixed", with_sales(*_Z_CTES, _ASSIGN_CTE, select="SELECT Cluster, count(*) AS Num_Clientes, round(sum(CASE Cluster "
    + " ".join(f"WHEN {j} THEN {_dist(j)}" for j in range(4)) + " END), 4) AS Costo FROM asg GROUP BY Cluster"), "J7")
def cluster_cost_fixed(spark, sf):
    return sg.cluster_cost(sg.assign(_rf(spark, sf), FIXED_CENTERS), FIXED_CENTERS)


@register("centroids_fixed", with_sales(*_Z_CTES, select="""
SELECT CAST(c.k AS INTEGER) AS Cluster, round(c.r * (SELECT stddev_samp(Recencia_Dias) FROM rf) + (SELECT avg(Recencia_Dias) FROM rf), 6)
         AS Recencia_Dias,
       round(c.p * (SELECT stddev_samp(Productos_Comprados) FROM rf) + (SELECT avg(Productos_Comprados) FROM rf), 6)
         AS Productos_Comprados FROM (VALUES """ + ", ".join(f"({j}, {r}::DOUBLE, {p}::DOUBLE)" for j, (r, p) in enumerate(FIXED_CENTERS))
    + ") c(k, r, p)"), "J11")
def centroids_fixed(spark, sf):
    return sg.unscale(_rf(spark, sf), FIXED_CENTERS)


@register("silhouette_fixed", with_sales(*_Z_CTES, _ASSIGN_CTE,
    """cl AS (SELECT Cluster, CAST(count(*) AS DOUBLE) AS n, sum(zr) AS sr, sum(zp) AS sp, sum(zr * zr + zp * zp) AS q
          FROM asg GROUP BY Cluster)""",
    """d AS (SELECT a.ID_Tienda, a.ID_Transaccion, cl.Cluster = a.Cluster AS own, cl.n,
          (cl.n * (a.zr * a.zr + a.zp * a.zp) + cl.q - 2 * (cl.sr * a.zr + cl.sp * a.zp)) AS t FROM asg a, cl)""",
    """ab AS (SELECT max(CASE WHEN own THEN n END) AS n, max(CASE WHEN own THEN t / nullif(n - 1, 0) END) AS a,
          min(CASE WHEN NOT own THEN t / n END) AS b FROM d GROUP BY ID_Tienda, ID_Transaccion)""",
    select="""SELECT count(*) AS Clientes, round(avg(CASE WHEN n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END), 6)
       AS Silhouette FROM ab"""), "J12")
def silhouette_fixed(spark, sf):
    return sg.silhouette_native(sg.assign(_rf(spark, sf), FIXED_CENTERS))


@register("kmeans_checks", with_sales(select=f"""
SELECT CAST(0 AS BIGINT) AS Mal_Asignados, count(*) AS Clientes, CAST({K} AS BIGINT) AS Clusters FROM baskets"""), "J8")
def kmeans_checks(spark, sf):
    model, clustered = _fit(spark, sf)
    return km.checks(clustered, model)


def _top(stage: str, text: str, value: str, source: str, n: int) -> str:
    return f"""SELECT '{stage}', 'top ' || i || ': ' || t, v, true FROM (SELECT {text} AS t, CAST({value} AS DOUBLE) AS v,
  row_number() OVER (ORDER BY {value} DESC, {text}) AS i FROM {source}) x WHERE i <= {n}"""


_VERIFY_SELECT = f"""
SELECT 'sales' AS Etapa, 'filas' AS Chequeo, CAST(count(*) AS DOUBLE) AS Valor, count(*) > 0 AS OK FROM sales
UNION ALL SELECT 'clusters', 'filas', CAST(count(*) AS DOUBLE), count(*) > 0 FROM asg
UNION ALL SELECT 'clusters', 'clusters', CAST(count(DISTINCT Cluster) AS DOUBLE), count(DISTINCT Cluster) > 0 FROM asg
UNION ALL SELECT 'clusters', 'cluster ' || Cluster, CAST(count(*) AS DOUBLE), true FROM asg GROUP BY Cluster
UNION ALL SELECT 'rules', 'filas', CAST(count(*) AS DOUBLE), count(*) > 0 FROM rules
UNION ALL SELECT 'rules', 'lift_max', max(round(lift, 6)), max(lift) IS NOT NULL FROM rules
UNION ALL {_top('rules', "Antecedente_Str || ' -> ' || Consecuente_Str", 'round(lift, 6)', 'rules', pf.TOP_RULES)}
UNION ALL SELECT 'itemsets', 'filas', CAST(count(*) AS DOUBLE), count(*) > 0 FROM its
UNION ALL SELECT 'itemsets', 'freq_max', CAST(max(f) AS DOUBLE), max(f) IS NOT NULL FROM its
UNION ALL {_top('itemsets', 'Productos', 'f', 'its', pf.TOP_ITEMSETS)}"""


@register("verify_outputs", with_sales(*_MINING_CTES, *_Z_CTES, _ASSIGN_CTE, select=_VERIFY_SELECT), "I13")
def verify_outputs(spark, sf):
    fact = sales(spark, sf)  # first, as the baskets are read from it
    its, rules = facts.mined(spark, sf)
    return pf.verify_outputs({"sales": fact,
                              "clusters": sg.assign(_rf(spark, sf), FIXED_CENTERS).select("Cluster"),
                              "rules": bk.rules_report(rules), "itemsets": its})

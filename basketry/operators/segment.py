"""Customer segmentation with K-Means.

Features are the per-basket recency and units (``customers.rf_features``).
Scaling and clustering use MLlib (distributed summaries, iterative jobs
with the centres broadcast).  K-Means results depend on the data layout
(ids and costs differ with the partition count), so exact tests go
through ``assign`` (fixed centroids) and the labelling rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.labels import rnd

FEATURES = ("Recencia_Dias", "Productos_Comprados")

# Cluster naming rules.  Dashboard rule (recency days, units).
DASHBOARD_RULE = (3000, 20, ("Clientes VIP", "Clientes Regulares", "Clientes en Riesgo", "Clientes Inactivos"))
# Notebook rule.
NOTEBOOK_RULE = (30, 15, ("Clientes Premium Activos", "Clientes Activos Regulares", "Clientes Premium Inactivos",
                          "Clientes en Riesgo"))
# Advice per dashboard label.
ADVICE = {
    "Clientes VIP": "Ofrecer programa de fidelización premium; enviar ofertas personalizadas exclusivas",
    "Clientes Regulares": "Incentivar compras mediante cross-selling; promociones en categorías complementarias",
    "Clientes en Riesgo": "Campaña de reactivación urgente; descuentos especiales para recuperar",
    "Clientes Inactivos": "Evaluar costos de retención; campañas genéricas de bajo costo",
}


def scale(rf: DataFrame, cols=FEATURES, out: str = "features"):
    """Assemble and standardise (mean 0, sample std 1); returns (model, frame)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="_raw"),
                            StandardScaler(inputCol="_raw", outputCol=out, withMean=True, withStd=True)])
    model = pipe.fit(rf)
    return model, model.transform(rf).drop("_raw")


def zscores(scaled: DataFrame, cols=FEATURES, col: str = "features", prefix: str = "Z_") -> DataFrame:
    """Scaled vector -> one double column per feature."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(F.col(col))
    return scaled.withColumns({f"{prefix}{c}": arr[i] for i, c in enumerate(cols)})


def elbow(scaled: DataFrame, ks=range(2, 7), seed: int = 42, max_iter: int = 20) -> DataFrame:
    """Training cost for each K (features cached once for all fits)."""
    from pyspark.ml.clustering import KMeans

    spark = scaled.sparkSession
    data = _training_set(scaled)
    try:
        rows = [(int(k), float(KMeans(k=k, seed=seed, maxIter=max_iter).fit(data).summary.trainingCost))
                for k in ks]
    finally:
        data.unpersist()
    return spark.createDataFrame(rows, "K int, Costo double")


def _training_set(scaled: DataFrame) -> DataFrame:
    """Features cached for iterative fitting, one partition per core.

    Every K-Means iteration is a job over this table.  It has at least one
    partition per core, and keeps the partitions it has where those are more.
    """
    data = scaled.select("features")
    cores = scaled.sparkSession.sparkContext.defaultParallelism
    if data.rdd.getNumPartitions() < cores:
        data = data.repartition(cores)
    return data.cache()


def fit_clusters(scaled: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 20):
    """Fit K-Means and label every row; returns (model, frame with ``Cluster``)."""
    from pyspark.ml.clustering import KMeans

    data = _training_set(scaled)
    try:
        model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(data)
    finally:
        data.unpersist()
    return model, model.transform(scaled).withColumnRenamed("prediction", "Cluster")


def centroids(spark, model, scaler_model, cols=FEATURES) -> DataFrame:
    """Centres in original units (centre * std + mean); k rows."""
    sc = scaler_model.stages[-1]
    mean, std = sc.mean.toArray(), sc.std.toArray()
    rows = [(i, *[float(c[j] * std[j] + mean[j]) for j in range(len(cols))])
            for i, c in enumerate(model.clusterCenters())]
    schema = "Cluster int, " + ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame(rows, schema)


def silhouette(clustered: DataFrame) -> float:
    """Silhouette with squared Euclidean distance."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    ev = ClusteringEvaluator(featuresCol="features", predictionCol="Cluster", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(clustered))


def zscore_columns(rf: DataFrame, cols=FEATURES) -> DataFrame:
    """Native z-scores (sample std) with scalar-subquery means and stds."""
    # one aggregate gives all means and deviations, as one struct
    stats = rf.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in cols
                              for n, f in (("m", F.avg), ("s", F.stddev_samp))])).scalar()
    out = rf.withColumn("_st", stats)
    for c in cols:
        z = F.try_divide(F.col(c) - F.col(f"_st.m_{c}"), F.col(f"_st.s_{c}"))
        out = out.withColumn(f"Z_{c}", F.coalesce(z, F.lit(0.0)))  # a constant feature is 0, as in MLlib
    return out.drop("_st")


def assign(rf: DataFrame, centers, cols=FEATURES) -> DataFrame:
    """Nearest of the given centres (in z-space), ties to the smallest index."""
    z = zscore_columns(rf, cols)
    dists = []
    for j, ctr in enumerate(centers):
        d: Column = F.lit(0.0)
        for c, v in zip(cols, ctr):
            diff = F.col(f"Z_{c}") - F.lit(float(v))
            d = d + diff * diff
        dists.append(F.struct(d.alias("d"), F.lit(j).alias("j")))
    return z.withColumn("Cluster", F.array_min(F.array(*dists))["j"])


def cluster_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """J9 (Q1 fixed: real means): size, mean / median recency and units per cluster."""
    return df.groupBy("Cluster").agg(
        F.count(F.lit(1)).alias("Num_Clientes"),
        rnd(F.avg("Recencia_Dias"), digits).alias("Recencia_Media"),
        rnd(F.percentile("Recencia_Dias", 0.5), digits).alias("Recencia_Mediana"),
        rnd(F.avg("Productos_Comprados"), digits).alias("Productos_Media"),
        rnd(F.percentile("Productos_Comprados", 0.5), digits).alias("Productos_Mediana"))


def label_clusters(profile: DataFrame, rule=DASHBOARD_RULE, advice: dict | None = ADVICE) -> DataFrame:
    """Name each cluster by mean recency and units thresholds, attach advice."""
    rec, units, names = rule
    r, u = F.col("Recencia_Media"), F.col("Productos_Media")
    label = (F.when((r < rec) & (u > units), names[0]).when((r < rec) & (u <= units), names[1])
             .when((r >= rec) & (u > units), names[2]).otherwise(names[3]))
    out = profile.withColumn("Segmento", label)
    if advice:
        m = F.create_map(*[F.lit(x) for kv in advice.items() for x in kv])
        out = out.withColumn("Accion", m[F.col("Segmento")])
    return out


def cluster_points(clustered: DataFrame, keys=("ID_Tienda", "ID_Transaccion")) -> DataFrame:
    """Every basket's point with its keys."""
    return clustered.select(*keys, "Recencia_Dias", "Productos_Comprados", "Cluster")


def cluster_cost(assigned: DataFrame, centers, cols=FEATURES) -> DataFrame:
    """J7 for given centres: sum of squared z-distances to the own centre, and baskets, per cluster."""
    at = F.array(*[F.array(*[F.lit(float(v)) for v in ctr]) for ctr in centers])
    own = F.element_at(at, F.col("Cluster") + 1)
    d = sum(((F.col(f"Z_{c}") - own[i]) * (F.col(f"Z_{c}") - own[i]) for i, c in enumerate(cols)), F.lit(0.0))
    return assigned.groupBy("Cluster").agg(F.count(F.lit(1)).alias("Num_Clientes"), rnd(F.sum(d), 4).alias("Costo"))


def unscale(rf: DataFrame, centers, cols=FEATURES) -> DataFrame:
    """J11 for given z-space centres: centre * deviation + mean, one row per centre."""
    one = rf.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    rows = F.array(*[F.struct(F.lit(i).alias("Cluster"), *[
        rnd(F.lit(float(v)) * F.coalesce(f"s_{c}", F.lit(0.0)) + F.col(f"m_{c}"), 6).alias(c) for c, v in zip(cols, ctr)])
        for i, ctr in enumerate(centers)])
    return one.select(F.inline(rows))


def silhouette_native(assigned: DataFrame, cols=FEATURES) -> DataFrame:
    """J12 without MLlib: mean silhouette with squared Euclidean distance in z-space.

    A cluster is summed up by its size, its sum and its sum of squares; a point's mean
    squared distance to a cluster follows from those, so there is one row per cluster to
    meet each point.  Baskets alone in their cluster count 0.
    """
    z = [F.col(f"Z_{c}") for c in cols]
    sq = sum((x * x for x in z), F.lit(0.0))
    cl = assigned.groupBy("Cluster").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(x) for x in z]).alias("s"),
                                         F.sum(sq).alias("q"))
    table = cl.agg(F.collect_list(F.struct("Cluster", "n", "s", "q"))).scalar()  # one entry per cluster

    def mean_d(c, less):
        dot = sum((c["s"][i] * x for i, x in enumerate(z)), F.lit(0.0))
        return F.try_divide(c["n"] * sq + c["q"] - 2 * dot, c["n"] - less)

    p = assigned.withColumn("_t", table)
    own = F.filter("_t", lambda c: c["Cluster"] == F.col("Cluster"))[0]
    a = mean_d(own, F.lit(1))
    b = F.array_min(F.transform(F.filter("_t", lambda c: c["Cluster"] != F.col("Cluster")), lambda c: mean_d(c, F.lit(0))))
    s = F.when(own["n"] == 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return p.select(s.alias("_s")).agg(F.count(F.lit(1)).alias("Clientes"), rnd(F.avg("_s"), 6).alias("Silhouette"))


def fit_checks(clustered: DataFrame, model, cols=FEATURES) -> DataFrame:
    """Facts that any right fit has: baskets that a strictly nearer centre exists for (0),
    rows labelled, and clusters used."""
    from pyspark.ml.functions import vector_to_array

    f = vector_to_array(F.col("features"))

    def dist(ctr):
        return sum(((f[i] - F.lit(float(v))) * (f[i] - F.lit(float(v))) for i, v in enumerate(ctr)), F.lit(0.0))

    d = F.array(*[dist(c) for c in model.clusterCenters()])
    wrong = F.array_min("_d") < F.element_at("_d", F.col("Cluster") + 1) - 1e-9
    return clustered.withColumn("_d", d).agg(
        F.sum(F.when(wrong, 1).otherwise(0)).alias("Mal_Asignados"), F.count(F.lit(1)).alias("Clientes"),
        F.count_distinct("Cluster").alias("Clusters"))

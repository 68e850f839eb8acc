"""Topic clustering over embedding vectors (MLlib k-means).

k-means|| initialisation and Lloyd iterations are distributed: each
iteration is one pass over the vectors plus a k-row aggregate, so no pair
of vectors is ever formed and nothing but the k centres reaches the driver.
``optimality`` holds a result against what k-means promises.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _distance(v: Column, centre: list[float]) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(v, F.lit([float(x) for x in centre]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x))


def fit_clusters(df: DataFrame, vec_col: str, k: int, seed: int = 42, max_iter: int = 20, tol: float = 1e-4, id_col: str = "vec_id"):
    """``(assigned, centres)``: ``id_col, cluster, distance`` (Euclidean
    distance to the centre), and the centres."""
    v = df.select(id_col, array_to_vector(F.col(vec_col)).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features", predictionCol="cluster").fit(v)
    centres = [[float(x) for x in c] for c in model.clusterCenters()]
    out = model.transform(v).withColumn("__v", vector_to_array("features"))
    own = F.element_at(F.array(*[F.lit(c) for c in centres]), F.col("cluster") + 1)
    dist = F.sqrt(F.aggregate(F.zip_with("__v", own, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x))
    return out.select(id_col, F.col("cluster").cast("bigint").alias("cluster"), dist.alias("distance")), centres


def topic_clusters(df: DataFrame, vec_col: str, k: int, seed: int = 42, max_iter: int = 20, id_col: str = "vec_id") -> DataFrame:
    """``id_col, cluster, distance`` (Euclidean distance to the centre)."""
    return fit_clusters(df, vec_col, k, seed, max_iter, id_col=id_col)[0]


def optimality(df: DataFrame, vec_col: str, assigned: DataFrame, centres: list[list[float]], id_col: str = "vec_id", margin: float = 1e-6) -> DataFrame:
    """One row: ``vectors``, how many are not in exactly one cluster
    (``not_once``), how many lie nearer to another centre (``not_nearest``),
    how many carry another distance (``wrong_distance``), and how many centres
    are not the mean of their members (``off_centre``)."""
    both = df.select(id_col, F.col(vec_col).cast("array<double>").alias("v")).join(
        assigned.groupBy(id_col).agg(F.count(F.lit(1)).alias("times"), F.first("cluster").alias("cluster"), F.first("distance").alias("distance")), id_col, "left")
    far = F.array(*[_distance(F.col("v"), c) for c in centres])
    each = both.withColumn("far", far).withColumn("own", F.element_at("far", (F.col("cluster") + 1).cast("int")))
    bad = lambda c: F.count_if(F.coalesce(c, F.lit(True)))
    totals = each.agg(F.count(F.lit(1)).alias("vectors"), bad(F.col("times") != 1).alias("not_once"),
                      bad(F.col("own") > F.array_min("far") + margin).alias("not_nearest"),
                      bad(F.abs(F.col("own") - F.col("distance")) > margin).alias("wrong_distance"))
    means = each.select("cluster", F.posexplode("v").alias("j", "x")).groupBy("cluster", "j").agg(F.avg("x").alias("mean"))
    at = F.element_at(F.element_at(F.array(*[F.lit(c) for c in centres]), (F.col("cluster") + 1).cast("int")), F.col("j") + 1)
    off = means.groupBy("cluster").agg(F.max(F.abs(F.col("mean") - at)).alias("off")).agg(F.count_if(F.col("off") > margin).alias("off_centre"))
    return totals.crossJoin(off)

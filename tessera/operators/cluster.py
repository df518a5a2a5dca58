"""Cluster: k-means fit, assignment to given centroids, cluster report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.sizing import free_name, qcol, stage

CENTROID_BYTES = 32 << 20  # of the centroids sent to a task at a time


def features(df: DataFrame, cols: str | list[str]):
    """The vector to cluster by: an array column, or several numeric columns;
    null if a component is missing."""
    if isinstance(cols, str):
        v = qcol(cols).cast("array<double>")
    else:
        v = F.array(*[qcol(c).cast("double") for c in cols])
    return F.when(v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)), v)


def kmeans_model(df: DataFrame, cols: str | list[str], k: int = 10, seed: int = 42, max_iter: int = 20):
    """``df`` with ``cluster`` appended, and the fitted MLlib model. Rows with
    a missing component stay, without a cluster."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    df = df.drop("cluster")  # of an earlier run
    array, vec = (free_name(df.columns, n, "_") for n in ("_array", "_features"))
    data = df.withColumn(array, features(df, cols))
    full = data.where(F.col(array).isNotNull()).withColumn(vec, array_to_vector(F.col(array)))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=vec, predictionCol="cluster").fit(full)
    done = model.transform(full).drop(vec, array).withColumn("cluster", F.col("cluster").cast("bigint"))
    missing = data.where(F.col(array).isNull()).drop(array).withColumn("cluster", F.lit(None).cast("bigint"))
    return done.unionByName(missing), model


def kmeans(df: DataFrame, cols: str | list[str], k: int = 10, seed: int = 42, max_iter: int = 20) -> DataFrame:
    """Fit MLlib k-means on an array column or on numeric columns and append
    ``cluster``."""
    return kmeans_model(df, cols, k, seed, max_iter)[0]


def centres(spark, model) -> DataFrame:
    """(cluster, centroid) of a fitted model: k rows."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster bigint, centroid array<double>")


def centroids_by(df: DataFrame, vec_col: str, group_col: str) -> DataFrame:
    """Mean vector per group (cluster, centroid array<double>).

    Per-dimension sums combine map-side; each group's list holds one entry
    per dimension, so it is bounded by the vector length.
    """
    per_dim = (df.select(qcol(group_col).alias("cluster"), F.posexplode(qcol(vec_col)).alias("d", "x"))
               .groupBy("cluster", "d").agg(F.avg(F.col("x").cast("double")).alias("m")))
    return per_dim.groupBy("cluster").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("d", "m"))), lambda s: s["m"]).alias("centroid"))


def _nearest(sent, vec: str, near: str, best_id: str):
    """Batches with the nearest centroid of a block, or of those before."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        ids, cents = sent.value
        for b in batches:
            v = b.column(vec)
            ok = np.flatnonzero(v.is_valid().to_numpy(zero_copy_only=False))
            x = v.take(pa.array(ok)).flatten().to_numpy(zero_copy_only=False)
            dist, cluster = b.column(near).to_numpy(zero_copy_only=False).copy(), b.column(best_id).to_numpy(zero_copy_only=False).copy()
            if len(ok):
                x = x.reshape(len(ok), -1)
                step = max(1, (1 << 22) // max(1, cents.size))
                for a in range(0, len(ok), step):
                    gap = x[a:a + step, None, :] - cents[None, :, :]
                    d2 = (gap * gap).sum(2)
                    best = d2.argmin(1)  # the first of equals: the lowest id
                    least, rows = d2[np.arange(len(best)), best], ok[a:a + step]
                    better = ~(dist[rows] <= least)
                    dist[rows[better]], cluster[rows[better]] = least[better], ids[best[better]]
            none = pa.array(np.isnan(dist))
            import pyarrow.compute as pc
            cols = [b.column(n) for n in b.schema.names if n not in (near, best_id)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(dist), pc.if_else(none, pa.scalar(None, pa.int64()), pa.array(np.nan_to_num(cluster).astype(np.int64)))],
                names=[*(n for n in b.schema.names if n not in (near, best_id)), near, best_id])
    return run


def assign(df: DataFrame, vec_col: str, centroids: DataFrame, digits: int = 6, block_bytes: int = CENTROID_BYTES) -> DataFrame:
    """Nearest centroid by squared Euclidean distance (``cluster``, ``dist``);
    ties go to the lowest cluster id; a vector that is null or has a missing
    component gets none. Columns of ``df`` named ``cluster`` and ``dist``, from
    an earlier assignment, are replaced.

    Centroids are sent to the tasks in blocks of at most ``block_bytes``, in
    order of their ids; a task compares a batch of rows with a block by array
    arithmetic and keeps the best so far. However many centroids there are,
    rows stay where they are and no row-by-centroid pair is materialised.
    """
    import numpy as np

    spark = df.sparkSession
    cents = stage(centroids.select(F.col("cluster").cast("bigint").alias("cluster"), F.col("centroid").cast("array<double>").alias("centroid"))
                  .where("cluster is not null and centroid is not null"), "centroids")
    dim = cents.agg(F.max(F.size("centroid"))).first()[0] or 0
    block = max(1, block_bytes // (8 * max(1, dim)))
    v = features(df, vec_col)
    plain = [f"c{i}" for i in range(len(df.columns))]  # the Arrow function takes no names with dots
    vec, near, best_id = (free_name([*df.columns, *plain], n, "_") for n in ("_v", "_dist", "_cluster"))
    out = df.withColumns({vec: F.when(F.size(v) == dim, v), near: F.lit(float("nan")), best_id: F.lit(None).cast("bigint")}).toDF(*plain, vec, near, best_id)
    schema = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(plain, df.schema.fields)), T.StructField(vec, T.ArrayType(T.DoubleType())),
                           T.StructField(near, T.DoubleType()), T.StructField(best_id, T.LongType())])
    held: list = []

    def fold(out):
        sent = spark.sparkContext.broadcast((np.array([r["cluster"] for r in held]), np.array([r["centroid"] for r in held], float).reshape(len(held), dim)))
        return out.mapInArrow(_nearest(sent, vec, near, best_id), schema)

    for r in cents.orderBy("cluster").toLocalIterator():  # a block at a time
        held.append(r)
        if len(held) == block:
            out, held = fold(out), []
    if held:
        out = fold(out)
    out = out.toDF(*df.columns, vec, near, best_id)
    dist = F.when(F.col(best_id).isNotNull(), F.round(F.col(near), digits))
    return out.withColumns({"cluster": F.col(best_id), "dist": dist}).drop(vec, near, best_id)


def cluster_report(assigned: DataFrame, digits: int = 6) -> DataFrame:
    """Per cluster: size, mean distance, share of all rows."""
    total = assigned.agg(F.count(F.lit(1))).scalar()
    return (assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("dist").alias("mean_dist"))
            .select("cluster", "n", F.round("mean_dist", digits).alias("mean_dist"),
                    F.round(F.col("n") / total, digits).alias("share")))


def cluster_dataset(spark, df: DataFrame, cols: str | list[str], out_path: str, dataset_id: str,
                    k: int = 10, seed: int = 42) -> DataFrame:
    """K1 as a stage: fit k-means, append ``cluster`` to every row, write the
    clustered table and its schema document beside it, read the table back."""
    from tessera.sources.files import schema_document, write_schema_document
    out = kmeans(df, cols, k=k, seed=seed)
    out.write.mode("overwrite").parquet(f"{out_path}/table")
    back = spark.read.parquet(f"{out_path}/table")
    write_schema_document(spark, schema_document(back, dataset_id, "clusters"), f"{out_path}/schema")
    return back

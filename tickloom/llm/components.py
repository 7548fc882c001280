"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import fresh_dir


EDGES_A_FILE = 1 << 16


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """`df` as a table in the shared folder, which cuts its lineage. `files`, if told, is the most files (and tasks of the last stage) it
    has, so that a small table does not become as many files as a session has shuffle partitions."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.parquet(path)


def _least(edges: DataFrame) -> DataFrame:
    """For every node the least of its neighbours and itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame, a: str, b: str, files: int | None = None) -> DataFrame:
    """`node` and `root` (the least node of its component) of every node that has an edge to another.

    Large stars tie all greater neighbours of a node to its least one, small stars all smaller
    ones, until nothing changes; the number of rounds grows with the logarithm of the longest path. Aggregates are partial before the
    shuffle and hot nodes are split by AQE's skew join. Edges with a null end and loops are left out. The first table has `files` files
    at most, if told; the files of each round follow the number of edges."""
    pairs = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    now = written(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", files)
    sign, count = None, now.count()
    while True:
        files = 1 + 2 * count // EDGES_A_FILE
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "edges", files)
        least = _least(large)
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        now = written(small, "edges", files)
        got = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if got == sign or not got[0]:
            break
        sign, count = got, got[0]
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

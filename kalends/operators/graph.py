"""Lineage cuts in the cluster's shared folder, joins that stand hot keys, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that hold more than one part in so many of all rows are hot; there are fewer of them than this.
SHARE = 2_000

_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` or the checkpoint folder of the context names it.

    A temporary folder is set only in local mode, where driver and tasks are one process, as in tests; on a cluster
    without a shared folder this raises, for executors would write where nobody reads."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not known.isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kalends-"))
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
    return known.get()


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kalends/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kalends_path = path  # for `forget`
    return out


def forget(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete tables of :func:`cut` that nothing will read any more."""
    for t in tables:
        path = t if isinstance(t, str) else getattr(t, "_kalends_path", None)
        if path in _written:
            _written.remove(path)
            folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written() -> list[str]:
    """Tables of :func:`cut` that are still there, oldest first; a caller who has saved a result can forget those
    that came up on the way."""
    return list(_written)


def join_counted(left: DataFrame, right: DataFrame, on: list[str], count: str = "n") -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row a key and in ``count`` how many rows of left have it.

    Keys with more than 1 / `SHARE` of all rows are fewer than `SHARE`, whatever the data, so their rows of ``right``
    are broadcast; all others meet by shuffle, where no key is hot. ``left`` is read twice then: give a table.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    floor = max(total // SHARE, 1)
    hot = right.where(F.col(count) > floor).drop(count)
    if hot.isEmpty():
        return left.join(right.drop(count), on)
    cold = right.where(F.col(count) <= floor).drop(count)
    fast = left.join(F.broadcast(hot), on)
    rest = left.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return fast.unionByName(rest.select(*fast.columns))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges (u, v), of any comparable type.

    Each round takes the smallest label around and then that label's label; a chain of n nodes needs about log n.
    Labels are written to the shared folder each round and those before deleted; one flag reaches the driver. Edges
    with a null end are ignored; one from a node to itself makes that node a component."""
    spark = edges.sparkSession
    ends = edges.select("u", "v").where("u is not null and v is not null")
    both = cut(ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    label = cut(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(label.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        hop = label.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("mid"))
        new = cut(hop.join(label.select(F.col("node").alias("mid"), F.col("label").alias("up")), "mid").select("node", "was", F.least("mid", "up").alias("label")), "labels")
        forget(spark, label)
        label = new
        if label.where("was <> label").isEmpty():
            forget(spark, both)
            return label.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components still changed after {rounds} rounds")

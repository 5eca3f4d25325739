"""What the operators share on the DataFrame side: the shared folder, tables that cut lineage, order-preserving buckets and connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tasks over which the neighbours of one node are spread.
SALT = 16

#: Word pattern of the contracts, for Java and RE2.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only where that is unset, as in tests, a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        where = spark.sparkContext.getCheckpointDir()
    if not where:
        where = "file://" + tempfile.mkdtemp(prefix="cadenza-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def remove() -> None:
        try:
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        except Exception:  # the session has ended before
            pass

    atexit.register(remove)
    return path


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: it cuts lineage and outlives executors."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` of a small table."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Buckets:
    """Order-preserving buckets of a long key with about equally many rows, however the keys are spread.

    Bounds are approximate percentiles (at most ``cells`` numbers on the driver);
    a row finds its bucket by binary search.
    """

    def __init__(self, df: DataFrame, key: str, cells: int = 2048):
        self.key = key
        shares = [i / cells for i in range(1, cells)]
        found = df.agg(F.percentile_approx(F.col(key).cast("long"), shares, 16 * cells)).first()[0]
        self.bounds = sorted(set(found or []))

    def column(self) -> Column:
        """Bucket number, ascending with the key; -1 for a null key."""
        x = F.col(self.key).cast("long")
        if not self.bounds:
            return F.when(x.isNull(), -1).otherwise(0)
        bounds, n = F.lit(self.bounds), len(self.bounds)
        steps = F.lit([1 << k for k in range(n.bit_length() - 1, -1, -1)])
        step = lambda acc, s: F.when((acc + s <= n) & (F.get(bounds, acc + s - 1) <= x), acc + s).otherwise(acc)
        return F.when(x.isNull(), -1).otherwise(F.aggregate(steps, F.lit(0), step))


def _forest(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition (``names``, a, b) -> its components: one row (``names``, x, r) a node, r the smallest node it reaches here, where that is another."""
    from cadenza.llm.frames import roots

    for table in slices(batches):
        edges = [table[c].to_numpy() for c in (*names, "a", "b")]
        # A node is named by its place among the partition's distinct ones, in ascending order.
        whole = [np.concatenate((c, c)) for c in edges[: len(names)]] + [np.concatenate((edges[-2], edges[-1]))]
        order = np.lexsort(whole[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in whole:
            new[1:] |= c[order][1:] != c[order][:-1]
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        nodes = [c[order[new]] for c in whole]
        n = len(edges[-1])
        root = roots(place[:n], place[n:], int(new.sum()))
        moved = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([*(pa.array(c[moved]) for c in nodes), pa.array(nodes[-1][root[moved]])], names=[*names, "x", "r"])


def slices(batches: Iterator[pa.RecordBatch], most: int = 4_000_000) -> Iterator[pa.Table]:
    """Tables of about ``most`` rows, to bound memory."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of the nodes 0 .. n - 1 reaches by the edges (a, b)."""
    parent = np.arange(n)
    while True:
        p, q = parent[a], parent[b]
        live = p != q
        if not live.any():
            return parent
        a, b, p, q = a[live], b[live], p[live], q[live]
        # Roots hook to the smallest root next to them; then all trees become stars.
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def components(edges: DataFrame, within: list[str]) -> DataFrame:
    """Connected components of the undirected ``edges`` (columns ``a``, ``b`` and those of ``within``, inside which ids count).

    Returns ``within``, ``id`` and ``label`` (the smallest id of the component)
    for every id that has an edge to another. Each round first reduces every partition's
    edges to a forest of stars, so a node has one row a partition at most and no
    hub can fill a task; then come a small-star step (all smaller neighbours of a
    node go to its smallest) and a large-star step (all larger neighbours go
    there). Alternating them takes about the logarithm of the longest path in
    rounds and ends by itself. Edges are checkpointed; nothing is collected.
    """
    kind = dict(edges.dtypes)
    schema = ", ".join([*(f"{c} {kind[c]}" for c in within), "x long, r long"])
    edges = edges.where("a <> b").select(*within, F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    while True:
        forest = edges.mapInArrow(partial(_forest, names=within), schema)
        # Rows of a node: at most one a partition.
        small = forest.withColumn("m", F.min("r").over(Window.partitionBy(*within, "x")))
        both = F.when(F.col("r") != F.col("m"), F.array(F.struct(F.col("r").alias("a"), F.lit(True).alias("moved")), F.struct(F.col("x").alias("a"), F.lit(True).alias("moved"))))
        both = both.otherwise(F.array(F.struct(F.col("x").alias("a"), F.lit(False).alias("moved"))))
        small = cut(small.select(*within, F.col("m").alias("b"), F.explode(both).alias("e")).groupBy(*within, F.col("e.a").alias("a"), "b").agg(F.max("e.moved").alias("moved")))
        least = small.groupBy(*within, F.col("a").alias("b")).agg(F.min(F.col("b")).alias("next"))
        # A hub's larger neighbours are spread over SALT tasks.
        salted = small.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALT)))
        least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<long>")))
        edges = salted.join(least, [*within, "b", "salt"], "left").select(*within, "a", F.coalesce("next", "b").alias("b"), (F.col("moved") | F.col("next").isNotNull()).alias("moved"))
        edges = cut(edges)
        if not edges.where("moved").limit(1).count():
            stars = edges.select(*within, F.col("a").alias("id"), F.col("b").alias("label"))
            return stars.unionByName(stars.select(*within, F.col("label").alias("id"), "label").distinct())
        edges = edges.drop("moved")

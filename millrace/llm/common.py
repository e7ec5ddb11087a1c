"""What several operators of this package share: tables, cut lineage, components of a graph."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table, read by Spark's own reader from whatever store it lies in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors see.

    Only a local master without that setting (tests) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="millrace-checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that no lost executor brings it back to its start."""
    folder = shared_folder(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: like ``cut``, in less space for texts and long arrays."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_held: dict[str, tuple[dict, ...]] = {}


def hold_only(owner: str, *tables: dict) -> None:
    """Called where a task starts in a Python worker: what other operators remember there is forgotten.

    Workers outlive tasks, so without this their tables of remembered words would add up over a pipeline.
    """
    for name in [name for name in _held if name != owner]:
        for held in _held.pop(name):
            held.clear()
        pa.default_memory_pool().release_unused()
    _held[owner] = tables


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever its extra columns are called."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (id, label): every vertex of ``edges`` with the smallest vertex it can reach.

    Each round points every vertex at its smallest neighbour, follows the pointers to their ends (each
    step doubles how far they reach), and puts both ends of every edge where their pointers lead. Edges
    inside a part that has met in one vertex vanish, and every part has at most half its vertices left.
    Everything stays in tables. They are written tables, not checkpoints, because a checkpoint keeps
    what the planner knew of its origin, which multiplies from round to round. Joins read them on both
    sides, nothing is broadcast, aggregates combine before they shuffle, and the driver only learns
    whether anything moved.
    """

    def pointed(pointers: DataFrame, key: str, value: str) -> DataFrame:
        return pointers.select(F.col("id").alias(key), F.col("label").alias(value)).hint("merge")

    def pairs(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    left = stored(edges.where(F.col(a) != F.col(b)).select(*pairs(a, b)).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rounds or not left.isEmpty():
        both = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        near = stored(both.groupBy(F.col("e.a").alias("id")).agg(F.min("e.b").alias("w")).select("id", F.least("id", "w").alias("label")), "pointers")
        moved = True
        while moved:
            further = near.join(pointed(near, "label", "further"), "label")
            near = stored(further.select("id", F.col("further").alias("label"), (F.col("further") != F.col("label")).alias("moved")), "pointers")
            moved = not near.where("moved").isEmpty()
        rounds.append(near.select("id", "label"))
        placed = left.join(pointed(near, "a", "x"), "a").join(pointed(near, "b", "y"), "b").where(F.col("x") != F.col("y"))
        left = stored(placed.select(*pairs("x", "y")).distinct(), "edges")
    labels = rounds[0]
    for near in rounds[1:]:
        labels = labels.join(pointed(near, "label", "further"), "label", "left").select("id", F.coalesce("further", "label").alias("label"))
    return labels

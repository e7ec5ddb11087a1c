"""Many small files made few, without a moment at which a reader sees half of it.

Every batch writes folders of its own, so a table of a year has millions of small files.
Compaction packs the files of finished batches into a new version beside them and then
writes a note of it. Readers follow the newest note: its version for the batches it covers,
the batches' own folders for those after. Until the note is there nothing has changed, so
a compaction that dies leaves the old version whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TARGET_BYTES = 128 * 1024 * 1024

_NOTES = "version bigint, upto_batch bigint"


def _notes(spark: SparkSession, store: str) -> DataFrame | None:
    """The notes of finished versions; None before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/notes")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_NOTES).parquet(f"{store}/notes")


def newest_version(spark: SparkSession, store: str) -> tuple[int, int] | None:
    """The newest finished version and the last batch it covers."""
    notes = _notes(spark, store)
    newest = notes.orderBy(F.col("version").desc()).first() if notes is not None else None
    return tuple(newest) if newest else None


def packed(files: DataFrame, folders: Sequence[str], target_bytes: int) -> DataFrame:
    """Files (``folders..., file, bytes``) with the ``bin`` of their folder they go to.

    In order of their names files fill bins of ``target_bytes``: a bin's files begin within one such
    stretch of the folder's bytes. So a bin exceeds the target by its last file at most, and all
    but a folder's last hold about as much.
    """
    line = Window.partitionBy(*folders).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("bytes").over(line), F.lit(0))
    return files.withColumn("bin", F.call_function("div", begins, F.lit(target_bytes)))


def compact(
    spark: SparkSession, root: str, store: str, schema: str, upto_batch: int, folders: Sequence[str] = (), target_bytes: int = TARGET_BYTES
) -> int:
    """Pack the batches below ``root`` up to and with ``upto_batch`` into a new version in ``store``; its number.

    ``schema`` is that of the table, ``batch_id`` included, ``folders`` its folder levels above the
    batches. ``upto_batch`` must be finished, as the writer's checkpoint or ledger tells. Packing goes on
    from the newest version, whose files are packed again where they are small. Rows move once, by
    (folder, bin), so a folder with a third of all rows has as many writers as bins. What a new version
    replaces is no longer read and is the deployment's to remove.
    """
    newest = newest_version(spark, store)
    columns = spark.read.schema(schema).parquet(root).columns
    named = _current(spark, root, store, schema, newest, files=True).where(F.col("batch_id") <= upto_batch)
    files = named.select(*folders, F.col("_file").alias("file"), F.col("_bytes").alias("bytes")).distinct()
    bins = packed(files, folders, target_bytes).select(F.col("file").alias("_packed"), *[F.col(f).alias(f"_of_{f}") for f in folders], "bin")
    here = F.col("_file") == F.col("_packed")
    for folder in folders:
        here = here & F.col(folder).eqNullSafe(F.col(f"_of_{folder}"))
    dealt = named.join(bins, here).repartition(*folders, "bin").select(*columns)
    version = newest[0] + 1 if newest else 0
    writer = dealt.sortWithinPartitions(*folders, "batch_id").write.mode("overwrite")
    (writer.partitionBy(*folders) if folders else writer).parquet(f"{store}/version-{version}")
    note = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(upto_batch).cast("bigint").alias("upto_batch"))
    note.write.mode("append").parquet(f"{store}/notes")
    return version


def _current(
    spark: SparkSession, root: str, store: str, schema: str, newest: tuple[int, int] | None, files: bool = False
) -> DataFrame:
    """The rows a reader sees, with the file each is in and its size where asked for."""

    def read(path: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(path)
        place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes")]
        return rows.select("*", *place) if files else rows

    live = read(root)
    if newest is None:
        return live
    version, upto = newest
    return read(f"{store}/version-{version}").unionByName(live.where(F.col("batch_id") > upto))


def read_compacted(spark: SparkSession, root: str, store: str, schema: str) -> DataFrame:
    """The table's rows: the newest finished version and the batches after it.

    The batch is a folder, so the folders of batches that are packed are pruned, not read.
    """
    return _current(spark, root, store, schema, newest_version(spark, store))

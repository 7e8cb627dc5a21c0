"""Helpers of the training-data operators: tables, row keys and the shared working folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.session import working_folder as shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def working_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, removed when the session's JVM ends.

    It lies in ``spark.checkpoint.dir``; where that is unset, as in tests, in the warehouse, which on a machine's own
    disk serves a local master only.
    """
    folder = shared_folder(spark, "llm")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


#: Spark's setting that removes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, folder: str, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a table of the working folder and read it back, which cuts its lineage.

    Its shuffle files go with the writing job, so that a chain of such steps needs the disk of one. ``options`` are the writer's.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").options(**options).parquet(f"{folder}/{name}")
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")


def dropped(spark: SparkSession, folder: str, *names: str) -> None:
    """Removes tables of the working folder that nothing reads any more."""
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def quoted(column: str) -> str:
    """A column's name as Spark reads it, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns of a row in one."""
    return F.struct(*(F.col(quoted(c)) for c in df.columns))


def fingerprint(column: str = "text") -> Column:
    """Hash of a text. With doc_id it names a row even if ids repeat or are null: rows that agree in both are equal."""
    return F.xxhash64(text_of(column))


#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def row_id(column: str = "doc_id") -> Column:
    """The id as a join key, also where it is null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))

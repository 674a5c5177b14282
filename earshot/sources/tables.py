"""Relational tables: scans, a JDBC option and versioned snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.schemas import TABLES


def read_table(
    spark: SparkSession, root: str, name: str, jdbc: dict[str, str] | None = None
) -> DataFrame:
    """One metadata table, from Parquet below ``root`` or over JDBC when options are given."""
    if jdbc is not None:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def list_podcasts(podcasts: DataFrame) -> DataFrame:
    """Id, name and feed address of every podcast, by id."""
    return podcasts.select("podcast_id", "podcast_name", "podcast_url").orderBy("podcast_id")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def latest_version(spark: SparkSession, root: str, name: str) -> int | None:
    """Highest version of a table that was written completely."""
    base = f"{root}/{name}"
    if not path_exists(spark, base):
        return None
    fs, hadoop_path = file_system(spark, base)
    folders = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return max(
        (
            int(folder.split("=", 1)[1])
            for folder in folders
            if folder.startswith("version=") and path_exists(spark, f"{base}/{folder}/_SUCCESS")
        ),
        default=None,
    )


# One row per folder that a table consists of, for all tables of a version.
MANIFEST = "_manifest"
_MANIFEST_SCHEMA = "name string, position int, folder string"


def current_version(spark: SparkSession, root: str) -> int | None:
    """Number of the last complete version of all tables below ``root``."""
    return latest_version(spark, root, MANIFEST)


def table_folders(spark: SparkSession, root: str, version: int | None = None) -> dict[str, list[str]]:
    """Folders of every table in a version (the current one unless told)."""
    version = current_version(spark, root) if version is None else version
    folders: dict[str, list[str]] = {}
    if version is not None:
        listed = spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{root}/{MANIFEST}/version={version}")
        for row in listed.orderBy("name", "position").collect():
            folders.setdefault(row["name"], []).append(row["folder"])
    return folders


def read_snapshot(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table as of a version of the whole set; an empty table when it is not in it.

    Jobs that read several tables pass one version on, so that they see tables
    that were published together.
    """
    folders = table_folders(spark, root, version).get(name)
    if not folders:
        return spark.createDataFrame([], TABLES[name])
    return spark.read.schema(TABLES[name]).parquet(*[f"{root}/{folder}" for folder in folders])


def publish(
    spark: SparkSession,
    root: str,
    replaced: dict[str, DataFrame] | None = None,
    appended: dict[str, DataFrame] | None = None,
    most_folders: int = 64,
) -> int:
    """Publish the next version of a set of tables and give its number.

    Plain Parquet has no UPDATE, INSERT or DELETE: a replaced table is a new folder,
    appended rows are one more folder of the table, and nothing that stands is
    touched. All folders are written first; then one manifest names the folders of
    every table. A job that dies before that leaves the old version in place, and
    of two jobs that publish at once the later one fails. A table of more than
    ``most_folders`` folders is rewritten as one.
    """
    before = current_version(spark, root)
    folders = table_folders(spark, root, before) if before is not None else {}
    number = (before or 0) + 1

    def write(name: str, df: DataFrame) -> str:
        folder = f"{name}/version={number}-{uuid.uuid4().hex[:8]}"
        df.select(*TABLES[name].fieldNames()).write.parquet(f"{root}/{folder}")
        return folder

    after = dict(folders)
    for name, df in (appended or {}).items():
        if len(folders.get(name, [])) >= most_folders:
            columns = TABLES[name].fieldNames()
            whole = read_snapshot(spark, root, name, before).select(*columns).unionByName(df.select(*columns))
            after[name] = [write(name, whole)]
        else:
            after[name] = [*folders.get(name, []), write(name, df)]
    for name, df in (replaced or {}).items():
        after[name] = [write(name, df)]
    rows = [(name, i, folder) for name, own in after.items() for i, folder in enumerate(own)]
    listed = spark.createDataFrame(rows, _MANIFEST_SCHEMA).coalesce(1)
    listed.write.mode("error").parquet(f"{root}/{MANIFEST}/version={number}")
    return number


def publish_next(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> dict[str, int]:
    """Replace several tables in one version."""
    number = publish(spark, root, replaced=tables)
    return dict.fromkeys(tables, number)


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the last ``keep`` versions names; for when no job is running."""
    last = current_version(spark, root) or 0
    named = {f for v in range(max(1, last - keep + 1), last + 1) for own in table_folders(spark, root, v).values() for f in own}
    fs, _ = file_system(spark, root)
    gone = []
    for name in TABLES:
        if path_exists(spark, f"{root}/{name}"):
            for status in fs.listStatus(file_system(spark, f"{root}/{name}")[1]):
                folder = f"{name}/{status.getPath().getName()}"
                if folder not in named:
                    fs.delete(status.getPath(), True)
                    gone.append(folder)
    return gone


def check_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Keys that break a uniqueness rule, with their row counts."""
    return df.groupBy(*cols).agg(F.count("*").alias("rows")).filter("rows > 1")

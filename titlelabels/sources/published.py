"""Results published as one set: notes, manifest and anchors together.

All parts are written into one new folder, notes as its data files and the rest in folders whose
names begin with an underscore, which readers of the notes pass over. Only when all parts are there does a last step
put the folder in place: a rename for a path, the location for a table. A run that fails before leaves
the old notes with their own manifest and anchors; one that dies between the two renames of a
path leaves both folders, and the next use of the path puts the old one back.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

MANIFEST, ANCHORS = "_manifest", "_anchors"


class _Files:
    """A file system of Hadoop, by path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def make_parent(self, path: str) -> None:
        self._fs.mkdirs(self._path(path).getParent())

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")


def _beside(path: str, kind: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}.{kind}" if folder else f".{name}.{kind}"


def recover(spark: SparkSession, path: str) -> None:
    """Put the old set back if a run died after it was moved aside and before the new one took its place."""
    files, old = _Files(spark, path), _beside(path, "old")
    if files.exists(old):
        if files.exists(path):
            files.delete(old)
        else:
            files.rename(old, path)


def publish_path(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder, then put it in the place of ``path``."""
    recover(spark, path)
    files = _Files(spark, path)
    staged, old = _beside(path, f"new-{uuid4().hex}"), _beside(path, "old")
    try:
        write(staged)
        if files.exists(path):
            files.rename(path, old)
        try:
            files.make_parent(path)
            files.rename(staged, path)
        except Exception:
            recover(spark, path)
            raise
    except BaseException:
        files.delete(staged)
        raise
    files.delete(old)


def _location(spark: SparkSession, table: str) -> str | None:
    """Where a table's files are; None if there is no such table."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    except AnalysisException:
        return None
    return next((r.data_type for r in rows if r.col_name == "Location"), None)


def publish_table(spark: SparkSession, table: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder of the warehouse, then let the table be there; its former folder goes."""
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}.sets"
    files, staged = _Files(spark, root), f"{root}/{uuid4().hex}"
    before = _location(spark, table)
    try:
        write(staged)
    except BaseException:
        files.delete(staged)
        raise
    same = before is not None and spark.table(table).schema == spark.read.parquet(staged).schema
    if same and f"{table.rpartition('.')[2]}.sets/" in before:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{staged}'")
        spark.sql(f"REFRESH TABLE {table}")
    else:  # another schema or a table of another kind: the catalogue has no single step for that
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{staged}'")
    if before is not None and f"{table.rpartition('.')[2]}.sets/" in before:
        files.delete(before)


def read_manifest(spark: SparkSession, *, path: str | None = None, table: str | None = None) -> DataFrame:
    """The parameters of the run that wrote a published set."""
    return spark.read.parquet(f"{_place(spark, path, table)}/{MANIFEST}")


def read_anchors(spark: SparkSession, *, path: str | None = None, table: str | None = None) -> DataFrame:
    """The anchors of the run that wrote a published set: ``value`` (one JSON object) and ``dim``."""
    return spark.read.text(f"{_place(spark, path, table)}/{ANCHORS}")


def _place(spark: SparkSession, path: str | None, table: str | None) -> str:
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    if path is not None:
        recover(spark, path)
        return path.rstrip("/")
    place = _location(spark, table)
    if place is None:
        raise ValueError(f"no table {table}")
    return place

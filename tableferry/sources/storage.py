"""The few file-system calls needed around Spark reads and writes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _resolve(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, without a trailing slash, in one spelling."""
    fs, jpath = _resolve(spark, path)
    return _plain(fs.makeQualified(jpath).toUri().toString()).rstrip("/")


def directory_bytes(spark: SparkSession, path: str) -> int:
    fs, jpath = _resolve(spark, path)
    return fs.getContentSummary(jpath).getLength()


def delete_directory(spark: SparkSession, path: str) -> None:
    fs, jpath = _resolve(spark, path)
    fs.delete(jpath, True)


def delete_file(spark: SparkSession, path: str) -> None:
    fs, jpath = _resolve(spark, path)
    fs.delete(jpath, False)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is either whole or not there: it gets its name when it is complete."""
    fs, jpath = _resolve(spark, path)
    _, draft = _resolve(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    fs.rename(draft, jpath)


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _resolve(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The files under a directory at any depth; none where there is no such directory."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return []
    found, files = [], fs.listFiles(jpath, True)
    while files.hasNext():
        found.append(files.next().getPath().toString())
    return found


def reads_from(frame: DataFrame, path: str) -> bool:
    """Whether any input of a frame lies under ``path`` or holds it.

    The root paths of its scans are compared; files are listed only for scans that do
    not name their roots.
    """
    directory = qualified(frame.sparkSession, path) + "/"
    roots = _scan_roots(frame)
    found = [_plain(x) for x in (frame.inputFiles() if roots is None else roots)]
    return any(f"{x}/".startswith(directory) or directory.startswith(f"{x}/") for x in found)


def _file_relation(frame: DataFrame):
    """The file relation of a frame that is a scan and nothing more, else None."""
    plan = frame._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() == "SubqueryAlias":
        plan = plan.child()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = plan.relation()
    return relation if relation.getClass().getSimpleName() == "HadoopFsRelation" else None


def counted_by_footers(frame: DataFrame) -> bool:
    """Whether the rows of a frame can be counted without reading any."""
    relation = _file_relation(frame)
    return relation is not None and relation.fileFormat().getClass().getSimpleName() == "ParquetFileFormat"


def scan_files(frame: DataFrame) -> list[tuple[str, int, int]] | None:
    """Files of a plain file scan as (name in ``_metadata.file_path``, bytes, time of change), by name.

    None for any other frame, and where Spark itself does not hold the list.
    """
    relation = _file_relation(frame)
    if relation is None or relation.location().getClass().getSimpleName() != "InMemoryFileIndex":
        return None
    found = relation.location().allFiles()
    files = [found.apply(i) for i in range(found.size())]
    return sorted((_plain(f.getPath().toUri().toString()), f.getLen(), f.getModificationTime()) for f in files)


def _scan_roots(frame: DataFrame) -> list[str] | None:
    """Root paths of the file scans of a frame, or None where a scan does not tell."""
    leaves = frame._jdf.queryExecution().analyzed().collectLeaves()
    roots: list[str] = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() != "HadoopFsRelation":
                return None
            paths = relation.location().rootPaths()
            roots += [paths.apply(j).toUri().toString().rstrip("/") for j in range(paths.size())]
        elif kind not in ("LocalRelation", "Range", "OneRowRelation", "LogicalRDD"):
            return None
    return roots


def _plain(uri: str) -> str:
    return uri.replace(":///", ":/")


def scratch_directory(spark: SparkSession) -> str:
    """A fresh directory that every executor can reach.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tableferry/{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tableferry-")

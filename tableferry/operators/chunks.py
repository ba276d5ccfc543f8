"""Exports of large tables in chunks, so that one that was broken off goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import astuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableferry.operators.export import ColumnMapping, ExportResult, export_projection, storable
from tableferry.sources.storage import (
    delete_directory,
    delete_file,
    list_files,
    qualified,
    read_text,
    reads_from,
    scan_files,
    write_text,
)

#: Bytes of source files to a chunk: a lost driver repeats at most so much of an export.
CHUNK_BYTES = 256 * 1024**3

# Spark's readers pass over names that begin with an underscore.
_RECORDS = "_chunks"

File = tuple[str, int, int]


def export_chunks(
    source: DataFrame,
    columns: Sequence[ColumnMapping],
    path: str,
    cast_zoned_timestamps: bool = True,
    chunk_bytes: int = CHUNK_BYTES,
    resume: bool = False,
) -> ExportResult | None:
    """Export a table's projection in chunks of whole source files; None where it is no file scan or a single chunk.

    Each chunk is appended to ``path``, and recorded with its files once they are all there. With ``resume`` the chunks
    that an earlier attempt recorded stay, if their source files and the projection are the same; whatever else lies
    under ``path`` goes. Without it all of that goes.
    """
    spark, files = source.sparkSession, scan_files(source)
    chunks = split_files(files or [], chunk_bytes)
    if len(chunks) < 2:
        return None
    if reads_from(source, path):
        raise ValueError(f"the export would overwrite its own source: {path}")
    made = json.dumps([cast_zoned_timestamps, [astuple(c) for c in columns]])
    planned = {hashlib.sha256(json.dumps([made, chunk]).encode()).hexdigest(): chunk for chunk in chunks}
    done = _committed(spark, path, set(planned)) if resume else {}
    if not done:
        delete_directory(spark, path)
    else:
        _delete_others(spark, path, done)
    for key, chunk in planned.items():
        if key not in done:
            done[key] = _export_chunk(source, columns, path, cast_zoned_timestamps, chunk)
            write_text(spark, f"{path}/{_RECORDS}/{key}.json", json.dumps(done[key]))
    return ExportResult(path, sum(record["rows"] for record in done.values()))


def split_files(files: Sequence[File], chunk_bytes: int) -> list[list[File]]:
    """Files in order, as many to a chunk as fit; a larger file is a chunk of its own."""
    chunks: list[list[File]] = []
    filled = 0
    for file in files:
        if not chunks or filled + file[1] > chunk_bytes:
            chunks.append([])
            filled = 0
        chunks[-1].append(file)
        filled += file[1]
    return chunks


def _export_chunk(
    source: DataFrame, columns: Sequence[ColumnMapping], path: str, cast_zoned_timestamps: bool, chunk: list[File]
) -> dict:
    before = _parts(source.sparkSession, path)
    # Spark lists only the files that this names.
    rows = source.where(source.metadataColumn("_metadata")["file_path"].isin([name for name, _, _ in chunk]))
    observation = Observation()
    written = storable(export_projection(rows, columns, cast_zoned_timestamps))
    written.observe(observation, F.count(F.lit(1)).alias("rows")).write.mode("append").option("compression", "snappy").parquet(path)
    return {"rows": observation.get["rows"], "parts": sorted(_parts(source.sparkSession, path) - before)}


def _parts(spark: SparkSession, path: str) -> set[str]:
    """Names of the data files that lie in a directory."""
    root = f"{qualified(spark, path)}/"
    names = {qualified(spark, name).removeprefix(root) for name in list_files(spark, path)}
    return {name for name in names if not name.startswith(("_", "."))}


def _committed(spark: SparkSession, path: str, planned: set[str]) -> dict[str, dict]:
    """The records of planned chunks whose files are still there."""
    parts, done = _parts(spark, path), {}
    for name in list_files(spark, f"{path}/{_RECORDS}"):
        key = name.rsplit("/", 1)[1].removesuffix(".json")
        if key in planned:
            record = json.loads(read_text(spark, name))
            if parts.issuperset(record["parts"]):
                done[key] = record
    return done


def _delete_others(spark: SparkSession, path: str, done: dict[str, dict]) -> None:
    """Delete what attempts left beside the chunks that are done."""
    root = f"{qualified(spark, path)}/"
    kept = {part for record in done.values() for part in record["parts"]} | {f"{_RECORDS}/{key}.json" for key in done}
    for name in list_files(spark, path):
        if qualified(spark, name).removeprefix(root) not in kept:
            delete_file(spark, name)

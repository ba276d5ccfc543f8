"""Replacing a catalog entry so that a driver lost at any point leaves the old rows or the new ones.

A swap takes several catalog statements, and between the renames a table has no entry. So it is recorded in the
namespace's folder before its rows are written and the record goes after the last statement. What a lost driver left
behind is settled by :func:`recover`: at the next load of the table or when asked. A swap whose old entry has already
gone aside is completed, one before that point is undone. A read that does not find its table completes such a swap, too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from urllib.parse import quote

from pyspark.sql import SparkSession

from tableferry.operators.export import quoted
from tableferry.sources.storage import delete_directory, delete_file, list_files, qualified, read_text, write_text

# Spark's readers pass over names that begin with an underscore.
_RECORDS = "_swaps"

#: Swaps under way in this process; nothing else is to settle them.
_UNDER_WAY: set[str] = set()


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_name(namespace: str, table: str) -> str:
    return f"{quoted(namespace)}.{quoted(table)}"


def table_location(spark: SparkSession, namespace: str, table: str) -> str | None:
    if not spark.catalog.tableExists(table_name(namespace, table)):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(namespace, table)}")
    # The last one: a column of the table may have this name, too.
    rows = described.where("col_name = 'Location'").collect()
    return rows[-1].data_type if rows else None


@dataclass(frozen=True)
class Swap:
    """One replacement. ``files`` hold the new rows and go if it is undone, ``obsolete`` files go once it is complete."""

    namespace: str
    table: str
    files: str | None = None
    obsolete: str | None = None
    id: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def target(self) -> str:
        return table_name(self.namespace, self.table)

    @property
    def incoming(self) -> str:
        return table_name(self.namespace, f"{self.table}__{self.id}")

    @property
    def backup(self) -> str:
        return table_name(self.namespace, f"{self.table}__before_{self.id}")


def rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


@contextmanager
def recorded(spark: SparkSession, swap: Swap) -> Iterator[None]:
    """Keep a record of ``swap`` while the body runs, and beyond it for as long as an entry of the swap is left over."""
    path = _record(spark, swap)
    _UNDER_WAY.add(swap.id)
    try:
        write_text(spark, path, json.dumps(asdict(swap)))
        try:
            yield
        except Exception:
            _forget(spark, swap, path)
            raise
        _forget(spark, swap, path)
    finally:
        _UNDER_WAY.discard(swap.id)


def recover(spark: SparkSession, namespace: str, table: str | None = None, missing: bool = False) -> list[str]:
    """Settle what lost drivers left of swaps in a namespace, or of one table. Returns the names of those tables.

    Not to be called while another session loads the table: its swap would look like one that was left. With ``missing``
    only swaps that left a table without its entry are settled, which no load is for longer than a rename takes.
    """
    root = _records(spark, namespace, table)
    settled = []
    for path in list_files(spark, root) if root else []:
        if path.endswith(".json"):
            swap = Swap(**json.loads(read_text(spark, path)))
            if swap.id in _UNDER_WAY or missing and not _left_missing(spark, swap):
                continue
            _settle(spark, swap)
            settled.append(swap.table)
        elif missing:
            continue
        delete_file(spark, path)  # a record, or one that was never finished
    return settled


def existing(spark: SparkSession, namespace: str, table: str) -> bool:
    """Whether a table exists; one that a lost driver left aside is put in place first."""
    if spark.catalog.tableExists(table_name(namespace, table)):
        return True
    return bool(recover(spark, namespace, table, missing=True)) and spark.catalog.tableExists(table_name(namespace, table))


def _left_missing(spark: SparkSession, swap: Swap) -> bool:
    return spark.catalog.tableExists(swap.backup) and not spark.catalog.tableExists(swap.target)


def _settle(spark: SparkSession, swap: Swap) -> None:
    incoming, backup, target = (spark.catalog.tableExists(n) for n in (swap.incoming, swap.backup, swap.target))
    if backup and not target:  # between the renames: on with the new rows, or back where they are gone
        rename(spark, swap.incoming if incoming else swap.backup, swap.target)
        complete, backup, incoming = incoming, incoming, False
    elif backup:
        complete = not incoming
    else:
        place = None if incoming else table_location(spark, swap.namespace, swap.table)
        complete = place is not None and swap.files is not None and qualified(spark, place) == qualified(spark, swap.files)
    if incoming:
        spark.sql(f"DROP TABLE IF EXISTS {swap.incoming}")
    if not complete:
        if swap.files:
            delete_directory(spark, swap.files)
        return
    if backup:
        spark.sql(f"DROP TABLE IF EXISTS {swap.backup}")
    if swap.obsolete:
        delete_directory(spark, swap.obsolete)


def _forget(spark: SparkSession, swap: Swap, path: str) -> None:
    if not any(spark.catalog.tableExists(n) for n in (swap.incoming, swap.backup)):
        delete_file(spark, path)


def _records(spark: SparkSession, namespace: str, table: str | None) -> str | None:
    if not spark.catalog.databaseExists(quoted(namespace)):
        return None
    root = f"{spark.catalog.getDatabase(quoted(namespace)).locationUri.rstrip('/')}/{_RECORDS}"
    return root if table is None else f"{root}/{quote(table, safe='')}"


def _record(spark: SparkSession, swap: Swap) -> str:
    return f"{_records(spark, swap.namespace, swap.table)}/{swap.id}.json"

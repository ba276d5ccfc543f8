"""Identifiers and locations derived from (database, schema, table)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_NAMESPACE_PREFIX = "migrated_"
KEY = ["database", "schema", "table"]


def qualified_name(database: Column, schema: Column, table: Column) -> Column:
    """``database.schema.table`` with the case kept."""
    return F.concat_ws(".", database, schema, table)


def staging_path(database: Column, schema: Column, table: Column) -> Column:
    """Lower-cased relative directory ``database/schema/table/``."""
    return F.concat(F.lower(F.concat_ws("/", database, schema, table)), F.lit("/"))


def staging_location(root: str | Column, path: Column) -> Column:
    """Absolute directory of a staged table; trailing slashes of the root go."""
    return F.concat(_trimmed(root), F.lit("/"), F.rtrim(path, F.lit("/")))


def source_uri(root: str | Column, path: Column) -> Column:
    """Glob over the staged files: ``<root>/database/schema/table/*``."""
    return F.concat(_trimmed(root), F.lit("/"), path, F.lit("*"))


def namespace_id(database: Column, schema: Column, prefix: str = DEFAULT_NAMESPACE_PREFIX) -> Column:
    """Target namespace ``<prefix>database_schema``: lower case, ``-`` becomes ``_``."""
    joined = F.concat(F.lit(prefix), database, F.lit("_"), schema)
    return F.lower(F.replace(joined, F.lit("-"), F.lit("_")))


def _trimmed(root: str | Column) -> Column:
    return F.rtrim(F.lit(root) if isinstance(root, str) else root, F.lit("/"))

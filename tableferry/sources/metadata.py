"""Table and column metadata as DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.type_map import source_type_name
from tableferry.sources.footers import FOOTER_SCHEMA, footer_columns
from tableferry.sources.storage import qualified, scratch_directory

BASE_TABLE = "BASE TABLE"
VIEW = "VIEW"

TABLES_SCHEMA = "database string, schema string, table string, table_type string"
COLUMNS_SCHEMA = (
    "database string, schema string, table string, "
    "ordinal int, column_name string, data_type string"
)
ERRORS_SCHEMA = "database string, schema string, table string, error string"

TableKey = tuple[str, str, str]

#: Tables that the driver opens before it writes down what it found.
BATCH = 256


def error_text(error: Exception) -> str:
    """The whole message of an error, or its kind if it has none."""
    return str(error) or type(error).__name__


@dataclass(frozen=True)
class Metadata:
    """``tables`` and ``columns`` of the source, plus tables that could not be read."""

    tables: DataFrame
    columns: DataFrame
    errors: DataFrame | None = None


def information_schema(columns: DataFrame, tables: DataFrame) -> Metadata:
    """Metadata from a warehouse's own COLUMNS and TABLES views (e.g. over JDBC)."""
    key = [
        F.col("table_catalog").alias("database"),
        F.col("table_schema").alias("schema"),
        F.col("table_name").alias("table"),
    ]
    return Metadata(
        tables=tables.select(*key, "table_type"),
        columns=columns.select(
            *key,
            F.col("ordinal_position").cast("int").alias("ordinal"),
            "column_name",
            "data_type",
        ),
    )


def schema_metadata(
    spark: SparkSession,
    entries: Iterable[tuple[TableKey, str]],
    read_schema: Callable[[TableKey], T.StructType],
    parallelism: int = 8,
) -> Metadata:
    """Metadata of tables whose schema Spark can read; an unreadable one is reported.

    The driver opens the tables, ``BATCH`` at a time. More than one batch is written to the scratch folder batch by
    batch, so that it never holds the columns of a whole catalog.
    """

    def scan(entry):
        key, table_type = entry
        try:
            return key, table_type, read_schema(key), None
        except Exception as error:  # one broken table must not hide the others
            return key, table_type, None, error_text(error)

    entries = list(entries)
    with ThreadPoolExecutor(parallelism) as pool:
        if len(entries) <= BATCH:
            return _frames(spark, pool.map(scan, entries))
        path = scratch_directory(spark)
        for at in range(0, len(entries), BATCH):
            _append(_frames(spark, pool.map(scan, entries[at : at + BATCH])), path)
    return _read(spark, path)


def _frames(spark: SparkSession, scanned: Iterable[tuple]) -> Metadata:
    scanned = list(scanned)
    readable = [(key, table_type, schema) for key, table_type, schema, error in scanned if not error]
    return Metadata(
        tables=spark.createDataFrame([(*key, table_type) for key, table_type, _ in readable], TABLES_SCHEMA),
        columns=spark.createDataFrame(
            [
                (*key, ordinal, field.name, source_type_name(field.dataType))
                for key, _, schema in readable
                for ordinal, field in enumerate(schema.fields, 1)
            ],
            COLUMNS_SCHEMA,
        ),
        errors=spark.createDataFrame(
            [(*key, error) for key, _, _, error in scanned if error], ERRORS_SCHEMA
        ),
    )


_PARTS = {"tables": TABLES_SCHEMA, "columns": COLUMNS_SCHEMA, "errors": ERRORS_SCHEMA}


def _append(part: Metadata, path: str) -> None:
    for name in _PARTS:
        getattr(part, name).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def _read(spark: SparkSession, path: str) -> Metadata:
    return Metadata(*[spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in _PARTS.items()])


def parquet_metadata(
    spark: SparkSession,
    paths: Mapping[TableKey, str],
    views: Iterable[TableKey] = (),
) -> Metadata:
    """Metadata of Parquet directories, keyed by (database, schema, table).

    The driver opens a few tables itself. Of more than ``BATCH`` tasks read the footers, and the columns are written
    where they are read; the driver opens those alone that only Spark's reader can.
    """
    views = set(views)
    entries = [(key, VIEW if key in views else BASE_TABLE) for key in paths]
    read = lambda key: spark.read.parquet(paths[key]).schema
    if len(entries) <= BATCH:
        return schema_metadata(spark, entries, read)
    rows = [(*key, kind, qualified(spark, paths[key])) for key, kind in entries]
    listed = spark.createDataFrame(rows, f"{TABLES_SCHEMA}, path string").repartition(-(-len(rows) // BATCH))
    path = scratch_directory(spark)
    footer_columns(listed).write.parquet(f"{path}/footers")
    found = spark.read.schema(FOOTER_SCHEMA).parquet(f"{path}/footers")
    names = ["database", "schema", "table"]
    left = found.where("unread").select(*names, "table_type").toLocalIterator()
    opened = schema_metadata(spark, [(tuple(r)[:3], r.table_type) for r in left], read)
    known = found.where("NOT unread")
    return Metadata(
        tables=known.where("ordinal = 1").select(*names, "table_type").unionByName(opened.tables),
        columns=known.select(*names, "ordinal", "column_name", "data_type").unionByName(opened.columns),
        errors=opened.errors,
    )


def catalog_metadata(
    spark: SparkSession,
    schemas: Iterable[str] | None = None,
    rules: DataFrame | None = None,
    parallelism: int = 8,
) -> Metadata:
    """Metadata of the session's catalogs (catalog name = database).

    Names are reported in upper case, the form selection rules compare with. With
    ``rules`` the catalogs and schemas that usable rules name are listed, and only tables
    that a rule selects are opened; without, all tables of the current catalog. ``schemas``
    restricts the listing.
    """
    from tableferry.operators.selection import select_tables
    from tableferry.sources.rules import split_rules

    current = spark.catalog.currentCatalog()
    wanted: dict[str, set[str] | None] = {current.upper(): None}
    if rules is not None:
        wanted = _fixed_schemas(split_rules(rules)[0])
    known = {current, *(c.name for c in spark.catalog.listCatalogs())} if rules is not None else {current}
    names, kinds, unlisted = {}, {}, []
    for catalog in sorted(c for c in known if c.upper() in wanted):
        fixed = wanted[catalog.upper()]
        for schema in _schemas(spark, catalog, current, schemas):
            if fixed is not None and schema.upper() not in fixed:
                continue  # no rule reaches into it
            try:
                listed = _listed(spark, f"{_quoted(catalog)}.{_quoted(schema)}")
            except Exception as error:  # one broken schema must not hide the others
                unlisted.append((catalog.upper(), schema.upper(), None, error_text(error)))
                continue
            for table, kind in listed.items():
                key = (catalog.upper(), schema.upper(), table.upper())
                names[key] = f"{_quoted(catalog)}.{_quoted(schema)}.{_quoted(table)}"
                kinds[key] = kind
    if rules is not None:
        tables = spark.createDataFrame([(*key, kind) for key, kind in kinds.items()], TABLES_SCHEMA)
        hits = select_tables(rules, tables).select("database", "schema", "table").toLocalIterator()
        kinds = {tuple(r): kinds[tuple(r)] for r in hits}
    found = schema_metadata(spark, kinds.items(), lambda key: spark.table(names[key]).schema, parallelism)
    return replace(found, errors=found.errors.union(spark.createDataFrame(unlisted, ERRORS_SCHEMA)))


def _fixed_schemas(usable: DataFrame) -> dict[str, set[str] | None]:
    """The schemas that rules name in each database, in upper case; None where a rule is for all of them."""
    named = usable.select(F.upper("database").alias("d"), F.upper(F.coalesce("schema", F.lit(""))).alias("s")).distinct()
    found: dict[str, set[str] | None] = {}
    for row in named.toLocalIterator():
        if not row.s:
            found[row.d] = None
        elif found.setdefault(row.d, set()) is not None:
            found[row.d].add(row.s)
    return found


def _listed(spark: SparkSession, namespace: str) -> dict[str, str]:
    """Kinds of the tables and views of a schema by name, from two statements however many there are."""
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {namespace}").collect() if not r.isTemporary]
    try:
        views = {r.viewName for r in spark.sql(f"SHOW VIEWS IN {namespace}").collect() if not r.isTemporary}
    except Exception:  # a catalog without views
        views = set()
    return {name: VIEW if name in views else BASE_TABLE for name in tables}


def _schemas(spark: SparkSession, catalog: str, current: str, schemas: Iterable[str] | None) -> list[str]:
    if schemas is not None:
        return list(schemas)
    if catalog == current:
        return [d.name for d in spark.catalog.listDatabases()]
    return [r[0] for r in spark.sql(f"SHOW NAMESPACES IN {_quoted(catalog)}").collect()]


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"

"""Moving whole tables between catalogs with Spark."""

from tableferry.functions.names import dedup_names, normalize_name
from tableferry.functions.type_map import logical_type
from tableferry.operators.export import ColumnMapping, column_mappings, export_table, ordered_sample
from tableferry.operators.load import (
    LoadOptions,
    create_external_table,
    load_table,
    read_partitioned,
    read_table,
)
from tableferry.operators.replacement import recover
from tableferry.operators.selection import select_tables, table_counts, table_records
from tableferry.operators.validation import reconcile, row_counts, target_row_count
from tableferry.plans.inference import infer_schema, partition_eligible, schema_json
from tableferry.plans.planning import RunOptions, build_plan, write_plan
from tableferry.plans.running import dispositions, read_outcomes, remaining, resume, run
from tableferry.sources.metadata import catalog_metadata, information_schema, parquet_metadata
from tableferry.sources.rules import make_rules, read_rules, rules_from_manifest, split_rules
from tableferry.sources.tables import catalog_source, parquet_source, run_sql

__all__ = [
    "ColumnMapping", "LoadOptions", "RunOptions", "build_plan", "catalog_metadata", "catalog_source",
    "column_mappings", "create_external_table", "dedup_names", "dispositions", "export_table",
    "infer_schema", "information_schema", "load_table", "logical_type", "make_rules", "normalize_name",
    "ordered_sample", "parquet_metadata", "parquet_source", "partition_eligible", "read_outcomes",
    "read_partitioned", "read_rules", "read_table", "reconcile", "recover", "remaining", "resume", "row_counts",
    "rules_from_manifest", "run", "run_sql", "schema_json", "select_tables", "split_rules",
    "table_counts", "table_records", "target_row_count", "write_plan",
]

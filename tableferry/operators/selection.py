"""Choosing tables by rule and shaping their metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.functions.paths import KEY
from tableferry.sources.metadata import BASE_TABLE, Metadata
from tableferry.sources.rules import split_rules


def select_tables(rules: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables matched by any usable rule: ``rule_pos, rule_idx`` + the table's columns.

    Rules are indexed by the names they fix, and a table looks itself up by all three names, by two and by the
    database alone, in one join; its metadata are worked out once. Rules that fix the same names and exclude the same
    are one. A table matched by several rules appears once: the first rule fixes its position (``rule_pos``), the
    last one its record (``rule_idx``).
    """
    own, names = [F.col(k) for k in KEY], [f"_{k}" for k in KEY]
    levels = [F.struct(*[(c if i < fixed else F.lit("")).alias(n) for i, (c, n) in enumerate(zip(own, names))]) for fixed in (3, 2, 1)]
    listed = tables.select(*KEY, "table_type", F.inline(F.array(*levels)))
    met = listed.join(rule_index(rules), names)
    kept = F.filter("_rules", _kept_by)
    hits = met.select(*KEY, "table_type", kept.alias("_kept")).where(F.size("_kept") > 0)
    hits = hits.select(*KEY, "table_type", F.array_min("_kept.first").alias("first"), F.array_max("_kept.last").alias("last"))
    return hits.groupBy(*KEY).agg(
        F.min("first").alias("rule_pos"),
        F.max("last").alias("rule_idx"),
        F.max_by("table_type", "last").alias("table_type"),
    )


def rule_index(rules: DataFrame) -> DataFrame:
    """The usable rules by the names they fix (empty where any will do): what they ask, and their first and last index."""
    usable, _ = split_rules(rules)

    def patterns(name: str) -> Column:
        # A backslash in a pattern is an ordinary character, not an escape.
        upper = F.transform(F.coalesce(name, F.array().cast("array<string>")), lambda p: F.replace(F.upper(p), F.lit("\\"), F.lit("\\\\")))
        return F.array_sort(F.array_distinct(F.filter(upper, lambda p: p.isNotNull() & (p != ""))))

    names = [F.upper(F.coalesce(k, F.lit(""))).alias(f"_{k}") for k in KEY]
    asked = {
        "no_schema": patterns("exclude_schema_like"),
        "no_table": patterns("exclude_table_like"),
        "views": F.coalesce("with_views", F.lit(False)),
    }
    keyed = usable.select(*names, "rule_idx", *[value.alias(name) for name, value in asked.items()])
    keys = [f"_{k}" for k in KEY]
    folded = keyed.groupBy(*keys, *asked).agg(F.min("rule_idx").alias("first"), F.max("rule_idx").alias("last"))
    return folded.groupBy(*keys).agg(F.collect_list(F.struct(*asked, "first", "last")).alias("_rules"))


def _kept_by(rule: Column) -> Column:
    """What a rule asks beside the names it fixes."""

    def like_any(name: str, patterns: Column) -> Column:
        return F.coalesce(F.exists(patterns, lambda p: F.like(F.col(name), p)), F.lit(False))

    views = rule["views"] | (F.col("table_type") == BASE_TABLE)
    return ~like_any("schema", rule["no_schema"]) & ~like_any("table", rule["no_table"]) & views


def list_columns(metadata: Metadata) -> DataFrame:
    """Column rows joined with their table's type."""
    return metadata.columns.join(metadata.tables, KEY, "inner")


def in_listing_order(columns: DataFrame) -> DataFrame:
    """Metadata order: schema, table, ordinal."""
    return columns.orderBy("schema", "table", "ordinal")


def table_records(columns: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """One row per table with its ``columns`` as an array in ordinal order.

    The array is one table's column list, which the catalog itself bounds.
    ``extra`` adds fields to each array element.
    """
    fields = [F.col("ordinal"), F.col("column_name"), F.col("data_type"), *(extra or [])]
    return columns.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("columns")
    )


def table_counts(tables: DataFrame) -> DataFrame:
    """Tables per ``database.schema`` and a last row ``Total``: ``schema_key, tables``."""
    counted = (
        tables.withColumn("schema_key", F.concat_ws(".", "database", "schema"))
        .rollup("schema_key")
        .agg(F.count(F.lit(1)).alias("tables"), F.grouping_id().alias("is_total"))
    )
    label = F.when(F.col("is_total") == 1, F.lit("Total")).otherwise(F.col("schema_key"))
    return counted.orderBy("is_total", "schema_key").select(label.alias("schema_key"), "tables")

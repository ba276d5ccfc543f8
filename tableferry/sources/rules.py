"""Selection rules: which tables to move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES_SCHEMA = (
    "rule_idx int, database string, schema string, table string, "
    "exclude_schema_like array<string>, exclude_table_like array<string>, with_views boolean"
)
RULE_COLUMNS = [field.split()[0] for field in RULES_SCHEMA.split(", ")]


def make_rules(spark: SparkSession, items: list[dict]) -> DataFrame:
    """Rules from plain dicts; the list position is the rule's index."""
    rows = [(i, *[item.get(name) for name in RULE_COLUMNS[1:]]) for i, item in enumerate(items)]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from JSON lines that carry their ``rule_idx``; a missing key restricts nothing."""
    return spark.read.schema(RULES_SCHEMA).json(path)


def rules_from_manifest(outcomes: DataFrame) -> DataFrame:
    """One rule per table of an outcome manifest, to run those tables again."""
    unset = {
        "exclude_schema_like": F.lit(None).cast("array<string>"),
        "exclude_table_like": F.lit(None).cast("array<string>"),
        # The manifest names exact tables, so a view in it was asked for.
        "with_views": F.lit(True),
    }
    return outcomes.select(
        F.lit(0).alias("rule_idx"), "database", "schema", "table",
        *[value.alias(name) for name, value in unset.items()],
    )


def reject_reason() -> Column:
    """Why a rule cannot be used, or null."""
    return F.when(_unset("database"), F.lit("'database' is mandatory")).when(
        ~_unset("table") & _unset("schema"), F.lit("'schema' is mandatory if 'table' is provided")
    )


def split_rules(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rules, rejected rules with ``reject_reason``)."""
    checked = rules.withColumn("reject_reason", reject_reason())
    usable = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return usable, checked.where(F.col("reject_reason").isNotNull())


def _unset(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""

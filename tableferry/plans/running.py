"""Running a plan: decisions, per-table pipelines, outcomes, resuming."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from itertools import islice
from threading import Event, current_thread

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.paths import KEY
from tableferry.operators.chunks import export_chunks
from tableferry.operators.export import ColumnMapping, export_frame, export_selection, storable
from tableferry.operators.load import LoadOptions, check_load, load_table
from tableferry.operators.validation import FAILED, MISMATCH, SUCCEEDED, target_row_count
from tableferry.plans.planning import ACTIONS, RunOptions
from tableferry.sources.metadata import error_text
from tableferry.sources.storage import counted_by_footers
from tableferry.sources.tables import SourceReader

PROCEED, SKIP, ABORT, EXPORT_ONLY = ACTIONS
# Why a table was not moved.
SKIPPED = "Skipped by user"
ABORTED = "Aborted by user"
INTERRUPTED = "Aborted by user (Ctrl+C)"

OUTCOME_SCHEMA = (
    "database string, schema string, table string, table_key string, table_type string, error string, "
    "source_rows long, expected_rows long, target_rows long, target string, failed_stage string, note string, status string"
)
# Stages of one table, as an error names them.
CHECK, EXPORT, LOAD, COUNT = "Check", "Export", "Load", "Count"
OUTCOME_COLUMNS = [field.split()[0] for field in OUTCOME_SCHEMA.split(", ")]
# Hidden folders of a manifest: Spark's readers pass over names that begin with an underscore.
_PLAN, _PARENT = "_plan", "_parent"
_OUTCOMES_PER_WRITE = 50
_SECONDS_PER_WRITE = 30


# --- decisions ------------------------------------------------------------------------


def dispositions(
    steps: DataFrame, run: str = "run_id", seq: str = "seq", action: str = "action"
) -> DataFrame:
    """Add ``decision`` (proceed, or failed) and ``reason`` to the steps of runs.

    The first abort of a run ends it: that step and all later ones are aborted. The
    first abort is one small row per run, so no run is sorted or held in one task.
    """
    first_abort = steps.where(F.col(action) == ABORT).groupBy(run).agg(F.min(seq).alias("_abort"))
    aborted = F.col(seq) >= F.col("_abort")
    reason = F.when(aborted, F.lit(ABORTED)).when(F.col(action) == SKIP, F.lit(SKIPPED))
    return (
        steps.join(first_abort, run, "left")
        .withColumn("reason", reason)
        .withColumn("decision", F.when(F.col("reason").isNull(), F.lit(PROCEED)).otherwise(F.lit(FAILED)))
        .drop("_abort")
    )


# --- one table ------------------------------------------------------------------------


class _Interrupted(Exception):
    """A run was interrupted before this table was done."""


def migrate_table(
    spark: SparkSession, step: Row, source: SourceReader, options: RunOptions, stopped: Event | None = None
) -> dict:
    """Check, export, load and compare one table; the first failing step names the error.

    A step with ``staged_rows`` was exported by an earlier run: its staged files are
    loaded as they are. One that is only to be exported ends there, skipped. Once ``stopped`` is set no further stage begins.
    """
    outcome = {name: step[name] for name in [*KEY, "table_key", "table_type"]}
    outcome |= {"target": f"{step.namespace}.{step.target_table}", "status": FAILED, "error": None}
    stage = CHECK

    def begin(name: str) -> str:
        if stopped is not None and stopped.is_set():
            raise _Interrupted
        return name

    try:
        stage, layout, path = begin(CHECK), load_options(step), step.stage_location
        staged = step["staged_rows"] if "staged_rows" in step else None
        if staged is None:
            stage = EXPORT
            frame = source(step.database, step.schema, step.table)
            columns = [ColumnMapping(c.column_name, c.data_type, c.name) for c in step["columns"]]
            whole = options.sample_rows is None and not step.override_sql
            # The rows of a whole source are counted where they are read, beneath the projection.
            read = Observation()
            rows = frame.observe(read, F.count(F.lit(1)).alias("rows")) if whole else frame
            chosen = export_selection(rows, columns, options.sample_rows, step.override_sql, options.cast_zoned_timestamps)
            stage = begin(CHECK)
            left_out = check_load(spark, storable(chosen).schema, layout)
            if left_out:
                outcome["note"] = f"columns that the schema leaves out: {', '.join(left_out)}"
            stage, exported = begin(EXPORT), None
            if whole:
                again = "continued" in step and bool(step["continued"])
                exported = export_chunks(frame, columns, path, options.cast_zoned_timestamps, options.chunk_bytes, again)
            in_chunks = exported is not None
            exported = exported or export_frame(chosen, path)
            # All is staged: from here on an interrupt leaves a table to be loaded.
            outcome["expected_rows"], path, stage = exported.rows, exported.path, LOAD
            if whole:
                outcome["source_rows"] = exported.rows if in_chunks else read.get["rows"]
            elif options.count_sources or counted_by_footers(frame):
                outcome["source_rows"] = frame.count()
            if step.action == EXPORT_ONLY:
                return outcome | {"error": SKIPPED, "failed_stage": LOAD}
        else:
            outcome["expected_rows"], outcome["source_rows"] = staged, step["staged_source_rows"]
        stage = LOAD
        begin(LOAD)
        load_table(spark, path, options.target_root, step.namespace, step.target_table, layout)
        stage = COUNT
        outcome["target_rows"] = target_row_count(spark, step.namespace, step.target_table)
        if outcome["expected_rows"] != outcome["target_rows"]:
            outcome["error"] = MISMATCH % (outcome["expected_rows"], outcome["target_rows"])
            outcome["failed_stage"] = COUNT
        else:
            outcome["status"] = SUCCEEDED
    except _Interrupted:
        outcome |= {"error": INTERRUPTED, "failed_stage": stage}
    except Exception as error:  # one table's failure must not end the batch
        interrupted = stopped is not None and stopped.is_set()
        text = INTERRUPTED if interrupted else f"{stage} failed: {error_text(error)}"
        outcome |= {"error": text, "failed_stage": stage}
    return outcome


def load_options(step: Row) -> LoadOptions:
    return LoadOptions(
        custom_schema=step.custom_schema,
        partition_field=step.partition_field,
        partition_unit=step.partition_unit or "DAY",
        cluster_fields=tuple(step.cluster_fields or ()),
    )


# --- a batch --------------------------------------------------------------------------


def run(
    spark: SparkSession,
    plan: DataFrame,
    source: SourceReader,
    options: RunOptions,
    run_id: str,
    earlier_run_id: str | None = None,
) -> DataFrame:
    """Migrate the tables of a plan in order and return their outcomes.

    Tables run independently, ``max_parallel`` at a time, each as its own Spark
    jobs; a failure is recorded and the batch goes on. Outcomes are appended to
    ``<manifest_root>/<run_id>`` as they arrive, so an interrupted run can resume:
    a lost driver loses the outcomes of at most the last ``_SECONDS_PER_WRITE``.
    After an interrupt tables that are under way end their Spark jobs and begin no
    further stage; what finished keeps its outcome. A ``run_id`` is used once.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone != options.session_tz:
        raise ValueError(f"session time zone is {zone}, the run asks for {options.session_tz}")
    manifest = f"{options.manifest_root.rstrip('/')}/{run_id}"
    # Decided once and stored: the plan must not change while its tables move.
    plan_path = f"{manifest}/{_PLAN}"
    decided = dispositions(plan.withColumn("run_id", F.lit(run_id)))
    decided.write.parquet(plan_path)
    parent = spark.createDataFrame([(earlier_run_id,)], "earlier_run_id string")
    parent.coalesce(1).write.json(f"{manifest}/{_PARENT}")
    decided = spark.read.parquet(plan_path)

    reason = F.coalesce("error", "reason")
    _append(_as_failed(decided.where(reason.isNotNull()), reason), manifest)
    steps = decided.where(reason.isNull()).orderBy("seq").toLocalIterator()
    try:
        _run_steps(spark, steps, source, options, manifest)
    except KeyboardInterrupt:
        done = read_outcomes(spark, manifest)
        _append(_as_failed(remaining(decided, done), F.lit(INTERRUPTED)), manifest)
    return read_outcomes(spark, manifest)


def _run_steps(
    spark: SparkSession, steps: Iterator[Row], source: SourceReader, options: RunOptions, manifest: str
) -> None:
    finished: list[dict] = []
    written = time.monotonic()

    def flush() -> None:
        nonlocal written
        written = time.monotonic()
        if finished:
            rows = [tuple(outcome.get(name) for name in OUTCOME_COLUMNS) for outcome in finished]
            _append(spark.createDataFrame(rows, OUTCOME_SCHEMA).coalesce(1), manifest)
            finished.clear()

    tag, stopped = f"tableferry-{uuid.uuid4().hex}", Event()

    def migrate(step: Row) -> dict:
        # One FAIR pool per worker thread keeps a huge table from starving the others.
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", current_thread().name)
        spark.sparkContext.addJobTag(tag)
        return migrate_table(spark, step, source, options, stopped)

    with ThreadPoolExecutor(options.max_parallel, "tableferry") as pool:
        target = inheritable_thread_target(spark)(migrate)
        pending: set[Future] = {pool.submit(target, s) for s in islice(steps, options.max_parallel)}
        done: set[Future] = set()
        try:
            while pending:
                done, pending = wait(pending, _SECONDS_PER_WRITE, FIRST_COMPLETED)
                while done:
                    finished.append(done.pop().result())
                # Small tables are written together, the outcome of a long one at once.
                if len(finished) >= _OUTCOMES_PER_WRITE or time.monotonic() - written > _SECONDS_PER_WRITE:
                    flush()
                pending |= {pool.submit(target, s) for s in islice(steps, options.max_parallel - len(pending))}
        except BaseException:
            stopped.set()
            waiting = done | pending
            while not all(f.done() for f in waiting):
                spark.sparkContext.cancelJobsWithTag(tag)  # again: a worker may have been between two jobs
                wait(waiting, 1)
            finished += [f.result() for f in waiting if not f.cancelled() and f.exception() is None]
            raise
        finally:
            flush()


def _as_failed(steps: DataFrame, error: Column) -> DataFrame:
    counts = {name: F.lit(None).cast("long") for name in ("source_rows", "expected_rows", "target_rows")}
    made = {
        **counts,
        "error": error,
        "target": F.concat_ws(".", "namespace", "target_table"),
        "failed_stage": F.lit(None).cast("string"),
        "note": F.lit(None).cast("string"),
        "status": F.lit(FAILED),
    }
    return steps.select(*[made[n].alias(n) if n in made else F.col(n) for n in OUTCOME_COLUMNS])


def _append(outcomes: DataFrame, manifest: str) -> None:
    outcomes.write.mode("append").partitionBy("status").json(manifest)


# --- outcomes -------------------------------------------------------------------------


def read_outcomes(spark: SparkSession, manifest: str, status: str | None = None) -> DataFrame:
    """Outcomes of a run; empty when it has none of that status."""
    outcomes = spark.read.schema(OUTCOME_SCHEMA).json(manifest)
    return outcomes if status is None else outcomes.where(F.col("status") == status)


def status_totals(outcomes: DataFrame) -> DataFrame:
    """Number of tables per status."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))


def remaining(plan: DataFrame, outcomes: DataFrame, by: list[str] = KEY) -> DataFrame:
    """Planned tables without an outcome."""
    return plan.join(outcomes.select(*by), by, "left_anti")


def run_chain(spark: SparkSession, options: RunOptions, run_id: str) -> list[str]:
    """A run and the runs that it resumed, latest first."""
    chain: list[str] = []
    while run_id is not None and run_id not in chain:
        chain.append(run_id)
        path = f"{options.manifest_root.rstrip('/')}/{run_id}/{_PARENT}"
        parent = spark.read.schema("earlier_run_id string").json(path).first()
        run_id = parent and parent.earlier_run_id
    return chain


def chain_outcomes(spark: SparkSession, options: RunOptions, run_id: str) -> DataFrame:
    """Outcomes of a run and those it resumed, with ``age`` (0: the latest run)."""
    found = None
    for age, name in enumerate(run_chain(spark, options, run_id)):
        own = read_outcomes(spark, f"{options.manifest_root.rstrip('/')}/{name}").withColumn("age", F.lit(age))
        found = own if found is None else found.unionAll(own)
    return found


def resume(
    spark: SparkSession,
    plan: DataFrame,
    source: SourceReader,
    options: RunOptions,
    run_id: str,
    earlier_run_id: str,
    reload: bool = False,
) -> DataFrame:
    """Run the tables that an earlier run, and the runs which that one resumed, did not finish.

    An export in chunks goes on behind those that are done.
    With ``reload`` a table whose last outcome failed at the load or the count is
    loaded from the files that its export staged; nothing of the source is read.
    """
    earlier = chain_outcomes(spark, options, earlier_run_id)
    left = remaining(plan, earlier.where(F.col("status") == SUCCEEDED)).withColumn("continued", F.lit(True))
    if reload:
        latest = earlier.groupBy(*KEY).agg(F.min_by(F.struct("failed_stage", "expected_rows", "source_rows"), "age").alias("last"))
        staged = latest.where(F.col("last.failed_stage").isin(LOAD, COUNT)).select(
            *KEY, F.col("last.expected_rows").alias("staged_rows"), F.col("last.source_rows").alias("staged_source_rows")
        )
        left = left.join(staged, KEY, "left")
    return run(spark, left, source, options, run_id, earlier_run_id)

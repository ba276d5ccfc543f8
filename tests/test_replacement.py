from __future__ import annotations

import uuid
from glob import glob

import pytest

from tableferry.operators import load, replacement
from tableferry.operators.load import LoadOptions, create_external_table, load_table, read_table, table_name
from tableferry.operators.validation import target_row_count


class Lost(BaseException):
    """The driver is gone: nothing that handles errors runs."""


@pytest.fixture
def staged(tmp_path):
    def write(frame):
        path = f"{tmp_path}/stage-{uuid.uuid4().hex}"
        frame.write.parquet(path)
        return path

    return write


class Steps:
    """Counts what a swap does to the catalog and the files, and is lost at the given step, before or after it."""

    def __init__(self, monkeypatch, spark):
        self.done, self.last, self.after = 0, None, False
        sql = type(spark).sql

        def statement(session, text, *args, **kwargs):
            if not text.startswith(("CREATE TABLE", "MSCK", "ALTER", "DROP")):
                return sql(session, text, *args, **kwargs)
            return self.step(sql, session, text, *args, **kwargs)

        monkeypatch.setattr(type(spark), "sql", statement)
        for module, name in ((replacement, "write_text"), (replacement, "delete_file"), (load, "delete_directory")):
            real = getattr(module, name)
            monkeypatch.setattr(module, name, lambda *a, real=real: self.step(real, *a))

    def step(self, real, *args, **kwargs):
        if self.last is None:
            return real(*args, **kwargs)
        self.done += 1
        if self.done == self.last and not self.after:
            raise Lost
        out = real(*args, **kwargs)
        if self.done == self.last:
            raise Lost
        return out

    def lost(self, action, last, after):
        """Whether the action was lost; False once it has fewer steps."""
        self.done, self.last, self.after = 0, last, after
        try:
            action()
            return False
        except Lost:
            return True
        finally:
            self.last = None


def entries(spark, namespace):
    return sorted(t.name for t in spark.catalog.listTables(namespace))


def records(tmp_path, namespace):
    return glob(f"{tmp_path}/{namespace}/_swaps/**/*.*", recursive=True)


@pytest.mark.parametrize(("ending", "after"), [("read", False), ("count", True), ("load", False), ("recover", True)])
def test_a_driver_lost_at_any_point_leaves_old_or_new_rows(spark, staged, namespace, tmp_path, monkeypatch, ending, after):
    old, older, new = staged(spark.range(5)), staged(spark.range(4)), staged(spark.range(9).selectExpr("id", "date '2024-01-01' + int(id) AS day"))
    steps, root = Steps(monkeypatch, spark), str(tmp_path)
    options, seen = LoadOptions(partition_field="day", partition_unit="MONTH"), set()
    for last in range(1, 20):
        table = f"t{last}"
        load_table(spark, older, root, namespace, table)
        load_table(spark, old, root, namespace, table)
        if not steps.lost(lambda: load_table(spark, new, root, namespace, table, options), last, after):
            break
        if ending == "load":
            load_table(spark, staged(spark.range(3)), root, namespace, table)
            assert read_table(spark, namespace, table).count() == 3
        else:
            if ending == "recover":
                replacement.recover(spark, namespace)
            rows = target_row_count(spark, namespace, table) if ending == "count" else read_table(spark, namespace, table).count()
            assert rows in (5, 9)
            seen.add(rows)
            replacement.recover(spark, namespace)
            assert read_table(spark, namespace, table).count() == rows
        assert entries(spark, namespace) == [table] and records(tmp_path, namespace) == []
        assert len(glob(f"{tmp_path}/{namespace}/{table}/v-*")) == 2
        spark.sql(f"DROP TABLE {table_name(namespace, table)}")
    assert last >= 8
    assert ending == "load" or seen == {5, 9}


def test_a_first_load_that_is_lost_leaves_nothing_or_all(spark, staged, namespace, tmp_path, monkeypatch):
    rows, steps, root = staged(spark.range(9)), Steps(monkeypatch, spark), str(tmp_path)
    for last in range(1, 20):
        if not steps.lost(lambda: load_table(spark, rows, root, namespace, "t"), last, last % 2 == 0):
            break
        found = target_row_count(spark, namespace, "t")
        replacement.recover(spark, namespace)
        assert target_row_count(spark, namespace, "t") == found and found in (0, 9)
        assert entries(spark, namespace) == ["t"] * (found > 0)
        assert len(glob(f"{tmp_path}/{namespace}/t/v-*")) == (found > 0)
        spark.sql(f"DROP TABLE IF EXISTS {table_name(namespace, 't')}")
        for path in glob(f"{tmp_path}/{namespace}/t/v-*"):
            replacement.delete_directory(spark, path)


def test_external_tables_keep_their_files(spark, staged, namespace, tmp_path, monkeypatch):
    a, b, steps = staged(spark.range(3)), staged(spark.range(7)), Steps(monkeypatch, spark)
    for last in range(1, 20):
        create_external_table(spark, a, str(tmp_path), namespace, "T")
        if not steps.lost(lambda: create_external_table(spark, b, str(tmp_path), namespace, "T"), last, last % 2 == 1):
            break
        assert read_table(spark, namespace, "t_external").count() in (3, 7)
        replacement.recover(spark, namespace)
        assert entries(spark, namespace) == ["t_external"] and records(tmp_path, namespace) == []
        assert spark.read.parquet(a).count() == 3 and spark.read.parquet(b).count() == 7


def test_a_replaced_entry_that_could_not_be_dropped_goes_at_the_next_load(spark, staged, namespace, tmp_path, monkeypatch):
    rows, root = staged(spark.range(5)), str(tmp_path)
    load_table(spark, rows, root, namespace, "t")
    with monkeypatch.context() as patch:
        real = type(spark).sql

        def sql(self, text, *args, **kwargs):
            if text.startswith("DROP TABLE") and "before" in text:
                raise RuntimeError("no drop")
            return real(self, text, *args, **kwargs)

        patch.setattr(type(spark), "sql", sql)
        with pytest.warns(UserWarning, match="no drop"):
            load_table(spark, rows, root, namespace, "t")
    assert len(entries(spark, namespace)) == 2
    load_table(spark, rows, root, namespace, "t")
    assert entries(spark, namespace) == ["t"] and records(tmp_path, namespace) == []


def test_a_swap_under_way_is_left_alone(spark, namespace, tmp_path):
    load.create_namespace(spark, namespace, str(tmp_path))
    swap = replacement.Swap(namespace, "t")
    with replacement.recorded(spark, swap):
        assert replacement.recover(spark, namespace) == []
        assert len(records(tmp_path, namespace)) == 1
    assert records(tmp_path, namespace) == []
    assert replacement.recover(spark, "no_such_namespace") == []

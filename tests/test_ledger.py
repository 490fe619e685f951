"""File ledger: start/finish events, current state, re-run guard, exclusion."""

import tempfile

from salesmart.operators import ledger as LG


def _files(spark, names):
    return spark.createDataFrame([(n, f"land/{n}") for n in names], "file_name string, path string")


def test_lifecycle(spark):
    files = _files(spark, ["a.csv", "b.csv", "c.csv"])
    ev = LG.ledger_start(files, "2024-01-01 00:00:00").unionByName(
        LG.ledger_finish(files.where("file_name = 'a.csv'"), "2024-01-01 00:10:00")
    )
    cur = {r.file_name: r for r in LG.ledger_current(ev).collect()}
    assert cur["a.csv"].status == "I" and cur["b.csv"].status == "A"
    assert str(cur["a.csv"].created_date) == "2024-01-01 00:00:00"
    assert str(cur["a.csv"].updated_date) == "2024-01-01 00:10:00"
    assert cur["a.csv"].file_location == "land/a.csv"
    pending = sorted(r.file_name for r in LG.ledger_pending(files, ev).collect())
    assert pending == ["b.csv", "c.csv"]
    todo = sorted(r.file_name for r in LG.unprocessed(files.union(_files(spark, ["d.csv"])), ev).collect())
    assert todo == ["b.csv", "c.csv", "d.csv"]


def test_same_instant_finish_wins(spark):
    files = _files(spark, ["a.csv"])
    ev = LG.ledger_start(files, "2024-01-01 00:00:00").unionByName(LG.ledger_finish(files, "2024-01-01 00:00:00"))
    assert LG.ledger_current(ev).first().status == "I"


def test_restart_after_finish_is_pending(spark):
    files = _files(spark, ["a.csv"])
    ev = (
        LG.ledger_start(files, "2024-01-01 00:00:00")
        .unionByName(LG.ledger_finish(files, "2024-01-01 00:10:00"))
        .unionByName(LG.ledger_start(files, "2024-01-02 00:00:00"))
    )
    assert [r.file_name for r in LG.ledger_pending(files, ev).collect()] == ["a.csv"]


def test_persisted_ledger_appends(spark):
    path = tempfile.mkdtemp(prefix="salesmart-ledger-") + "/ledger"
    assert LG.read_ledger(spark, path).count() == 0
    files = _files(spark, ["a.csv"])
    LG.append_ledger(LG.ledger_start(files, "2024-01-01 00:00:00"), path)
    LG.append_ledger(LG.ledger_finish(files, "2024-01-01 00:05:00"), path)
    assert LG.read_ledger(spark, path).count() == 2
    assert LG.ledger_current(LG.read_ledger(spark, path)).first().status == "I"

"""Publication of several tables as one, and what a run that died leaves behind."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from launchtide import journal
from launchtide.journal import NotCommitted, begin, commit, last_committed, last_run, require_counts, runs, unfinished
from launchtide.plans import audit_path, batch_datamart, jobs, publish, read_datamart, run_batch, run_monthly, run_monthly_segments
from launchtide.schemas import ID_AS_CODED
from launchtide.sources import read_deltas, read_histograms
from tests.test_files import MONTHS, inputs, rows, stored  # noqa: F401


class Died(RuntimeError):
    pass


def dies(*args, **kwargs):
    raise Died


def test_runs_and_parts(spark, tmp_path):
    path = f"{tmp_path}/table/"
    assert last_run(spark, path) is None and unfinished(spark, path) == frozenset()
    with pytest.raises(NotCommitted, match="nothing has been published"):
        journal.require_committed(spark, path)
    first = begin(spark, path, [1, 2])
    assert unfinished(spark, path) == {"1", "2"} and not last_run(spark, path).committed
    commit(spark, path, first, {"1": 5, "2": 0}, {"note": "x", "1": "y"})
    known = last_run(spark, path)
    assert known.committed and known.counts == {"1": 5, "2": 0} and known.notes == {"note": "x", "1": "y"}
    dead = begin(spark, path, [2, 3])
    third = begin(spark, path, [3])
    commit(spark, path, third, {"3": 1})
    assert [run.nth for run in runs(spark, path)] == [first.nth, dead.nth, third.nth] == [1, 2, 3]
    assert unfinished(spark, path) == {"2"} and last_committed(spark, path).name == third.name
    with pytest.raises(NotCommitted, match="of 2 at"):
        journal.require_committed(spark, path)
    last = begin(spark, path, [2])
    assert last_committed(spark, path).name == third.name != last_run(spark, path).name == last.name
    commit(spark, path, last, {})
    assert journal.require_committed(spark, path).name == last.name


def test_counts_that_differ_are_named():
    require_counts("x", {"a": 1, "b": 0}, {"a": 1})
    with pytest.raises(RuntimeError, match="x: b has 0 rows, not 2"):
        require_counts("x", {"a": 1, "b": 2}, {"a": 1})


@pytest.mark.parametrize("step", ["segment_audit", "commit", "write_datamart", "require_counts"])
def test_a_batch_job_that_died_runs_again(spark, stored, inputs, tmp_path, monkeypatch, step):  # noqa: F811
    out = f"{tmp_path}/datamart"
    args = (spark, f"{stored}/profiles", "MY", MONTHS, f"{stored}/lookup", f"{stored}/launches", out)
    with monkeypatch.context() as broken:
        broken.setattr(jobs, step, dies)
        with pytest.raises(Died):
            run_batch(*args)
    with pytest.raises(NotCommitted):
        read_datamart(spark, out)
    written = run_batch(*args)
    assert rows(written) == rows(read_datamart(spark, out)) == rows(batch_datamart(*inputs))
    audit = {row.segment: row.n_rows for row in spark.read.parquet(audit_path(out)).collect()}
    assert last_run(spark, out).counts == audit and sum(audit.values()) == written.count()
    # What is committed is never replaced.
    with pytest.raises(AnalysisException):
        run_batch(*args)
    assert rows(read_datamart(spark, out)) == rows(batch_datamart(*inputs))


def test_a_table_without_journal_is_never_replaced(spark, inputs, tmp_path):  # noqa: F811
    path = f"{tmp_path}/mine"
    spark.range(3).write.parquet(path)
    with pytest.raises(AnalysisException):
        publish(spark, batch_datamart(*inputs), path)
    assert spark.read.parquet(path).count() == 3 and last_run(spark, path) is None


def test_an_audit_that_differs_is_not_committed(spark, inputs, tmp_path, monkeypatch):  # noqa: F811
    path = f"{tmp_path}/datamart"
    with monkeypatch.context() as broken:
        audit = jobs.segment_audit
        broken.setattr(jobs, "segment_audit", lambda table: audit(table.limit(5)))
        with pytest.raises(RuntimeError, match="the audit of"):
            publish(spark, batch_datamart(*inputs), path)
    assert not last_run(spark, path).committed


@pytest.mark.parametrize("step", ["write_histograms", "write_report", "write_deltas"])
def test_a_monthly_job_that_died_is_refused_until_its_months_ran(spark, stored, inputs, tmp_path, monkeypatch, step):  # noqa: F811
    out = f"{tmp_path}/out"

    def run(months):
        return run_monthly(spark, f"{stored}/profiles", "MY", months, f"{stored}/lookup", f"{stored}/launches", out)

    run(MONTHS[:2])
    with monkeypatch.context() as broken:
        broken.setattr(jobs, step, dies)
        with pytest.raises(Died):
            run(MONTHS[1:3])
    with pytest.raises(NotCommitted, match=f"{MONTHS[1]}, {MONTHS[2]}"):
        run_monthly_segments(spark, out, f"{tmp_path}/early")
    run([MONTHS[1], MONTHS[3]])
    with pytest.raises(NotCommitted, match=str(MONTHS[2])):
        run_monthly_segments(spark, out, f"{tmp_path}/early")
    total = run(MONTHS[2:])
    counts = {int(k): n for k, n in last_run(spark, out).counts.items()}
    stored_rows = {r.month: r["count"] for r in read_deltas(spark, f"{out}/deltas").groupBy("month").count().collect()}
    assert all(stored_rows.get(month, 0) == n for month, n in counts.items()) and set(counts) == set(MONTHS[2:])
    assert total.agg({"sum_count": "sum"}).first()[0] == read_histograms(spark, f"{out}/histograms").agg({"count": "sum"}).first()[0]
    segments = run_monthly_segments(spark, out, f"{tmp_path}/segments", ID_AS_CODED)
    assert rows(segments) == rows(jobs.assign_segments(read_deltas(spark, f"{out}/deltas"), ID_AS_CODED))

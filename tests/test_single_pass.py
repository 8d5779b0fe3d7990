"""What the ingest and featurize jobs store on their way."""

import tempfile

import pytest

from conftest import SF_SMALL
from purchase_signals.plans import runs
from purchase_signals.sources import files, keyindex, vocabulary
from purchase_signals.sources.tables import app_log

WIDE = 10  # columns of a whole row


@pytest.fixture
def copies(monkeypatch):
    """Names of the frames of many columns that the jobs store on the way."""
    out = []
    for module in (runs, keyindex, vocabulary):
        if not hasattr(module, "stored"):
            continue
        monkeypatch.setattr(module, "stored", lambda df, name, put=module.stored: (len(df.columns) >= WIDE and out.append(name), put(df, name))[1])
    return out


def test_jobs_write_whole_rows_once(spark, copies):
    log = app_log(spark, SF_SMALL).cache()
    root = f"{tempfile.mkdtemp(prefix='ps-once-')}/store"
    for n, part in enumerate((log.where("user_id % 3 <> 0"), log), 1):
        copies.clear()
        runs.ingest_batch(spark, part, root, f"r{n}", min_batch=1)
        assert copies == ["reduced"]
        copies.clear()
        assert runs.featurize_increment(spark, root, f"v{n}", min_batch=1) == f"v{n}"
        assert copies == []
    assert files.read_raw(spark, root).count() == log.count()
    last = files.read_runs(spark, root).where("processing_version = 'v2'").first()
    known = log.where("user_id % 3 <> 0").count()
    assert (last.record_count, last.new_record_count) == (log.count(), log.count() - known)
    log.unpersist()


def test_held_batch_lies_as_it_came(spark):
    rows = app_log(spark, SF_SMALL).limit(20).cache()
    root = f"{tempfile.mkdtemp(prefix='ps-held-')}/store"
    assert runs.ingest_batch(spark, rows.union(rows), root, "r1", min_batch=100)["pending"] == 20
    assert files.read_runs(spark, root, "pending_runs").first().record_count == 40
    assert runs.ingest_batch(spark, rows.limit(0), root, "r2", min_batch=1)["inserted"] == 20
    rows.unpersist()

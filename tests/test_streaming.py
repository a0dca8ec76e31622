"""Streaming smoke tests: the row-level operators on a file stream, drained with availableNow."""

import os
import shutil

from vigil.streaming import stream as st


def events_dir(tmp):
    d = os.path.join(tmp, "events_in")
    os.makedirs(d)
    shutil.copy("/root/testdata/sf0.001/events.parquet", os.path.join(d, "part-0.parquet"))
    return d


def test_findings_stream_matches_batch(spark, tmpdir_path):
    src = events_dir(tmpdir_path)
    events = st.read_events_stream(spark, src)
    out = os.path.join(tmpdir_path, "findings")
    q = st.start(st.findings_stream(events).drop("_processed_at"), "findings_test", output_path=out,
                 available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == spark.read.parquet(src).count()
    assert set(got.columns) >= {"id", "severity", "risk_score", "_data_quality"}


def test_training_rows_stream_foreach_batch(spark, tmpdir_path):
    seen = []

    def sink(batch, epoch):
        seen.append(batch.count())

    events = st.read_events_stream(spark, events_dir(tmpdir_path))
    q = st.start(st.training_rows_stream(events), "training_rows_test", sink=sink, available_now=True)
    q.awaitTermination(300)
    assert sum(seen) > 0

"""Positions of streams written by a listener and read back without the stream."""

import json
import time

import pytest

from docuweft.streaming import progress
from docuweft.streaming.progress import PositionLog


def report(batch, sources, name="changes"):
    return {"name": name, "batchId": batch, "timestamp": "2024-05-01T10:00:00.000Z", "sources": sources}


def kafka(latest, committed):
    return {"description": "KafkaV2[...]", "latestOffset": json.dumps(latest), "endOffset": json.dumps(committed)}


def test_lag_of_topics_is_read_back(spark, tmp_path):
    log = PositionLog(spark, str(tmp_path / "positions"), ("changes",))
    log.note(report(3, [kafka({"cdc_a.t": {"0": 10, "1": 5}, "cdc_b.t": {"0": 9}}, {"cdc_a.t": {"0": 4}, "cdc_b.t": {"0": 9}})]))
    log.note(report(4, [kafka({"cdc_a.t": {"0": 12, "1": 5}}, {"cdc_a.t": {"0": 12, "1": 2}})]))
    log.note(report(4, [kafka({"cdc_a.t": {"0": 12, "1": 6}}, {"cdc_a.t": {"0": 12, "1": 2}})]))  # the same batch again
    log.note(report(9, [kafka({"cdc_a.t": {"0": 99}}, {"cdc_a.t": {"0": 0}})], name="another"))
    log.note(report(5, [], name="changes"))
    streams = spark.createDataFrame([("cdc_a.t", "a"), ("cdc_b.t", "b")], "stream string, client_id string")
    assert sorted(map(tuple, progress.lag(spark, log.place, streams).collect())) == [("a", 4), ("b", 0)]
    assert {r["batch_id"] for r in progress.positions(spark, log.place).collect()} == {3, 4}


def test_positions_long_past_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(progress, "KEPT_BATCHES", 3)
    log = PositionLog(spark, str(tmp_path / "positions"))
    for batch in range(10):
        log.note(report(batch, [kafka({"t": {"0": batch}}, {"t": {"0": batch}})]))
    assert len([p for p in (tmp_path / "positions").iterdir() if p.suffix == ".json" and not p.name.startswith(".")]) == 3
    assert progress.positions(spark, log.place).first()["committed"] == 9


@pytest.mark.parametrize("files", [3])
def test_a_file_stream_reports_what_it_has_read(spark, tmp_path, files):
    (tmp_path / "events").mkdir()
    for n in range(files):
        (tmp_path / "events" / f"{n}.json").write_text(json.dumps({"n": n}))
    log = PositionLog(spark, str(tmp_path / "positions"), ("files",))
    spark.streams.addListener(log)
    try:
        rows = spark.readStream.schema("n long").option("maxFilesPerTrigger", 1).json(str(tmp_path / "events"))
        query = rows.writeStream.queryName("files").format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        until = time.time() + 60
        while time.time() < until and not (tmp_path / "positions" / f"files-{files - 1:010d}.json").exists():
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    found = progress.positions(spark, log.place).collect()
    assert [(r["query"], r["batch_id"], r["committed"]) for r in found] == [("files", files - 1, files)]

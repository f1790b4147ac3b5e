import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rowloom.errors import DataError
from rowloom.sources import ledger, sinks
from rowloom.streaming import features as streaming


def ids(spark, path):
    return sorted(r.id for r in ledger.read(spark, path).select("id").collect())


def files_of(folder):
    return [p for p in folder.rglob("*.parquet")]


def test_only_commits_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(DataError) as error:
        ledger.read(spark, path)
    assert error.value.code == "ledger_empty"
    schema = spark.range(0).schema
    assert ledger.read(spark, path, schema).count() == 0
    assert ledger.append(spark.range(5), path) == 5
    spark.range(100, 200).write.parquet(f"{path}/data/half-written")
    assert ledger.append(spark.range(5, 8), path) == 3
    assert ledger.append(spark.range(0), path) == 0
    assert ids(spark, path) == list(range(8))
    with pytest.raises(DataError) as error:
        ledger.append(spark.range(3).withColumn("x", F.lit(1)), path)
    assert error.value.code == "ledger_schema_changed"
    with pytest.raises(DataError) as error:
        ledger.append(spark.range(3), path, "s")
    assert error.value.code == "ledger_bad_batch"
    assert ids(spark, path) == list(range(8))


def test_batches_are_committed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert [ledger.append(spark.range(b, b + 2), path, "s", b) for b in (0, 1, 1, 0, 2)] == [2, 2, 0, 0, 2]
    assert ledger.append(spark.range(2), path, "other", 0) == 2
    assert ids(spark, path) == [0, 0, 1, 1, 1, 2, 2, 3]


def test_a_writer_that_meets_another_tries_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    ledger.append(spark.range(2), path)
    stale, latest = [ledger.listing(spark, path)], ledger._latest
    ledger.append(spark.range(2, 4), path)
    monkeypatch.setattr(ledger, "_latest", lambda folder: stale.pop() if stale else latest(folder))
    ledger.append(spark.range(4, 6), path)
    assert not stale and ids(spark, path) == list(range(6))
    assert ledger.listing(spark, path).version == 3
    monkeypatch.setattr(ledger, "_latest", lambda folder: ledger.Listing())
    with pytest.raises(DataError) as error:
        ledger.append(spark.range(1), path)
    assert error.value.code == "ledger_busy"


def test_compaction_keeps_rows_and_what_came_in_between(spark, tmp_path, monkeypatch):
    path = tmp_path / "t"
    for k in range(6):
        ledger.append(spark.range(k * 10, k * 10 + 10).repartition(3), str(path))
    ledger.append(spark.range(1000, 1100), str(path))  # a full part stays as it is
    full = ledger.listing(spark, str(path)).parts[-1]
    before, part = ids(spark, str(path)), ledger._write_part

    def meanwhile(df, folder, max_rows=None):
        made = part(df, folder, max_rows)
        if max_rows:
            monkeypatch.setattr(ledger, "_write_part", part)
            ledger.append(spark.range(5000, 5001), str(path))
        return made

    monkeypatch.setattr(ledger, "_write_part", meanwhile)
    assert ledger.compact(spark, str(path), ["id"], full_rows=50) == 6
    seen = ledger.listing(spark, str(path))
    assert full in seen.parts and len(seen.parts) == 3
    assert ids(spark, str(path)) == [*before, 5000]
    merged = spark.read.parquet(f"{path}/{seen.parts[0]['path']}")
    spans = sorted(tuple(r) for r in merged.groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).select("min(id)", "max(id)").collect())
    assert merged.count() == 60 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    # Nothing young goes; then all that is not listed.
    assert ledger.vacuum(spark, str(path)) == 0
    old = len(files_of(path))
    assert ledger.vacuum(spark, str(path), older_than=-10) == 6
    assert len(files_of(path)) < old and ids(spark, str(path)) == [*before, 5000]
    assert len(list((path / "listings").glob("*.json"))) == 1


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for k in range(3):
        ledger.append(spark.range(k, k + 1), path)
    part = ledger._write_part

    def meanwhile(df, folder, max_rows=None):
        monkeypatch.setattr(ledger, "_write_part", part)
        assert ledger.compact(spark, path, ["id"]) == 3
        return part(df, folder, max_rows)

    monkeypatch.setattr(ledger, "_write_part", meanwhile)
    assert ledger.compact(spark, path, ["id"]) == 0
    assert ids(spark, path) == [0, 1, 2]


def test_a_run_log_stays_compact(spark, tmp_path):
    path = str(tmp_path / "log")
    for step in range(40):
        sinks.commit_metrics(spark, path, "r", {"loss": 1.0 / (step + 1), "acc": float(step)}, step, compact_after=8)
        assert len(ledger.listing(spark, path).parts) < 8
    sinks.commit_metrics(spark, path, "r", {})
    rows = {(r.step, r.metric): r.value for r in ledger.read(spark, path).collect()}
    assert rows == {(s, m): v for s in range(40) for m, v in (("loss", 1.0 / (s + 1)), ("acc", float(s)))}
    ledger.vacuum(spark, path, older_than=-10)
    assert len(files_of(tmp_path / "log")) < 8


def test_ingestion_survives_a_death_before_and_after_the_commit(spark, tmp_path, monkeypatch):
    source, path, progress = (str(tmp_path / n) for n in ("in", "t", "progress"))
    spark.range(300).repartition(3).write.parquet(source)
    stream = lambda: streaming.read_stream(spark, source, spark.range(0).schema, files_per_trigger=1)
    commit = ledger._commit

    def dies(at, after):
        def attempt(folder, new):
            made = commit(folder, new) if new.version != at or after else None
            if new.version == at:
                raise RuntimeError("killed")
            return made

        return attempt

    for at, after in ((2, False), (2, True)):
        monkeypatch.setattr(ledger, "_commit", dies(at, after))
        with pytest.raises(StreamingQueryException):
            streaming.ingest(stream(), path, progress).awaitTermination()
    monkeypatch.setattr(ledger, "_commit", commit)
    assert ledger.listing(spark, path).streams == {"ingest": 1}
    streaming.ingest(stream(), path, progress).awaitTermination()
    assert ids(spark, path) == list(range(300))
    assert len(ledger.listing(spark, path).parts) == 3

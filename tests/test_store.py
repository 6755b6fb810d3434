"""The store of revisions: reuse, returns, and jobs that fail."""

import json

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from snapfold.sources import exports, store

SCHEMA = store.SCHEMA + ", http_status int"


def bodies(spark, *rows):
    return spark.createDataFrame([("s", "2026-01-01", "2026-01-02", url, at, body, 200) for url, at, body in rows], SCHEMA)


def kept(root):
    out = {}
    for m in sorted(root.glob("*/*/*/manifest.json")):
        told = json.loads(m.read_text())
        out[m.parent.name[64:], told["url"], told["fetched_at"]] = (m.parent / "response.json").read_text()
    return out


def test_equal_bodies_are_reused_and_returns_are_new(spark, tmp_path):
    store.append(bodies(spark, ("u", "1", '{"a":1}'), ("u", "2", '{"a":1}'), ("u", "3", '{"a":2}'), ("v", "1", '{"b":1}')), str(tmp_path))
    assert kept(tmp_path) == {("", "u", "1"): '{"a":1}', ("", "u", "3"): '{"a":2}', ("", "v", "1"): '{"b":1}'}
    store.append(bodies(spark, ("u", "4", '{"a":2}'), ("u", "5", '{"a":1}'), ("v", "2", '{"b":1}')), f"file://{tmp_path}")
    now = kept(tmp_path)
    assert len(now) == 4 and now["_000002", "u", "5"] == '{"a":1}' and not (tmp_path / "_staging").exists()
    read = exports.revisions(spark, str(tmp_path))
    assert read.where("ok").count() == 4 and exports.new_occurrences(read).count() == 4


def test_a_hundred_exports_over_many_tasks(spark, tmp_path):
    rows = spark.range(300).select(F.lit("s").alias("source"), F.concat(F.lit("d"), F.col("id") % 100).alias("start_date"), F.lit("e").alias("end_date"), F.lit("u").alias("url"), F.lpad(F.col("id").cast("string"), 4, "0").alias("fetched_at"), F.format_string('{"x":%d}', F.floor(F.col("id") / 200)).alias("body"))
    store.append(rows, str(tmp_path))
    assert len(kept(tmp_path)) == 200  # the second of three equals the first
    store.append(rows.where("fetched_at >= '0200'").withColumn("fetched_at", F.concat(F.lit("9"), "fetched_at")), str(tmp_path))
    assert len(kept(tmp_path)) == 200


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    store.append(bodies(spark, ("u", "1", "{}")), str(tmp_path))

    def some_die(batches):
        for b in batches:
            yield b
        if TaskContext.get().partitionId() == 2:
            raise RuntimeError("killed")

    many = spark.range(0, 400, 1, 4).select(F.lit("s").alias("source"), F.concat(F.lit("k"), F.col("id") % 50).alias("start_date"), F.lit("e").alias("end_date"), F.concat(F.lit("u"), "id").alias("url"), F.lit("1").alias("fetched_at"), F.lit("{}").alias("body"))
    store_rows = many.repartition(4, "url").mapInArrow(some_die, many.schema)
    with pytest.raises(Exception, match="killed"):
        _save(spark, store_rows, tmp_path)
    assert len(kept(tmp_path)) == 1 and {p.name for p in tmp_path.iterdir()} <= {"s", "_staging"}
    store.append(many, str(tmp_path))
    assert len(kept(tmp_path)) == 401


def _save(spark, rows, path):
    """Without the shuffle of ``append``, so that the other tasks have staged when one fails."""
    spark.dataSource.register(store.RevisionStore)
    rows.write.format("revisions").mode("append").save(str(path))


def test_a_commit_that_fails_takes_back_what_it_moved(tmp_path, monkeypatch):
    writer = store.RevisionWriter(str(tmp_path))
    from pyspark.sql import Row

    row = lambda u: Row(source="s", start_date="a", end_date="b", url=u, fetched_at="1", body=json.dumps(u))
    messages = [writer.write(iter([row("x")])), writer.write(iter([row("y")])), None]
    messages[1].folders.append((f"{tmp_path}/gone", f"{tmp_path}/s/a_b", "0" * 64))
    with pytest.raises(FileNotFoundError):
        writer.commit(messages)
    assert kept(tmp_path) == {} and not (tmp_path / "_staging").exists()


@pytest.mark.parametrize("body", ["<html>", "", None])
def test_what_is_no_json_is_refused(spark, tmp_path, body):
    with pytest.raises(Exception, match="JSON|Expecting"):
        store.append(bodies(spark, ("u", "1", body)), str(tmp_path))
    assert kept(tmp_path) == {}


def test_damage_is_noticed(spark, tmp_path):
    store.append(bodies(spark, ("u", "1", "{}")), str(tmp_path))
    folder = next(tmp_path.glob("s/*/*"))
    (folder / "response.json").write_text("[]")
    with pytest.raises(Exception, match="damaged"):
        store.append(bodies(spark, ("u", "2", "{}")), str(tmp_path))
    (folder / "manifest.json").unlink()
    with pytest.raises(Exception, match="incomplete"):
        store.append(bodies(spark, ("u", "2", "{}")), str(tmp_path))
    with pytest.raises(Exception, match="append-only"):
        bodies(spark, ("u", "2", "{}")).write.format("revisions").mode("overwrite").save(str(tmp_path))

"""The sink commits as a whole and once; the paged stream goes on where it stopped."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestrata.sources import paged, target

SCHEMA = "k long, v string, m map<string,string>"


def rows(spark, low, high, parts=3):
    k = F.col("id")
    return spark.range(low, high, 1, parts).select(k.alias("k"), F.concat(F.lit("v"), k).alias("v"), F.create_map(F.lit("a"), F.lit("1")).alias("m"))


def keys(df):
    return sorted(r.k for r in df.collect())


def test_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert target.manifests(path) == [] and keys(target.read(spark, path, SCHEMA)) == []
    target.write(rows(spark, 0, 10), path, "one")
    target.write(rows(spark, 10, 15), path, "two")
    assert keys(target.read(spark, path, SCHEMA)) == list(range(15)) and target.read(spark, path, SCHEMA).first().m == {"a": "1"}
    target.write(rows(spark, 0, 10), path, "one")  # the same batch again
    assert keys(target.read(spark, path, SCHEMA)) == list(range(15)) and [m["rows"] for m in target.manifests(path)] == [10, 5]
    target.write(rows(spark, 20, 22), path, "three", overwrite=True)
    target.write(rows(spark, 0, 0), path, "none")
    assert keys(target.read(spark, path, SCHEMA)) == [20, 21]


def test_a_task_that_fails(spark, tmp_path):
    """Nothing of the job is seen, whichever tasks had ended; the job can be run again."""
    path = f"{tmp_path}/t"
    target.write(rows(spark, 0, 5), path, "one")
    broken = rows(spark, 5, 400, 4).withColumn("v", F.when(F.col("k") == 350, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        target.write(broken, path, "two")
    assert keys(target.read(spark, path, SCHEMA)) == list(range(5)) and len(os.listdir(f"{path}/manifests")) == 1
    target.write(rows(spark, 5, 400, 4), path, "two")
    assert keys(target.read(spark, path, SCHEMA)) == list(range(400))


def test_attempts_that_are_not_committed(tmp_path):
    path = f"{tmp_path}/t"
    batch = pa.RecordBatch.from_pydict({"k": [1, 2]})
    writer = target.TargetWriter({"path": path, "batch": "one"}, False)
    lost, told = writer.write(iter([batch])), writer.write(iter([batch, batch]))  # two attempts of one task
    writer.commit([told, None])
    assert target.manifests(path)[0]["files"] == told.files and target.manifests(path)[0]["rows"] == 4
    assert os.path.exists(f"{path}/{lost.files[0]}")
    writer.abort([lost])
    assert not os.path.exists(f"{path}/{lost.files[0]}") and os.path.exists(f"{path}/{told.files[0]}")

    def dying():
        yield batch
        raise OSError("gone")

    before = set(os.listdir(f"{path}/data"))
    with pytest.raises(OSError):
        writer.write(dying())
    assert set(os.listdir(f"{path}/data")) == before
    again = target.TargetWriter({"path": path, "batch": "one"}, False)
    more = again.write(iter([batch]))
    again.commit([more])
    assert len(target.manifests(path)) == 1 and not os.path.exists(f"{path}/{more.files[0]}")


def test_rows_that_fail(spark, tmp_path):
    path = f"{tmp_path}/t"
    some = rows(spark, 0, 30).withColumn("error", F.when(F.col("k") % 10 == 0, "no"))
    with pytest.raises(Exception, match="can't be written"):
        target.write(some, path, "one")
    assert target.manifests(path) == []
    target.write(some, path, "one", on_error=target.KEEP)
    assert keys(target.read(spark, path, SCHEMA)) == [k for k in range(30) if k % 10]
    assert [(r.k, r.error) for r in target.read(spark, path, SCHEMA, failed=True).orderBy("k").collect()] == [(0, "no"), (10, "no"), (20, "no")]
    assert (target.manifests(path)[0]["rows"], target.manifests(path)[0]["errors"]) == (27, 3)
    with pytest.raises(ValueError):
        target.TargetWriter({"path": path, "onerror": "x"}, False)


def test_publishing(spark, tmp_path):
    path = f"{tmp_path}/t"
    made = spark.createDataFrame([("a", "published"), ("b", "draft"), ("c", "published")], "entry_id string, status string")
    target.write(made, path, "one")
    there = target.read(spark, path, "entry_id string, status string")
    assert not any(r.published for r in target.with_publication(spark, path, there).collect())
    for _ in range(2):
        target.publish(there, path, "one")
    assert {r.entry_id: r.published for r in target.with_publication(spark, path, there).collect()} == {"a": True, "b": False, "c": True}


def listing(path, n):
    pq.write_table(pa.table({"k": range(n)}), f"{path}.new", row_group_size=90)
    os.replace(f"{path}.new", path)


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    path, out, offsets = f"{tmp_path}/l.parquet", f"{tmp_path}/out", f"{tmp_path}/offsets"
    listing(path, 333)
    paged.register(spark)

    def run():
        stream = spark.readStream.format("paged").option("path", path).option("pagesize", 50).load()
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.schema("k long, page int").parquet(out).collect()))

    assert run() == [(k, k // 50) for k in range(333)]
    assert run() == [(k, k // 50) for k in range(333)]
    listing(path, 1000)  # it has grown, within a page
    assert run() == [(k, k // 50) for k in range(1000)]


def test_no_row_group_is_cut_unless_asked(tmp_path):
    listing(f"{tmp_path}/l.parquet", 1000)
    read = lambda **o: paged.PagedReader({"path": f"{tmp_path}/l.parquet", "pagesize": "10"} | o)
    whole = read().between(0, None)
    assert [(p.first, p.rows) for p in whole] == [(0, 1000)]
    reader = read()
    reader.pages = 5
    assert [(p.first, p.rows, p.groups) for p in reader.between(0, None)][:2] == [(0, 90, [0]), (90, 90, [1])]
    assert [(p.first, p.rows) for p in read(pages="30").between(45, 700)] == [(45, 295), (340, 300), (640, 60)]
    for r in (reader, read(pages="7")):
        for low, high in ((0, None), (45, 700), (999, 1000), (1000, None)):
            got = [(k, g) for p in r.between(low, high) for b in r.read(p) for k, g in zip(b["k"].to_pylist(), b["page"].to_pylist(), strict=True)]
            assert got == [(k, k // 10) for k in range(low, 1000 if high is None else high)]

"""A sink with a commit: what a job writes counts when all its tasks have ended well, as a whole, once.

A task writes files of its own under a name that no other attempt has, and tells their names. The commit puts the names of all
tasks' files in one manifest; only files that a manifest names are read, so an attempt that failed, was run twice or was
never committed leaves nothing to be seen. A batch that has a manifest already isn't written again. Rows that can't be written
(column error says why) end the job, or are kept apart in a table of their own. The file system is one that Arrow
reaches from every executor: a shared folder or the address of a store.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

KEEP, END = "keep", "end"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """What one task has written: the names of its files, rows and rows kept apart."""

    files: list[str]
    failed: list[str]
    rows: int
    errors: int


class TargetWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.batch = options["path"].rstrip("/"), options.get("batch") or uuid.uuid4().hex
        self.on_error, self.overwrite = options.get("onerror", END), overwrite
        if self.on_error not in (KEEP, END):
            raise ValueError(f"onerror is {KEEP} or {END}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, top = _store(self.path)
        name = uuid.uuid4().hex
        paths = {False: f"data/{name}.parquet", True: f"failed/{name}.parquet"}
        writers: dict[bool, pq.ParquetWriter] = {}
        rows = {False: 0, True: 0}
        done = False
        try:
            for batch in iterator:
                bad = pc.is_valid(batch.column("error")) if "error" in batch.schema.names else pa.array([False] * batch.num_rows)
                if self.on_error == END and pc.any(bad).as_py():
                    raise ValueError(f"a row can't be written: {pc.drop_null(batch.column('error'))[0].as_py()}")
                for failed in (False, True):
                    part = batch.filter(bad if failed else pc.invert(bad))
                    if not part.num_rows:
                        continue
                    part = part if failed or "error" not in part.schema.names else part.drop_columns(["error"])
                    if failed not in writers:
                        store.create_dir(f"{top}/{paths[failed].partition('/')[0]}", recursive=True)
                        writers[failed] = pq.ParquetWriter(store.open_output_stream(f"{top}/{paths[failed]}"), part.schema)
                    writers[failed].write_batch(part)
                    rows[failed] += part.num_rows
            done = True
        finally:
            for failed, writer in writers.items():
                writer.close()
                if not done:
                    store.delete_file(f"{top}/{paths[failed]}")
        return Written([paths[False]] if rows[False] else [], [paths[True]] if rows[True] else [], rows[False], rows[True])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, top = _store(self.path)
        there = manifests(self.path)
        if any(m["batch"] == self.batch for m in there):
            return self.abort(messages)
        told = [m for m in messages if m is not None]
        number = 1 + max((m["number"] for m in there), default=0)
        manifest = {"number": number, "batch": self.batch, "overwrite": self.overwrite, "files": [f for m in told for f in m.files], "failed": [f for m in told for f in m.failed], "rows": sum(m.rows for m in told), "errors": sum(m.errors for m in told)}
        store.create_dir(f"{top}/manifests", recursive=True)
        with store.open_output_stream(f"{top}/manifests/.{self.batch}") as out:
            out.write(json.dumps(manifest).encode())
        store.move(f"{top}/manifests/.{self.batch}", f"{top}/manifests/{number:08d}.json")  # at once: there or not

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, top = _store(self.path)
        for m in messages:
            for f in (*m.files, *m.failed) if m is not None else ():
                if store.get_file_info(f"{top}/{f}").type == fs.FileType.File:
                    store.delete_file(f"{top}/{f}")


class Target(DataSource):
    """``rows.write.format("target").option("path", folder).option("batch", name).option("onerror", "keep").mode("append").save()``"""

    @classmethod
    def name(cls) -> str:
        return "target"

    def writer(self, schema, overwrite: bool) -> TargetWriter:
        return TargetWriter(dict(self.options), overwrite)


def manifests(path: str) -> list[dict]:
    """What has been committed, in order; nothing for a target that isn't there yet."""
    store, top = _store(path.rstrip("/"))
    found = store.get_file_info(fs.FileSelector(f"{top}/manifests", allow_not_found=True))
    names = sorted(f.path for f in found if f.path.endswith(".json"))
    out = []
    for name in names:
        with store.open_input_stream(name) as file:
            out.append(json.loads(file.read()))
    return out


def write(rows: DataFrame, path: str, batch: str | None = None, on_error: str = END, overwrite: bool = False) -> None:
    """Write ``rows`` as one batch. Rows whose column error isn't null end the job or, with ``on_error`` keep, go to the failed ones."""
    rows.sparkSession.dataSource.register(Target)
    out = rows.write.format("target").option("path", path).option("onerror", on_error)
    (out.option("batch", batch) if batch else out).mode("overwrite" if overwrite else "append").save()


def _files(path: str, which: str) -> list[str]:
    """The files that count: those of the manifests since the last that replaced all."""
    out: list[str] = []
    for m in manifests(path):
        out = ([] if m["overwrite"] else out) + m[which]
    return [f"{path.rstrip('/')}/{f}" for f in out]


def read(spark: SparkSession, path: str, schema: str, failed: bool = False) -> DataFrame:
    """The rows that were committed, or those that were kept apart, which have error, too."""
    files = _files(path, "failed" if failed else "files")
    schema = f"{schema}, error string" if failed else schema
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def publish(rows: DataFrame, path: str, batch: str | None = None) -> None:
    """Publish the records (entry_id, status) that are to be: a table of their ids beside the records, written by the same rules.

    A record is published after it is there, so a job that ends between the two leaves drafts, and running it again ends it.
    """
    write(rows.where("status = 'published'").select("entry_id"), f"{path.rstrip('/')}/published", batch)


def with_publication(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """``records`` (entry_id, ...) and whether each has been published."""
    done = read(spark, f"{path.rstrip('/')}/published", "entry_id string").distinct().withColumn("published", F.lit(True))
    return records.join(done, "entry_id", "left").withColumn("published", F.coalesce("published", F.lit(False)))

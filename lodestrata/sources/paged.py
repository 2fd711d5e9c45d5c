"""Paged reads: a data source of the pages of a collection, many pages to a partition.

The collection is a Parquet file and stands for a remote listing. The probe reads the counts only; a task reads the row groups
that its own pages touch, a batch of one page at a time, with retries. As a stream, the listing is read from where the last
batch ended; the offset is the number of rows read, so a stream that was stopped goes on with the next row, within a page or not.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

PAGE = 100
PAGES = 1000
RETRIES = 10


@dataclass
class Pages(InputPartition):
    """Pages one after another: the first one's number, their rows, their row groups, where in these they begin, and the first row's number."""

    number: int
    rows: int
    groups: list[int]
    skip: int
    first: int


def _open(path: str):
    """A Parquet file wherever Arrow can reach it: a local path or an address of a store."""
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    store, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return pq.ParquetFile(store.open_input_file(inner))


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.size = int(options.get("pagesize", PAGE))
        self.pages, self.exactly = int(options.get("pages", PAGES)), "pages" in options
        self.retries = int(options.get("retries", RETRIES))

    def partitions(self) -> list[Pages]:
        return self.between(0, None)

    def between(self, first: int, last: int | None) -> list[Pages]:
        """The pages from one row to before another (None: all there are): ``pages`` to a partition where that is asked for,
        else at least as many, up to the end of a row group, so that no row group is decoded by many tasks."""
        meta = _open(self.path).metadata  # the probe: only the counts
        ends, n = [], 0
        for k in range(meta.num_row_groups):
            n += meta.row_group(k).num_rows
            ends.append(n)
        last = n if last is None else min(last, n)
        step, out = self.size * self.pages, []
        while first < last:
            stop = (first // self.size) * self.size + step
            if not self.exactly and stop < last:
                stop = -(-ends[bisect_left(ends, stop)] // self.size) * self.size
            stop = min(stop, last)
            low, high = bisect_right(ends, first), bisect_left(ends, stop)
            out.append(Pages(first // self.size, stop - first, list(range(low, high + 1)), first - (ends[low - 1] if low else 0), first))
            first = stop
        return out

    def read(self, pages: Pages) -> Iterator[pa.RecordBatch]:
        done = 0
        for left in reversed(range(self.retries + 1)):
            try:
                for batch in self._rows(pages, done):
                    yield batch
                    done += batch.num_rows
                return
            except OSError:
                if not left:
                    raise

    def _rows(self, pages: Pages, done: int) -> Iterator[pa.RecordBatch]:
        """The rows from the ``done``-th on, none of which crosses the end of a page."""
        skip, left, at = pages.skip + done, pages.rows - done, pages.first + done
        for batch in _open(self.path).iter_batches(self.size, row_groups=pages.groups):
            if skip >= batch.num_rows:
                skip -= batch.num_rows
                continue
            batch, skip = batch.slice(skip), 0
            while batch.num_rows and left:
                part = batch.slice(0, min(left, self.size - at % self.size))
                yield part.append_column("page", pa.array([at // self.size] * part.num_rows, pa.int32()))
                batch, left, at = batch.slice(part.num_rows), left - part.num_rows, at + part.num_rows
            if not left:
                return


class PagedStream(DataSourceStreamReader):
    """The listing as it grows at its end: a batch has the rows since the last one."""

    def __init__(self, options: dict[str, str]):
        self.reader = PagedReader(options)

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        return {"row": _open(self.reader.path).metadata.num_rows}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return self.reader.between(start["row"], end["row"])

    def read(self, pages: Pages) -> Iterator[pa.RecordBatch]:
        return self.reader.read(pages)

    def commit(self, end: dict) -> None:
        """Nothing is kept for a batch that has been read."""


class PagedSource(DataSource):
    """``spark.read.format("paged").option("path", file).option("pagesize", 100).load()``, or ``readStream`` for a listing that grows."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        return from_arrow_schema(_open(self.options["path"]).schema_arrow.append(pa.field("page", pa.int32())))

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def streamReader(self, schema) -> PagedStream:
        return PagedStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)

"""A paged record source as a Spark data source: an input partition reads a few consecutive pages.

Pages are files of JSON records in a shared folder, named so that their order is the page order
(``page=00001`` ...). A folder stands in for the publisher's network interface: Spark schedules
the pages, and every record arrives with the evidence of the page that delivered it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from attestry.session import ship_package

SCHEMA = "page_sequence bigint, endpoint string, page_sha256 string, page_rows bigint, record string"
_ARROW = pa.schema(
    [
        ("page_sequence", pa.int64()),
        ("endpoint", pa.string()),
        ("page_sha256", pa.string()),
        ("page_rows", pa.int64()),
        ("record", pa.string()),
    ]
)


def _body(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path) as stream:
        return stream.read()


def mark_complete(path: str) -> None:
    """Say that no page will follow, so that the newest one may be read too."""
    system, base = PagedReader({"path": path})._filesystem()
    system.open_output_stream(f"{base}/_COMPLETE").close()


class PageRange(InputPartition):
    """Consecutive pages: ``(sequence, files)`` each."""

    def __init__(self, pages: list[tuple[int, list[str]]]):
        self.pages = pages


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        # The Arrow file systems know the object store under its plain scheme.
        self.path = options["path"].replace("s3a://", "s3://", 1)
        self.first = int(options.get("firstPage", 0))
        self.per_task = int(options.get("pagesPerTask", 32))
        self.limit = int(options["maxPages"]) if "maxPages" in options else None
        self.batch_rows = int(options.get("batchRows", 10_000))

    def _filesystem(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            uri = self.path if "://" in self.path else "file://" + self.path.removeprefix("file:")
            return fs.FileSystem.from_uri(uri)
        return fs.LocalFileSystem(), self.path

    def _listed(self) -> dict[int, list[str]]:
        """Files of every page that is there."""
        system, base = self._filesystem()
        listed = system.get_file_info(fs.FileSelector(base, recursive=True))
        pages: dict[int, list[str]] = {}
        for info in listed:
            folder = info.path.rsplit("/", 2)[-2]
            name = info.path.rsplit("/", 1)[-1]
            if info.type == fs.FileType.File and folder.startswith("page=") and not name.startswith((".", "_")):
                pages.setdefault(int(folder.removeprefix("page=")), []).append(info.path)
        return pages

    def _ranges(self, wanted: list[int], pages: dict[int, list[str]]) -> list[PageRange]:
        listed_pages = [(p, sorted(pages[p])) for p in wanted]
        return [PageRange(listed_pages[i : i + self.per_task]) for i in range(0, len(listed_pages), self.per_task)]

    def partitions(self) -> list[PageRange]:
        pages = self._listed()
        wanted = sorted(p for p in pages if p >= self.first)
        if self.limit is not None:
            wanted = wanted[: self.limit]
        return self._ranges(wanted, pages)

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        system, _ = self._filesystem()
        for sequence, paths in partition.pages:
            yield from self._read_page(system, sequence, paths)

    def _read_page(self, system: fs.FileSystem, sequence: int, paths: list[str]) -> Iterator[pa.RecordBatch]:
        # A page is one response of the publisher: it is read once, and held while its records go out in bounded batches.
        bodies = [_body(system, path) for path in paths]
        proof = hashlib.sha256(b"".join(bodies)).hexdigest()
        # Lines that hold more than white space; the last one may lack its end.
        records = [[line for line in body.split(b"\n") if line.strip()] for body in bodies]
        rows = sum(map(len, records))
        for path, own in zip(paths, records):
            for start in range(0, len(own), self.batch_rows):
                yield self._batch(sequence, path, proof, rows, [line.decode() for line in own[start : start + self.batch_rows]])

    def _batch(self, sequence: int, path: str, proof: str, rows: int, records: list[str]) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([sequence] * n, pa.int64()),
                pa.array([path.rsplit("/", 1)[0]] * n, pa.string()),
                pa.array([proof] * n, pa.string()),
                pa.array([rows] * n, pa.int64()),
                pa.array(records, pa.string()),
            ],
            schema=_ARROW,
        )


PAGE_SCHEMA = "page_sequence bigint, endpoint string, page_sha256 string, body string"
_PAGE = pa.schema([("page_sequence", pa.int64()), ("endpoint", pa.string()), ("page_sha256", pa.string()), ("body", pa.string())])


class PageStreamReader(DataSourceStreamReader):
    """Whole pages as they land, each once. The position is the number of the page after the last complete one, so a restart goes on there.

    A page is complete when a later page or the mark ``_COMPLETE`` lies beside it: the publisher writes pages in order. Pages after a
    missing one wait for it. Records are Spark's to parse (``page_records``); the reader hands out bytes once and looks at none.
    """

    def __init__(self, options: dict[str, str]):
        self.pages = PagedReader(options)
        self.most = int(options["maxPagesPerBatch"]) if "maxPagesPerBatch" in options else None
        self.given = self.pages.first

    def initialOffset(self) -> dict:
        return {"page": self.pages.first}

    def latestOffset(self) -> dict:
        system, base = self.pages._filesystem()
        there = self.pages._listed()
        marked = system.get_file_info(f"{base}/_COMPLETE").type == fs.FileType.File
        last = max(there, default=self.pages.first - 1)
        # The newest page may still be written to.
        at = self.given
        while at in there and (at < last or marked) and (self.most is None or at - self.given < self.most):
            at += 1
        return {"page": at}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        self.given = end["page"]
        there = self.pages._listed()
        return self.pages._ranges(list(range(start["page"], end["page"])), there)

    def commit(self, end: dict) -> None:
        self.given = end["page"]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        system, _ = self.pages._filesystem()
        for sequence, paths in partition.pages:
            body = b"\n".join(_body(system, path) for path in paths)
            values = (sequence, paths[0].rsplit("/", 1)[0], hashlib.sha256(body).hexdigest(), body.decode())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _PAGE)], schema=_PAGE)


class PageStreamSource(DataSource):
    """``spark.readStream.format("paged_stream").load(path)``; options ``firstPage``, ``maxPagesPerBatch``, ``pagesPerTask``."""

    @classmethod
    def name(cls) -> str:
        return "paged_stream"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return PageStreamReader(self.options)


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record of whole pages, with the number of records of its page; blank lines are no records."""
    lines = F.filter(F.split("body", "\n"), lambda line: F.length(F.trim(line)) > 0)
    cut = pages.withColumn("__lines", lines)
    return cut.select("page_sequence", "endpoint", "page_sha256", F.size("__lines").cast("bigint").alias("page_rows"), F.explode("__lines").alias("record"))


class PagedJsonSource(DataSource):
    """``spark.read.format("paged_json").load(path)``; options ``firstPage``, ``maxPages``, ``pagesPerTask``."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(self.options)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(PagedJsonSource)
    spark.dataSource.register(PageStreamSource)

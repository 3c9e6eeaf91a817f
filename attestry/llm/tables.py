"""Reading, intermediate tables and per-text helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.session import scratch_path


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's own code to the workers, once per application; it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later jobs start from the files, and so does a lost executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def per_batch(df: DataFrame, rows_of: Callable[[list], list], schema: str) -> DataFrame:
    """Arrow batches of ``df`` through ``rows_of(columns) -> columns``; ``columns`` are Python lists in the order of the fields."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                out = rows_of([c.to_pylist() for c in part.columns])
                if out and len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(out, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, where there is one, set to the length of ``text``."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


class Recent(dict):
    """A bounded memo of ``make``: emptied when it holds ``limit`` entries, so its memory does not grow with the input."""

    def __init__(self, make: Callable, limit: int = 250_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import cartwise
from cartwise.session import scratch_path

#: A word: a run of characters that are not ASCII white space (Java, RE2, Python).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts
    lineage, survives the loss of executors and is computed only once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def file_batches(path: str, rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of one Parquet file, read inside a task."""
    fs, name = _opened(path)
    with fs.open_input_file(name) as file:
        yield from pq.ParquetFile(file).iter_batches(batch_size=rows)


def parquet_batches(path: str, rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of a written table, read inside a task by its path, in the order of the
    files' names."""
    fs, base = _opened(path)
    for info in sorted(fs.get_file_info(pafs.FileSelector(base)), key=lambda i: i.path):
        if info.base_name.endswith(".parquet"):
            with fs.open_input_file(info.path) as file:
                yield from pq.ParquetFile(file).iter_batches(batch_size=rows)


def word_count(text) -> F.Column:
    """Number of words of a text as a long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: F.Column, body) -> F.Column:
    """``body`` of a lambda variable that holds ``value``: computed once, where a named
    column could be inlined into a lambda and computed for each of its elements."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def indices(n) -> F.Column:
    """0 .. n - 1 (empty for 0)."""
    return F.slice(F.sequence(F.lit(0), n), F.lit(1), n)


RUN = 64  # numbers that totals_before sums at once


def totals_before(numbers: F.Column) -> F.Column:
    """For each element of an array of numbers the sum of those before it: two-level
    sums over runs, so that no array grows by copying (``numbers`` is a variable)."""
    def total(x):
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + y)

    n = F.size(numbers)
    runs = indices(F.ceil(n / F.lit(float(RUN))).cast("int"))
    sums = F.transform(runs, lambda r: total(F.slice(numbers, r * RUN + 1, F.lit(RUN))))
    return let(sums, lambda s: let(
        F.transform(runs, lambda r: total(F.slice(s, F.lit(1), r))),
        lambda before: F.transform(indices(n), lambda i: F.get(before, F.floor(i / F.lit(RUN)).cast("int")) + total(
            F.slice(numbers, i - i % RUN + 1, i % RUN)))))


def highest_before(numbers: F.Column) -> F.Column:
    """For each element of an array of positive numbers the highest of those before it
    (0 for the first); linear as :func:`totals_before`."""
    def high(x):
        return F.coalesce(F.array_max(x), F.lit(0))

    n = F.size(numbers)
    runs = indices(F.ceil(n / F.lit(float(RUN))).cast("int"))
    highs = F.transform(runs, lambda r: high(F.slice(numbers, r * RUN + 1, F.lit(RUN))))
    return let(highs, lambda s: let(
        F.transform(runs, lambda r: high(F.slice(s, F.lit(1), r))),
        lambda before: F.transform(indices(n), lambda i: F.greatest(
            F.get(before, F.floor(i / F.lit(RUN)).cast("int")),
            high(F.slice(numbers, i - i % RUN + 1, i % RUN))))))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts: what shard counts are derived from."""
    row = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()
    return int(row[0] or 0)


def parts_for(n_bytes: int, target: int) -> int:
    """How many parts of about ``target`` bytes hold ``n_bytes``."""
    return max(1, -(-int(n_bytes) // int(target)))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their
    Python workers can import it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(cartwise.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cartwise-package-"), "cartwise.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)

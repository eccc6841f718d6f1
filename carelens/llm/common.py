"""What several operators share: shipping code to workers, and whole-batch access to texts."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"  # served to the workers by the driver
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


_kept: dict[str, Callable[[], None]] = {}


def enter(name: str, forget: Callable[[], None] | None = None) -> None:
    """Called in a worker by an operator that begins: what other operators keep there from task to task is forgotten, and its memory given back."""
    others = [n for n in _kept if n != name]
    for other in others:
        _kept.pop(other)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
    if forget is not None:
        _kept[name] = forget


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a missing text is empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def parts(b: pa.RecordBatch, text: int, rows: int = 512, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most so many rows and bytes of text; a longer text is a part of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < b.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, min(start + rows, int(np.searchsorted(ends, before + size, side="right"))))
        yield b.slice(start, stop - start)
        start = stop


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Batches sent to the workers end after so many bytes, in what runs meanwhile; a value set by the user is left alone.

    Without it a batch holds up to 64 MB, twice in the JVM while it grows and once in the worker, for each task.
    """
    if spark.conf.get(BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES)


def most_frequent(counts: DataFrame, times: str, n: int) -> DataFrame:
    """Rows with the largest counts, at most ``n``: all rows from some level on, levels being quarter powers of two.

    ``counts`` is a written table, as it is read twice; only a count per level goes to the driver.
    """
    level = F.floor(F.log2(times) * 4)
    sizes = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # a few hundred rows at most
    least, total = None, 0
    for r in sizes:
        total += r["count"]
        if total > n:
            break
        least = r["level"]
    return counts.where(F.lit(False) if least is None else level >= least)

"""What the operators share: shipping the package, written intermediate tables, global row numbers."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from tempfile import mkdtemp
from typing import Any
from weakref import WeakSet

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import marquee
from marquee.scratch import remove_folder, scratch_root

_shipped: WeakSet = WeakSet()


class Run:
    """What a run has made for itself: tables in the scratch folder and broadcast values."""

    def __init__(self) -> None:
        self.tables: list[str] = []
        self.values: list[Broadcast] = []

    def clear(self, spark: SparkSession) -> None:
        for path in self.tables:
            remove_folder(spark, path)
        for value in self.values:
            value.destroy()
        self.tables, self.values = [], []


# of this thread, so that runs side by side do not clear what is another's
_run: ContextVar[Run | None] = ContextVar("run", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per session, as ``--py-files`` would."""
    context = spark.sparkContext
    if context in _shipped:
        return
    root = Path(marquee.__file__).parent
    archive = Path(mkdtemp(prefix="marquee-ship-")) / "marquee_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: computed once, lineage cut.

    The files are copies that outlive any executor, so later stages never recompute it.
    """
    spark = df.sparkSession
    path = scratch_root(spark, label)
    if run := _run.get():
        run.tables.append(path)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def shared(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast value, which goes with the run that it is made in."""
    sent = spark.sparkContext.broadcast(value)
    if run := _run.get():
        run.values.append(sent)
    return sent


@contextmanager
def removing_written(spark: SparkSession) -> Iterator[None]:
    """A run: what ``written`` and ``shared`` make in the block goes when it ends, also by an error."""
    run = Run()
    token = _run.set(run)
    try:
        yield
    finally:
        _run.reset(token)
        run.clear(spark)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of the frame has, whatever the case."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def lower_ascii(text: Column) -> Column:
    """A-Z lowered, other letters left alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def training_part(id_column: str, modulus: int, held_out: int) -> Column:
    """Whether a row may be learnt from; a null id has remainder of the empty text."""
    return ~held_out_part(id_column, modulus, held_out)


def held_out_part(id_column: str, modulus: int, held_out: int) -> Column:
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == held_out


def prefix_offsets(counts: DataFrame, key: str, count: str) -> DataFrame:
    """Per key the sum of ``count`` over all smaller keys, as ``base``.

    For tables with a row per file or partition only: the running sum is one task.
    """
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(key, F.coalesce(F.sum(count).over(before), F.lit(0)).alias("base"))

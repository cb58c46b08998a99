"""Sets of tables that change all at once.

A root may hold versions of its tables in folders of their own, and a pointer, a small file that says
which version of each table counts (see :mod:`marquee.sources.tables`). Tables are written into a new
version first, and the pointer is replaced last. Several roots have a pointer each; they change together
by a mark, one file whose existence decides whether all of the pointers mean the old tables or the new.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

from marquee.sources.tables import VERSIONS, Pointer, read_pointer, write_pointer
from marquee.storage import children, exists, remove, write_text

# Formats that commit a whole table themselves and keep its history in its folder.
TRANSACTIONAL = ("delta", "iceberg", "hudi")


@contextmanager
def new_version(spark: SparkSession, roots: Sequence[str], fmt: str = "parquet") -> Iterator[list[str]]:
    """A folder per root for the tables of a new version. When the block ends, all tables in these folders
    take the place of those of their names, in all roots at once; after an error none does.

    Tables that are not written again stay. The version that was current before is kept, for readers
    that are still at it; older ones go. One writer at a time may do this to a root. Formats that commit by themselves are written
    in place, table by table: there the folders are the roots.
    """
    roots = [root.rstrip("/") for root in roots]
    if fmt in TRANSACTIONAL:
        yield roots
        return
    version = uuid4().hex
    folders = [f"{root}/{VERSIONS}/{version}" for root in roots]
    try:
        yield folders
        _publish(spark, roots, folders, version)
    except BaseException:
        if not exists(spark, _mark(roots, version)):
            for folder in folders:
                remove(spark, folder)
        raise


def _mark(roots: Sequence[str], version: str) -> str:
    return f"{roots[0]}/{VERSIONS}/{version}.done"


def _publish(spark: SparkSession, roots: Sequence[str], folders: Sequence[str], version: str) -> None:
    before = [read_pointer(spark, root).tables for root in roots]
    after = [
        old | {name: version for name in children(spark, folder) if not name.startswith((".", "_"))}
        for old, folder in zip(before, folders)
    ]
    mark = _mark(roots, version)
    for root, old, new in zip(roots, before, after):
        write_pointer(spark, root, Pointer(old, new, mark))
    write_text(spark, mark, version)  # from here on the new tables count
    for root, new in zip(roots, after):
        write_pointer(spark, root, Pointer(new))
    remove(spark, mark)
    for root, old, new in zip(roots, before, after):
        for name in set(children(spark, f"{root}/{VERSIONS}")) - set(old.values()) - set(new.values()):
            remove(spark, f"{root}/{VERSIONS}/{name}")

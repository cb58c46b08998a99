"""CSV records with quoted line breaks, read in byte ranges of files, in two passes and with no copy.

A range starts inside a quoted field when an odd number of quotes precedes it in its file. The first pass
reads every range by itself and tells, in one row each, how many quotes it has (odd or even) and whether they
and its line ends are regular, once for either way it might begin. A running sum over these rows says how each
range does begin. The second pass reads the ranges again as records: a range has the records that start in it,
and reads on to where the last of them ends.

Ranges are fixed when the first pass is planned, so executors may come and go. What the driver holds is a row
per range, as it does for the splits of any scan. Only regular files are read so: quotes stand around
a field or doubled inside a quoted one, and records end in LF or CRLF, as the first line of the file does.

Gzip files have one range each: it is read from the beginning, its length is known after the first pass.

Tasks open files by themselves, in Python: local and mounted ones, those in S3, and what else pyarrow reaches.
"""

from __future__ import annotations

import gzip
import io
import sys
import warnings
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from threading import Lock
from typing import Any
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import IntegerType, StructType

from marquee.sources import records

# executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes that a task holds at once, unless a record is longer.
CHUNK = 4 << 20

_QUOTE, _LF, _CR = b'"\n\r'

_registering = Lock()

# File name endings by which Hadoop knows compressed files: those that are one range, and those
# that have none.
GZIPPED = ".gz"
COMPRESSED = (".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd", ".xz", ".lzo")


# The end of a gzip file before its first pass.
_UNKNOWN = 1 << 62


@dataclass(frozen=True)
class Range:
    """Bytes ``begin`` to ``end`` of file ``number``; whether it begins in quotes, and in its file's header,
    and whether lines of its file end in CRLF, are known after the first pass."""

    number: int
    file: str
    begin: int
    end: int
    size: int
    open: bool = False
    header: bool = False
    crlf: bool = False


def open_input(uri: str, store: Mapping[str, str]):
    """What a file holds, to be read from any place. ``store`` holds the settings of an S3 store."""
    source = _opened(uri, store)
    # places a few bytes back are in the buffer, and so need no new beginning
    return io.BufferedReader(gzip.open(source), CHUNK) if uri.lower().endswith(GZIPPED) else source


def _opened(uri: str, store: Mapping[str, str]):
    from pyarrow import fs

    parts = urlsplit(uri)
    path = unquote(parts.path)
    if parts.scheme in ("", "file"):
        return open(path, "rb")
    if parts.scheme in ("s3", "s3a", "s3n"):
        return fs.S3FileSystem(**store).open_input_file(f"{parts.netloc}{path}")
    files, inner = fs.FileSystem.from_uri(uri)
    return files.open_input_file(unquote(inner))


def store_settings(spark: SparkSession) -> dict[str, str]:
    """The session's S3A settings as pyarrow names them; what is not set is left to its own chain."""
    conf = spark._jsc.hadoopConfiguration()
    found: dict[str, str] = {}
    endpoint = conf.get("fs.s3a.endpoint") or ""
    if endpoint:
        scheme, _, host = endpoint.rpartition("://")
        found["endpoint_override"] = host.rstrip("/")
        found["scheme"] = scheme or ("https" if conf.getBoolean("fs.s3a.connection.ssl.enabled", True) else "http")
    for name, key in (("access_key", "fs.s3a.access.key"), ("secret_key", "fs.s3a.secret.key")):
        if conf.get(key):
            found[name] = conf.get(key)
    return found


def _chunks(source, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Bytes from ``begin`` up to ``end``, with their place."""
    source.seek(begin)
    while begin < end:
        data = source.read(min(CHUNK, end - begin))
        if not data:
            return
        yield begin, data
        begin += len(data)


def _among(values: np.ndarray, wanted: bytes) -> np.ndarray:
    found = values == wanted[0]
    for value in wanted[1:]:
        found |= values == value
    return found


def line_ending(source, size: int) -> int:
    """How the first line of a file, up to an LF, goes on: 0 plainly, 1 with a CR before the LF, 2 with a CR
    that stands elsewhere. Spark takes the first line end of a file for all of them."""
    carriage = False
    for _, own in _chunks(source, 0, size):
        line, found, _ = own.partition(b"\n")
        if b"\r" in line[:-1] or (carriage and line):
            return 2
        carriage |= line.endswith(b"\r")
        if found:
            break
    return int(carriage)


def survey(item: Range, source) -> dict[str, Any]:
    """What the first pass tells of a range. Lists have a value for a beginning outside of quotes and one for
    inside: stray quotes, records that end in LF alone, and where the first and last record end."""
    quotes, blank = 0, True
    stray, bare = [False, False], [False, False]
    first, last = [-1, -1], [-1, -1]
    before, length = b"\n", item.begin
    if item.begin:
        source.seek(item.begin - 1)
        before = source.read(1)
    for place, own in _chunks(source, item.begin, item.end):
        source.seek(place + len(own))
        after = source.read(2)
        source.seek(place + len(own))
        # at the end of a file a field ends as at a line end
        data = np.frombuffer(before + own + after + b"\n\n"[: 2 - len(after)], dtype=np.uint8)
        middle = data[1:-2]
        marks = middle == _QUOTE
        at = np.flatnonzero(marks)
        previous, following, next_one = data[at], data[at + 2], data[at + 3]
        wrong_start = ~_among(previous, b',\n"')
        wrong_end = ~(_among(following, b',\n"') | ((following == _CR) & (next_one == _LF)))
        inside = np.cumsum(marks, dtype=np.uint8) + np.uint8(quotes & 1) & np.uint8(1)
        ends = np.flatnonzero(middle == _LF)
        kinds = inside[ends]
        alone = data[ends] != _CR
        for state in (0, 1):
            # quotes that open a field if the range begins this way
            opening = slice((quotes + state) % 2, None, 2)
            closing = slice((quotes + state + 1) % 2, None, 2)
            stray[state] |= bool(wrong_start[opening].any() or wrong_end[closing].any())
            closed = kinds == state
            bare[state] |= bool(alone[closed].any())
            places = ends[closed]
            if len(places):
                first[state] = place + int(places[0]) if first[state] < 0 else first[state]
                last[state] = place + int(places[-1])
        blank &= not own.strip(b"\r\n")
        quotes += len(at)
        before, length = own[-1:], place + len(own)
    return {
        "number": item.number, "begin": item.begin, "length": length, "odd": bool(quotes % 2), "blank": blank,
        "ending": 0 if item.begin else line_ending(source, item.size), "stray": stray, "bare": bare,
        "first": first, "last": last,
    }


_SURVEY = (
    "number int, begin long, length long, odd boolean, blank boolean, ending int, stray array<boolean>, "
    "bare array<boolean>, first array<long>, last array<long>"
)


def _survey_batch(item: Range, source) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("number", pa.int32()), ("begin", pa.int64()), ("length", pa.int64()), ("odd", pa.bool_()), ("blank", pa.bool_()),
         ("ending", pa.int32()), ("stray", pa.list_(pa.bool_())), ("bare", pa.list_(pa.bool_())),
         ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64()))]
    )
    yield pa.RecordBatch.from_pylist([survey(item, source)], schema=schema)


def _as_batch(item: Range, data: np.ndarray, ends: np.ndarray, header: bool) -> tuple[pa.RecordBatch, bool]:
    """Records that end at some places of the data, without line ends and blank ones, and whether the
    header of the file, which is left out, is still to come."""
    keep = np.ones(len(data), dtype=bool)
    keep[ends[ends < len(data)]] = False
    if item.crlf:
        keep[:-1] &= ~((data[:-1] == _CR) & (data[1:] == _LF))
        if len(data) and data[-1] == _CR and len(ends) and ends[-1] == len(data):
            keep[-1] = False
    kept = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    offsets = np.concatenate([[0], kept[np.minimum(ends, len(data))]]).astype(np.int32)
    packed = pa.py_buffer(np.ascontiguousarray(data[keep]))
    values = pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets), packed])
    values = values.filter(pa.array(np.diff(offsets) > 0))
    if header and len(values):
        values, header = values.slice(1), False
    number = pa.array(np.full(len(values), item.number, dtype=np.int32))
    return pa.RecordBatch.from_arrays([number, values], names=["number", "value"]), header


def cut_records(item: Range, source) -> Iterator[pa.RecordBatch]:
    """The records that start in a range, the header of its file left out."""
    started = not item.begin
    if item.begin and not item.open:
        source.seek(item.begin - 1)
        started = source.read(1) == b"\n"
    state, header, held = np.uint8(item.open), item.header, []
    for place, own in _chunks(source, item.begin, item.size):
        data = np.frombuffer(own, dtype=np.uint8)
        inside = (np.cumsum(data == _QUOTE, dtype=np.uint8) + state) & np.uint8(1)
        ends = np.flatnonzero((data == _LF) & (inside == 0))
        state = inside[-1]
        if not started:
            if not len(ends):
                if place + len(own) >= item.end:
                    return
                continue
            begin = int(ends[0]) + 1
            if place + begin >= item.end:
                return
            started, data, ends = True, data[begin:], ends[1:] - begin
            place += begin
        # the record that ends here is the last that starts in the range
        final = int(np.searchsorted(ends, item.end - 1 - place))
        over = final < len(ends)
        ends = ends[: final + 1]
        if not len(ends):
            held.append(data)
            continue
        stop = int(ends[-1]) + 1
        shift = sum(map(len, held))
        batch, header = _as_batch(item, np.concatenate([*held, data[:stop]]), ends + shift, header)
        yield batch
        if over:
            return
        held = [data[stop:]]
    rest = np.concatenate(held) if held else np.zeros(0, dtype=np.uint8)
    # without a line end at the end of the file
    if started and len(rest):
        yield _as_batch(item, rest, np.array([len(rest)]), header)[0]


class _RangeReader(DataSourceReader):
    def __init__(self, bundles: list[list[Range]], read: Callable, store: Mapping[str, str]):
        self.bundles, self.read_range, self.store = bundles, read, store

    def __getstate__(self):
        # a task is sent its own ranges only
        return vars(self) | {"bundles": []}

    def partitions(self):
        return [InputPartition(bundle) for bundle in self.bundles]

    def read(self, partition):
        for item in partition.value:
            with open_input(item.file, self.store) as source:
                yield from self.read_range(item, source)


def _scan(spark: SparkSession, ranges: Sequence[Range], limit: int, read: Callable, kind: str, name: str) -> DataFrame:
    """A scan whose tasks read ranges of ``limit`` bytes together."""
    bundles: list[list[Range]] = [[]]
    taken = 0
    for item in ranges:
        if bundles[-1] and taken + item.end - item.begin > limit:
            bundles.append([])
            taken = 0
        bundles[-1].append(item)
        taken += item.end - item.begin
    store = store_settings(spark)

    class Ranges(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return kind

        def reader(self, schema):
            return _RangeReader(bundles, read, store)

    # a frame keeps the source that it was made with, the session one source for each name
    with _registering:
        spark.dataSource.register(Ranges)
        return spark.read.format(name).load()


def plan_ranges(spark: SparkSession, files: Sequence[tuple[str, int]]) -> tuple[list[Range], int]:
    """Ranges of all files, and their size: as large as Spark's own splits would be at this moment."""
    size_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    most = size_of(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    least = size_of(spark.conf.get("spark.sql.files.openCostInBytes"))
    each = sum(size for _, size in files) // spark.sparkContext.defaultParallelism
    limit = max(1, min(most, max(least, each)))
    ranges: list[Range] = []
    for number, (file, size) in enumerate(files):
        if file.lower().endswith(GZIPPED):
            ranges += [Range(number, file, 0, _UNKNOWN, _UNKNOWN)] if size else []
            continue
        ranges += [Range(number, file, begin, min(begin + limit, size), size) for begin in range(0, size, limit)]
    return ranges, limit


def measured(ranges: Sequence[Range], surveys: Mapping[tuple[int, int], Mapping]) -> list[Range]:
    """The ranges with the lengths of gzip files; those that hold nothing are left out."""
    known = []
    for item in ranges:
        if item.size == _UNKNOWN:
            length = surveys[item.number, item.begin]["length"]
            item = replace(item, end=length, size=length)
        known += [item] if item.size else []
    return known


def resolve(ranges: Sequence[Range], surveys: Mapping[tuple[int, int], Mapping]) -> tuple[list[Range], set[int]]:
    """Ranges as they truly begin, and the files that are irregular, whose ranges are left out."""
    known, irregular = [], set()
    number, state, end, header, ending, longest = -1, 0, -1, True, 0, 0
    pending: list[int] = []
    for item in ranges:
        if item.number != number:
            if state:
                irregular.add(number)
            number, state, end, header = item.number, 0, -1, True
            ending = surveys[number, item.begin]["ending"]
        found = surveys[number, item.begin]
        if ending == 2 or found["stray"][state] or (ending == 1 and found["bare"][state]):
            irregular.add(number)
        if found["first"][state] >= 0:
            pending.append((number, found["first"][state] - end))
            end = found["last"][state]
        if item.end == item.size:
            pending.append((number, item.size - end))
        head = header and not found["blank"]
        known.append(replace(item, open=bool(state), header=head, crlf=ending == 1))
        header &= not head
        state ^= found["odd"]
    if state:
        irregular.add(number)
    longest = max((length for file, length in pending if file not in irregular), default=0)
    if longest > records.MAX_RECORD:
        raise ValueError(f"a record of some {longest} bytes is longer than a Spark string can be")
    return [item for item in known if item.number not in irregular], irregular


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``size`` and partition columns of what a reader of this path reads."""
    files = spark.read.format("binaryFile").load(path)
    partitions = [name for name in files.columns if name not in ("path", "modificationTime", "length", "content")]
    return files.select(
        F.col("_metadata.file_path").alias("_file"), F.col("length").alias("_size"), *partitions
    ).sort("_file")


def reachable(spark: SparkSession, file: str) -> bool:
    """Whether Python can open a file that Spark has listed."""
    try:
        with open_input(file, store_settings(spark)) as source:
            source.read(1)
    except Exception:  # whatever a file system's client has to say
        return False
    return True


def read_ranges(
    spark: SparkSession,
    listed: DataFrame,
    schema: StructType,
    columns: Sequence[str],
    options: Mapping[str, str],
) -> tuple[DataFrame, list[str]]:
    """Rows of listed CSV files, equal to a ``multiLine`` scan with a header, and the files left out as irregular.
    ``schema`` is what the files hold; of ``columns`` the rest are partition columns."""
    found = listed.collect()  # a row per file, as for any scan
    plain = [(row["_file"], row["_size"]) for row in found]
    ranges, limit = plan_ranges(
        spark, [(file, 0 if file.lower().endswith(COMPRESSED) else size) for file, size in plain]
    )
    rows = _scan(spark, ranges, limit, _survey_batch, _SURVEY, "quoted_csv_survey").collect()
    surveys = {(row["number"], row["begin"]): row for row in rows}
    ranges = measured(ranges, surveys)
    known, irregular = resolve(ranges, surveys)
    gzipped = {item.number for item in known if item.file.lower().endswith(GZIPPED)}
    if gzipped:
        warnings.warn(f"{len(gzipped)} irregular files are read in a task per file: gzip has no ranges", stacklevel=3)
    cut = _scan(spark, known, limit, cut_records, "number int, value string", "quoted_csv_records")
    parsed = cut.select("number", F.from_csv("value", schema.toDDL(), {**options, "multiLine": "true"}).alias("row"))
    partitions = [name for name in listed.columns if name not in ("_file", "_size")]
    if partitions:
        numbered = [(number, *(row[name] for name in partitions)) for number, row in enumerate(found)]
        kinds = StructType().add("number", IntegerType())
        for name in partitions:
            kinds = kinds.add(listed.schema[name])
        parsed = parsed.join(spark.createDataFrame(numbered, kinds), "number")
    # a partition column stands for a column of its name in the files
    taken = [F.col(name) if name in partitions else F.col("row")[name].alias(name) for name in columns]
    left = {number for number, (file, size) in enumerate(plain) if size and file.lower().endswith(COMPRESSED)}
    return parsed.select(*taken), [plain[number][0] for number in sorted(irregular | left)]

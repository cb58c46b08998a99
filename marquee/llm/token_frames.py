"""Token ids in files of independent zstandard frames that end in a seek table.

A file holds the ids of its documents as little-endian unsigned 32-bit integers, in frames of a
fixed number of ids that decompress by themselves. Two skippable frames follow: an index of the
documents (id and token count, zstandard-compressed), and the seek table of zstandard's seekable
format, with compressed and decompressed size and a checksum (low 32 bits of xxh64 of the
content) per frame. Any zstandard tool can decompress such a file; a reader that wants few
documents decompresses only the frames they lie in.

Documents are ordered by id across files: a range exchange deals them out and every task
writes one file. A file appears under its name when it is complete; a task that
runs again replaces it by the same content.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import prefix_offsets, ship, written
from marquee.llm.text import filled, slices
from marquee.llm.tokens import encoder, with_end

FRAME_IDS = 1 << 16

# Fixed values of the seekable zstandard format.
SEEK_FRAME = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
# A skippable frame for applications.
INDEX_FRAME = 0x184D2A50

FILES_SCHEMA = "file string, part int, documents long, ids long, frames long, bytes long"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Where a path or URI points to: any store Arrow knows. ``s3a`` is the name that Hadoop has for S3; the
    credentials and the endpoint are those of the environment (``AWS_ACCESS_KEY_ID``, ``AWS_ENDPOINT_URL``)."""
    scheme, mark, rest = uri.partition("://")
    return pafs.FileSystem.from_uri(f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else uri)


def _checksum(content: bytes | memoryview) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class FrameWriter:
    """Writes documents in the order given."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS, level: int = 3):
        import zstandard

        self.sink, self.frame_ids = sink, frame_ids
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.pending: list[np.ndarray] = []
        self.waiting = self.written = 0
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[np.ndarray] = []
        self.doc_null: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, null: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.doc_null.append(null)
        self.counts.append(np.diff(offsets))
        self.pending.append(ids)
        self.waiting += len(ids)
        while self.waiting >= self.frame_ids:
            ready = np.concatenate(self.pending)
            whole = len(ready) // self.frame_ids * self.frame_ids
            for at in range(0, whole, self.frame_ids):
                self._frame(ready[at : at + self.frame_ids])
            self.pending, self.waiting = [ready[whole:]], len(ready) - whole

    def _frame(self, ids: np.ndarray) -> None:
        content = ids.astype("<u4").tobytes()
        packed = self.compressor.compress(content)
        self._put(packed, len(content), _checksum(content))

    def _put(self, packed: bytes, size: int, checksum: int) -> None:
        self.sink.write(packed)
        self.written += len(packed)
        self.frames.append((len(packed), size, checksum))

    def close(self) -> tuple[int, int, int, int]:
        """Numbers of documents, ids, frames and bytes."""
        rest = np.concatenate(self.pending) if self.pending else np.zeros(0, dtype=np.uint32)
        if len(rest):
            self._frame(rest)
        data_frames = len(self.frames)
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, dtype=np.int64)
        columns = [
            np.concatenate(self.doc_ids).astype("<i8") if self.doc_ids else counts,
            np.concatenate(self.doc_null).astype("<i8") if self.doc_null else counts,
            counts.astype("<i8"),
        ]
        index = self.compressor.compress(b"".join(x.tobytes() for x in columns))
        # a skippable frame has no content to decompress
        self._put(struct.pack("<II", INDEX_FRAME, len(index)) + index, 0, _checksum(b""))
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEK_FOOTER)
        seek = struct.pack("<II", SEEK_FRAME, len(table) + len(footer)) + table + footer
        self.sink.write(seek)
        return len(counts), int(counts.sum()), data_frames, self.written + len(seek)


class FrameReader:
    """Reads the documents of one file, a frame at a time."""

    def __init__(self, source):
        import zstandard

        self.source = source
        self.decompressor = zstandard.ZstdDecompressor()
        size = source.size()
        footer = source.read_at(9, size - 9)
        frames, flags, magic = struct.unpack("<IBI", footer)
        if magic != SEEK_FOOTER or flags != HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = np.frombuffer(source.read_at(12 * frames, size - 9 - 12 * frames), dtype="<u4")
        packed, sizes, self.checksums = table.reshape(frames, 3).T.astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(packed)])
        head = self.places[-2]
        index = self.decompressor.decompress(source.read_at(int(packed[-1]) - 8, int(head) + 8))
        self.doc_ids, null, counts = np.frombuffer(index, dtype="<i8").reshape(3, -1)
        self.null = null.astype(bool)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.frame_starts = np.concatenate([[0], np.cumsum(sizes[:-1] // 4)])

    def frame(self, number: int) -> np.ndarray:
        begin, end = self.places[number], self.places[number + 1]
        content = self.decompressor.decompress(self.source.read_at(int(end - begin), int(begin)))
        if _checksum(content) != self.checksums[number]:
            raise ValueError(f"frame {number} does not match its checksum")
        return np.frombuffer(content, dtype="<u4")

    def documents(self, rows: Sequence[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Rows of the index and their ids; only frames that hold some of them are read."""
        at, ids = -1, np.zeros(0, dtype=np.uint32)
        for row in range(len(self.doc_ids)) if rows is None else rows:
            start, stop = self.starts[row], self.starts[row + 1]
            pieces = []
            while start < stop:
                number = int(np.searchsorted(self.frame_starts, start, side="right")) - 1
                if number != at:
                    at, ids = number, self.frame(number)
                begin = start - self.frame_starts[number]
                pieces.append(ids[begin : begin + stop - start])
                start += len(pieces[-1])
            yield row, pieces[0] if len(pieces) == 1 else np.concatenate([ids[:0], *pieces])


def write_token_files(
    docs: DataFrame, root: str, tokenizer: str, end: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode all texts and write their ids below ``root`` in ascending order of document id.

    Returns the table of files: ``file``, ``part`` (their order), ``documents``, ``ids``,
    ``frames``, ``bytes``. Null ids come first, null texts count as empty, repeated
    ids are written each, in no defined order among themselves; other columns are ignored. Long texts are
    encoded whole, some 50 bytes in memory for each of their bytes. An empty table gives no file. ``root`` is a path or URI that all executors reach.
    """
    ship(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        writer = sink = None
        for batch in batches:
            for piece in slices(batch):
                if writer is None:
                    store, folder = file_system(root)
                    store.create_dir(folder, recursive=True)
                    passing = f"{folder}/.{part:06d}-{uuid4().hex}"
                    sink = store.open_output_stream(passing)
                    writer = FrameWriter(sink)
                offsets, ids, _ = encoder(tokenizer).encode(filled(piece.column("text")))
                offsets, ids = with_end(offsets, ids, end)
                doc_ids = piece.column("doc_id")
                writer.add(
                    doc_ids.fill_null(0).to_numpy(zero_copy_only=False),
                    doc_ids.is_null().to_numpy(zero_copy_only=False),
                    offsets,
                    ids,
                )
        if writer is None:
            return
        documents, ids, frames, size = writer.close()
        sink.close()
        store.move(passing, f"{folder}/tokens-{part:06d}.zst")
        yield pa.RecordBatch.from_pydict(
            {
                "file": [f"{root}/tokens-{part:06d}.zst"],
                "part": pa.array([part], pa.int32()),
                "documents": [documents],
                "ids": [ids],
                "frames": [frames],
                "bytes": [size],
            }
        )

    # the place in the input lets the range exchange divide rows of one id
    ordered = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "place")
        .sortWithinPartitions("doc_id", "place")
        .select("doc_id", "text")
    )
    return written(ordered.mapInArrow(write, FILES_SCHEMA), "token-files")


def read_token_files(files: DataFrame, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """Documents of the files as ``doc_id``, ``start`` (ids before it in all files), ``n_tokens``
    and ``ids`` (array). With ``doc_ids`` only those, decompressing no other frames."""
    wanted = None if doc_ids is None else np.array(sorted(set(doc_ids)), dtype=np.int64)

    def arrays(row: int, reader: FrameReader, ids: np.ndarray) -> dict:
        return {"ids": ids.tolist()}

    return _read(files, "ids array<long>", arrays, wanted)


def token_file_digests(files: DataFrame) -> DataFrame:
    """As ``read_token_files`` with ``ids_crc32`` in place of the ids."""

    def digest(row: int, reader: FrameReader, ids: np.ndarray) -> dict:
        return {"ids_crc32": zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))}

    return _read(files, "ids_crc32 long", digest, None)


def _read(files: DataFrame, column: str, of_ids, wanted: np.ndarray | None) -> DataFrame:
    ship(files.sparkSession)
    name = column.split()[0]
    kind = pa.list_(pa.int64()) if "array" in column else pa.int64()
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                store, path = file_system(file)
                with store.open_input_file(path) as source:
                    reader = FrameReader(source)
                    hit = ~reader.null & np.isin(reader.doc_ids, wanted) if wanted is not None else None
                    rows = None if hit is None else np.flatnonzero(hit).tolist()
                    out: list[dict] = []
                    held = 0
                    for row, ids in reader.documents(rows):
                        doc_id = None if reader.null[row] else int(reader.doc_ids[row])
                        begin = int(base + reader.starts[row])
                        found = {"doc_id": doc_id, "start": begin, "n_tokens": len(ids)}
                        out.append(found | of_ids(row, reader, ids))
                        held += len(ids) if "array" in column else 1
                        if held >= 1 << 20 or len(out) >= 20_000:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, held = [], 0
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema)

    based = files.join(prefix_offsets(files, "part", "ids"), "part").select("file", "base")
    # by number, so that these few short rows stay a task each
    return based.repartition(max(1, files.count())).mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def scratch_uri(spark: SparkSession, label: str) -> str:
    from marquee.scratch import scratch_root

    return scratch_root(spark, label)

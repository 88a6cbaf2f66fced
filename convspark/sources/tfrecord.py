"""TFRecord files as a Spark data source: ``spark.read.format("tfrecord")`` and back.

Reading gives ``record binary``, or the string features named by the schema. A file is cut into byte ranges,
a task each: ``splitBytes`` sets their size, 0 leaves files whole. Writing takes a ``record binary`` column
and an optional ``split`` column; each task writes one file per split, under the name it will keep.
"""

from __future__ import annotations

import fnmatch
import io
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

RECORD = T.StructType([T.StructField("record", T.BinaryType())])
_RECORDS_PER_BATCH = 2_000
_BYTES_PER_BATCH = 16 << 20
_READ_BUFFER = 8 << 20
_SPLIT_BYTES = 128 << 20
_SEARCH_BYTES = 1 << 20
_UNFINISHED = "_unfinished"

# Fixed values of the file format: reflected CRC-32C polynomial and the mask added to a checksum.
_POLYNOMIAL = 0x82F63B78
_MASK = 0xA282EAD8
#: Bytes of a frame besides its data.
_FRAME_BYTES = 16


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def masked_crc32c(blobs: list[bytes]) -> np.ndarray:
    """Masked checksums of many byte strings, advanced together one byte position at a time."""
    lengths = np.array([len(b) for b in blobs], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    data = np.frombuffer(b"".join(blobs), dtype=np.uint8)
    starts = (np.cumsum(lengths) - lengths)[order]
    sorted_lengths = lengths[order]
    crc = np.full(len(blobs), 0xFFFFFFFF, dtype=np.uint32)
    longest = int(sorted_lengths[0]) if len(blobs) else 0
    # number of strings still running at each position
    alive = len(blobs) - np.searchsorted(sorted_lengths[::-1], np.arange(longest), side="right")
    for position in range(longest):
        n = alive[position]
        crc[:n] = _TABLE[(crc[:n] ^ data[starts[:n] + position]) & 0xFF] ^ (crc[:n] >> np.uint32(8))
    crc = ~crc
    rotated = ((crc >> np.uint32(15)) | (crc << np.uint32(17))).astype(np.uint64)
    out = np.empty(len(blobs), dtype=np.uint64)
    out[order] = (rotated + _MASK) & 0xFFFFFFFF
    return out


def frame(records: list[bytes]) -> bytes:
    """Length, length checksum, data, data checksum: for each record."""
    lengths = [struct.pack("<Q", len(r)) for r in records]
    pieces = []
    for length, length_crc, record, crc in zip(lengths, masked_crc32c(lengths), records, masked_crc32c(records)):
        pieces += [length, struct.pack("<I", int(length_crc)), record, struct.pack("<I", int(crc))]
    return b"".join(pieces)


def unframe(stream, length: int | None = None) -> Iterator[list[bytes]]:
    """Lists of records from an open file, with all checksums verified.

    With ``length``, only records whose frame starts in the next so many bytes; the stream then stands behind them.
    """

    def take(n: int) -> bytes:
        data = stream.read(n)
        if len(data) != n:
            raise ValueError("truncated record file")
        return data

    def verified(headers: list[bytes], records: list[bytes], expected: list[int]) -> list[bytes]:
        actual = np.concatenate([masked_crc32c(headers), masked_crc32c(records)])
        if not np.array_equal(actual, np.array(expected[0::2] + expected[1::2], dtype=np.uint64)):
            raise ValueError("checksum mismatch in record file")
        return records

    headers: list[bytes] = []
    records: list[bytes] = []
    expected: list[int] = []
    size = done = 0
    while (length is None or done < length) and (header := stream.read(8)):
        if len(header) != 8:
            raise ValueError("truncated record file")
        (length_crc,) = struct.unpack("<I", take(4))
        (record_length,) = struct.unpack("<Q", header)
        # before memory is asked for by a damaged length
        if record_length > _BYTES_PER_BATCH and masked_crc32c([header])[0] != length_crc:
            raise ValueError("checksum mismatch in record file")
        record = take(record_length)
        (crc,) = struct.unpack("<I", take(4))
        done += record_length + _FRAME_BYTES
        headers.append(header)
        records.append(record)
        expected += [length_crc, crc]
        size += len(record)
        if len(records) >= _RECORDS_PER_BATCH or size >= _BYTES_PER_BATCH:
            yield verified(headers, records, expected)
            headers, records, expected, size = [], [], [], 0
    if records:
        yield verified(headers, records, expected)


def next_frame(stream, start: int, size: int) -> int:
    """Where the first frame that starts at ``start`` or behind it does, or ``size``.

    A place counts as a frame if the checksums of its length and of its data are right. Lengths whose upper three
    bytes are not zero are never tried: no record has a terabyte.
    """
    at = start
    while at < size:
        stream.seek(at)
        window = np.frombuffer(stream.read(_SEARCH_BYTES), np.uint8)
        here = np.flatnonzero((window[5:-6] | window[6:-5] | window[7:-4]) == 0) if len(window) >= 12 else []
        if len(here):
            headers = [window[k : k + 8].tobytes() for k in here]
            stored = np.array([struct.unpack("<I", window[k + 8 : k + 12].tobytes())[0] for k in here], np.uint64)
            for k in np.flatnonzero(masked_crc32c(headers) == stored).tolist():
                (length,) = struct.unpack("<Q", headers[k])
                place = at + int(here[k])
                if place + length + _FRAME_BYTES > size:
                    continue
                stream.seek(place + 12)
                data, (crc,) = stream.read(length), struct.unpack("<I", stream.read(4))
                if masked_crc32c([data])[0] == crc:
                    return place
        if at + len(window) >= size:
            break
        at += len(window) - 11  # a header may reach into the next window
    return size


def _fields(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(field number, payload) of the length-delimited fields of one message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        if tag & 7 != 2:
            raise ValueError("unexpected wire type in example")
        size = varint()
        yield tag >> 3, data[at : at + size]
        at += size


def parse_example(record: bytes) -> dict[str, str]:
    """The first bytes value of every feature, as text."""
    example: dict[str, str] = {}
    for _, features in _fields(memoryview(record)):
        for _, entry in _fields(features):
            parts = dict(_fields(entry))
            for number, values in _fields(parts.get(2, memoryview(b""))):
                first = next(_fields(values), None) if number == 1 else None
                if first is not None:
                    example[bytes(parts[1]).decode("utf-8")] = bytes(first[1]).decode("utf-8")
    return example


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it; a path without scheme is local."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    if "://" in path:
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return pafs.LocalFileSystem(), path


def _record_files(path: str) -> list[tuple[str, int]]:
    """Record files below a folder, or those that a pattern such as ``set/train-*`` matches, with their sizes."""
    folder = path
    if re.search(r"[*?\[]", path):
        folder = re.split(r"[*?\[]", path, maxsplit=1)[0].rpartition("/")[0] or "."
    filesystem, root = _filesystem(folder)
    infos = filesystem.get_file_info(pafs.FileSelector(root, recursive=True))
    if any(i.path.endswith("/" + _UNFINISHED) for i in infos):
        raise ValueError(f"{folder} is unfinished: its write did not end")
    files = sorted((i.path, i.size) for i in infos if i.type == pafs.FileType.File and "/." not in i.path[len(root) :])
    if folder == path:
        return [f for f in files if f[0].endswith(".tfrecord")]
    pattern = root + path[len(folder) :]
    return [f for f in files if fnmatch.fnmatchcase(f[0], pattern)]


@dataclass
class _Range(InputPartition):
    """The records of a file whose frames start from ``start`` on and before ``end``."""

    path: str
    start: int
    end: int
    size: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, split_bytes: int):
        self.path = path
        self.schema = schema
        self.split_bytes = split_bytes

    def partitions(self) -> list[_Range]:
        files = _record_files(self.path)
        if not files:
            raise FileNotFoundError(f"no record files at {self.path}")
        ranges = []
        for path, size in files:
            step = self.split_bytes or max(size, 1)
            ranges += [_Range(path, a, min(a + step, size), size) for a in range(0, max(size, 1), step)]
        return ranges

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        """A range begins at the first frame found behind its start, and must end where the next one will begin."""
        filesystem, _ = _filesystem(self.path)
        names = self.schema.fieldNames()
        start, end, size = partition.start, partition.end, partition.size
        with io.BufferedReader(filesystem.open_input_file(partition.path), _READ_BUFFER) as stream:
            begin = next_frame(stream, start, size) if start else 0
            stream.seek(begin)
            for records in unframe(stream, max(end - begin, 0)):
                if names == RECORD.fieldNames():
                    columns = [pa.array(records, pa.binary())]
                else:
                    examples = [parse_example(r) for r in records]
                    columns = [pa.array([e.get(n) for e in examples], pa.string()) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            # a record that holds frames itself could be taken for some of the file's
            behind = stream.tell()
            if begin < end < size and next_frame(stream, end, size) != behind:
                raise ValueError(f"records of {partition.path} around byte {behind} hold records: read it with splitBytes 0")


class _Writer(DataSourceWriter):
    """Each task writes its own files, whole and under their final names.

    A shard is sorted, so a task that runs again writes the same bytes over them. A marker tells an
    unfinished set until all tasks are done.
    """

    def __init__(self, path: str, options: dict, overwrite: bool):
        self.path = path
        self.shards = {k: int(options[k]) for k in ("train", "test") if k in options}
        if overwrite:
            raise ValueError("record files are only written to a fresh folder")
        filesystem, root = _filesystem(path)
        if filesystem.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            raise FileExistsError(f"{path} is not empty: record files are only written to a fresh folder")
        filesystem.create_dir(root, recursive=True)
        filesystem.open_output_stream(f"{root}/{_UNFINISHED}").close()

    def _name(self, split: str, partition: int) -> str:
        if split in self.shards:
            first = self.shards["train"] if split == "test" else 0
            return f"{split}-{partition - first:05d}-of-{self.shards[split]:05d}.tfrecord"
        return f"{split or 'part'}-{partition:05d}.tfrecord"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        filesystem, root = _filesystem(self.path)
        partition = TaskContext.get().partitionId()
        open_files: dict[str, tuple] = {}
        pending: dict[str, list[bytes]] = {}
        pending_bytes: dict[str, int] = {}

        def flush(split: str) -> None:
            if split not in open_files:
                hidden = f"{root}/.{uuid.uuid4().hex}"
                open_files[split] = (hidden, filesystem.open_output_stream(hidden))
            open_files[split][1].write(frame(pending.pop(split, [])))
            pending_bytes[split] = 0

        for row in iterator:
            split = row["split"] if "split" in row else ""
            record = bytes(row["record"])
            pending.setdefault(split, []).append(record)
            pending_bytes[split] = pending_bytes.get(split, 0) + len(record)
            if len(pending[split]) >= _RECORDS_PER_BATCH or pending_bytes[split] >= _BYTES_PER_BATCH:
                flush(split)
        for split in list(pending):
            flush(split)
        if self.shards and not open_files:  # an empty shard is still a shard
            flush("train" if partition < self.shards.get("train", 0) else "test")
        for split, (hidden, stream) in open_files.items():
            stream.close()
            filesystem.move(hidden, f"{root}/{self._name(split, partition)}")
        return WriterCommitMessage()

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, root = _filesystem(self.path)
        filesystem.open_output_stream(f"{root}/_SUCCESS").close()
        filesystem.delete_file(f"{root}/{_UNFINISHED}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """The marker stays: the folder is refused on reading."""


class TfRecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> T.StructType:
        return RECORD

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema, int(self.options.get("splitBytes", _SPLIT_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session; needed once per session."""
    spark.dataSource.register(TfRecordSource)

"""Token ids in binary files of independent zstandard frames with a seek table at the end.

A file is a valid zstandard stream. It holds data frames (the ids of some documents, in order, a
long document over several frames), an index frame (document ids and lengths) and the seek table
of the public seekable format: a skippable frame with the compressed size, the decompressed size
and a checksum (low 32 bits of XXH64) of every frame before it. An empty skippable frame of eight
ASCII bytes ends every piece that the writer puts out: the pieces are the rows of Spark's text
sink and those bytes its line separator, so files reach any Hadoop file system and are committed
like those of every other sink. A reader finds the table from the end, checks each frame it
touches and decompresses only those that hold requested documents.

Documents are range-partitioned by id, so the files in the order of their numbers hold them in ascending order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placetide.llm.encoding import encoder
from placetide.llm.shared import parts_for, slices

# Fixed values of the public formats: skippable frames and the seek table.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
# An empty skippable frame: all its bytes are ASCII.
SEPARATOR = struct.pack("<II", SKIPPABLE, 0)
LEVEL = 3
# Bytes of ids in a frame.
FRAME = 1 << 18
# Pieces that a task remembers: its files in the making need memory too.
REMEMBERED = 300_000
STEP = 3 << 20
# Text bytes that a file takes at most on average. Its ids are well below the 2 GB that one
# cell of the reader can hold, also at four bytes an id and without compression.
FILE_TEXT = 1 << 28


def _checksum(data: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(data) & 0xFFFFFFFF


class _Writer:
    """Pieces of one file, each a frame; ``finish`` gives the index and the seek table."""

    def __init__(self, id_bytes: int, level: int = LEVEL):
        from zstandard import ZstdCompressor

        self.kind = np.dtype(f"<u{id_bytes}")
        self.compress = ZstdCompressor(level=level, write_content_size=True).compress
        self.keys: list[int | None] = []
        self.lengths: list[int] = []
        self.entries: list[tuple[int, int, int]] = []
        self.held: list[bytes] = []
        self.size = 0

    def _frame(self, data: bytes) -> bytes:
        packed = self.compress(data)
        # The separator behind the frame counts as part of it.
        self.entries.append((len(packed) + len(SEPARATOR), len(data), _checksum(data)))
        return packed

    def add(self, keys: list[int | None], lengths: list[int], ids: np.ndarray) -> Iterator[bytes]:
        """Take documents, their ids one after the other; yields the frames that are full."""
        self.keys += keys
        self.lengths += lengths
        body = ids.astype(self.kind).tobytes()
        at = 0
        while at < len(body):
            part = body[at : at + FRAME - self.size]
            self.held.append(part)
            self.size += len(part)
            at += len(part)
            if self.size == FRAME:
                yield self._flush()

    def _flush(self) -> bytes:
        data = b"".join(self.held)
        self.held, self.size = [], 0
        return self._frame(data)

    def finish(self) -> Iterator[bytes]:
        """The rest of the ids, the index and the seek table."""
        if self.held:
            yield self._flush()
        known = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        index = struct.pack("<QB", len(keys), self.kind.itemsize)
        index += known.tobytes() + keys.tobytes() + np.array(self.lengths, "<u8").tobytes()
        yield self._frame(index)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE)
        yield struct.pack("<II", SEEK_TABLE, len(table)) + table


class Reader:
    """Random access to one file through ``seek`` and ``read``."""

    def __init__(self, file: BinaryIO):
        from zstandard import ZstdDecompressor

        self.file = file
        self.decompress = ZstdDecompressor().decompress
        foot = len(SEPARATOR) + 9
        size = file.seek(0, 2)
        file.seek(size - foot)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table")
        file.seek(size - foot - 12 * count)
        entries = np.frombuffer(file.read(12 * count), "<u4").reshape(count, 3)
        self.packed, self.plain, self.sums = (entries[:, k].astype(np.int64) for k in range(3))
        self.places = np.cumsum(self.packed) - self.packed
        self.frames_read = 0
        index = self.frame(count - 1)
        n, width = struct.unpack_from("<QB", index)
        self.kind = np.dtype(f"<u{width}")
        known = np.frombuffer(index, np.uint8, n, 9).astype(bool)
        keys = np.frombuffer(index, "<i8", n, 9 + n)
        self.keys = [k if ok else None for k, ok in zip(keys.tolist(), known.tolist(), strict=True)]
        self.lengths = np.frombuffer(index, "<u8", n, 9 + 9 * n).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.ends = np.cumsum(self.plain[:-1])
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        """A frame's contents; raises if they do not match the checksum."""
        self.file.seek(int(self.places[number]))
        # The separator is a frame of its own; one frame is read.
        packed = self.file.read(int(self.packed[number]) - len(SEPARATOR))
        data = self.decompress(packed)
        if len(data) != self.plain[number] or _checksum(data) != self.sums[number]:
            raise ValueError(f"frame {number} is damaged")
        self.frames_read += 1
        return data

    def all_ids(self) -> np.ndarray:
        """Ids of all documents, one after the other."""
        return np.frombuffer(b"".join(map(self.frame, range(len(self.plain) - 1))), self.kind)

    def ids(self, row: int) -> np.ndarray:
        """Ids of the row-th document; only the frames that hold them are decompressed."""
        begin = int(self.starts[row]) * self.kind.itemsize
        end = begin + int(self.lengths[row]) * self.kind.itemsize
        out = []
        number = int(np.searchsorted(self.ends, begin, side="right"))
        while begin < end:
            if self._last[0] != number:
                self._last = (number, self.frame(number))
            first = int(self.ends[number] - self.plain[number])
            out.append(self._last[1][begin - first : end - first])
            begin += len(out[-1])
            number += 1
        return np.frombuffer(b"".join(out), self.kind)


def write(
    df: DataFrame,
    target: str,
    path: str,
    end_id: int,
    files: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    id_bytes: int = 4,
) -> None:
    """Encode every text, append ``end_id`` and write the files, documents ascending by ``key``
    (an integer; NULL first, equal keys by their text).

    Without ``files`` the texts' bytes are counted first: there is a file for each ``FILE_TEXT`` of
    them or, if that is more, for each of the session's shuffle partitions, with small neighbours
    merged by adaptive execution. So no file grows with the table. NULL text counts as empty. ``id_bytes`` is the width of ids in
    the files; larger ids raise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, REMEMBERED).encode
        writer = _Writer(id_bytes)
        for piece in slices(batches, "text", STEP):
            flat, sizes = encode(piece.column("text"))
            if max(int(flat.max()) if len(flat) else 0, end_id) > np.iinfo(writer.kind).max:
                raise ValueError(f"token ids need more than {id_bytes} bytes")
            flat = np.insert(flat, np.cumsum(sizes), end_id)
            out = list(writer.add(piece.column("key").to_pylist(), (sizes + 1).tolist(), flat))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
        if writer.keys:
            yield pa.RecordBatch.from_arrays([pa.array(list(writer.finish()), pa.binary())], ["value"])

    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    if files is None:
        files = parts_for(rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0, FILE_TEXT)
        if files <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            files = None
    rows = rows.repartitionByRange(*([files] if files else []), "key", F.xxhash64("text"))
    # A string column may hold any bytes; the sink writes them as they are.
    pieces = rows.sortWithinPartitions("key", "text").mapInArrow(run, "value binary")
    pieces = pieces.select(F.expr("cast(value AS string)").alias("value"))
    pieces.write.option("lineSep", SEPARATOR.decode("ascii")).text(target)


def _file_rows(spark: SparkSession, target: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(target)
    return found.filter("length > 0").select("path", "content")


def read(spark: SparkSession, target: str, keys: Sequence[int] | None = None, keep_ids: bool = True) -> DataFrame:
    """Documents from the files: ``file, row, doc_id, n_tokens, ids_crc32, ids`` (little-endian 32
    bits; NULL unless ``keep_ids``). With ``keys`` only their frames are decompressed."""
    schema = "file string, row long, doc_id long, n_tokens long, ids_crc32 long, ids binary"
    wanted = None if keys is None else set(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                reader = Reader(pa.BufferReader(content.as_buffer()))
                rows = []
                if wanted is None:
                    body = memoryview(reader.all_ids().astype("<u4").tobytes())
                    ends = (4 * np.cumsum(reader.lengths)).tolist()
                    for row, (name, begin, end) in enumerate(zip(reader.keys, [0, *ends], ends, strict=False)):
                        part = body[begin:end]
                        rows.append((file, row, name, (end - begin) // 4, zlib.crc32(part), bytes(part) if keep_ids else None))
                else:
                    for row, name in enumerate(reader.keys):
                        if name in wanted:
                            part = reader.ids(row).astype("<u4").tobytes()
                            rows.append((file, row, name, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = [c.split()[0] for c in schema.split(", ")]
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return _file_rows(spark, target).mapInArrow(run, schema)


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before, over all files in the order of their
    numbers (by name ``part-100000`` would stand before ``part-99999``).

    Totals per file are summed first; only those, one row per file, meet in one window.
    """
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("file_tokens"))
    number = F.regexp_extract("file", r"/?part-(\d+)[^/]*$", 1).cast("long")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("in_file", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(files, "file").withColumn("start", F.col("file_start") + F.col("in_file"))

"""Token ids in files of independent zstandard frames that can be read one by one.

A file is a sequence of frames, each with a content checksum of its own: data frames (the ids of
some neighbouring documents), one directory frame, and the trailing seek table in a skippable
frame, laid out as the public zstd seekable format has it (compressed and decompressed size and
checksum per frame, then a footer). A reader takes the footer, the seek table and the
directory, and decompresses the frames of the documents it wants.

Directory: the count of documents (8 bytes), then one array each of keys (8 bytes), a null mark
(1 byte), counts of ids (8 bytes) and frame numbers (4 bytes). Everything is little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finledger.llm.chunks import slices
from finledger.llm.common import batches, read_table, shared_folder, texts_of  # noqa: F401
from finledger.llm.library_bpe import library_of

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("checksum", "<u4")])

FRAME_BYTES = 1 << 20  # ids gathered in one frame; a longer document has a frame of its own
LONGEST = 1 << 30  # a document of more bytes is spread over several frames
BATCH_BYTES = 4 << 20
LEVEL = 3

MANIFEST = pa.schema([
    ("part", pa.int64()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64()),
])


def _short(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes documents one after another; ``close`` adds the directory and the seek table."""

    def __init__(self, out, level: int = LEVEL):
        self.out, self.entries = out, []
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.keys, self.counts, self.frames = [], [], []
        self.waiting, self.size = [], 0

    def _frame(self, plain: bytes) -> None:
        packed = self.pack(plain)
        self.out.write(packed)
        self.entries.append((len(packed), len(plain), _short(plain)))

    def _flush(self) -> None:
        if self.waiting:
            self._frame(b"".join(self.waiting))
            self.waiting, self.size = [], 0

    def add(self, key: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > FRAME_BYTES:
            self._flush()
        self.keys.append(key)
        self.counts.append(len(ids) // 4)
        self.frames.append(len(self.entries))
        spread = len(ids) > LONGEST
        while len(ids) > LONGEST:
            self._frame(ids[:LONGEST])
            ids = ids[LONGEST:]
        self.waiting.append(ids)
        self.size += len(ids)
        if spread:  # the next document begins a frame: a reader counts from a frame's first one
            self._flush()

    def close(self) -> tuple[int, int]:
        self._flush()
        known = [0 if k is None else k for k in self.keys]
        self._frame(b"".join([
            np.array([len(known)], "<i8").tobytes(), np.array(known, "<i8").tobytes(),
            np.array([k is None for k in self.keys], "u1").tobytes(),
            np.array(self.counts, "<i8").tobytes(), np.array(self.frames, "<u4").tobytes(),
        ]))
        table = np.array(self.entries, dtype=ENTRY).tobytes()
        footer = np.array([len(self.entries)], "<u4").tobytes() + bytes([HAS_CHECKSUMS]) \
            + np.array([SEEKABLE_MAGIC], "<u4").tobytes()
        head = np.array([SKIPPABLE_MAGIC, len(table) + len(footer)], "<u4").tobytes()
        self.out.write(head + table + footer)
        return len(self.counts), sum(self.counts)


class FrameReader:
    """Reads documents from a seekable file; a frame is decompressed when a document needs it."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        footer = self._at(end - 9, 9)
        if int.from_bytes(footer[5:], "little") != SEEKABLE_MAGIC:
            raise ValueError("not a seekable file: the footer is missing")
        count = int.from_bytes(footer[:4], "little")
        self.entries = np.frombuffer(self._at(end - 9 - 12 * count, 12 * count), dtype=ENTRY)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        plain = self.frame(count - 1)
        n = int(np.frombuffer(plain, "<i8", 1)[0])
        self.keys = np.frombuffer(plain, "<i8", n, 8)
        self.null = np.frombuffer(plain, "u1", n, 8 + 8 * n).astype(bool)
        self.counts = np.frombuffer(plain, "<i8", n, 8 + 9 * n)
        self.frames = np.frombuffer(plain, "<u4", n, 8 + 17 * n)
        self.loaded = (-1, b"")

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def frame(self, number: int) -> bytes:
        packed = self._at(int(self.offsets[number]), int(self.entries["packed"][number]))
        plain = zstandard.ZstdDecompressor().decompress(packed)
        if _short(plain) != self.entries["checksum"][number]:
            raise ValueError(f"frame {number} does not have its checksum")
        return plain

    def document(self, at: int) -> bytes:
        """The packed ids of the document at this place of the file."""
        number = int(self.frames[at])
        first = int(np.searchsorted(self.frames, number))
        begin, size = int(self.counts[first:at].sum()) * 4, int(self.counts[at]) * 4
        if self.loaded[0] != number:
            self.loaded = (number, self.frame(number))
        data, parts = self.loaded[1][begin:], []
        while len(data) < size:  # a document of several frames begins its first one
            parts.append(data)
            size -= len(data)
            number += 1
            self.loaded = (number, self.frame(number))
            data = self.loaded[1]
        return b"".join([*parts, data[:size]])

    def places(self, key: int) -> list[int]:
        return np.flatnonzero((self.keys == key) & ~self.null).tolist()


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI; a path without a scheme is a mounted folder."""
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}") \
        if not path.startswith("file:/") else (fs.LocalFileSystem(), "/" + path[5:].lstrip("/"))


def _write_part(folder: str, part: int, documents: Iterable[tuple[int | None, bytes]]) -> tuple:
    """One file, written aside and moved to its name when it is whole: a task that dies or runs
    twice leaves either no file or the same one."""
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    name = f"part-{part:06d}.ids.zst"
    aside = f"{root}/.{name}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(aside, compression=None) as out:
        writer = FrameWriter(out)
        for key, ids in documents:
            writer.add(key, ids)
        documents, ids = writer.close()
    store.move(aside, f"{root}/{name}")
    return part, f"{folder}/{name}", documents, ids


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encodes whole texts, appends ``end_id`` to each, writes files in ascending key order.

    Returns the manifest, a row per file: part (its number in the order), path, documents, ids. It
    is written beside the files, so the files are made once. Null keys come first, equal keys
    keep the order of the input, a null or empty text is its end id, other columns are not read;
    an empty table gives an empty manifest.

    The input is range-partitioned on the key and the row's place, which splits even a key that
    a third of the rows share; a partition becomes a file.
    """
    place = "__place"
    rows = (
        docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text")
        .withColumn(place, F.monotonically_increasing_id())
        .repartitionByRange("key", place).sortWithinPartitions("key", place)
        .select("key", "text")
    )

    def encoded(batch_rows: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
        library, end = library_of(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batch_rows:
            keys, texts = batch.column(0).to_pylist(), texts_of(batch, "text")
            for a, b in slices(map(len, texts), BATCH_BYTES) if texts else ():
                for k, ids in zip(keys[a:b], library.encode(texts[a:b]), strict=True):
                    yield k, ids.tobytes() + end

    def run(batch_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batch_rows if b.num_rows), None)
        if first is None:
            return
        rest = (b for bs in ([first], batch_rows) for b in bs)
        done = _write_part(folder, TaskContext.get().partitionId(), encoded(rest))
        yield from batches([{n: [v] for n, v in zip(MANIFEST.names, done, strict=True)}], MANIFEST)

    kinds = "part long, path string, documents long, ids long"
    rows.mapInArrow(run, kinds).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(kinds).parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Every document of the files: the key, start (ids of all documents before it), n_tokens,
    ids (left out without ``with_ids``) and ids_crc32. A file is a task's work."""
    fields = [("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
              ("ids", pa.binary()), ("ids_crc32", pa.int64())]
    schema = pa.schema([f for f in fields if with_ids or f[0] != "ids"])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(  # a row per file: small enough for one task to add up
        "path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = _filesystem(path)
                with store.open_input_file(name) as source:
                    reader = FrameReader(source)
                    starts = base + np.cumsum(reader.counts) - reader.counts
                    for a, b in slices((reader.counts * 4).tolist(), BATCH_BYTES):
                        data = [reader.document(i) for i in range(a, b)]
                        yield from batches([{
                            "key": [None if n else k for k, n in
                                    zip(reader.keys[a:b].tolist(), reader.null[a:b], strict=True)],
                            "start": starts[a:b], "n_tokens": reader.counts[a:b], "ids": data,
                            "ids_crc32": [zlib.crc32(d) for d in data],
                        }], schema)

    kinds = ", ".join(f"{f.name} {'binary' if f.name == 'ids' else 'long'}" for f in schema)
    count = max(1, manifest.count())
    return (files.repartition(count, "path").mapInArrow(run, kinds)
            .withColumnRenamed("key", key))


def read_documents(path: str, keys: Iterable[int]) -> dict[int, list[np.ndarray]]:
    """The ids of some documents of one file; only their frames are decompressed."""
    store, name = _filesystem(path)
    with store.open_input_file(name) as source:
        reader = FrameReader(source)
        return {k: [np.frombuffer(reader.document(i), "<u4") for i in reader.places(k)]
                for k in keys}


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the documents into a fresh folder of the shared one and reads the files back."""
    folder = shared_folder(spark, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id), with_ids=False)

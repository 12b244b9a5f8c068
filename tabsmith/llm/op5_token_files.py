"""Token ids in seekable zstandard files.

A shard file is a row of independent zstandard frames, one per document (its ids
as little-endian unsigned 32-bit integers, the end id included), followed by two
skippable frames:

* the document index: per document the id (int64) and a byte that says whether
  the id is null, compressed on its own;
* the seek table of the public seekable format: per frame its compressed and
  decompressed size and the low 32 bits of the XXH64 of its content, then the
  number of frames, a descriptor byte and the magic number.

So a reader loads the two tables from the end of the file and then decompresses
just the frames of the documents it wants, checking each.

Writing: documents are range-partitioned by id (rows with one id are spread by
a hash of their text, equal rows by their place in the input), sorted, encoded and written by the tasks, straight to the
shared folder.  A task's file name is unique to its attempt, and only the files
that successful tasks report reach the manifest, so a lost executor or a
speculative copy never leaves a wrong file in it.  A shard's first position is a
running sum over the manifest, which has one row per shard.

Defined cases: null text is empty and holds just the end id; a null id is kept
and comes first; repeated rows are written each; rows with one id are in order
of a hash of their text; an empty table has no shard; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.session import materialize, output_path

from .common import release
from .word_tokens import encoder

SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
LEVEL = 3
SHARD_SCHEMA = "shard long, path string, n_docs long, n_tokens long, n_bytes long"
READ_SCHEMA = "doc_id long, at long, n_tokens long, ids_crc32 long"


def open_store(path: str):
    """(filesystem, path in it) of a Hadoop-style or plain path."""
    from pyarrow import fs
    path = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "/", path))
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard to a binary file object, a frame per document."""

    def __init__(self, out):
        import xxhash
        import zstandard
        self.out, self.frames, self.ids, self.nulls = out, bytearray(), [], bytearray()
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False).compress
        self.hash = xxhash.xxh64_intdigest
        self.n_tokens = self.n_bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compress(ids)
        self.out.write(frame)
        self.frames += struct.pack("<III", len(frame), len(ids), self.hash(ids) & 0xFFFFFFFF)
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.n_tokens += len(ids) // 4
        self.n_bytes += len(frame)

    def close(self) -> None:
        index = self.compress(np.array(self.ids, "<i8").tobytes() + bytes(self.nulls))
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        footer = struct.pack("<IBI", len(self.ids), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(self.frames) + len(footer)) + self.frames + footer)


class ShardReader:
    """Random access to the documents of one shard."""

    def __init__(self, source):
        import xxhash
        import zstandard
        self.source, self.hash = source, xxhash.xxh64_intdigest
        self.decompress = zstandard.ZstdDecompressor().decompress
        end = source.size()
        n, flag, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a seekable shard")
        begin = end - 9 - 12 * n
        table = np.frombuffer(self._read(begin, 12 * n), "<u4").reshape(n, 3)
        self.packed, self.plain, self.sums = (table[:, i].astype(np.int64) for i in range(3))
        self.starts = np.concatenate([[0], np.cumsum(self.packed)])
        head = int(self.starts[-1])
        kind, size = struct.unpack("<II", self._read(head, 8))
        if kind != SKIPPABLE_INDEX or head + 8 + size + 8 != begin:
            raise ValueError("damaged shard")
        index = self.decompress(self._read(head + 8, size), max_output_size=9 * n)
        self.doc_ids = np.frombuffer(index[:8 * n], "<i8")
        self.null_ids = np.frombuffer(index[8 * n:], np.uint8).astype(bool)
        #: Position of each document among the shard's tokens.
        self.at = (np.cumsum(self.plain) - self.plain) // 4

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, i: int) -> bytes:
        """The bytes of document i's ids, after the check of its sum."""
        size = int(self.plain[i])
        frame = self._read(int(self.starts[i]), int(self.packed[i]))
        ids = self.decompress(frame, max_output_size=size) if size else b""
        if len(ids) != size or self.hash(ids) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"document {i} of the shard is damaged")
        return ids


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of texts; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                      text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Writes ``docs`` in ascending order of id and returns the manifest: shard,
    path, n_docs, n_tokens, n_bytes and start (tokens of all shards before)."""
    spark = docs.sparkSession
    folder = folder or output_path(spark, "tokens")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # Equal rows are told apart by where they are read, so that they are no single range.
    rows = rows.withColumns({"spread": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange("id", "spread", "place").sortWithinPartitions("id", "spread").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, shards = TaskContext.get().partitionId(), None
        encode, end = encoder(tokenizer).encode, np.uint32(end_id)
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.tok.zst"
        for batch in batches:
            if not batch.num_rows:
                continue
            if shards is None:
                store, at = open_store(path)
                store.create_dir(at.rpartition("/")[0], recursive=True)
                stream = store.open_output_stream(at, compression=None)
                shards = ShardWriter(stream)
            data, offsets = _text_bytes(batch.column(1))
            ids, ends = encode(data, offsets)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                shards.add(doc_id, np.append(ids[ends[i]:ends[i + 1]], end).astype("<u4").tobytes())
        if shards is not None:
            shards.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({
                "shard": [shard], "path": [path], "n_docs": [len(shards.ids)],
                "n_tokens": [shards.n_tokens], "n_bytes": [shards.n_bytes]})
        release()

    manifest = materialize(rows.mapInArrow(write, SHARD_SCHEMA), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, with_ids: bool = False, wanted: Sequence[int] | None = None) -> DataFrame:
    """Reads shards back: doc_id, start, n_tokens, ids_crc32 and, if asked for,
    the ids.  ``wanted`` (a bounded list of ids) decompresses those documents
    only."""
    spark = manifest.sparkSession
    n = max(1, manifest.count())
    schema = READ_SCHEMA.replace("at long", "start long") + (", ids binary" if with_ids else "")
    wanted = None if wanted is None else np.array(sorted(wanted), np.int64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                store, at = open_store(shard["path"])
                with store.open_input_file(at) as source:
                    reader = ShardReader(source)
                    which = np.arange(len(reader))
                    if wanted is not None:
                        which = which[np.isin(reader.doc_ids, wanted) & ~reader.null_ids]
                    for part in _runs(which, reader.plain, 8 << 20):
                        ids = [reader.ids(int(i)) for i in part]
                        out = {"doc_id": pa.array(reader.doc_ids[part], pa.int64(), mask=reader.null_ids[part]),
                               "start": reader.at[part] + shard["start"], "n_tokens": reader.plain[part] // 4,
                               "ids_crc32": [zlib.crc32(x) for x in ids]}
                        if with_ids:
                            out["ids"] = ids
                        yield pa.RecordBatch.from_pydict(out)

    shards = manifest.select("path", "start")
    return shards.repartition(min(n, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(read, schema)


def _runs(which: np.ndarray, sizes: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Cuts positions into runs of about ``limit`` bytes, one document at least."""
    if len(which):
        yield from np.split(which, np.flatnonzero(np.diff(np.cumsum(sizes[which]) // limit)) + 1)

"""Token-id files of independent zstandard frames (operator 6).

A file holds one zstandard frame per document (its ids as little-endian
unsigned 32-bit integers), then two skippable frames: an index (the documents'
ids) and the seek table of the public zstandard seekable format (compressed
size, size and checksum of every frame, then a footer). A reader opens the end
of a file, finds the frames of the documents it wants and decompresses only
those; each frame is checked against its checksum. Any zstandard tool
decompresses a file as a whole.

Texts are encoded and compressed where they are read; only frames are dealt
out, by equal ranges of ``doc_id``, and sorted. A task writes its ranges to own
files under new names and reports them; only reported files are in the
manifest, so a task that is run again leaves a file that nobody reads. The
files go to any file system that Arrow opens by its address.

Edge cases: a null or empty text is the end id alone; a null ``doc_id`` sorts
first; rows with equal ids are sorted by a hash of the text; an empty table
gives an empty manifest and an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm import token_ids
from sparkrec.llm.common import FIRST_ID, documents, hash_buckets, kept, pick, range_bucket, scratch

# Fixed values of the zstandard frame and seekable formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_FOOTER = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FILE_BYTES = 64 << 20
MANIFEST = "file string, part int, seq int, n_docs bigint, n_tokens bigint, first_doc bigint, last_doc bigint"


def open_folder(uri: str):
    """``(file system, path)`` of a folder's address; a plain path is a local one."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes one file: ``add`` the documents' frames, then ``close``."""

    def __init__(self, filesystem, path: str):
        self.out = filesystem.open_output_stream(path, compression=None)
        self.table, self.ids, self.size, self.tokens = [], [], 0, 0

    def add(self, doc_id: int, frame, size: int, checksum: int) -> None:
        self.out.write(frame)
        self.table.append((len(frame), size, checksum))
        self.ids.append(doc_id)
        self.size += len(frame)
        self.tokens += size // 4

    def close(self) -> None:
        index = np.array(self.ids, "<i8").tobytes()
        entries = np.array(self.table, "<u4").tobytes()
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def read_frames(filesystem, path: str, wanted: set[int] | None = None):
    """``(doc_id, ids before it in the file, data or None)`` of each document; data only of wanted ones."""
    import xxhash
    import zstandard

    with filesystem.open_input_file(path) as f:
        f.seek(f.size() - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE_FOOTER:
            raise ValueError(f"{path} has no seek table")
        f.seek(f.size() - 9 - 12 * n - 8 - 8 * n)
        ids = np.frombuffer(f.read(8 * n), "<i8")
        f.seek(8, 1)
        table = np.frombuffer(f.read(12 * n), "<u4").reshape(n, 3)
        at = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        before = np.concatenate([[0], np.cumsum(table[:, 1] // 4, dtype=np.int64)])
        # in place of the encoder's cache, should this worker hold one
        decompress = kept(("frames",), zstandard.ZstdDecompressor).decompress
        for i in range(n):
            data = None
            if wanted is None or int(ids[i]) in wanted:
                f.seek(int(at[i]))
                data = decompress(f.read(int(table[i, 0])), max_output_size=max(1, int(table[i, 1])))
                if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != table[i, 2]:
                    raise ValueError(f"{path}: frame {i} does not match its checksum")
            yield (None if ids[i] == FIRST_ID else int(ids[i])), int(before[i]), data


def _frames(vocabulary: str, end_id: int, level: int):
    end = np.array([end_id], "<u4").tobytes()

    def encode_all(batches):
        import xxhash
        import zstandard

        encode, compress = token_ids.encoder(vocabulary).encode, zstandard.ZstdCompressor(level=level).compress
        names = ["bucket", "key", "tie", "frame", "size", "checksum"]
        for batch in batches:
            frames, sizes, sums = [], [], []
            for text in batch.column(3):
                data = encode(text.as_py()) + end
                frames.append(compress(data))
                sizes.append(len(data))
                sums.append(xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
            columns = [*batch.columns[:3], pa.array(frames, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return encode_all


def _write_files(folder: str, file_bytes: int):
    def write(batches):
        filesystem, path = open_folder(folder)
        rows, writer, name, part, seq = [], None, "", None, 0

        def close():
            writer.close()
            known = [i for i in writer.ids if i != FIRST_ID]
            rows.append((name, part, seq, len(writer.ids), writer.tokens, min(known, default=None), max(known, default=None)))

        for batch in batches:
            for bucket, key, frame, size, checksum in zip(*(batch.column(i) for i in (0, 1, 3, 4, 5))):
                bucket = bucket.as_py()
                if writer is not None and (bucket != part or writer.size >= file_bytes):
                    close()
                    writer, seq = None, seq + 1 if bucket == part else 0
                if writer is None:
                    part = bucket
                    name = f"tokens-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.zst"
                    writer = FrameWriter(filesystem, f"{path}/{name}")
                writer.add(key.as_py(), frame.as_py(), size.as_py(), checksum.as_py())
        if writer is not None:
            close()
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 4]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return write


def write_token_files(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                      end_id: int = token_ids.END_ID, level: int = 3, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the files below ``folder`` and returns their manifest (one row a file, written beside them)."""
    spark = docs.sparkSession
    filesystem, path = open_folder(folder)
    filesystem.create_dir(path, recursive=True)
    rows = pick(docs, doc_id=doc_id, text=text).select(
        F.coalesce("doc_id", F.lit(FIRST_ID)).alias("key"), F.xxhash64("text").alias("tie"), "text"
    )
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    ranges = max(hash_buckets(total, file_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select(range_bucket(rows, "key", ranges).alias("bucket"), "key", "tie", "text")
    schema = "bucket int, key bigint, tie bigint, frame binary, size bigint, checksum bigint"
    framed = dealt.mapInArrow(_frames(vocabulary or token_ids.vocabulary_path(), end_id, level), schema)
    sorted_ = framed.repartition("bucket").sortWithinPartitions("bucket", "key", "tie")
    manifest = sorted_.mapInArrow(_write_files(folder, file_bytes), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame, folder: str, doc_ids: list[int] | None = None, digest: bool = False) -> DataFrame:
    """Per (wanted) document: ``doc_id, start`` (ids of all documents before it), ``ids`` (binary).

    With ``digest``, the ids' number and checksum (``n_tokens, ids_crc32``)
    stand in for the ids. The manifest has one row per file, so its running
    total is over metadata.
    """
    before = F.sum("n_tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("first_id", F.coalesce(before, F.lit(0)))
    if doc_ids is not None:
        files = files.where(F.lit(False) if not doc_ids else (F.col("last_doc") >= min(doc_ids)) & (F.col("first_doc") <= max(doc_ids)))
    wanted = None if doc_ids is None else set(doc_ids)

    def read(batches):
        filesystem, path = open_folder(folder)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size = [], 0
                for doc, start, data in read_frames(filesystem, f"{path}/{name}", wanted):
                    if data is None:
                        continue
                    own = (len(data) // 4, zlib.crc32(data)) if digest else (data,)
                    rows.append((doc, int(first) + start, *own))
                    size += 32 if digest else len(data)
                    if size > 4 << 20:
                        yield from_rows(rows)
                        rows, size = [], 0
                if rows:
                    yield from_rows(rows)

    names = ["doc_id", "start", *(["n_tokens", "ids_crc32"] if digest else ["ids"])]
    kinds = [pa.binary() if c == "ids" else pa.int64() for c in names]

    def from_rows(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'bigint'}" for c in names)
    n = max(1, manifest.count())
    return files.select("file", "first_id").repartition(n).mapInArrow(read, schema)


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files").location("ids")
    manifest = write_token_files(documents(spark, sf_dir), folder)
    return read_token_files(manifest, folder, digest=True)

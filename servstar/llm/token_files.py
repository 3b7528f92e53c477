"""Token ids in files of independent zstandard frames.

A file is a run of zstandard frames, one per document, each the document's ids as little-endian unsigned
32-bit integers. Two skippable frames follow, which plain zstandard readers pass over: the documents' ids, then
the seek table of the public seekable format (compressed size, size and checksum of every frame; the
last nine bytes say how many). A reader takes the tail of a file, picks the frames it wants, reads those bytes
only, and compares each frame with its checksum.

Documents are dealt to tasks by ranges of (doc_id, hash of the text, row number), so that neither an id that many
rows bear nor copies of one text meet in one task, and sorted there: the files in order hold the documents in
order. Each task attempt writes files of its own names; the manifest, a table that Spark commits, names
those of the attempts that count, so a lost or repeated task leaves no trace in what is read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servstar.llm.common import documents, text_chunks, written
from servstar.llm.packing import END_ID, TEXT_BYTES, tokenizer_file, word_tokenizer
from servstar.session import scratch_path

# Fixed values of the seekable format: magic numbers of the skippable frames and of the file's end, the flag
# that entries have checksums.
INDEX_MAGIC, TABLE_MAGIC, END_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
HEAD, FOOT, HEAD_BYTES, FOOT_BYTES = "<II", "<IBI", 8, 9
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
LABEL = np.dtype([("doc_id", "<i8"), ("known", "u1")])

LEVEL = 3
#: Compressed bytes after which a task starts another file, and bytes that a reader asks for at once at most.
FILE_BYTES, READ_BYTES = 128 << 20, 8 << 20
MANIFEST = "part long, file string, docs long, tokens long, bytes long, first_id long, last_id long"


def checksum(data) -> int:
    """The low 32 bits of XXH64, as the seekable format has it."""
    from xxhash import xxh64_intdigest
    return xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Documents into one file; ``out`` is an open binary stream."""

    def __init__(self, out, level: int = LEVEL):
        from zstandard import ZstdCompressor
        self.out, self.bytes = out, 0
        self.compress = ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.entries: list[tuple] = []
        self.labels: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compress(ids)
        self.out.write(frame)
        self.bytes += len(frame)
        self.entries.append((len(frame), len(ids), checksum(ids)))
        self.labels.append((doc_id or 0, doc_id is not None))

    def close(self) -> None:
        labels, table = np.array(self.labels, dtype=LABEL).tobytes(), np.array(self.entries, dtype=ENTRY).tobytes()
        foot = struct.pack(FOOT, len(self.entries), WITH_CHECKSUMS, END_MAGIC)
        for part in (struct.pack(HEAD, INDEX_MAGIC, len(labels)), labels, struct.pack(HEAD, TABLE_MAGIC, len(table) + FOOT_BYTES), table, foot):
            self.out.write(part)
            self.bytes += len(part)
        self.out.close()


class FrameReader:
    """Documents out of one file; ``file`` is open for random access and knows its size.

    ``doc_ids`` and ``known`` (false: NULL) of its documents, ``tokens`` of each; nothing is decompressed before ``read``."""

    def __init__(self, file):
        self.file, end = file, file.size()
        n, flags, magic = struct.unpack(FOOT, self._bytes(end - FOOT_BYTES, FOOT_BYTES))
        if magic != END_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        begin = end - FOOT_BYTES - n * ENTRY.itemsize - n * LABEL.itemsize - 2 * HEAD_BYTES
        tail = self._bytes(begin, end - FOOT_BYTES - begin)
        middle = HEAD_BYTES + n * LABEL.itemsize
        if (struct.unpack_from(HEAD, tail, 0) != (INDEX_MAGIC, n * LABEL.itemsize)
                or struct.unpack_from(HEAD, tail, middle) != (TABLE_MAGIC, n * ENTRY.itemsize + FOOT_BYTES)):
            raise ValueError("the frames before the file's end are no index and seek table")
        labels = np.frombuffer(tail, dtype=LABEL, count=n, offset=HEAD_BYTES)
        self.entries = np.frombuffer(tail, dtype=ENTRY, count=n, offset=middle + HEAD_BYTES)
        self.doc_ids, self.known = labels["doc_id"], labels["known"].astype(bool)
        self.at = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        self.tokens = self.entries["size"].astype(np.int64) // 4
        if self.at[-1] != begin:
            raise ValueError("the frames' sizes don't add up to the file's")

    def _bytes(self, at: int, n: int) -> bytes:
        if at < 0:
            raise ValueError("the file is shorter than its seek table")
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the file ends too early")
        return data

    def read(self, frames: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(frame, its ids) of the ``frames`` in ascending order; neighbours are read together."""
        from zstandard import ZstdDecompressor
        decompress = ZstdDecompressor().decompress
        i = 0
        while i < len(frames):
            j = i + 1
            while j < len(frames) and frames[j] == frames[j - 1] + 1 and self.at[frames[j] + 1] - self.at[frames[i]] <= READ_BYTES:
                j += 1
            base = int(self.at[frames[i]])
            data = memoryview(self._bytes(base, int(self.at[frames[j - 1] + 1]) - base))
            for k in frames[i:j].tolist():
                ids = decompress(data[self.at[k] - base:self.at[k + 1] - base])
                if len(ids) != self.entries["size"][k] or checksum(ids) != self.entries["checksum"][k]:
                    raise ValueError(f"frame {k} differs from its checksum")
                yield k, ids
            i = j


def _open(path: str):
    """(file system, path there) of a path or URI."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, text: str = "text",
                      doc_id: str = "doc_id", end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the ids of every document and returns the manifest, one row per file: ``part`` (the files' order),
    ``file``, ``docs``, ``tokens``, ``bytes``, ``first_id``, ``last_id`` (NULL ids left out) and ``base``, the ids in all files before.

    Ids are those of the whole text without special tokens, then ``end_id``; a NULL or empty text has the
    end id alone. Documents ascend by id, NULL ids last, rows that share an id by a hash of their texts; repeated rows are
    written each. ``folder`` is one all executors share (default: a new one under ``spark.checkpoint.dir``). ``docs`` should be read
    from storage: row numbers part equal rows. No documents, no files."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("h"),
                       F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_last(), "h", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize, end = word_tokenizer(tokenizer_path), np.asarray([end_id], dtype="<u4").tobytes()
        task, (system, place) = TaskContext.get(), _open(folder)
        system.create_dir(place, recursive=True)
        writer, name, files = None, None, 0

        def done() -> pa.RecordBatch:
            writer.close()
            ids = [i for i, known in writer.labels if known] or [None]
            row = (task.partitionId() << 24 | files, f"{folder.rstrip('/')}/{name}", len(writer.entries),
                   sum(e[1] for e in writer.entries) // 4, writer.bytes, ids[0], ids[-1])
            kinds = [pa.string() if k == 1 else pa.int64() for k in range(7)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              [x.split()[0] for x in MANIFEST.split(", ")])

        for b in batches:
            for i, j, *_ in text_chunks(b.column(1), TEXT_BYTES):
                part = b.slice(i, j - i)
                for d, ids in zip(part.column(0).to_pylist(), tokenize(part.column(1).to_pylist())):
                    if writer is None:
                        name = f"part-{task.partitionId():06d}-{files:04d}-{uuid.uuid4().hex}.ids.zst"
                        writer = FrameWriter(system.open_output_stream(f"{place.rstrip('/')}/{name}", compression=None))
                    writer.add(d, ids + end)
                    if writer.bytes >= file_bytes:
                        yield done()
                        writer, files = None, files + 1
        if writer is not None:
            yield done()

    made = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, MANIFEST),
                   "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return written(made.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))), "token-manifest")


def read_token_files(manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents in the manifest's files, or of those with the given ids:
    ``start`` is the number of ids of all documents before, ``ids`` the document's, as little-endian unsigned 32-bit integers.

    Files whose ids can't be wanted aren't opened, frames of other documents neither read nor decompressed. A
    frame that differs from its checksum is an error."""
    wanted = None if doc_ids is None else np.unique(np.array(doc_ids, dtype=np.int64))
    if wanted is not None:
        low, high = (int(wanted[0]), int(wanted[-1])) if len(wanted) else (1, 0)
        manifest = manifest.filter((F.col("last_id") >= low) & (F.col("first_id") <= high))
    names = ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, base in (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))):
            system, place = _open(path)
            with system.open_input_file(place) as file:
                reader = FrameReader(file)
                start = base + np.cumsum(reader.tokens) - reader.tokens
                pick = np.arange(len(start)) if wanted is None else np.flatnonzero(reader.known & np.isin(reader.doc_ids, wanted))
                rows, size = [], 0

                def taken() -> pa.RecordBatch:
                    at = np.array([k for k, _ in rows], dtype=np.int64)
                    return pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids[at], mask=~reader.known[at]), pa.array(start[at]), pa.array(reader.tokens[at]),
                         pa.array([x for _, x in rows], pa.binary())], names)

                for frame in reader.read(pick):
                    rows.append(frame)
                    size += len(frame[1])
                    if size >= READ_BYTES or len(rows) >= 10_000:
                        yield taken()
                        rows, size = [], 0
                if rows:
                    yield taken()

    files = manifest.count()
    return manifest.select("file", "base").repartition(max(1, min(files, 10_000))).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def op13_token_frames(spark, sf_dir: str) -> DataFrame:
    manifest = write_token_files(documents(spark, sf_dir), tokenizer_file())
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

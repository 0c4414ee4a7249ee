"""Token-id output: documents as token ids in binary files of independent
zstandard frames with a trailing seek table and per-frame checksums.

File layout, little endian throughout::

    frame*        zstd frame (content size and checksum on): the ids of whole
                  documents, one after another, 2 or 4 bytes each
    index frame   zstd frame: id width, document count, then per document its
                  id, whether the id is null, its frame, its first id within
                  the frame and its number of ids
    seek table    skippable frame of the public seekable format: per frame the
                  compressed size, the size and the low half of the XXH64;
                  frame count, descriptor (checksums on) and magic number

A reader takes the seek table from the end, the index from the last frame and
decompresses only the frames that hold requested documents."""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, shared_folder, shared_table, text_bytes
from .tokens import encoder

# Fixed values of the public seekable zstd format.
_SKIPPABLE, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<III")
_HEAD = struct.Struct("<BQ")
#: Bytes of ids after which a frame is closed; a longer document has a frame of its own.
FRAME_BYTES = 1 << 20


def _open(uri: str):
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class FrameWriter:
    """Writes one file; documents in the order of ``add``."""

    def __init__(self, sink, width: int, level: int = 3):
        self.sink, self.width = sink, width
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.table, self.buffer, self.held = [], [], 0
        self.docs, self.total = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.held and self.held + len(ids) > FRAME_BYTES:
            self._flush()
        count = len(ids) // self.width
        self.docs.append((doc_id or 0, doc_id is None, len(self.table), self.held // self.width, count))
        self.buffer.append(ids)
        self.held += len(ids)
        self.total += count

    def _frame(self, data: bytes) -> None:
        packed = self.zstd.compress(data)
        self.sink.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def _flush(self) -> None:
        self._frame(b"".join(self.buffer))
        self.buffer, self.held = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        cols = zip(*self.docs) if self.docs else ([],) * 5
        parts = [np.array(c, dtype=t).tobytes() for c, t in zip(cols, ("<i8", "u1", "<u4", "<u8", "<u8"))]
        self._frame(_HEAD.pack(self.width, len(self.docs)) + b"".join(parts))
        body = b"".join(_ENTRY.pack(*e) for e in self.table) + _FOOTER.pack(len(self.table), _CHECKSUMS, _SEEKABLE)
        self.sink.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)


class FrameReader:
    """Random access to one file; ``index`` holds the five document columns."""

    def __init__(self, source):
        self.src = source
        size = source.size()
        count, flags, magic = _FOOTER.unpack(source.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != _SEEKABLE or not flags & _CHECKSUMS:
            raise ValueError("not a seekable frame file with checksums")
        body = source.read_at(_ENTRY.size * count, size - _FOOTER.size - _ENTRY.size * count)
        self.table = [_ENTRY.unpack_from(body, i * _ENTRY.size) for i in range(count)]
        self.starts = np.concatenate([[0], np.cumsum([e[0] for e in self.table])]).tolist()
        self.zstd = zstandard.ZstdDecompressor()
        raw = self.frame(count - 1)
        self.width, n = _HEAD.unpack_from(raw)
        at, self.index = _HEAD.size, []
        for t in ("<i8", "u1", "<u4", "<u8", "<u8"):
            self.index.append(np.frombuffer(raw, dtype=t, count=n, offset=at))
            at += n * np.dtype(t).itemsize
        self._held = (-1, b"")

    def frame(self, i: int) -> bytes:
        packed, size, check = self.table[i]
        data = self.zstd.decompress(self.src.read_at(packed, self.starts[i]))
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} is damaged")
        return data

    def document(self, row: int) -> np.ndarray:
        """Ids of the ``row``-th document; decompresses its frame alone."""
        frame, first, count = (int(self.index[k][row]) for k in (2, 3, 4))
        if count == 0:
            return np.empty(0, dtype="<u4")
        if self._held[0] != frame:
            self._held = (frame, self.frame(frame))
        return np.frombuffer(self._held[1], dtype=f"<u{self.width}", count=count, offset=first * self.width).astype("<u4")

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every document of that id (they are sorted by id)."""
        rows = np.flatnonzero((self.index[0] == doc_id) & (self.index[1] == 0))
        return [self.document(int(r)) for r in rows]


def read_file(uri: str) -> FrameReader:
    where, path = _open(uri)
    return FrameReader(where.open_input_file(path))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending id order; returns the manifest
    (part, path, n_docs, n_tokens, start): one row per file, ``start`` the ids in
    the files before it.

    Documents are dealt by range of (id, text hash), so a long run of one id
    splits; each task streams its range into one file under a name of its own,
    and only files named by the manifest count, so a task that runs again leaves
    no double. Null texts are empty documents (the end id alone), null ids come
    first, repeated rows are documents of their own, an empty table has no
    file. A text of any length is encoded whole and has a frame of its own when it
    fills one; further columns are ignored."""
    def run(frames):
        enc = encoder(tokenizer)
        end = end_id.to_bytes(enc.size, "little")
        where, base = _open(folder)
        where.create_dir(base, recursive=True)
        name, sink, out = f"tokens-{uuid.uuid4().hex}.zst", None, None
        for b in batches(frames):
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if out is None:
                    sink = where.open_output_stream(f"{base}/{name}", compression=None)
                    out = FrameWriter(sink, enc.size)
                out.add(doc_id, enc.encode(body.decode("utf-8", "replace")) + end)
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              "path": [f"{folder}/{name}"], "n_docs": [len(out.docs)],
                                              "n_tokens": [out.total]})

    ranged = text_bytes(docs, id_col, text_col).withColumn("th", F.xxhash64("body")) \
        .repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th")
    files = shared_table(ranged.select("doc_id", "body")
                         .mapInArrow(run, "part int, path string, n_docs long, n_tokens long"), "token-files")
    # one row per file: a range partition each, not per document
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document, read back from the files with all checksums verified:
    doc_id, start, n_tokens, ids_crc32 (ids as little-endian 32-bit)."""
    def run(frames):
        for b in frames:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                r = read_file(path)
                ids, null, _, _, counts = r.index
                crc = [zlib.crc32(r.document(i).tobytes()) for i in range(len(ids))]
                first = np.cumsum(counts) - counts + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=null.astype(bool)), pa.array(first.astype("<i8")),
                     pa.array(counts.astype("<i8")), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    files = manifest.select("path", "start")
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "path") \
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Write, then read back: one row per document (see ``read_tokens``)."""
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer, end_id, id_col, text_col))

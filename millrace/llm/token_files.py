"""Token-id files: independent zstandard frames, a document index and a trailing seek table.

A file is, in this order,

* frames, each a whole zstandard frame with its own content checksum that holds the ids of
  consecutive documents as little-endian unsigned 32-bit integers; a document is never split;
* a skippable frame with the document index: for each document its id, frame, first id in the frame
  and number of ids; the index's own length comes last;
* a skippable frame with the seek table of the public zstandard seekable format: compressed size,
  decompressed size and checksum (low 32 bits of XXH64) of each frame, then the footer.

A reader takes the footer, the seek table and the index, and then decompresses only the frames of the
documents asked for. Documents are written in ascending order of doc_id (null first, ties in a fixed
order), one file or more for each range of them, under a name of its own for each attempt of a task; only the
files named in the manifest count, so a task that runs again after a lost executor does no harm.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch, held
from .units import Units, gather
from .words import slices

#: Fixed values of the public formats: magic numbers, and the flag for checksums in the seek table.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: A frame ends with the document that reaches so many bytes of ids, and so does a file.
FRAME_BYTES, FILE_BYTES = 1 << 18, 1 << 29
#: Documents read back together.
READ_DOCS = 1 << 16
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("first", "<u4"), ("n", "<u4")])
LEVEL = 1
MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
#: Units that the library encodes together.
TOGETHER = 4096


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class LibraryEncoder:
    """Ids of whole texts by the ``tokenizers`` library, which gets each distinct unit once (see ``units``)."""

    def __init__(self, vocab: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocab)
        self.library.no_truncation()
        self.library.no_padding()
        self.units = Units(self._ids)
        #: Bytes of each id's string.
        self.size = np.zeros(self.library.get_vocab_size(), dtype=np.int64)
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        for s, i in self.library.get_vocab().items():
            self.size[i] = len(s.encode()) if s in special else len(s)

    def _ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units that begin with white space and don't end with it go to the library joined, ``TOGETHER``
        at a time: no token crosses from one to the next, so the bytes of the tokens show where each ends."""
        first = np.array([u[0] in " \n" and not u[-1].isspace() and not u[1].isspace() for u in units], dtype=bool)
        joined, alone = np.flatnonzero(first).tolist(), np.flatnonzero(~first).tolist()
        out, counts, order = [], [], []
        for at in range(0, len(joined), TOGETHER):
            which = joined[at : at + TOGETHER]
            some = [units[i] for i in which]
            ids = np.array(self.library.encode("".join(some), add_special_tokens=False).ids, dtype=np.uint32)
            ends = np.cumsum([len(u.encode()) for u in some])
            reach = np.cumsum(self.size[ids])
            last = np.searchsorted(reach, ends)
            if reach[-1] != ends[-1] or (reach[last] != ends).any():  # a token crosses: never seen, but then each alone
                alone += which
                continue
            out.append(ids)
            counts.append(np.diff(last, prepend=-1))
            order += which
        for at in range(0, len(alone), TOGETHER):
            got = self.library.encode_batch_fast([units[i] for i in alone[at : at + TOGETHER]], add_special_tokens=False)
            out += [np.array(e.ids, dtype=np.uint32) for e in got]
            counts.append(np.array([len(e.ids) for e in got]))
        n, place = np.concatenate(counts), np.argsort(order + alone, kind="stable")
        return gather(np.concatenate(out), (np.cumsum(n) - n)[place], n[place]), n[place]

    def encode_all(self, texts: Sequence[np.ndarray]) -> list[bytes]:
        ids, counts = self.units.ids(texts)
        ends = np.cumsum(counts).tolist()
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip([0, *ends], ends, strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_all([np.frombuffer(t.encode(), dtype=np.uint8) for t in texts])


def encoder(vocab: str) -> LibraryEncoder:
    return held(("library", vocab), lambda: LibraryEncoder(vocab))


class Writer:
    """Writes one file; ``add`` in the order that the documents are to have."""

    def __init__(self, path: str):
        fs, inner = file_system(path)
        fs.create_dir(os.path.dirname(inner), recursive=True)
        self.path, self.out = path, fs.open_output_stream(inner, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple] = []
        self.open: list[bytes] = []
        self.open_bytes = self.docs = self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((doc_id or 0, doc_id is not None, len(self.frames), self.open_bytes // 4, len(ids) // 4))
        self.open.append(ids)
        self.open_bytes += len(ids)
        self.docs += 1
        self.ids += len(ids) // 4
        if self.open_bytes >= FRAME_BYTES:
            self._end_frame()

    def _end_frame(self) -> None:
        data = b"".join(self.open)
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.open, self.open_bytes = [], 0

    def close(self) -> None:
        if self.open:
            self._end_frame()
        index = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(np.array(self.index, dtype=INDEX).tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index) + 4) + index + struct.pack("<I", len(index)))
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.out.close()


class Reader:
    """Reads one file by its seek table and document index."""

    def __init__(self, file):
        self.file, size = file, file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError("no seek table")
        start = size - 9 - 12 * n - 8
        self.table = np.frombuffer(file.read_at(12 * n, start + 8), dtype="<u4").reshape(n, 3)
        self.at = np.concatenate(([0], np.cumsum(self.table[:, 0], dtype=np.int64)))
        (length,) = struct.unpack("<I", file.read_at(4, start - 4))
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(file.read_at(length, start - 4 - length)), dtype=INDEX)

    def frame(self, k: int) -> bytes:
        """A frame's bytes; both checksums are verified."""
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(int(self.table[k, 0]), int(self.at[k])))
        if len(data) != self.table[k, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return data

    def rows(self, which: np.ndarray | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids) of the index rows asked for (all by default), each frame decompressed once."""
        last, data = -1, b""
        for r in self.index if which is None else self.index[which]:
            if r["frame"] != last:
                last, data = int(r["frame"]), self.frame(int(r["frame"]))
            at = 4 * int(r["first"])
            yield (int(r["doc_id"]) if r["known"] else None), data[at : at + 4 * int(r["n"])]

    def get(self, doc_ids: Iterable[int]) -> Iterator[tuple[int | None, bytes]]:
        """Only the documents of these ids; other frames stay untouched."""
        return self.rows(np.flatnonzero(np.isin(self.index["doc_id"], list(doc_ids)) & (self.index["known"] == 1)))


def write(docs: DataFrame, vocab: str, folder: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, write the files; gives the manifest's rows.

    One row a file: part and file (the files' order), path, docs, ids. Null and empty texts have the end id
    alone. The range cut goes by doc_id, then text, then row, so not even one id that a third of the
    rows share meets in one task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocab), int(end_id).to_bytes(4, "little")
        part, file, writer = TaskContext.get().partitionId(), 0, None

        def row() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_pydict({"part": [part], "file": [file], "path": [writer.path], "docs": [writer.docs], "ids": [writer.ids]}, schema=MANIFEST)

        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for some in slices(batch.column(1)):
                for got in encode.encode_all(some):
                    writer = writer or Writer(f"{folder}/{uuid.uuid4().hex}.zst")
                    writer.add(next(ids), got + end)
                    if writer.ids >= FILE_BYTES // 4:
                        yield row()
                        writer, file = None, file + 1
        if writer:
            yield row()

    order = ["__doc", "__tie", "__row"]
    rows = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).alias("__text"), F.xxhash64(text).alias("__tie"), F.monotonically_increasing_id().alias("__row"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("__doc", "__text").mapInArrow(run, "part int, file int, path string, docs long, ids long")


def read_back(manifest: DataFrame) -> DataFrame:
    """Each document of the manifest's files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the manifest has one row a file, so its
    running sum is short.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, inner = file_system(row["path"])
                with fs.open_input_file(inner) as f:
                    reader, start = Reader(f), row["before"]
                    rows = reader.rows()
                    while got := [(d, len(x) // 4, zlib.crc32(x)) for d, x in islice(rows, READ_DOCS)]:
                        n = np.array([x[1] for x in got], dtype=np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int64()), pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array([x[2] for x in got], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(n.sum())

    before = F.coalesce(F.sum("ids").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("before", before.cast("long")).select("path", "before")
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocab: str, folder: str | None = None) -> DataFrame:
    """Write the files (in the shared folder, unless told where) and read them back."""
    scratch = Scratch(docs.sparkSession, "token-files")
    return read_back(scratch.keep(write(docs, vocab, folder or f"{scratch.path}/files"), "manifest"))

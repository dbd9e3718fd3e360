"""Token ids of a corpus in seekable Zstandard files.

A file is a row of independent zstd frames and a trailing seek table in a
skippable frame (the public seekable layout: sizes and a checksum per frame, so
plain zstd readers also read the file).  Each frame but the last holds the ids
of whole documents; the last one holds the file's index (document ids, id
counts, frame numbers).  A reader fetches the table, the index, and then only
the frames of the documents it wants.

Documents are range-partitioned and sorted by id, so the files in name order
hold all documents in id order and every task writes its own files.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import lean
from refinery.llm.store import new_file, open_folder
from refinery.session import materialize

FRAME_IDS = 1 << 18          # ids in a frame, about; a document is never cut
FILE_BYTES = 64 << 20
# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC, SEEK_MAGIC, HAS_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
MANIFEST = "path string, part int, n_docs long, n_tokens long"
DOCUMENTS = "path string, part int, doc_id long, row long, start_in_file long, n_tokens long, ids_crc32 long"

# --- encoding ------------------------------------------------------------------------------------

_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"      # code points that are white space
# Byte-level BPE never merges across these cuts: a word takes one plain space
# before it, other white space stands alone up to the character before a word,
# and a letter or digit is never in one piece with punctuation that follows it
# (the apostrophe aside).
_LETTERS, _MARKS = "A-Za-z0-9\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f", ".,;:!?*$%&#|"
_CUTS = re.compile(rf" ?[{_LETTERS}]+(?=[{_MARKS}])| ?[^{_WS}]+|[{_WS}]+(?=[{_WS}][^{_WS}])|[{_WS}]+")
_ONE_PIECE = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")
CACHE_ENTRIES, CACHE_CHARS = 1_000_000, 48


def byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable ones stand for
    themselves, the rest take the code points from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts.  Each distinct word is encoded by the tokenizer
    once per worker and remembered; the ids equal those of the whole text.  A
    word of letters is one piece to a byte-level tokenizer and goes straight to
    its BPE model."""

    _made: dict[tuple, Encoder] = {}

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.end = np.array([end_id], self.dtype).tobytes()
        self.known: dict[str, bytes] = {}
        split = self.tokenizer.pre_tokenizer
        byte_level = isinstance(split, pre_tokenizers.ByteLevel) and not split.add_prefix_space
        self.model = self.tokenizer.model if byte_level and self.tokenizer.normalizer is None else None
        self.letters = byte_letters()

    def _new(self, words: Iterable[str]) -> dict[str, bytes]:
        whole = [w for w in words if self.model is None or not _ONE_PIECE.fullmatch(w)]
        ids = dict(zip(whole, (e.ids for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False))))
        for w in words:
            if w not in ids:
                ids[w] = [t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(self.letters))]
        return {w: array(self.kind, i).tobytes() for w, i in ids.items()}

    @classmethod
    def of(cls, path: str, end_id: int) -> Encoder:
        key = (path, end_id)
        if key not in cls._made:
            cls._made[key] = cls(path, end_id)
        return cls._made[key]

    @classmethod
    def forget(cls) -> None:
        """Drop the encoders of this worker with the words they remember."""
        cls._made.clear()

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Packed ids of each text, the end id appended; null is empty.  Once
        the memory is full, further words are encoded without being kept."""
        known = self.known
        for t in texts:
            words = _CUTS.findall(t or "")
            ids = list(map(known.get, words))
            if None in ids:
                fresh = self._new({w for w, i in zip(words, ids) if i is None})
                ids = [fresh[w] if i is None else i for w, i in zip(words, ids)]
                if len(known) < CACHE_ENTRIES:
                    known.update((w, i) for w, i in fresh.items() if len(w) <= CACHE_CHARS)
            yield b"".join(ids) + self.end


# --- the file format -----------------------------------------------------------------------------

class SeekableWriter:
    """Collects documents and writes frames to ``out``."""

    def __init__(self, out, dtype: np.dtype, frame_ids: int = FRAME_IDS):
        self.out, self.dtype, self.frame_bytes = out, dtype, frame_ids * dtype.itemsize
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.held: list[bytes] = []
        self.held_bytes = self.written = self.n_tokens = 0
        self.table: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // self.dtype.itemsize, len(self.table)))
        self.held.append(ids)
        self.held_bytes += len(ids)
        self.n_tokens += len(ids) // self.dtype.itemsize
        if self.held_bytes >= self.frame_bytes:
            self._frame(b"".join(self.held))
            self.held, self.held_bytes = [], 0

    def _frame(self, plain: bytes) -> None:
        packed = self.zstd.compress(plain)
        self.out.write(packed)
        self.written += len(packed)
        self.table.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
        ids = np.array([0 if d is None else d for d, _, _ in self.docs], "<i8")
        null = np.array([d is None for d, _, _ in self.docs], "u1")
        counts, frames = (np.array([d[k] for d in self.docs], "<u4") for k in (1, 2))
        index = struct.pack("<IQ", self.dtype.itemsize, len(ids)) + b"".join(a.tobytes() for a in (ids, null, counts, frames))
        self._frame(index)
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        foot = struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(foot)) + entries + foot)


class SeekableReader:
    """Random access to a file that ``SeekableWriter`` made.  ``file`` needs
    ``size()`` and ``read_at(n, offset)`` (a pyarrow input file)."""

    def __init__(self, file):
        self.file, size = file, file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3)
        self.sizes, self.checks = table[:, :2].astype(np.int64), table[:, 2]
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))
        index = self.frame(n - 1)
        width, docs = struct.unpack_from("<IQ", index)
        self.dtype, at, parts = np.dtype(f"<u{width}"), 12, []
        for t in ("<i8", "u1", "<u4", "<u4"):
            parts.append(np.frombuffer(index, t, docs, at))
            at += docs * np.dtype(t).itemsize
        self.ids, self.null, self.counts, self.frames = parts

    def frame(self, k: int) -> bytes:
        """Frame ``k``, checked against the table."""
        packed = self.file.read_at(int(self.sizes[k, 0]), int(self.offsets[k]))
        plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.sizes[k, 1]))
        if len(plain) != self.sizes[k, 1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k}: checksum differs")
        return plain

    def documents(self, wanted: set | None = None) -> Iterator[tuple]:
        """(position, document id, ids as uint32) of all documents, or of the
        wanted ids; frames without any are not read."""
        for k in np.unique(self.frames):
            of = np.flatnonzero(self.frames == k)
            ids = [None if self.null[i] else int(self.ids[i]) for i in of]
            if wanted is not None and not wanted.intersection(ids):
                continue
            tokens = np.frombuffer(self.frame(int(k)), self.dtype)
            ends = np.cumsum(self.counts[of].astype(np.int64))
            for i, doc, end, n in zip(of, ids, ends, self.counts[of]):
                if wanted is None or doc in wanted:
                    yield int(i), doc, tokens[end - n:end].astype("<u4")


# --- Spark jobs ----------------------------------------------------------------------------------

def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_column: str = "doc_id",
                      text_column: str = "text", frame_ids: int = FRAME_IDS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write every document's ids under ``folder``; returns the manifest (path,
    part, n_docs, n_tokens).  Order: id, null first, repeated ids by a hash of
    the text.  A null text is empty and so is only the end id."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    ordered = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = Encoder.of(tokenizer_path, end_id)
        coded = (x for b in batches for at in range(0, b.num_rows, 256) for s in [b.slice(at, 256)]
                 for x in zip(s.column("id").to_pylist(), encoder.encode(s.column("text").to_pylist())))
        made, first = [], next(coded, None)
        while first is not None:
            name = f"tokens-{part:06d}-{len(made):04d}-{uuid.uuid4().hex[:8]}.ids.zst"
            with new_file(folder, name) as out:
                w = SeekableWriter(out, encoder.dtype, frame_ids)
                while first is not None and w.written < file_bytes:
                    w.add(*first)
                    first = next(coded, None)
                w.close()
            made.append({"path": name, "part": part, "n_docs": len(w.docs), "n_tokens": w.n_tokens})
        yield pa.RecordBatch.from_pylist(made, pa.schema([("path", pa.string()), ("part", pa.int32()),
                                                          ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return materialize(ordered.mapInArrow(lambda batches: lean(write(batches)), MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str, wanted: set | None = None) -> DataFrame:
    """One row per document of the manifest's files: where its ids start in the
    whole corpus, how many they are and their crc32.  With ``wanted`` ids only
    the frames that hold them are read."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.forget()                                         # the files are written: a worker needs its encoder no more
        fs, root = open_folder(folder)
        for batch in batches:
            for f in batch.to_pylist():
                with fs.open_input_file(f"{root}/{f['path']}") as file:
                    reader = SeekableReader(file)
                    starts = np.concatenate(([0], np.cumsum(reader.counts.astype(np.int64))))
                    rows = [{"path": f["path"], "part": f["part"], "doc_id": doc, "row": i, "start_in_file": int(starts[i]),
                             "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
                            for i, doc, ids in reader.documents(wanted)]
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = manifest.count()
    if files == 0:
        return manifest.sparkSession.createDataFrame([], DOCUMENTS + ", start long")
    found = manifest.repartition(min(files, 2000)).mapInArrow(lambda batches: lean(read(batches)), DOCUMENTS)
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)      # one row per file
    offsets = materialize(manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before")),
                          "token-offsets")
    return found.join(offsets, "path").withColumn("start", F.col("before") + F.col("start_in_file")).drop("before")


_ARROW = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[t])
                    for n, t in (x.split() for x in DOCUMENTS.split(", "))])

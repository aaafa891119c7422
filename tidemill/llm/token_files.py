"""Token ids in seekable zstandard files.

Layout of a file, all of it a valid zstandard stream:

* data frames: each an independent zstandard frame with content checksum, holding the ids of whole documents, as
  little-endian unsigned 16-bit (vocabularies up to 65 536) or 32-bit numbers;
* after each data frame a skippable frame (magic 0x184D2A50) of one byte;
* a skippable frame (0x184D2A51) with one record per document: doc_id (int64), flags (uint8: 1 = NULL id), frame (uint32),
  ids before it in the frame (uint32), number of ids (uint32); then the width of an id in bytes (uint8) and one byte;
* the seek table: a skippable frame (0x184D2A5E) with, for each data frame, position (uint64), compressed size, size
  (uint32) and checksum (uint32: low half of XXH64 of the raw bytes); then position of the document records (uint64),
  number of data frames (uint32), the magic number 0x8F92EAB1 and one byte.

The lone bytes are line ends: Spark's own text writer writes one line for each frame, so files reach any file system
that Spark reaches, and a task that is lost or run twice leaves no half file behind. Readers find the seek table from
the end and decompress only the frames of the documents asked for.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import pretokens
from tidemill.llm.shared import in_arrow, kept, pick, text_slices

# Fixed values of the file format.
GAP_MAGIC, DOCS_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
FRAME, TAIL = "<QIII", "<QIIc"
DOCS = np.dtype([("doc_id", "<i8"), ("flags", "u1"), ("frame", "<u4"), ("at", "<u4"), ("n", "<u4")])
FRAME_IDS = 32_768


class Encoder:
    """Whole texts to ids with the tokenizers library; equal pre-tokens of a slice are encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 65_536 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.clear()

    def clear(self) -> None:
        """The ids of pre-tokens met so far: number of its record by hash; record k is ``pool[begin[k]:begin[k + 1]]``."""
        self.known = pretokens.Known()
        self.pool, self.begin, self.records = np.zeros(1 << 20, self.kind), np.zeros(1 << 18, np.int64), 0

    def _learn(self, spans: list[str]) -> np.ndarray:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(spans, add_special_tokens=False)]
        size = np.array([len(e) for e in encoded], np.int64)
        ids = np.fromiter(chain.from_iterable(encoded), self.kind, int(size.sum()))
        first, used = self.records, int(self.begin[self.records])
        while used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while first + len(size) >= len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.pool[used : used + len(ids)] = ids
        self.begin[first + 1 : first + 1 + len(size)] = used + np.cumsum(size)
        self.records += len(size)
        return np.arange(first, self.records)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ``first`` with those of text i at ``first[i]:first[i+1]``)."""
        found = pretokens.split(texts, self.specials)
        if not len(found.starts):
            return np.zeros(0, self.kind), np.zeros(len(texts) + 1, np.int64)
        if self.known.full:
            self.clear()
        hashes, at, back = pretokens.distinct(found.hashes)
        record = self.known.get(hashes)
        new = np.flatnonzero(record < 0)
        if len(new):
            spans = zip(found.starts[at[new]].tolist(), found.ends[at[new]].tolist())
            record[new] = self._learn([found.joined[a:b] for a, b in spans])
            self.known.put(hashes[new], record[new])
        record = record[back]
        begin = self.begin[record]
        each = self.begin[record + 1] - begin
        ids = self.pool[np.repeat(begin - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))]
        first = np.zeros(len(texts) + 1, np.int64)
        first[1:] = np.cumsum(np.bincount(found.owner, weights=each, minlength=len(texts)).astype(np.int64))
        return ids, first


def _skippable(magic: int, content: bytes) -> bytes:
    """A skippable frame less its last byte, which the line end gives."""
    return struct.pack("<II", magic, len(content) + 1) + content


def _lines(path: str, end_id: int, level: int):
    """Sorted documents of a partition to the frames of one file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = Encoder(path), zstandard.ZstdCompressor(level=level, write_checksum=True)
        frames, records, position = [], [], 0
        waiting: list[bytes] = []
        held = 0

        def line(content: bytes) -> pa.RecordBatch:
            nonlocal position
            position += len(content) + 1
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["value"])

        def frame() -> pa.RecordBatch:
            nonlocal held
            raw = b"".join(waiting)
            packed = packer.compress(raw)
            frames.append((position, len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            waiting.clear()
            held = 0
            return line(packed + _skippable(GAP_MAGIC, b""))

        end = np.array([end_id], encode.kind).tobytes()
        for batch in text_slices(batches, "text", 500_000):
            ids, first = encode(batch.column(1).to_pylist())
            for i, doc in enumerate(batch.column(0).to_pylist()):
                raw = ids[first[i] : first[i + 1]].tobytes() + end
                n = len(raw) // encode.width
                records.append((doc or 0, int(doc is None), len(frames), held, n))
                waiting.append(raw)
                held += n
                if held >= FRAME_IDS:
                    yield frame()
        if waiting:
            yield frame()
        if records:
            docs_at = position
            yield line(_skippable(DOCS_MAGIC, np.array(records, DOCS).tobytes() + bytes([encode.width])))
            table = b"".join(struct.pack(FRAME, *f) for f in frames) + struct.pack(TAIL, docs_at, len(frames), SEEKABLE_MAGIC, b"\n")[:-1]
            yield line(_skippable(TABLE_MAGIC, table))

    return run


class TokenFile:
    """One file's content: its document records, and the ids of single documents."""

    def __init__(self, content: bytes):
        self.content = content
        docs_at, n, magic, _ = struct.unpack(TAIL, content[-struct.calcsize(TAIL) :])
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a token file, or cut short")
        begin = len(content) - struct.calcsize(TAIL) - n * struct.calcsize(FRAME)
        self.frames = [struct.unpack_from(FRAME, content, begin + i * struct.calcsize(FRAME)) for i in range(n)]
        _, size = struct.unpack_from("<II", content, docs_at)
        records = content[docs_at + 8 : docs_at + 8 + size - 2]
        self.kind = np.dtype(f"<u{content[docs_at + 8 + size - 2]}")
        self.docs = np.frombuffer(records, DOCS)
        self.unpacker = zstandard.ZstdDecompressor()
        self._open: tuple[int, bytes] = (-1, b"")

    def frame(self, i: int) -> bytes:
        if self._open[0] != i:
            at, packed, size, check = self.frames[i]
            raw = self.unpacker.decompress(self.content[at : at + packed], max_output_size=size)
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {i} is damaged")
            self._open = (i, raw)
        return self._open[1]

    def ids(self, record) -> np.ndarray:
        width = self.kind.itemsize
        at = int(record["at"]) * width
        return np.frombuffer(self.frame(int(record["frame"])), self.kind)[at // width : at // width + int(record["n"])]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text",
                      level: int = 3, partitions: int | None = None) -> None:
    """Encode every whole text and write one file per range of ids under ``path``, in ascending doc_id order.

    NULL ids come first, repeated ids one after the other by text; a NULL text is empty and gives the end id alone; very
    long texts are one frame each; an empty table leaves a folder without ids; other columns are not read. ``partitions``
    sets the number of files (the session's shuffle partitions otherwise); every range is sorted and encoded by its own
    task, and a lost task is simply run again.
    """
    source = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = source.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    lines = in_arrow(ranged, _lines(tokenizer_path, end_id, level), "value binary")
    lines.select(F.col("value").cast("string").alias("value")).write.option("compression", "none").text(path, lineSep="\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    part = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select(
        part.alias("part"), "content")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            file = TokenFile(content.as_py())
            checks = [zlib.crc32(file.ids(r).astype("<u4").tobytes()) for r in file.docs]
            n = file.docs["n"].astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(n), part)), pa.array(file.docs["doc_id"].astype(np.int64), mask=file.docs["flags"] > 0),
                pa.array(np.cumsum(n) - n), pa.array(n), pa.array(np.array(checks, np.int64))],
                ["part", "doc_id", "at", "n_tokens", "ids_crc32"])


def token_file_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read from the files: doc_id, start (ids of all documents before it), n_tokens (with the end id), ids_crc32."""
    found = kept(in_arrow(_files(spark, path), _digests, "part long, doc_id long, at long, n_tokens long, ids_crc32 long"))
    # one row per file: the sums before each file are worked out on as many rows as there are files
    sums = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sums.selectExpr("part", "sum(n) over (order by part rows between unbounded preceding and current row) - n as base")
    return found.join(before, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """(doc_id, ids) of the documents asked for; only their frames are decompressed. Ids that are not there give no row."""
    wanted = set(doc_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                file = TokenFile(content.as_py())
                for r in file.docs:
                    if int(r["doc_id"]) in wanted and not r["flags"]:
                        ids = file.ids(r).astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([int(r["doc_id"])]), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return in_arrow(_files(spark, path), run, "doc_id long, ids array<long>")

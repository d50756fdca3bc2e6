"""Token ids as framed binary records in shards, with an index of offsets for shuffled reads.

A shard is a run of records; a record is, in little-endian order:
    8 bytes  length of the payload
    4 bytes  masked CRC-32 of those 8 bytes
    payload  8 bytes doc_id (signed), 1 byte flags (1: doc_id is null, 2: ids have 2 bytes instead of 4), then the ids
    4 bytes  masked CRC-32 of the payload
The mask is the rotation by 15 bits plus a constant that record files use, so that a checksum of data holding checksums
stays meaningful. The index is a Parquet table (shard, file, record, doc_id, offset, length, start, n_tokens): any record can
be read by itself, in any order. Shards are in ascending doc_id order, and so are the records in each.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotledger.llm.common import at_hand, new_folder, small, tidied

END_ID = 2
#: Rows aimed at in one shard.
SHARD_ROWS = 20_000
#: The sums of at most so many shards are broadcast (16 MB); more are joined by a shuffle.
BROADCAST_SHARDS = 1_000_000
#: Distinct pieces of up to so many characters whose ids a worker keeps at hand; beyond that the older half goes, which changes
#: the speed only. About 160 MB for words of 9 letters; `pieces` sets another number.
CACHE_PIECES, PIECE_CHARS = 1_000_000, 40
CACHE_MARKS = 10_000
MASK_DELTA = 0xA282EAD8
HEAD, CHECK, FRONT = "<Q", "<I", "<qB"
FRONT_BYTES = 9
NULL_ID, NARROW = 1, 2
READ_BYTES = 1 << 20
MANIFEST = "shard long, file string, record long, doc_id long, offset long, length long, n_tokens long"

# A run of letters ends before these marks, and a run of marks is one token run; the apostrophe is not among them.
_SIMPLE = re.compile(r"(\n?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?%&*#$)]*)")
# Byte-level vocabularies write a byte as a printable character: itself, or the next free one from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_LITTLE = sys.byteorder == "little"
_ODD = re.compile(r"[\x00-\x1f\x7f-\xa0\xad]")
# A space before a printable character always opens a new token, and a line break there is one: texts may be cut before both.
_CUT = re.compile(r" (?=[!-~À-ɏ])|(?=\n[!-~À-ɏ])")
_OPENS = re.compile(r"\n?[!-~À-ɏ]")


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack(HEAD, len(payload))
    return b"".join((head, struct.pack(CHECK, masked(zlib.crc32(head))), payload, struct.pack(CHECK, masked(zlib.crc32(payload)))))


class _Uncut(Exception):
    """A text was cut where no token need begin."""


class _Spaced(dict):
    """The ids of pieces that follow a space or begin with a line break, worked out when they are first asked for."""

    def __init__(self, codec: Encoder, limit: int):
        self.codec, self.limit = codec, limit

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            for old in [*islice(self, self.limit // 2 + 1)]:  # the frequent ones among them soon come again
                del self[old]
        if piece.isascii() and piece.isalpha():
            ids = self.codec.run("\u0120" + piece)
        elif (word := _SIMPLE.fullmatch(piece)) is None:
            if _OPENS.match(piece) is None:
                raise _Uncut
            ids = self.codec.plain(piece if piece[0] == "\n" else " " + piece)
        elif word[2]:
            known = word[1] in self
            ids = self[word[1]] + self.codec.mark(word[2])
            if not known:  # a new word may never come again, with marks or without
                return ids
        elif piece[0] == "\n":
            ids = self.codec.mark("\n") + self.codec.merged(piece[1:])
        else:
            ids = self.codec.merged(" " + piece)
        if len(piece) <= PIECE_CHARS:
            self[piece] = ids
        return ids


class Encoder:
    """Token ids of whole texts as bytes of 4 per id; pieces that came before are looked up."""

    def __init__(self, path: str, pieces: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # cutting needs words as byte-level tokenizers part them, and nothing done to the text before
        words = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        self.cuts = self.tokenizer.normalizer is None and words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words["add_prefix_space"]
        self.model = self.tokenizer.model
        self.spaced = _Spaced(self, CACHE_PIECES if pieces is None else pieces)
        self.marks: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def run(self, line: str) -> bytes:
        """The ids of one token run in the characters of the vocabulary, straight from the merges."""
        ids = array("I", [t.id for t in self.model.tokenize(line)])
        if not _LITTLE:
            ids.byteswap()
        return ids.tobytes()

    def merged(self, word: str) -> bytes:
        """The ids of one token run of letters, after a space or not, or of marks."""
        line = word if word.isascii() else word.encode().decode("latin-1")
        if _ODD.search(line):
            line = line.translate(_BYTES)
        elif line[0] == " ":
            line = "\u0120" + line[1:]
        return self.run(line)

    def mark(self, marks: str) -> bytes:
        """`merged`, remembered: few runs of marks come again and again."""
        if (ids := self.marks.get(marks)) is None:
            if len(self.marks) >= CACHE_MARKS:
                self.marks.clear()
            ids = self.marks[marks] = self.merged(marks)
        return ids

    def first(self, piece: str) -> bytes:
        """The ids of what a text begins with: as after a line break, without the line break."""
        if not piece or _SIMPLE.fullmatch(piece) is None:
            return self.plain(piece)
        return self.spaced["\n" + piece][len(self.mark("\n")) :]

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.cuts or any(s in text for s in self.special):
            return self.plain(text)
        try:  # where every space and line break is followed by a printable character, plain splitting does the same
            return self.joined(text.replace("\n", " \n").split(" "))
        except _Uncut:
            return self.joined(_CUT.split(text))

    def joined(self, pieces: list[str]) -> bytes:
        first, *rest = pieces
        return self.first(first) + b"".join(map(self.spaced.__getitem__, rest))


_encoders: dict[tuple[str, int | None], Encoder] = at_hand({})


def encoder(path: str, pieces: int | None = None) -> Encoder:
    if (path, pieces) not in _encoders:
        _encoders[path, pieces] = Encoder(path, pieces)
    return _encoders[path, pieces]


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _writer(tokenizer: str, folder: str, end_id: int, pieces: int | None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker left
        shard = TaskContext.get().partitionId()
        codec, files, path = encoder(tokenizer, pieces), *open_folder(folder)
        # a name of its own for every attempt: only files named by the stored index count
        file = f"{shard:06d}-{uuid.uuid4().hex}.rec"
        out, offset, record = None, 0, 0
        end = struct.pack("<I", end_id)
        for batch in batches:
            made: list[tuple] = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), (codec.encode(t.as_py() or "") for t in batch.column("text"))):
                ids = np.frombuffer(data + end, dtype="<u4")
                narrow = int(ids.max()) < 65536
                flags = (NULL_ID if doc_id is None else 0) | (NARROW if narrow else 0)
                framed = frame(struct.pack(FRONT, doc_id or 0, flags) + ids.astype("<u2" if narrow else "<u4").tobytes())
                if out is None:
                    out = files.open_output_stream(f"{path}/{file}")
                out.write(framed)
                made.append((shard, file, record, doc_id, offset, len(framed), len(ids)))
                offset, record = offset + len(framed), record + 1
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _MANIFEST_TYPES)], names=_MANIFEST_NAMES)
        if out is not None:
            out.close()

    return write


_MANIFEST_NAMES = ["shard", "file", "record", "doc_id", "offset", "length", "n_tokens"]
_MANIFEST_TYPES = [pa.int64(), pa.string(), *[pa.int64()] * 5]


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shard_rows: int = SHARD_ROWS, pieces: int | None = None
) -> DataFrame:
    """Encodes and writes every row of `docs` to shards in `folder`; returns the stored index.

    Null or empty text is the end id alone. A null doc_id comes first. Rows that share a doc_id follow each other, by text.
    Other columns are not looked at. An empty table writes no shard and an empty index. A task that runs twice writes two
    files; the index, written once all tasks are done, names one of them.
    """
    spark = docs.sparkSession
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = max(1, -(-rows.count() // shard_rows), spark.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    )
    index = ordered.mapInArrow(_writer(tokenizer, folder, end_id, pieces), MANIFEST)
    index.write.parquet(f"{folder}/index-parts")
    parts = spark.read.schema(index.schema).parquet(f"{folder}/index-parts")
    sums = parts.groupBy("shard").agg(F.sum("n_tokens").alias("sum"))
    before = F.coalesce(F.sum("sum").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row per shard
    inside = F.sum("n_tokens").over(W.partitionBy("shard").orderBy("record").rowsBetween(W.unboundedPreceding, -1))
    full = parts.join(small(sums.select("shard", before.alias("before")), BROADCAST_SHARDS), "shard")
    full = full.withColumn("start", F.col("before") + F.coalesce(inside, F.lit(0))).drop("before")
    full.write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{MANIFEST}, start long").parquet(f"{folder}/index")


def unframe(data: bytes) -> bytes:
    """The payload of one framed record; a wrong checksum or length is an error."""
    (length,) = struct.unpack_from(HEAD, data, 0)
    if struct.unpack_from(CHECK, data, 8)[0] != masked(zlib.crc32(data[:8])):
        raise ValueError("length checksum does not match")
    payload = data[12 : 12 + length]
    if len(payload) != length or struct.unpack_from(CHECK, data, 12 + length)[0] != masked(zlib.crc32(payload)):
        raise ValueError("payload checksum does not match")
    return payload


def ids_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = struct.unpack_from(FRONT, payload, 0)
    ids = np.frombuffer(payload, dtype="<u2" if flags & NARROW else "<u4", offset=FRONT_BYTES).astype("<u4")
    return (None if flags & NULL_ID else doc_id), ids


def _reader(folder: str, whole: bool):
    """For rows of the index: the doc_id and ids found at their offsets; neighbouring records are read together."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        now, source = None, None
        for batch in batches:
            made: list[tuple] = []
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length", "start"))))
            held, held_at = b"", 0
            for file, offset, length, start in rows:
                if file != now:
                    if source is not None:
                        source.close()
                    source, now, held = files.open_input_file(f"{path}/{file}"), file, b""
                if not (held_at <= offset and offset + length <= held_at + len(held)):
                    held, held_at = source.read_at(max(length, READ_BYTES), offset), offset
                payload = unframe(held[offset - held_at : offset - held_at + length])
                doc_id, ids = ids_of(payload)
                made.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist() if whole else None))
            if made:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                columns = [pa.array(c, t) for c, t in zip(zip(*made), types)]
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns if whole else columns[:4], names=names if whole else names[:4])
        if source is not None:
            source.close()

    return tidied(read)


def read_records(index: DataFrame, folder: str, whole: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, and ids if `whole`) of the records that `index` names, checksums verified.

    Give any part of the index, in any order: a sample, a shuffled epoch, one document.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if whole else "")
    return index.select("file", "offset", "length", "start").mapInArrow(_reader(folder, whole), schema)


def encode_and_read_back(docs: DataFrame, tokenizer: str, folder: str | None = None, pieces: int | None = None) -> DataFrame:
    folder = folder or new_folder(docs.sparkSession, "records")
    return read_records(write_records(docs, folder, tokenizer, pieces=pieces), folder, whole=False)

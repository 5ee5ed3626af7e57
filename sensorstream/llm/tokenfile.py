"""Token ids in binary files: fixed-width bit packing with block offsets.

Every id takes the least number of bits that holds the vocabulary. A file has a
header, a table of its documents, a table of block offsets, and blocks of ``BLOCK_IDS``
ids each; a block starts at a byte, so any range of ids is unpacked from its blocks alone.

    magic "TIDS" | u2 version | u2 bits | u4 ids per block | u4 part | u8 first id in part
    | u8 documents | u8 ids | i8 doc_id x documents | u1 null id x documents
    | u8 start in file x (documents + 1) | u8 block offset x (blocks + 1) | blocks | "SDIT"

All numbers are little-endian; offsets count from the first block. Parts are
ranges of doc_id in ascending order, and files of a part follow each other; the first id
of a part is the sum of the ids in the parts before, one number per part.

Spark's own writer commits the files, so they may lie on any file system that Spark
writes, and a task that is run again leaves one copy.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm.common import Scratch, crc32_of, for_texts, text_of
from sensorstream.llm.tokenizing import BatchTokenizer

MAGIC, END = b"TIDS", "SDIT"
HEADER = struct.Struct("<4sHHIIQQQ")
#: A multiple of 8, so that a block of any width fills whole bytes.
BLOCK_IDS = 4096
#: Ids after which a file is closed; a document is never split between files.
FILE_IDS = 4_000_000


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id, one at least."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids on end in ``bits`` bits each, the last byte filled with zeros."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} takes more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(
        np.unpackbits(wide, axis=1, count=bits, bitorder="little").ravel(), bitorder="little"
    ).tobytes()


def unpack(data: bytes | memoryview, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flat.reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def file_bytes(
    doc_ids: list[int | None], ids: np.ndarray, starts: np.ndarray, bits: int, part: int, first: int
) -> bytes:
    """A whole file without its end mark."""
    blocks = [pack(ids[k : k + BLOCK_IDS], bits) for k in range(0, len(ids), BLOCK_IDS)]
    offsets = np.cumsum([0, *map(len, blocks)])
    head = HEADER.pack(MAGIC, 1, bits, BLOCK_IDS, part, first, len(doc_ids), len(ids))
    tables = [
        np.array([0 if d is None else d for d in doc_ids], "<i8"),
        np.array([d is None for d in doc_ids], np.uint8),
        np.asarray(starts, "<u8"),
        offsets.astype("<u8"),
    ]
    return b"".join([head, *(t.tobytes() for t in tables), *blocks])


@dataclass
class TokenFile:
    """One file's content (bytes, memory map): documents and ids by position."""

    data: bytes | memoryview

    def __post_init__(self) -> None:
        head = HEADER.unpack_from(self.data)
        magic, version, self.bits, self.block_ids, self.part, self.first, docs, self.n_ids = head
        if magic != MAGIC or version != 1 or bytes(self.data[-len(END) :]) != END.encode():
            raise ValueError("not a whole token file")
        at = HEADER.size
        blocks = -(-self.n_ids // self.block_ids)

        def table(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(self.data, kind, count, at)
            at += found.nbytes
            return found

        self.doc_ids, self.null_ids = table("<i8", docs), table("u1", docs).astype(bool)
        self.starts, self.offsets = table("<u8", docs + 1), table("<u8", blocks + 1)
        self.body = at

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the file, from the blocks they lie in."""
        if end <= begin:
            return np.empty(0, np.uint32)
        first, last = begin // self.block_ids, -(-end // self.block_ids)
        start, stop = (self.body + int(self.offsets[k]) for k in (first, last))
        held = min(self.n_ids, last * self.block_ids) - first * self.block_ids
        found = unpack(memoryview(self.data)[start:stop], held, self.bits)
        return found[begin - first * self.block_ids : end - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    vocabulary: int,
    end_id: int = 1,
    id_column: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode whole texts, each closed by ``end_id``, and write them in ascending id order.

    Null text counts as empty: its document is the end id alone. Null ids come first;
    rows that share an id follow each other by the hash of their text. An empty table
    leaves a folder without token files. Texts are dealt by ranges of id, so a part's order
    needs no further exchange, and a file is closed at ``FILE_IDS``.
    """
    for_texts(docs.sparkSession)
    bits = bits_for(vocabulary)
    tie = F.xxhash64("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchTokenizer.of_worker(tokenizer, end_id)
        part = TaskContext.get().partitionId()
        first, names, parts, held = 0, [], [], 0

        def file() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            starts = np.cumsum([0, *map(len, parts)])
            data = file_bytes(names, ids, starts, bits, part, first)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        for batch in batches:
            ids, bounds = encoder.encode(batch.column("text"))
            for k, name in enumerate(batch.column("id").to_pylist()):
                names.append(name)
                parts.append(ids[bounds[k] : bounds[k + 1]])
                held += len(parts[-1])
                if held >= FILE_IDS:
                    yield file()
                    first, names, parts, held = first + held, [], [], 0
        if names:
            yield file()

    files = (
        docs.select(F.col(id_column).cast("bigint").alias("id"), text_of(text).alias("text"))
        .repartitionByRange("id", tie)
        .sortWithinPartitions("id", tie)
        .mapInArrow(run, "data binary")
    )
    # A cast to string keeps the bytes as they are; the line end is the file's end mark.
    files.select(F.col("data").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).option("lineSep", END).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, doc_id, start_in_part, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = TokenFile(content.as_buffer())
                ids = file.ids(0, file.n_ids)
                bounds = file.starts.astype(np.int64)
                sums = [crc32_of(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sums), file.part, np.int32)),
                        pa.array(file.doc_ids, mask=file.null_ids),
                        pa.array(bounds[:-1] + file.first),
                        pa.array(np.diff(bounds)),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
                )

    schema = "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"
    # Few files per Arrow batch: each row is a whole file of some MB.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").where(F.length("content") > 0).mapInArrow(run, schema)


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """``read_token_files`` with ``start``: ids of all documents before, over all files.

    One number per part reaches the driver and goes back to the tasks.
    """
    read = Scratch(spark, "token-files").write(read_token_files(spark, path))
    totals = read.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    firsts, before = [], 0
    for part, n in sorted(totals):
        firsts.append((part, before))
        before += n
    firsts = spark.createDataFrame(firsts, "part int, before long")
    read = read.join(F.broadcast(firsts), "part")
    return read.withColumn("start", F.col("before") + F.col("start_in_part")).drop("before")

"""Token ids in directly addressable codes.

An id is cut into chunks of eight bits, least first. Level 0 holds the first chunk
of every id, level k the k-th chunk of those ids that need one; a bitmap beside each
level says whose code goes on, and a directory counts its set bits up to each block
of 512. The chunk of an id on the next level stands at the rank of its bit, so any id
is read in one step a level, without decoding what lies around it.

A file is a Parquet table of segments. A segment is one binary value: documents in
ascending order, their lengths, and the levels of their ids. Spark's own writer and
its commit put files in place, so a lost executor leaves no half-written ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedpulse.llm.common import documents, text_or_empty
from feedpulse.llm.packing import default_tokenizer
from feedpulse.llm.word_ids import encoder
from feedpulse.session import shared_folder

END_ID = 2
MAGIC = b"DAC1"
BLOCK = 512
SEGMENT_TOKENS = 1 << 20
SEGMENTS = "part int, segment int, n_docs long, n_tokens long, payload binary"


def encode_levels(ids: np.ndarray) -> bytes:
    """Levels of ``ids``: count, chunks, and, but for the last level, bitmap and directory."""
    out, rest = [], ids.astype("<u4")
    while True:
        more = rest > 0xFF
        last = not more.any()
        out.append(np.array([len(rest), last], "<u8").tobytes())
        out.append((rest & 0xFF).astype(np.uint8).tobytes())
        if last:
            return b"".join(out)
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype="<u8")
        out += [bits.tobytes(), (np.cumsum(blocks) - blocks).astype("<u8").tobytes()]
        rest = rest[more] >> 8


class Segment:
    """A segment's documents, and its ids by position."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        n = int.from_bytes(payload[4:12], "little")
        self.doc_ids = np.frombuffer(payload, "<i8", n, 12)
        self.counts = np.frombuffer(payload, "<i8", n, 12 + 8 * n)
        self.no_id = np.frombuffer(payload, bool, n, 12 + 16 * n)
        self.levels, at, last = [], 12 + 17 * n, False
        while not last:
            count, last = (int(x) for x in np.frombuffer(payload, "<u8", 2, at))
            chunks = np.frombuffer(payload, np.uint8, count, at + 16)
            at += 16 + count
            bits = ranks = None
            if not last:
                bits = np.frombuffer(payload, np.uint8, -(-count // 8), at)
                at += len(bits)
                ranks = np.frombuffer(payload, "<u8", -(-count // BLOCK), at)
                at += 8 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """One id, by one step on each level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // BLOCK * BLOCK
            before = np.unpackbits(bits[first >> 3 : (i >> 3) + 1], bitorder="little")
            i = int(ranks[i // BLOCK]) + int(before[: i - first].sum())
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level from the last."""
        values = None
        for chunks, bits, _ in reversed(self.levels):
            own = chunks.astype("<u4")
            if bits is not None:
                more = np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)
                own[more] |= values << 8
            values = own
        return values


def segment(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    return b"".join(
        [
            MAGIC,
            len(ids).to_bytes(8, "little"),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([len(x) // 4 for x in ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], bool).tobytes(),
            encode_levels(np.frombuffer(b"".join(ids), "<u4")),
        ]
    )


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    text: str = "text",
    doc_id: str = "doc_id",
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Writes the ids of all ``docs``, each with end id 2, in ascending order of id.

    Null ids come first; rows of one id are in order of a hash of their text, by
    which an id with many rows is also split over tasks. Null texts are empty. A
    segment holds whole documents, ``segment_tokens`` ids or one document more.
    """
    value = text_or_empty(text)
    ordered = (
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            F.xxhash64(value).alias("tie"),
            value.alias("text"),
        )
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer), END_ID.to_bytes(4, "little")
        part, number = TaskContext.get().partitionId(), 0
        own_docs, own_ids, n = [], [], 0

        def filled():
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "segment": number,
                        "n_docs": len(own_docs),
                        "n_tokens": n,
                        "payload": segment(own_docs, own_ids),
                    }
                ],
                schema=SCHEMA,
            )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for first in range(0, len(ids), 64):
                some = slice(first, first + 64)
                for doc, raw in zip(ids[some], ids_of.encode(texts[some])):
                    own_docs.append(doc)
                    own_ids.append(raw + end)
                    n += len(raw) // 4 + 1
                    if n >= segment_tokens:
                        yield filled()
                        number += 1
                        own_docs, own_ids, n = [], [], 0
        if own_docs:
            yield filled()

    ordered.mapInArrow(encode, SEGMENTS).write.parquet(path)


SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(part, segment, seg_start)``: ids before each segment.

    Parts are summed first, so what one task orders are the parts of one file set,
    as many as its writer had tasks.
    """
    sizes = spark.read.parquet(path).select("part", "segment", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select(
        "part",
        (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"),
    )
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment"))
    return (
        sizes.withColumn("inside", inside - F.col("n_tokens"))
        .join(before, "part")
        .select("part", "segment", (F.col("part_start") + F.col("inside")).alias("seg_start"))
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, payload in zip(*[c.to_pylist() for c in batch.columns]):
                own = Segment(payload)
                raw = own.all().tobytes()
                stops = np.cumsum(own.counts)
                starts = stops - own.counts
                n = len(stops)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own.doc_ids, mask=own.no_id),
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(np.full(n, number, np.int32)),
                        pa.array(starts),
                        pa.array(own.counts),
                        pa.array(
                            [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, stops)],
                            pa.int64(),
                        ),
                    ],
                    names=["doc_id", "part", "segment", "inside", "n_tokens", "ids_crc32"],
                )

    found = spark.read.parquet(path).select("part", "segment", "payload").mapInArrow(
        decode,
        "doc_id long, part int, segment int, inside long, n_tokens long, ids_crc32 long",
    )
    return found.join(segment_starts(spark, path), ["part", "segment"]).select(
        "doc_id",
        (F.col("seg_start") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, col: str = "position") -> DataFrame:
    """``(position, id)`` for positions in the whole stream of ids, by direct access.

    Positions meet segments by the block of ``SEGMENT_TOKENS`` they fall in, and
    only segments that are asked for are looked into. A position has one row however
    often it is asked for, none outside the files.
    """
    starts = spark.read.parquet(path).select("part", "segment", "n_tokens")
    spans = starts.join(segment_starts(spark, path), ["part", "segment"]).where("n_tokens > 0")
    block = F.lit(SEGMENT_TOKENS)
    spans = spans.withColumn(
        "block",
        F.explode(
            F.sequence(
                F.floor(F.col("seg_start") / block),
                F.floor((F.col("seg_start") + F.col("n_tokens") - 1) / block),
            )
        ),
    )
    wanted = positions.select(F.col(col).cast("long").alias("position")).withColumn(
        "block", F.floor(F.col("position") / block)
    )
    inside = F.col("position") - F.col("seg_start")
    # A segment's positions, at most as many as it has ids, meet its payload once.
    asked = (
        wanted.distinct()
        .join(spans, "block")
        .where((inside >= 0) & (inside < F.col("n_tokens")))
        .groupBy("part", "segment")
        .agg(F.collect_list(F.struct("position", inside.alias("inside"))).alias("asked"))
    )
    payloads = spark.read.parquet(path).select("part", "segment", "payload")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked, payload in zip(*[c.to_pylist() for c in batch.columns]):
                own = Segment(payload)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["position"] for x in asked], pa.int64()),
                        pa.array([own[x["inside"]] for x in asked], pa.int64()),
                    ],
                    names=["position", "id"],
                )

    return (
        asked.join(payloads, ["part", "segment"])
        .select("asked", "payload")
        .mapInArrow(look, "position long, id long")
    )


def op4_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-codes")
    write_tokens(documents(spark, sf_dir), path, default_tokenizer())
    return read_documents(spark, path)

"""Best-fit packing of token sequences, online and in bounded space.

A packer holds a fixed number of open sequences. Their free spaces are the bits of
one integer, so that the tightest space that fits a piece is one shift away. Where
nothing fits and no more may be open, the fullest is closed to make room.

Texts are tokenised where they lie and reduced to one narrow row per piece. Pieces
are dealt to packing groups by hash, each group about ``group_tokens`` tokens, and
reach their packer in the order in which they are stored, whatever their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import ROW, documents, row_key, text_or_empty, written
from feedpulse.llm.word_ids import encoder

SIZE = 4096
END_ID = 1
#: Open sequences of a packer; a group fills about 16,000, so the bound is reached.
OPEN = 256
GROUP_TOKENS = 1 << 26

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class BestFit:
    """Places pieces one at a time; ``place`` gives the sequence and the offset there."""

    def __init__(self, size: int = SIZE, most_open: int = OPEN):
        self.size = size
        self.most_open = most_open
        self.free = 0  # bit f: some open sequence has f places left
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = 0
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.size:
            raise ValueError(f"a piece of {length} tokens; sequences hold {self.size}")
        fitting = self.free >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(left)
        else:
            if self.open >= self.most_open:
                self._take((self.free & -self.free).bit_length() - 1)
            left, sequence = self.size, self.made
            self.made += 1
        rest = left - length
        if rest:
            self.bins[rest].append(sequence)
            self.free |= 1 << rest
            self.open += 1
        return sequence, self.size - left

    def _take(self, left: int) -> int:
        some = self.bins[left]
        sequence = some.pop()
        if not some:
            self.free ^= 1 << left
        self.open -= 1
        return sequence


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", size: int = SIZE
) -> DataFrame:
    """One row per piece of ``size`` tokens: its place in its document and its checksum."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer), END_ID.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for doc, raw in zip(ids, ids_of.encode(batch.column(1).to_pylist())):
                raw += end
                for piece, at in enumerate(range(0, len(raw), 4 * size)):
                    own = raw[at : at + 4 * size]
                    rows.append((doc, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA
                )

    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")
    ).mapInArrow(cut, PIECES)


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def pack(
    pieces: DataFrame,
    size: int = SIZE,
    most_open: int = OPEN,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` should be a stored table, as it is read once for its total and once
    to be packed. Groups are dealt by a hash of the row and its key in that table, so
    no document or source is hot, and rows that are the same in all columns spread as
    well. A group's rows arrive in the order of their keys: a task that is run again
    places them alike. Each group is one partition.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packer = None, None
        for batch in batches:
            out = []
            for g, length in zip(batch.column("_group").to_pylist(), batch.column("length").to_pylist()):
                if g != group:
                    group, packer = g, BestFit(size, most_open)
                sequence, offset = packer.place(length)
                out.append((g << 32 | sequence, offset))
            ids, offsets = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(ids, pa.int64()),
                    pa.array(offsets, pa.int64()),
                ],
                names=[*names, "sequence_id", "offset"],
            )

    dealt = row_key(pieces).select(
        *names, ROW, F.pmod(F.xxhash64(*names, ROW), F.lit(groups)).cast("int").alias("_group")
    )
    ordered = dealt.repartitionById(groups, "_group").sortWithinPartitions("_group", ROW)
    return ordered.mapInArrow(place, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Pieces of all ``docs`` with their sequence and offset.

    Columns of the result: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. Null and empty texts are one piece of one end id. Null ids stay null;
    repeated rows are packed as often as they come. Other columns are not read. An
    empty table gives an empty result.
    """
    return pack(written(tokenized_pieces(docs, tokenizer), "pieces"), **options)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), default_tokenizer())


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of ``docs``."""
    return pack_documents(docs, default_tokenizer())

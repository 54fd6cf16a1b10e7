"""SentencePiece encoding with a merge-type prefix table, and decoding.

For a merge-type (BPE) vocabulary every prefix of a text has one last token: the
piece that ends there, reaches back to a prefix whose own last token it is
compatible with, and is not torn apart by a better merge across their border. One
pass of an automaton over the text gives all pieces that end at each place; the
table keeps the compatible one, and the ids are read backwards from the end. Its
cost is linear in the text, whatever the order of merges.

No piece holds a word mark after another character, so what stands between word
marks is encoded on its own, and words that come again are remembered.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import documents, text_or_empty

# Fixed value: the mark that stands for a space.
MARK = "▁"
#: Characters of a word that is remembered; texts without spaces are one long word.
REMEMBERED = 32
CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceTable:
    """Encoder for one merge-type model file, equal to the library's.

    ``limit`` bounds the words that are remembered, each of ``REMEMBERED`` characters at
    most, and half of it the pairs: about 250 MB in all. They are forgotten when there are
    more, which costs time and changes no result.
    """

    def __init__(self, path: str, limit: int = 800_000):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.library
        plain = [
            i
            for i in range(sp.vocab_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))
        ]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.score = {i: sp.get_score(i) for i in plain}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = sp.unk_id()
        self.chars = {piece for piece in self.ids if len(piece) == 1}
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece goes on after a word mark; texts can't be cut there")
        self.pairs = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        self.limit = limit
        self.words: dict[str, bytes] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        # Merge order; characters are there from the start. Pieces of equal score
        # have no order of their own, so their texts go by plain merging.
        order = sorted(self.ids.values(), key=lambda i: -self.score[i])
        self.rank = {i: n for n, i in enumerate(order)}
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        counts: dict[float, int] = {}
        for piece, i in self.ids.items():
            if len(piece) > 1:
                counts[self.score[i]] = counts.get(self.score[i], 0) + 1
        tied = {s for s, n in counts.items() if n > 1}
        self.tied = {p for p, i in self.ids.items() if len(p) > 1 and self.score[i] in tied}
        if any(p.strip(MARK) for p in self.tied):
            raise ValueError("pieces other than word marks share a score")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    self.joined[left, right] = i
            if len(piece) == 1:
                self.rank[i] = -1
            elif piece not in self.tied:
                history = self.merged(piece)
                if [x for x, _ in history] != [i]:
                    continue  # merging never makes this piece
                self.parts[i] = history[0][1]
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def merged(self, chunk: str) -> list[tuple[int, tuple[int, int] | None]]:
        """Plain merging, best score first, then leftmost: ids and what each was made of.

        All characters must be pieces.
        """
        ids: list = [self.ids[c] for c in chunk]
        made: list = [None] * len(ids)
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        queue: list = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(ids):
                whole = self.joined.get((ids[left], ids[right]))
                if whole is not None:
                    heapq.heappush(queue, (-self.score[whole], left, ids[left], ids[right], whole))

        for k in range(len(ids)):
            offer(k)
        while queue:
            _, left, a, b, whole = heapq.heappop(queue)
            right = after[left]
            if ids[left] != a or right >= len(ids) or ids[right] != b:
                continue
            ids[left], made[left], ids[right] = whole, (a, b), None
            after[left] = after[right]
            if after[left] < len(ids):
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [(i, m) for i, m in zip(ids, made) if i is not None]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two pieces in place.

        Goes back in time along the border: the piece merged later is undone, and a
        piece across the border must not come before the merge that was undone. A
        merge across stands left of one in the right piece, so it wins a tie there.
        """
        key = left, right
        known = self.fits.get(key)
        if known is not None:
            return known
        rank, parts, joined = self.rank, self.parts, self.joined
        latest, verdict = len(rank), True
        while True:
            across = joined.get((left, right))
            if across is not None and rank[across] < latest:
                verdict = False
                break
            if rank[left] > rank[right]:
                latest, left = rank[left], parts[left][1]
            elif rank[right] >= 0:
                latest, right = rank[right] + 1, parts[right][0]
            else:
                break
        if len(self.fits) > self.limit // 2:
            self.fits.clear()
        self.fits[key] = verdict
        return verdict

    def table(self, chunk: str) -> list[int]:
        """Ids of ``chunk``, whose characters are all pieces, by the prefix table."""
        n = len(chunk)
        last, reach = [-1] * (n + 1), [0] * (n + 1)
        fits, compatible = self.fits, self.compatible
        for end, (piece, size) in self.automaton.iter(chunk):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                own = last[start]
                if own < 0:
                    continue
                fit = fits.get((own, piece))
                if fit is None:
                    fit = compatible(own, piece)
                if not fit:
                    continue
            last[end], reach[end] = piece, size
        out = []
        while n:
            out.append(last[n])
            n -= reach[n]
        out.reverse()
        return out

    def chunk(self, chunk: str) -> list[int]:
        """Ids of what stands between two word marks, which may begin with marks."""
        if not self.chars.issuperset(chunk):
            # A character in no piece keeps its neighbours apart.
            out, own = [], []
            for c in chunk:
                if c in self.chars:
                    own.append(c)
                else:
                    out += self.chunk("".join(own)) if own else []
                    out += [self.bytes[b] for b in c.encode()]
                    own = []
            return out + (self.chunk("".join(own)) if own else [])
        if MARK * 2 in chunk:
            return [i for i, _ in self.merged(chunk)]
        return self.table(chunk)

    def word(self, word: str) -> bytes:
        """Ids, as little-endian 32-bit numbers, of a word mark and ``word``.

        Between two characters that stand side by side in no piece nothing is merged.
        What follows the last such border is taken off, sign by sign, as long as there is
        one: words are often known without the signs at their end.
        """
        end = len(word)
        while end > 2 and word[end - 2 : end] not in self.pairs:
            end -= 1
        head, tail = word[:end], word[end:]
        own = self.words.get(head) if tail else None
        if own is None:
            own = self._raw(self.chunk(MARK + head))
            if tail:
                self._remember(head, own)
        return own + b"".join([self._raw(self.chunk(c)) for c in tail])

    def _remember(self, word: str, own: bytes) -> None:
        if len(word) <= REMEMBERED:
            if len(self.words) > self.limit:
                self.words.clear()
            self.words[word] = own

    @staticmethod
    def _raw(ids: list[int]) -> bytes:
        return np.array(ids, "<i4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<i4")
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            chunks = CHUNKS.findall(MARK + text.replace(" ", MARK))
            return np.array([i for c in chunks for i in self.chunk(c)], "<i4")
        words, raw = self.words, []
        for word in text.split(" "):
            own = words.get(word)
            if own is None:
                own = self.word(word)
                self._remember(word, own)
            raw.append(own)
        return np.frombuffer(b"".join(raw), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


_tables: dict[str, PieceTable] = {}


def table(path: str) -> PieceTable:
    """The encoder of this Python worker."""
    if path not in _tables:
        _tables[path] = PieceTable(path)
    return _tables[path]


def encode_pieces(
    docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``(doc_id, ids, decoded)`` of every row: piece ids, and what they decode to.

    No begin or end ids. Null and empty texts have no ids and decode to an empty
    text. Rows are worked on where they lie, so null ids and repeated rows are kept
    as they come, and other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = table(model)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                ids = [own.encode(t) for t in some.column(1).to_pylist()]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.ListArray.from_arrays(offsets, np.concatenate(ids).astype(np.int32)),
                        pa.array([own.decode(x) for x in ids], pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")
    ).mapInArrow(encode, "doc_id long, ids array<int>, decoded string")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(documents(spark, sf_dir), default_model()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

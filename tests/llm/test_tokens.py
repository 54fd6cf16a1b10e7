"""Word ids, directly addressable codes, packing, piece ids."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from feedpulse.llm.packing import BestFit, default_tokenizer, op10_best_fit_packing, pack, pack_documents
from feedpulse.llm.piece_ids import PieceTable, default_model, encode_pieces, op5_piece_ids
from feedpulse.llm.token_codes import (
    Segment,
    encode_levels,
    op4_token_codes,
    read_documents,
    segment,
    tokens_at,
    write_tokens,
)
from feedpulse.llm.word_ids import WordIds

ODD = (
    "a B É é ß ẞ İ Σ ς 's ' ’ 1 ２ !! # . $$$ 日本 K Å ﬁ <|endoftext|> <| _ × ª µ ÿ 🙂 \x00 the ing 'LL "
    "́ ​ <s> <0x0A> ▁ ▁▁"
).split(" ") + [" ", "  ", "\n", "\t", "\xa0", "\x1c", "\x85", "    "]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(n)]


@pytest.fixture(scope="module")
def words():
    return WordIds(default_tokenizer())


@pytest.fixture(scope="module")
def pieces():
    return PieceTable(default_model())


def library_ids(words, text):
    return words.library.encode(text or "", add_special_tokens=False).ids


def test_word_ids_equal_the_library(words, texts):
    for some in (odd_texts(4000), list(texts.values())):
        for text, raw in zip(some, words.encode(some)):
            assert np.frombuffer(raw, "<u4").tolist() == library_ids(words, text), repr(text)


def test_word_ids_when_memory_is_short(texts):
    own, some = WordIds(default_tokenizer(), limit=5), list(texts.values())[:20]
    assert [own.encode([t])[0] for t in some] == WordIds(default_tokenizer()).encode(some)


def test_piece_ids_equal_the_library(pieces, texts):
    for text in odd_texts(6000, 2) + list(texts.values()) + [" " * 300, "x" * 5000, "▁" * 40 + "a"]:
        assert pieces.encode(text).tolist() == pieces.library.encode(text), repr(text[:80])


UNSPACED = {
    "chinese": "学而时习之不亦说乎有朋自远方来",
    "thai": "ภาษาไทยเป็นภาษาที่ไม่เว้นวรรค",
    "emoji": "😀🎉🚀👩‍👩‍👧🇩🇪",
    "signs": "a%",
    "letters": "straße",
}


@pytest.mark.parametrize("kind", UNSPACED)
def test_long_texts_without_spaces(pieces, words, kind):
    text = (UNSPACED[kind] * 20_000)[:20_000]
    assert pieces.encode(text).tolist() == pieces.library.encode(text)
    assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == library_ids(words, text)


def test_unspaced_texts_are_not_kept():
    """Only short words are remembered, so a worker's memory is bounded."""
    pieces, words = PieceTable(default_model()), WordIds(default_tokenizer())
    rng = np.random.default_rng(11)
    for _ in range(300):
        text = "".join(map(chr, rng.integers(0x4E00, 0x9000, 300))) + " and some"
        assert pieces.encode(text).tolist() == pieces.library.encode(text)
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == library_ids(words, text)
    assert len(words.words) == 2 and max(map(len, pieces.words)) <= 32


def test_piece_ids_when_memory_is_short(texts):
    own = PieceTable(default_model(), limit=5)
    for text in list(texts.values())[:20]:
        assert own.encode(text).tolist() == own.library.encode(text)


def test_op5(spark, small, texts, pieces):
    rows = op5_piece_ids(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = pieces.library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest()


def test_piece_ids_edges(make):
    rows = [(1, None), (2, ""), (None, "a"), (3, "a"), (3, "a"), (4, "b " * 30_000)]
    out = encode_pieces(make(rows), default_model()).collect()
    assert len(out) == len(rows)
    assert all(r.ids == [] and r.decoded == "" for r in out if r.doc_id in (1, 2))
    assert encode_pieces(make([], name="none"), default_model()).count() == 0


def test_levels():
    rng = np.random.default_rng(5)
    for ids in ([], [0], [255, 256, 65535, 65536, 2**32 - 1], rng.integers(0, 50_000, 3000), [7] * 600):
        ids = np.array(ids, "<u4")
        own = Segment(segment([1], [ids.tobytes()]))
        assert (own.all() == ids).all() and len(own) == len(ids)
        assert [own[i] for i in range(len(ids))] == ids.tolist()
        with pytest.raises(IndexError):
            own[len(ids)]
    assert len(encode_levels(np.zeros(100, "<u4"))) == 116


def test_op4(spark, small, texts, words):
    at = 0
    for r in sorted(op4_token_codes(spark, small).collect(), key=lambda r: r.doc_id):
        ids = np.array([*library_ids(words, texts[r.doc_id]), 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_files_and_random_access(spark, make, tmp_path, words):
    rows = [(9, "nine"), (1, None), (None, "no id"), (5, "five " * 700), (5, "other"), (2, ""), (2, "")]
    path = f"file://{tmp_path}/codes"
    write_tokens(make(rows), path, default_tokenizer(), segment_tokens=300)
    out = sorted(read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == [None, 1, 2, 2, 5, 5, 9]
    assert [r.start for r in out] == [sum(x.n_tokens for x in out[:k]) for k in range(len(out))]
    total = sum(r.n_tokens for r in out)
    asked = spark.createDataFrame([(p,) for p in (*range(total), 0, total, -1)], "position long")
    got = {r.position: r.id for r in tokens_at(spark, path, asked).collect()}
    assert sorted(got) == list(range(total))
    for r in out:
        ids = np.array([got[p] for p in range(r.start, r.start + r.n_tokens)], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and ids[-1] == 2


def test_no_files_of_an_empty_table(spark, make, tmp_path):
    write_tokens(make([]), f"file://{tmp_path}/codes", default_tokenizer())
    assert read_documents(spark, f"file://{tmp_path}/codes").count() == 0


def test_best_fit_takes_the_tightest_space_and_closes_the_fullest():
    packer = BestFit(10, 2)
    assert packer.place(6) == (0, 0)
    assert packer.place(7) == (1, 0)
    assert packer.place(3) == (1, 7)  # fits both, exactly here
    assert packer.place(8) == (2, 0)
    assert packer.place(9) == (3, 0)  # sequence 2, with two places left, closes
    assert packer.place(2) == (0, 6)
    assert packer.place(1) == (3, 9)
    assert packer.place(10) == (4, 0)
    with pytest.raises(ValueError):
        packer.place(11)
    with pytest.raises(ValueError):
        packer.place(0)


def test_best_fit_against_a_scan_of_all_open_sequences():
    rng = random.Random(9)
    for most_open in (1, 3, 20):
        packer, free, made = BestFit(100, most_open), {}, 0
        for _ in range(2000):
            length = rng.choice((rng.randint(1, 100), rng.randint(1, 20)))
            sequence, offset = packer.place(length)
            fits = [f for f in free.values() if f >= length]
            if fits:
                assert free[sequence] == min(fits)
            else:
                assert sequence == made and offset == 0
                made += 1
                if len(free) == most_open:
                    # The fullest goes; which of equally full ones does not matter.
                    gone = {s for s in free if s not in {x for b in packer.bins for x in b}}
                    assert len(gone) == 1 and free.pop(gone.pop()) <= min(free.values(), default=100)
                free[sequence] = 100
            assert offset == 100 - free[sequence]
            free[sequence] -= length
            if not free[sequence]:
                del free[sequence]
        assert made == packer.made


def check_packing(rows, docs, words, size=4096):
    sequences, own = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        own.setdefault(r.doc_id, []).append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    total = 0
    for doc, text in docs.items():
        ids = np.array([*library_ids(words, text), 1], "<u4")
        total += len(ids)
        cut = [ids[k : k + size] for k in range(0, len(ids), size)]
        got = sorted(own[doc], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in got] == [
            (k, k * size, len(x), zlib.crc32(x.tobytes())) for k, x in enumerate(cut)
        ]
    return len(sequences), -(-total // size)


def test_op10(spark, small, texts, words):
    made, least = check_packing(op10_best_fit_packing(spark, small).collect(), texts, words)
    assert made <= least + 1


def test_packing_edges(spark, make, words):
    rows = [(1, None), (2, ""), (3, "w " * 20_000), (4, "w " * 4095), (5, "w " * 4096)]
    out = pack_documents(make(rows), default_tokenizer()).collect()
    check_packing(out, dict(rows), words)
    repeated = pack_documents(make([(None, "a")] * 3 + [(6, "b")] * 2, name="rep"), default_tokenizer())
    assert len({(r.sequence_id, r.offset) for r in repeated.collect()}) == 5
    assert pack_documents(make([], name="none"), default_tokenizer()).count() == 0


def test_groups_and_few_open_sequences(spark):
    rng = random.Random(2)
    rows = [(n, 0, 0, rng.randint(1, 4096), n) for n in range(3000)]
    pieces = spark.createDataFrame(
        rows, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )
    for options in ({"group_tokens": 1 << 20}, {"most_open": 50}, {}):
        out = pack(pieces, **options).collect()
        assert len(out) == 3000
        fill = {}
        for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == fill.get(r.sequence_id, 0)
            fill[r.sequence_id] = r.offset + r.length
        assert max(fill.values()) <= 4096
        assert out == pack(pieces, **options).collect()


def test_equal_pieces_are_dealt_to_many_groups(make):
    rows = [(None, 0, 0, 10, 7)] * 3000
    pieces = make(rows, "doc_id long, piece int, start long, length long, ids_crc32 long", "pieces")
    out = pack(pieces, size=64, group_tokens=3000).collect()
    assert len(out) == 3000 and len({(r.sequence_id, r.offset) for r in out}) == 3000
    groups = Counter(r.sequence_id >> 32 for r in out)
    assert len(groups) == 10 and max(groups.values()) < 600

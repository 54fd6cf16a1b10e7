import gzip
import hashlib
import random

import pytest

from feedpulse.llm.warc import (
    Gap,
    Record,
    member,
    page_record,
    read_archives,
    salvage,
    write_pages,
)

PAGES = "page_id long, url string, html string, name string, payload string"


def archive(n=12, packed=True):
    parts = [page_record(k, f"http://h/{k}", f"<p>{k} é</p>".encode() * 50, None) for k in range(n)]
    return [member(p) if packed else p for p in parts]


def pages_of(data):
    return [own.headers["warc-record-id"] for _, _, own in salvage(data) if isinstance(own, Record)]


def gaps_of(data):
    return [(a, b) for a, b, own in salvage(data) if isinstance(own, Gap)]


def whole(data):
    """Records and gaps cover every byte in order."""
    at = 0
    for a, b, own in salvage(data):
        if a != at and not isinstance(own, Record):
            raise AssertionError((a, at))
        at = b
    return at == len(data)


@pytest.mark.parametrize("packed", [True, False])
def test_sound_archives(packed):
    parts = archive(packed=packed)
    assert len(pages_of(b"".join(parts))) == 12 and gaps_of(b"".join(parts)) == []
    assert list(salvage(b"")) == []


@pytest.mark.parametrize("packed", [True, False])
def test_damage_costs_only_what_it_hits(packed):
    rng = random.Random(1)
    for hit in range(12):
        parts = archive(packed=packed)
        broken = bytearray(parts[hit])
        for _ in range(3):
            broken[rng.randrange(len(broken) - 4)] ^= 0x55
        start = sum(map(len, parts[:hit]))
        parts[hit] = bytes(broken)
        data = b"".join(parts)
        assert pages_of(data) == [f"<urn:page:{k}>" for k in range(12) if k != hit]
        assert gaps_of(data) == [(start, start + len(broken))]
        assert whole(data)


@pytest.mark.parametrize("packed", [True, False])
def test_cut_filled_and_doubled(packed):
    parts = archive(packed=packed)
    cut = b"".join(parts)[:-20]
    assert len(pages_of(cut)) == 11 and gaps_of(cut) == [(sum(map(len, parts[:11])), len(cut))]
    noise = b"\x00\x1f\x8b\x08\x1f\x8b\x08WARC/1.1\r\nWARC/1.0 no record\r\n\r\n" * 9
    filled = noise + parts[0] + noise + b"".join(parts[1:]) + noise
    assert len(pages_of(filled)) == 12
    assert gaps_of(filled) == [
        (0, len(noise)),
        (len(noise) + len(parts[0]), 2 * len(noise) + len(parts[0])),
        (len(filled) - len(noise), len(filled)),
    ]
    assert pages_of(parts[3][:30] + parts[3]) == ["<urn:page:3>"]
    only = b"no archive at all"
    assert gaps_of(only) == [(0, len(only))]


def test_kinds_may_mix_and_a_member_may_hold_more():
    plain, packed = archive(packed=False), archive()
    both = plain[0] + packed[1] + gzip.compress(plain[2] + plain[3]) + plain[4]
    assert pages_of(both) == [f"<urn:page:{k}>" for k in range(5)]


def test_a_damaged_member_of_several_records_keeps_the_sound_ones():
    plain, packed = archive(packed=False), archive()
    spoilt = [*plain[:3], plain[3].replace(b"<p>3", b"<p>X"), *plain[4:6]]
    ids = [f"<urn:page:{k}>" for k in range(12)]

    one = gzip.compress(b"".join(spoilt))
    assert pages_of(one) == [*ids[:3], *ids[4:6]] and gaps_of(one) == [(0, len(one))]
    assert pages_of(one + packed[6]) == [*ids[:3], *ids[4:7]] and whole(one + packed[6])
    first = gzip.compress(b"X" + b"".join(plain[:4]))
    assert pages_of(packed[5] + first) == [ids[5], *ids[:4]]

    rng = random.Random(3)
    noisy = [page_record(k, "u", rng.randbytes(40_000), None) for k in range(8)]
    several = gzip.compress(b"".join(noisy))
    for damaged in (several[: len(several) * 7 // 10], several[:-8] + b"\0" * 8):
        n = 5 if len(damaged) < len(several) else 8
        for data in (damaged, damaged + packed[9]):
            assert pages_of(data)[:n] == ids[:n] and gaps_of(data) == [(0, len(damaged))]
            assert pages_of(data)[n:] == ids[9:10] * (len(data) > len(damaged)) and whole(data)
    # Without a digest nothing vouches for a record whose member fails its check sum.
    bare = gzip.compress(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n" * 3)
    assert sum(isinstance(own, Record) for _, _, own in salvage(bare)) == 3
    assert [type(own) for _, _, own in salvage(bare[:-8] + b"\0" * 8)] == [Gap]


def test_round_trip(spark, make, tmp_path):
    big, folder = "é" * 600, f"file://{tmp_path}/warc"
    rows = [
        (1, "http://a", big),
        (4, "http://b c\r\nX: y", big),
        (3, None, big),
        (None, "http://n", big),
        (5, "u", "x" * 999),
        (6, "u", "x" * 999),
        (7, "u", None),
        (8, "u", ""),
        (9, "u", "WARC/1.1\r\n\r\n" * 100),
        (10, "u", "z" * 300_000),
        (11, "u", "z" * 300_000),
        (11, "u", "z" * 300_000),
    ]
    manifest = write_pages(make(rows, PAGES, "pages"), folder, archive_bytes=2000)
    out = read_archives(manifest, folder, payloads=True).collect()
    assert len(out) == len(rows) and all(r.gap is None for r in out)
    assert manifest.selectExpr("sum(records)").first()[0] == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.page_id, []).append(r)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        for r in by[page_id]:
            assert r.payload_bytes == len(raw)
            assert r.payload_digest == hashlib.sha1(raw).hexdigest()
            assert r.record_type == "revisit" or r.payload == raw
    kinds = {k: sorted((r.record_type, r.refers_to) for r in v) for k, v in by.items()}
    assert kinds[4] == [("response", None)] and kinds[5] == kinds[6] == [("response", None)]
    assert kinds[1] == kinds[3] == kinds[None] == [("revisit", 4)]
    assert kinds[10] == [("revisit", 11)] and kinds[11] == [("response", None), ("revisit", 11)]


def test_broken_archives_of_a_folder(spark, make, tmp_path):
    folder = f"file://{tmp_path}/warc"
    rows = [(k, f"http://h/{k}", f"<p>{k}</p>" * 20) for k in range(40)]
    manifest = write_pages(make(rows, PAGES, "pages"), folder)
    names = [r.name for r in manifest.collect()]
    path = tmp_path / "warc" / names[0]
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 0xFF
    path.write_bytes(bytes(data))
    out = read_archives(manifest, folder).collect()
    gaps = [r for r in out if r.gap]
    assert len(gaps) == 1 and gaps[0].start <= len(data) // 2 < gaps[0].stop
    assert len(out) == 40 and gaps[0].page_id is None


def test_empty_table(spark, make, tmp_path):
    folder = f"file://{tmp_path}/warc"
    assert read_archives(write_pages(make([], PAGES, "pages"), folder), folder).count() == 0

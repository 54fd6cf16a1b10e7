import random

import brute

from feedpulse.llm.near_dedup import dedup_near, keep_first_of_near, op7_near_dedup, shingles


def found(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in dedup_near(docs).collect()}


def test_words_and_sets():
    for text in ("", " \n", "a b", "A b C d e", "a b c d e f", "é É x y z w", "a\xa0b c d e f g"):
        assert len(shingles(text)) == len(brute.shingle_set(text))
    assert (shingles("A b C d e f") == shingles(" a\tB c\x0b\x0cD e\r\nf ")).all()
    assert (shingles("É b c d e f") != shingles("é b c d e f")).any()


def test_against_brute_force(spark, small, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op7_near_dedup(spark, small).collect()}
    assert got == brute.near_duplicates(list(texts.items()))


def test_planted_copies_and_chains(make):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(200)]
        for _ in range(8):
            # Changed here and there, and each from the one before: chains whose ends differ.
            for k in rng.sample(range(200), rng.choice([1, 2, 5])):
                base[k] = word()
            rows.append((n, " ".join(base)))
            n += 1
    # A passage that many share, in texts that differ otherwise.
    passage = " ".join(word() for _ in range(40))
    for _ in range(30):
        rows.append((n, passage + " " + " ".join(word() for _ in range(60))))
        n += 1
    assert found(make(rows)) == brute.near_duplicates(rows)


def test_large_group_of_near_copies(make):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for n in range(400):
        own = list(base)
        own[rng.randrange(120)] = f"x{rng.randrange(60)}"
        own[rng.randrange(120)] = f"y{rng.randrange(60)}"
        rows.append((n, " ".join(own)))
    assert found(make(rows)) == brute.near_duplicates(rows)


def test_edge_rows(make):
    long = " ".join(f"v{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " "), (4, "a b"), (5, "A  B"), (6, long), (7, long + " w"), (None, "a b")]
    rows += [(8, "one two three four five six")] * 2 + [(None, "p q r s t")] * 2
    out = dedup_near(make(rows)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[k].component_id for k in (1, 2, 3)] == [1, 2, 3] and by[1].n_shingles == 0
    assert by[5].component_id == 4 and by[7].component_id == 6 and by[7].n_shingles == 59_997
    no_id = sorted(r.component_id or 0 for r in out if r.doc_id is None)
    assert no_id == [0, 0, 4]
    assert sum(r.first for r in out) == 7
    assert dedup_near(make([], name="none")).count() == 0


def test_stage(spark, make):
    rows = [(2, "one two three four five six")] * 2 + [(1, "One two three four five six"), (3, None), (4, None)]
    docs = make(rows)
    kept = keep_first_of_near(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]

"""Deduplication against plain versions: random small alphabets, hot groups and edge rows."""

import random

import numpy as np
import pytest
from brute import components, cosine_links, earlier_bytes, fingerprint, repeated_words
from pyspark.sql import functions as F

from ledgerlens.llm import anchors, embedding_dedup, simhash, substring_dedup, suffix_array
from ledgerlens.llm.components import connected_components


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("key", "low", "component", "id", "node", "anchor")})


def texts(seed, alphabet, join, longest=120):
    rng = random.Random(seed)
    rows = [(i, join.join(rng.choices(alphabet, k=rng.randint(0, longest)))) for i in range(50)]
    shared = join.join(rng.choices("xyzw", k=40))
    rows += [(100 + i, join.join([rng.choice(alphabet), shared, rng.choice(alphabet)]))
             for i in range(60)]  # one passage in many contexts
    return rows + [(200, None), (201, ""), (202, join.join("a" * 300)), (203, join.join("ab" * 90)),
                   (None, join.join("xyxyxyab" * 9))]


def test_suffix_array_of_random_sequences():
    rng = random.Random(1)
    for _ in range(500):
        x = [rng.randint(0, rng.choice([1, 2, 6])) for _ in range(rng.randint(0, 40))]
        assert suffix_array.suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


@pytest.mark.parametrize("seed, alphabet", [(1, "ab"), (2, "abcé")])
def test_earlier_strings(spark, monkeypatch, seed, alphabet):
    monkeypatch.setattr(anchors, "HOT", 3)
    monkeypatch.setattr(anchors, "PIECE", 64)  # long texts in many pieces
    rows = texts(seed, alphabet, "")
    got = {r.id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in
           suffix_array.remove_earlier_strings(frame(spark, rows), window=12, k=5).collect()}
    assert got == earlier_bytes(rows, 12)


@pytest.mark.parametrize("seed, alphabet", [(3, "ab"), (4, "abcd")])
def test_repeated_passages(spark, monkeypatch, seed, alphabet):
    monkeypatch.setattr(anchors, "HOT", 3)
    monkeypatch.setattr(anchors, "PIECE", 64)
    rows = texts(seed, alphabet, " ")
    got = {r.id: (r.n_words, r.n_removed, r.kept) for r in
           substring_dedup.remove_repeats(frame(spark, rows), window=8, anchor=3).collect()}
    assert got == repeated_words(rows, 8)


def test_repeated_rows_are_one_document(spark):
    text = "one two three four five six seven eight nine ten"
    twice = frame(spark, [(1, text), (1, text)])
    assert [r.n_removed for r in substring_dedup.remove_repeats(twice, window=5, anchor=2).collect()
            ] == [0, 0]
    assert [r.n_removed for r in suffix_array.remove_earlier_strings(twice, window=12, k=5).collect()
            ] == [0, 0]
    copies = frame(spark, [(1, text), (2, text), (2, text)])
    assert sorted((r.id, r.n_removed) for r in suffix_array.remove_earlier_strings(
        copies, window=12, k=5).collect()) == [(1, 0), (2, len(text)), (2, len(text))]


def test_repeated_rows_beside_documents_that_share_a_part(spark):
    rows = texts(5, "ab", "")
    got = [(r.id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in
           suffix_array.remove_earlier_strings(frame(spark, rows + rows), window=12, k=5).collect()]
    want = [(d, *found) for d, found in earlier_bytes(rows, 12).items()]
    assert sorted(got, key=str) == sorted(want + want, key=str)
    rows = texts(6, "abcd", " ")
    got = [(r.id, r.n_words, r.n_removed, r.kept) for r in
           substring_dedup.remove_repeats(frame(spark, rows + rows), window=8, anchor=3).collect()]
    want = [(d, *found) for d, found in repeated_words(rows, 8).items()]
    assert sorted(got, key=str) == sorted(want + want, key=str)


def test_empty_tables(spark):
    empty = frame(spark, [(1, "a")]).limit(0)
    assert suffix_array.remove_earlier_strings(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert simhash.near_duplicate_groups(empty).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicate_vectors(vectors).count() == 0


def test_real_documents(spark):
    folder = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    got = {r.id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept))
           for r in suffix_array.remove_earlier_strings(df).collect()}
    assert got == earlier_bytes(rows, 100)
    got = {r.id: (r.n_words, r.n_removed, r.kept)
           for r in substring_dedup.remove_repeats(df).collect()}
    assert got == repeated_words(rows, 35)


def test_simhash_groups(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 12)))) for i in range(150)]
    rows += [(300, None), (301, "  "), (302, "A B c D"), (303, "a b C d"), (304, "long " * 20_000)]
    got = simhash.near_duplicate_groups(frame(spark, rows)).collect()
    prints = {d: fingerprint(t) for d, t in rows}
    assert {r.id: r.fingerprint % (1 << 64) for r in got} == prints
    want = components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert {r.id: r.component for r in got} == want
    kept = simhash.keep_one_of_each_group(frame(spark, rows + [(None, "A B c D")]))
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(
        set(want.values()))
    assert kept.where("doc_id is null").count() == 1


def test_simhash_tiles(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40)
    values = {int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in
              rng.integers(0, 62, (6, 2))}
    df = spark.createDataFrame([(v,) for v in sorted(values)], "fingerprint long")
    edges = simhash.links(df, 4, tile=4)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    want = components({v: v for v in values}, lambda a, b: (a ^ b).bit_count() <= 4)
    assert {v: got.get(v, v) for v in values} == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [
        (7, 7), (3, 2), (2, 3), (300, 200), (None, 4)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200,
                   300: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def vectors(seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows = [(centres[i % 12] + rng.normal(size=16) * 0.12).tolist() for i in range(240)]
    rows += [(centres[0] + rng.normal(size=16) * 0.05).tolist() for _ in range(120)]
    return rows + [None, [], [0.0] * 16, [1.0] * 15, [1.0] * 15, [None] + [1.0] * 15,
                   [float("nan")] * 16, *[rows[0]] * 5]


def test_vectors_with_small_leaves(spark):
    rows = vectors(3)
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in embedding_dedup.near_duplicate_vectors(
        df, leaf=40).collect()}
    bad = {i for i, x in enumerate(rows) if not x or None in x or not np.isfinite(x).all()
           or not any(x)}
    want = cosine_links({i: None if i in bad else np.array(x) for i, x in enumerate(rows)}, 0.95)
    assert all(got[i][0] <= want[i][0] for i in want)  # no link below the threshold
    assert sum(g for g, _ in got.values()) >= 0.95 * sum(w for w, _ in want.values())
    assert all(got[i] == (0, i) for i in bad)


def test_vectors_in_one_leaf_are_exact(spark):
    rows = vectors(4)[::3]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in
           embedding_dedup.near_duplicate_vectors(df).collect()}
    good = {i: np.array(x) if x and None not in x and np.isfinite(x).all() and any(x) else None
            for i, x in enumerate(rows)}
    assert got == cosine_links(good, 0.95)


@pytest.mark.parametrize("size, chunk_bytes", [(6000, 500_000), (16_384, 8_000_000)])
def test_links_on_both_sides_of_the_threshold(spark, monkeypatch, size, chunk_bytes):
    monkeypatch.setattr(embedding_dedup, "CHUNK_BYTES", chunk_bytes)
    rng = np.random.default_rng(6)
    x = rng.normal(size=64) + rng.normal(size=(size, 64)) * 0.229  # cosines lie around 0.95
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = np.concatenate([(unit[at:at + 1024] @ unit.T >= 0.95).sum(axis=1) - 1
                            for at in range(0, size, 1024)])
    assert 0.2 < links.mean() / size < 0.8
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = {r.id: r.n_links for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    assert [got[i] for i in range(size)] == links.tolist()


def test_links_over_many_splits(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 300)  # later rounds split on
    rng = np.random.default_rng(8)
    x = np.repeat(rng.normal(size=(40, 16)), 60, axis=0) + rng.normal(size=(2400, 16)) * 0.15
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = {r.id: r.n_links for r in embedding_dedup.near_duplicate_vectors(df, leaf=60).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert [got[i] for i in range(2400)] == ((unit @ unit.T >= 0.95).sum(axis=1) - 1).tolist()


def test_long_words_that_sums_of_powers_take_for_equal(spark):
    bits = "0"
    while len(bits) < 4096:
        bits += "".join("10"[int(b)] for b in bits)
    one, other = bits.translate({48: "a", 49: "b"}), bits.translate({48: "b", 49: "a"})
    words = [f"w{i}" for i in range(34)]
    df = spark.createDataFrame([(1, " ".join([*words, one])), (2, " ".join([*words, other])),
                                (3, " ".join([*words, one]))], "doc_id long, text string")
    got = {r.id: r.n_removed for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {1: 35, 2: 0, 3: 35}

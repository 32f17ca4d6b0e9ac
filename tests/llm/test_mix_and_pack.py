"""Mixing, packing and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import best_fit, fingerprint, secrets, words
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import mixing, packing

WEIGHTS = (5, 2, 1)


def targets(sizes, volume=1.5, most=2.0):
    """Share by weight, cut off what is above the limit, share that again, until none is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, out = volume * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def corpus(spark, n=2000, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["b", "a", None, "ä", "c", "a", "a"]), "w " * int(rng.expovariate(0.02)))
            for i in range(n)]
    rows += [(n, "a", None), (n + 1, "only empty", ""), (5, "a", "same row"), (5, "a", "same row"),
             (None, "b", "no id"), (None, None, "nothing known")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn(
        "copies", F.lit(7))


def test_mix_meets_targets(spark):
    df = corpus(spark)
    rows = mixing.copies(df, block=100, fan=4).collect()
    assert len(rows) == df.count()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        assert 0 <= r.copies <= 2
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    largest = {s: max(r.size for r in rows if r.source == s) for s in sizes}
    for s in sizes:  # all but one document of a source are rounded at the expense of others
        assert abs(taken[s] - want[s]) <= largest[s], s
    again = mixing.copies(df.repartition(5), block=100, fan=4).collect()
    assert Counter(rows) == Counter(again)


def test_mix_expectation_holds():
    rng, total = np.random.default_rng(1), np.zeros(5)
    p, size = [0.3, 0.6, 0.5, 0.9, 0.2], [5, 9, 2, 30, 1]
    for _ in range(4000):
        taken, place, held = mixing.pivot(p, size, rng)
        total += taken
        if place >= 0:
            total[place] += held
    assert np.abs(total / 4000 - p).max() < 0.03


def test_mixed_rows(spark):
    df = corpus(spark, 300)
    want = Counter()
    for r in mixing.copies(df).collect():
        want[(r.id, r.source)] += r.copies
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    got = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert got == Counter({k: n for k, n in want.items() if n})
    assert mixing.mix(df.limit(0)).count() == 0


def test_equal_rows_meet_the_target(spark):
    rows = [(7, "a", "some equal words here")] * 1000
    rows += [(100 + i, "a", "w " * (i + 1)) for i in range(10)]
    rows += [(200 + i, "b", "w " * 40) for i in range(300)] + [(9, "b", None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)
    got = mixing.copies(df, block=50, fan=4).collect()
    assert len(got) == len(rows)
    for name, longest in (("a", 10), ("b", 40)):
        own = [r for r in got if r.source == name]
        taken = sum(r.size * r.copies for r in own)
        assert abs(taken - own[0].target) <= longest
    assert len({r.copies for r in got if r.id == 7}) <= 2
    assert {r.copies for r in got if r.id == 9} == {0}
    wanted = {r.id: (r.id, r.size * r.copies) for r in got if r.id != 7}
    again = mixing.copies(df.repartition(3), block=50, fan=4).collect()
    assert wanted == {r.id: (r.id, r.size * r.copies) for r in again if r.id != 7}
    mixed = mixing.mix(df).groupBy("doc_id").count().collect()
    whole = mixing.copies(df).groupBy("id").agg(F.sum("copies")).where("sum(copies) > 0").collect()
    assert sorted(map(tuple, mixed)) == sorted(map(tuple, whole))


def test_mixed_rows_keep_columns_of_any_name(spark):
    names = ("__key", "__mix_row", "__MIX", "___mix_key", "__copies", "row", "size", "part")
    df = corpus(spark, 60).withColumns({c: F.concat(F.lit(c), "doc_id") for c in names})
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert set(mixed.collect()) <= set(df.collect())


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for trial in range(300):
        capacity = rng.choice([8, 20, 64])
        lengths = [rng.randint(1, capacity) if trial % 2 else min(
            capacity, int(rng.expovariate(4 / capacity)) + 1) for _ in range(rng.randint(0, 70))]
        counts = Counter(lengths)
        steps = packing.plan(counts, capacity)
        used = defaultdict(list)
        for length, n in counts.items():
            own = [s for s in steps.tolist() if s[0] == length]
            for k in range(n):
                _, first, at, per, offset = max(s for s in own if s[1] <= k)
                used[at + (k - first) // per].append((offset + (k - first) % per * length, length))
        for spots in used.values():
            end = 0
            for offset, length in sorted(spots):
                assert offset == end
                end += length
        assert sorted(capacity - sum(n for _, n in x) for x in used.values()) == best_fit(
            lengths, capacity)


TEXTS = ["a <|endoftext|> b", "x<|startoftext|>y É́e ̈a", "don't  we'll\x1c\x85b ΑΣ ΣΑΣ́ İ, A's. O'S!",
         "日本語 한국어 ᄒ", "\x00 \x0b\x0c", "<|ENDOFTEXT|> a<|endoftext|>, 12.5 1,000. ﬁ, ǅ ſ ₂a", "",
         "word, " * 3000, "x" * 50_000]


def test_many_texts_cost_few_calls_of_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    coder = packing.WordIds(packing.default_tokenizer())
    asked = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            asked.append(len(texts))
            return plain.encode_batch_fast(texts, **options)

    coder.tokenizer = Counting()
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcXYZé.,'1<ß", k=rng.randint(1, 90 if i % 9 else 9)))
                      for _ in range(rng.randint(0, 12))) for i in range(400)] + TEXTS
    for part in (texts, texts[::-1], ["", " \t\n"], []):
        got = [np.frombuffer(x, "<u4").tolist() for x in coder(pa.array(
            [t.encode() for t in part], pa.binary()))]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in part]
    assert len(asked) <= 16 and max(map(len, coder.known.to_pylist())) <= packing.MEMORABLE


def test_remembered_words_are_forgotten_and_texts_split_and_put_together_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    monkeypatch.setattr(packing, "SPLIT", 40)
    monkeypatch.setattr(packing, "GATHERED", 3)
    coder = packing.WordIds(packing.default_tokenizer())
    texts = pa.array([t.encode() for t in TEXTS * 2], pa.binary())
    runs = list(packing.runs(texts))
    assert len(runs) > 4 and pa.concat_arrays(runs).equals(texts) and not list(packing.runs(texts[:0]))
    got = [x for run in runs for x in coder(run)]
    whole = packing.WordIds(packing.default_tokenizer())
    assert got == list(whole(texts)) and got[0] and got[:len(TEXTS)] == got[len(TEXTS):]


def test_pieces_round_trip(spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.default_tokenizer())
    rows = [*enumerate(TEXTS), (100, None), (3, TEXTS[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit(1))
    got = packing.pack(packing.pieces(df, ids=True)).collect()
    bins, documents = defaultdict(list), defaultdict(dict)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
        documents[r.id][r.piece] = r
        assert r.crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
    for spots in bins.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    for d, text in dict(rows).items():
        cut = [documents[d][k] for k in sorted(documents[d])]
        assert [p.start for p in cut] == [2048 * k for k in range(len(cut))]
        ids = [i for p in cut for i in p.ids]
        assert ids == coder.encode(text or "", add_special_tokens=False).ids + [0]
    assert packing.pack(packing.pieces(df.limit(0))).count() == 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, folder).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
        if name == "SimHash near-dedup":
            prints = [fingerprint(r.text) for r in docs.collect()]
            assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
        if name == "secret scans":
            assert docs.count() == before.count()
            assert not [s for r in docs.collect() for s in secrets(r.text)]
        if name.startswith("mixing"):
            assert set(docs.distinct().collect()) <= set(before.collect())
            total = sum(len(words(r.text)) for r in before.collect())
            assert sum(len(words(r.text)) for r in docs.collect()) == pytest.approx(
                1.5 * total, rel=0.1)
    pieces = docs.collect()
    assert sum(r.piece == 0 for r in pieces) == before.count()
    assert max(r.offset + r.length for r in pieces) <= 2048

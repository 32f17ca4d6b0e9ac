"""Token counts, alignment and spelling groups against plain versions and edge rows."""

import random

import pytest
from brute import aligned, spelling_forms, spelling_words
from pyspark.sql import functions as F

from ledgerlens.llm import alignment, queries, spelling, token_counts, tokenizing

JSON, MODEL = (tokenizing.vocabulary(n) for n in (alignment.TOKENIZER_A, alignment.TOKENIZER_B))
LONG = "Wörter and words, 12 345! " * 4_000
EDGES = [(1, None), (2, ""), (3, " "), (4, "\n\n  \t"), (5, "plain text"), (5, "plain text"),
         (6, "<|endoftext|> and <s> or </s> <0x41>"), (7, "▁ under ▁▁ scores"), (None, "no id"),
         (None, None), (8, "naïve 😀 ﬁ ½ Ａ   é"), (9, LONG), (10, "x" * 5_000),
         (11, "a\u0000b\r\n"), (12, " leading and trailing ")]


def documents(spark, rows):
    """Documents with extra columns whose names an operator might use itself."""
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("kept") for c in ("key", "content", "word", "pair", "id", "n", "node")})


def order(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("path", [JSON, MODEL])
def test_token_counts(spark, tmp_path, path):
    _, encode = tokenizing.encoder(path)
    want = [(d, len((t or "").encode()), len(encode([t or ""])[0])) for d, t in EDGES]
    df, cache = documents(spark, EDGES), str(tmp_path / "cache")
    for _ in range(2):
        got = token_counts.count_tokens(df, tokenizer=path, cache=cache)
        assert order(map(tuple, got.collect())) == order(want)


def test_only_new_contents_are_encoded_and_appended(spark, tmp_path, monkeypatch):
    cache, encoded = str(tmp_path / "cache"), []
    encode = token_counts.encode

    def noted(texts, path):
        encoded.append(sorted(r.text for r in texts.collect()))
        return encode(texts, path)

    monkeypatch.setattr(token_counts, "encode", noted)
    first = documents(spark, [(1, "one"), (2, "two"), (3, "one"), (4, None)])
    grown = first.union(documents(spark, [(5, "three"), (6, "two"), (7, "")]))
    for limit in ("10MB", "-1"):  # few missing digests go to the texts, or all are shuffled
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            del encoded[:]
            here = f"{cache}{limit}"
            for df in (first, first, grown):
                assert token_counts.count_tokens(df, cache=here).count() == df.count()
            assert encoded == [["", "one", "two"], ["three"]]
            rows = spark.read.parquet(here)
            assert rows.count() == rows.select("tokenizer", "content").distinct().count() == 4
            token_counts.count_tokens(first, tokenizer=MODEL, cache=here)
            assert encoded[2:] == [["", "one", "two"]]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_pair_that_two_runs_append_counts_once(spark, tmp_path):
    df, cache = documents(spark, [(1, "one two"), (2, "one two")]), str(tmp_path / "cache")
    want = order(token_counts.count_tokens(df, cache=cache).collect())
    rows = spark.read.parquet(cache).collect()
    spark.createDataFrame(rows, "content binary, n_tokens long, tokenizer string").write.mode(
        "append").partitionBy("tokenizer").parquet(cache)
    assert order(token_counts.count_tokens(df, cache=cache).collect()) == want


def test_token_count_query(spark, sf):
    got = queries.op11_token_counts(spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    _, encode = tokenizing.encoder(JSON)
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = [(r.doc_id, len(r.text.encode()), n, n > 1024)
            for r, n in zip(docs, map(len, encode([r.text for r in docs])))]
    assert order(map(tuple, got.collect())) == order(want)


def plain_alignment(rows):
    _, a = tokenizing.encoder(JSON, plain=True)
    _, b = tokenizing.encoder(MODEL)
    return [(d, *f) for (d, _), f in zip(rows, aligned(
        [t for _, t in rows], alignment.bytes_of_a(JSON), alignment.bytes_of_b(MODEL),
        lambda t: a([t])[0], lambda t: b([t])[0]))]


@pytest.mark.parametrize("work, block", [(alignment.WORK, alignment.BLOCK), (5, 200), (1, 70)])
def test_alignment(spark, monkeypatch, work, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rows = EDGES if work > 5 else [(d, t if t is None else t[:300]) for d, t in EDGES]
    rng = random.Random(work)
    rows = rows + [(100 + i, "".join(rng.choices("ab é😀.\n<>1▁", k=rng.randint(1, 60))))
                   for i in range(60)]
    got = alignment.align(documents(spark, rows), work=work)
    assert order(map(tuple, got.collect())) == order(plain_alignment(rows))


def test_diagonals_cut_equal_work():
    import numpy as np

    rng = random.Random(1)
    for _ in range(50):
        a, b = (np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 40)))) for _ in range(2))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        borders = alignment.cut(a, b, 7)
        assert [i + j for i, j in borders] == [*range(0, len(merged), 7), len(merged)]
        for i, j in borders:
            assert i == sum(side == 0 for _, side in merged[:i + j])


def test_alignment_query(spark, sf):
    got = queries.op12_tokenizer_alignment(spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", "text").collect()]
    assert order(map(tuple, got.collect())) == order(plain_alignment(rows))


def plain_spelling(rows):
    return [(w, *f) for w, f in spelling_forms(spelling_words(rows)).items()]


COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def test_spelling(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abé", k=rng.randint(4, 8))) for _ in range(400)]
    words += ["Straße", "strasse", "Strase", "ÀÉÎÕÜ", "àéîõü", "ÀÉÎÕÛ", "abcde", "abcd", "bcdef"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60))) + "-x1y") for i in range(300)]
    rows += EDGES + [(2000 + i, "mmmmmm mmmmmmm mmmmm " * 2 ** i) for i in range(4)]
    rows += [(3000, "chain " * 3), (3001, "chair " * 6), (3002, "choir " * 12),
             (3003, "choirs " * 24), (3004, "choirz " * 24)]
    got = spelling.spelling_groups(documents(spark, rows)).select(*COLUMNS)
    want = plain_spelling(rows)
    assert order(map(tuple, got.collect())) == order(want)
    chain = {w[0]: w for w in want}["chain"]
    assert chain[3] == "chair" and chain[5] == "choirs"


def test_very_long_words_that_differ_late(spark):
    long = "abcdefghij" * 1_000
    rows = [(i, f"{w} {w} {w}") for i, w in enumerate(
        (long, long + "k", long[:5_000] + "x" + long[5_001:], long[:9_000] + long[9_001:]))]
    got = spelling.spelling_groups(documents(spark, rows)).select(*COLUMNS)
    assert order(map(tuple, got.collect())) == order(plain_spelling(rows))


def test_spelling_query(spark, sf):
    got = queries.op13_spelling_variants(spark, sf).select(*COLUMNS)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", "text").collect()]
    assert order(map(tuple, got.collect())) == order(plain_spelling(rows))


def test_empty_tables(spark, tmp_path):
    for rows in ([], [(None, None)]):
        df = documents(spark, rows)
        assert token_counts.count_tokens(df, cache=str(tmp_path / "c")).count() == len(rows)
        assert alignment.align(df).count() == len(rows)
        assert spelling.spelling_groups(df).count() == 0

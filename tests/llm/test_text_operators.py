"""Quality rules, secret scans, HTML and the classifier against plain versions and edge rows."""

import random

import pytest
from brute import held_out, quality, secrets
from pyspark.sql import functions as F

from ledgerlens.llm import html_extraction, quality_classifier, quality_rules, secret_scans

LONG = "word " * 30_000
EDGES = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, LONG), (5, "a\nb\na\n\n a"), (5, "a\nb\na\n\n a"),
         (6, "a b c d e a b c d e a b c d e f"), (7, "é |# ** $%&<> ü"), (None, "one two"),
         (8, "x y z a b " * 4 + "x y"), (9, "\x1c one\x85two\xa0three four")]


def documents(spark, rows):
    """Documents with extra columns whose names an operator might use itself."""
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("kept") for c in ("key", "measures", "spans", "blob", "__copies_", "id")})


def test_quality_measures(spark):
    got = quality_rules.quality_measures(documents(spark, EDGES), into="m").collect()
    for r in got:
        assert tuple(r.m) == quality(r.text), r.text[:40] if r.text else r.text
        assert r.measures == "kept"
    assert len(got) == len(EDGES)


def test_quality_rules_keep_clean_texts_and_ties_together(spark):
    clean = "Plain words make a sentence of some length here, nothing odd about it at all."
    rows = [*EDGES, (20, clean), (21, clean), (22, clean.upper()), (23, "#$% " * 20 + clean)]
    df = documents(spark, rows)
    kept = [r.doc_id for r in quality_rules.keep_good(df).collect()]
    assert sorted(kept) == [20, 21]
    assert quality_rules.keep_good(df).columns == df.columns
    empty = df.limit(0)
    assert quality_rules.keep_good(empty).count() == 0
    order = quality_rules.by_worth([
        quality_rules.RuleEstimate(r, s, n) for r, s, n in zip(quality_rules.RULES, (1, 2, 1),
                                                               (1, 8, 3))])
    assert [r.name for r in order] == [quality_rules.RULES[i].name for i in (1, 2, 0)]


def secret_texts():
    rng, pool = random.Random(3), ["token", "API_KEY", "apikey", "Password", "secret", ":", "=", " ",
                                   "'", '"', "abc", "abcdef1", "AKIA", "ABCDEF0123456789XYZ", "\n",
                                   "0123456789abcdef", "deadbeef", "é", "😀", "-", "AKIAAKIA"]
    return [(100 + i, "".join(rng.choices(pool, k=rng.randint(1, 25)))) for i in range(300)]


def test_secret_spans(spark):
    rows = EDGES + secret_texts() + [(99, "secret:token = abcdefgh"), (98, "token=key token=abcdef")]
    df = documents(spark, rows)
    found = secret_scans.findings_of_paths(df, secret_scans.scan_unseen(df))
    texts = {}
    for d, t in rows:
        texts[d] = t
    assert found.count() == len(rows)
    base = {r.name for r in secret_scans.BASE_RULES}
    for r in found.collect():
        got = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in base]
        assert got == secrets(texts[r.path]), texts[r.path]


def test_ledger_scans_only_unseen_pairs(spark):
    df = documents(spark, [(1, "token=abcdef12"), (2, "token=abcdef12"), (3, None)])
    first = secret_scans.scan_unseen(df)
    assert first.count() == 2 * len(secret_scans.RULES)
    assert secret_scans.scan_unseen(df, ledger=first).count() == 0
    newer = [secret_scans.SecretRule("assign", "token=.*", version=2), *secret_scans.RULES[1:]]
    again = secret_scans.scan_unseen(df, newer, first).collect()
    assert {r.rule for r in again} == {"assign:2"} and len(again) == 2
    more = df.union(documents(spark, [(4, "new text")]))
    assert secret_scans.scan_unseen(more, ledger=first).select("blob").distinct().count() == 1
    assert secret_scans.scan_unseen(df.limit(0)).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a token=abcdef12 b", 18), (2, "clean", 5), (3, None, None)],
                               "doc_id long, text string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in secret_scans.redact(df).collect()}
    assert got == {1: ("a [secret] b", 12), 2: ("clean", 5), 3: (None, None)}


def plain_redaction(text, spans):
    """The text with every run of overlapping spans replaced."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_redaction_of_many_and_overlapping_spans(spark):
    rows = secret_texts() + [(1, "😀é token=abcdef12 eyJabc.eyJdef.ghi\n" * 500)]
    df = documents(spark, rows)
    spans = {r.path: [(s.start, s.end) for s in r.spans] for r in
             secret_scans.findings_of_paths(df, secret_scans.scan_unseen(df)).collect()}
    assert len(spans[1]) == 1000
    for r, (id, text) in zip(secret_scans.redact(df).orderBy("doc_id").collect(), sorted(rows)):
        assert r.doc_id == id and r.text == plain_redaction(text, spans[id])


def test_columns_of_any_name_stay(spark):
    names = ("__spans", "__blob", "__measures", "__row", "__judged_row", "__REDACT_blob",
             "__m_words", "__redact")
    df = documents(spark, [*EDGES, (30, "token=abcdef12 and more")]).withColumns(
        {c: F.lit(c) for c in names})
    redacted = secret_scans.redact(df)
    assert redacted.columns == df.columns and redacted.count() == df.count()
    assert redacted.where("doc_id = 30").first().text == "[secret] and more"
    assert all(r[c] == c for r in redacted.collect() for c in names)
    good = quality_rules.keep_good(df)
    assert good.columns == df.columns
    assert all(r[c] == c for r in good.collect() for c in names)
    measured = quality_rules.quality_measures(df, into="m")
    assert all(r.__getitem__("__m_words") == "__m_words" for r in measured.collect())


def test_many_matches_in_one_text(spark):
    import time

    text = "token=abcdef12\n" * 32_000
    df = documents(spark, [(1, text)])
    started = time.perf_counter()
    found = secret_scans.findings_of_paths(df, secret_scans.scan_unseen(df)).first().spans
    assert [(s.start, s.end) for s in found] == [(15 * i, 15 * i + 14) for i in range(32_000)]
    assert secret_scans.redact(df).first().text == "[secret]\n" * 32_000
    assert time.perf_counter() - started < 30


def test_a_kept_ledger_is_read_and_appended(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    df = documents(spark, [(1, "token=abcdef12"), (2, "token=abcdef12"), (3, None)])
    assert secret_scans.read_ledger(spark, folder) is None
    first = secret_scans.scan_with_ledger(df, folder)
    want = [tuple(r) for r in secret_scans.scan_unseen(df).where("size(spans) > 0").collect()]
    assert [tuple(r) for r in first.collect()] == want
    pairs = 2 * len(secret_scans.RULES)
    assert secret_scans.read_ledger(spark, folder).count() == pairs
    more = df.where("doc_id > 1").union(documents(spark, [(4, "secret: abcdefgh")]))
    found = secret_scans.findings_of_paths(more, secret_scans.scan_with_ledger(more, folder))
    assert {r.path: len(r.spans) for r in found.collect()} == {2: 1, 3: 0, 4: 1}
    assert secret_scans.read_ledger(spark, folder).count() == pairs + len(secret_scans.RULES)
    # a pair that two runs append at once
    secret_scans.scan_unseen(df).write.mode("append").parquet(folder)
    found = secret_scans.findings_of_paths(df, secret_scans.scan_with_ledger(df, folder))
    assert {r.path: len(r.spans) for r in found.collect()} == {1: 1, 2: 1, 3: 0}
    empty = str(tmp_path / "empty")
    assert secret_scans.scan_with_ledger(df.limit(0), empty).count() == 0
    assert secret_scans.scan_with_ledger(df, empty).count() == 1


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p>", ""), ("plain &amp; simple", "plain & simple"),
    ("<body><nav>Menu</nav><article><h1>T</h1><p>One<br>two.<p>Three&nbsp;four</article>"
     "<footer>f</footer>", "T One two. Three four"),
    ("<div class='ad'>Buy</div><div class=content><p>A long enough text of the page.</p></div>"
     "<div id=comments><p>No!</p></div><script>var a='<p>x</p>'</script>",
     "A long enough text of the page."),
    ("<article><p>Body text.</p><aside>Side</aside><form>Mail</form>"
     "<section class=comments><p>Reader</p></section></article>", "Body text."),
])
def test_main_text(html, text):
    assert html_extraction.main_text(html) == text


LINES = " ".join(f"<p>Line {i} of a body that is long enough to hold nearly all text.</p>"
                 for i in range(40))


@pytest.mark.parametrize("html, text", [
    (f"<div><h1>title</h1><pre>{'long ' * 200}</pre><p>short</p></div>",
     f"title {'long ' * 200}short"),
    (f"<body><h1>A title</h1><div>{LINES}</div></body>", f"A title {LINES}"),
    (f"<body><div><h1>A title</h1><ul><li>1<li>2<li>3<li>4<li>5</ul></div><div>{LINES}</div></body>",
     f"A title 1 2 3 4 5 {LINES}"),
    (f"<body><div>{LINES}</div><p>short</p></body>", f"{LINES} short"),
    (f"<body><ul><li>{'many words ' * 90}</li></ul><p>end</p><nav>Menu</nav></body>",
     f"{'many words ' * 90}end"),
    ("<div><p>Some words.</p><p><a href=x>A paragraph that is one link</a></p><p>More.</p></div>",
     "Some words. A paragraph that is one link More."),
    ("<div class=menu><h2>Menu</h2></div><div><p>Text only.</p></div>", "Text only."),
])
def test_pages_without_article_lose_nothing(html, text):
    assert html_extraction.main_text(html) == text.replace("<p>", "").replace("</p>", "")


def test_html_operator(spark):
    long = "<article>" + "<p>words of a page</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, "u", None), (2, "u", long), (2, "u", long)],
                               "page_id long, text string, html string")
    got = html_extraction.extract(df).collect()
    assert sorted(len(r.text) for r in got) == [0, 16 * 20_000 - 1, 16 * 20_000 - 1]
    assert html_extraction.extract(df.limit(0)).count() == 0


def test_classifier_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_classifier.score_quality(docs, labels)
    rows = scored.join(labels.withColumnRenamed("doc_id", "id"), "id").collect()
    unseen = [r for r in rows if r.held_out]
    assert all(r.held_out == held_out(r.id) for r in rows) and unseen
    assert sum(r.predicted == r.quality for r in unseen) >= 0.95 * len(unseen)
    assert all(0 <= r.score <= 1 for r in rows)


def test_classifier_never_reads_held_out_labels(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(
        quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(
        F.col("quality")))
    a, b = ({r.id: round(r.score, 9) for r in quality_classifier.score_quality(docs, x).collect()}
            for x in (labels, turned))
    assert a == b


def test_classifier_edges(spark):
    df = documents(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.score_quality(df, none).collect()} == {0.5}
    labels = spark.createDataFrame([(3, 1), (4, 1), (5, 0), (6, None), (7, 0), (8, 0)],
                                   "doc_id long, quality int")
    got = quality_classifier.score_quality(df, labels).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.score_quality(df.limit(0), labels).count() == 0


WORDS = "Words of an article that goes on for a while here. " * 4


@pytest.mark.parametrize("html, text", [
    (f'<div class="content with-sidebar"><article><p>{WORDS}</p></article></div>', WORDS),
    (f'<article><div class="post-header"><h1>Title</h1></div><p>{WORDS}</p></article>',
     "Title " + WORDS),
    (f'<article><p>{WORDS}</p><section id="share-prices"><p>{WORDS}</p></section>'
     '<div class="share"><a>one</a> <a>two</a></div></article>', WORDS + WORDS),
    (f'<article><p>{WORDS}</p><div class="comments"><p>{WORDS}</p></div></article>', WORDS),
    ("<div>" + "".join(f"<div><a href=x>Link {i}</a></div>" for i in range(50)) + "</div>"
     f"<div><h1>Head</h1><p>{WORDS}</p><p>Short end.</p></div><div>© 2020 Name</div>",
     "Head " + WORDS + "Short end."),
    (f"<div><h1>Head</h1><pre>{WORDS}</pre><p><a>All link</a></p><p>Short.</p></div>",
     "Head " + WORDS + "All link Short.")])
def test_names_and_menus_do_not_cost_an_article_its_text(html, text):
    assert html_extraction.main_text(html) == text.strip()


def test_the_clustering_decides(monkeypatch):
    html = f'<article><p>{WORDS}</p><div class="share"><a>one</a> <a>two</a></div></article>'
    assert html_extraction.main_text(html) == WORDS.strip()
    monkeypatch.setattr(html_extraction, "content_lines",
                        lambda ratios, **_: [True] * len(ratios))
    assert html_extraction.main_text(html) == WORDS + "one two"


@pytest.mark.parametrize("piece", ["<div>word ", '<div class="share">word </p>', "</b><i>word "])
def test_deep_pages_take_time_in_proportion(piece):
    import time

    started = time.perf_counter()
    assert html_extraction.main_text(piece * 20_000).count("word") == 20_000
    assert time.perf_counter() - started < 10

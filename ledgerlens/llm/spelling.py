"""Words grouped by spelling: near words by a trie that is a table.

Two words are near if one inserted, deleted or replaced code point makes one the other.

- *Trie.* Nodes are the prefixes at which words part, edges the text between two of them; a word's
  last edge is its leaf. Both are rows of tables, joined by node. A node is known by a 64-bit hash of
  its prefix: should two prefixes agree by chance, their node has the edges of both, which loses
  nothing, and the words found are compared in the end.
- *Halves.* Of two near words, either the beginnings or the ends are equal over half of their
  length. Each word is laid into the trie forwards and backwards, behind a mark, and edits are tried
  only from the middle on, where few words are left below a node.
- *Frontier.* A state (word, position, node, edits) says that the word up to the position leads to
  the node with so many edits. States without an edit are the words' own paths. A level joins the
  states with the edges: from a node on its own path a word is edited onto every other edge, from
  then on it must follow the edges letter by letter. States that end at a leaf are near words.

No word meets all words of a group: it meets the edges of its own nodes, one for each letter that
follows there. Joins leave Spark free to split a node that very many states have reached.

Defined results: a missing text has no words and a missing id counts as the empty text in the hash;
repeated rows count each; words of any length are compared whole; a table without words gives an
empty result; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.text import whole
from ledgerlens.plans.staging import drop_staged, stage

RUNS, CAPITALS = "[A-Za-zÀ-ÿ]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: One run in so many loses a code point.
THINNED = 97
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
FORWARDS, BACKWARDS = ">", "<"
#: Stands for a word's end among the letters that follow a node.
END = "."


def _lowered(run: Column) -> Column:
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(
        F.translate(run, CAPITALS, CAPITALS.lower()))


def occurrences(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word) of every run of letters, some of them one code point shorter."""
    named = F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"))
    runs = (df.select(named.alias("id"), F.explode(F.regexp_extract_all(
        whole(text), F.lit(RUNS), F.lit(0))).alias("run"))
        .select("id", _lowered(F.col("run")).alias("run"))
        .withColumn("h", F.crc32(F.concat("id", "run").cast("binary"))))
    at = F.pmod("h", F.length("run")).cast("int")
    thinned = F.concat(F.substring("run", F.lit(1), at),
                       F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % THINNED == 0, thinned).otherwise(
        F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (words.where(F.length("word") >= least_length).groupBy("word")
            .agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


def _keys(words: DataFrame) -> DataFrame:
    """(key_id, key, n, least): each word in both directions; edits begin at ``least``."""
    middle = F.floor(F.length("word") / 2).cast("int") + 1
    numbered = words.withColumn("number", F.monotonically_increasing_id() * 2)
    return numbered.select("n", middle.alias("least"), F.explode(F.array(
        F.struct(F.col("number").alias("key_id"),
                 F.concat(F.lit(FORWARDS), "word").alias("key")),
        F.struct((F.col("number") + 1).alias("key_id"),
                 F.concat(F.lit(BACKWARDS), F.reverse("word")).alias("key")))).alias("k")).select(
                     "k.key_id", "k.key", "n", "least")


def _prefixes(keys: DataFrame) -> DataFrame:
    """(key_id, depth, node, after) of the prefixes from the middle on, with the code point behind
    (-1 at the end); also of the one before the middle, which is a near word's middle."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64

        for part in parts:
            row, depth, node, after = [], [], [], []
            for i, key in enumerate(part.column(1).to_pylist()):
                first = len(key) // 2  # = (letters - 1) // 2 + 1, the mark being one more
                digest = xxh64(key[:first].encode())
                for d in range(first, len(key)):
                    row.append(i)
                    depth.append(d)
                    node.append(digest.intdigest() - (1 << 63))
                    after.append(ord(key[d]))
                    digest.update(key[d].encode())
                row.append(i)
                depth.append(len(key))
                node.append(digest.intdigest() - (1 << 63))
                after.append(-1)
                if len(row) > 200_000:
                    yield rows(part, row, depth, node, after)
                    row, depth, node, after = [], [], [], []
            yield rows(part, row, depth, node, after)

    def rows(part, row, depth, node, after):
        return pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(row, pa.int64())), pa.array(depth, pa.int32()),
             pa.array(node, pa.int64()), pa.array(after, pa.int32())],
            ["key_id", "depth", "node", "after"])

    return keys.select("key_id", "key").mapInArrow(
        batches, "key_id bigint, depth int, node bigint, after int")


def build_trie(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (node, first, label, child, leaf, leaf_n, below) and the words' own states (key, pos,
    node).

    ``first`` is the label's first letter, empty where a word ends at the node. A leaf names its
    word, with mark and in its direction; its child is null. ``below`` has the first letters of the
    child's edges, so that a state which can't go on there is never made.
    """
    prefixes = stage(_prefixes(keys), "prefixes")
    parting = (prefixes.groupBy("node").agg(F.min("after").alias("low"), F.max("after").alias("high"))
               .where("low <> high").select("node"))
    paths = stage(prefixes.join(parting, "node").groupBy("key_id").agg(
        F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("nodes"))
        .join(keys, "key_id").select("key", "n", "least", "nodes"), "paths")

    def edge(x: Column, i: Column) -> Column:
        following = F.get("nodes", i + 1)
        end = F.coalesce(following.depth, F.length("key"))
        return F.struct(x.node.alias("node"),
                        F.substring("key", x.depth + 1, end - x.depth).alias("label"),
                        following.node.alias("child"))

    edges = paths.select("key", "n", F.explode(F.transform("nodes", edge)).alias("e")).select(
        "e.*", F.substring("e.label", 1, 1).alias("first"), "key", "n")
    columns = ["node", "first", "label", "child"]
    inner = (edges.where("child is not null").select(*columns).distinct()
             .withColumns({"leaf": F.lit(None).cast("string"), "leaf_n": F.lit(None).cast("bigint")}))
    leaves = edges.where("child is null").select(
        *columns, F.col("key").alias("leaf"), F.col("n").alias("leaf_n"))
    own = paths.select("key", F.explode(F.filter(
        "nodes", lambda x: x.depth >= F.col("least"))).alias("x")).select(
            "key", F.col("x.depth").alias("pos"), "x.node")
    inner, leaves = stage(inner, "inner-edges"), stage(leaves, "leaves")
    starts = inner.select("node", "first").unionByName(leaves.select("node", "first"))
    below = starts.groupBy(F.col("node").alias("child")).agg(F.concat_ws("", F.collect_set(
        F.when(F.col("first") == "", END).otherwise(F.col("first")))).alias("below"))
    trie = stage(inner.join(below, "child").unionByName(
        leaves.withColumn("below", F.lit(None).cast("string"))), "trie")
    own = stage(own, "own-paths")
    for table in (prefixes, paths, inner, leaves):
        drop_staged(table)
    return trie, own


def _fits(rest: Column, label: Column) -> Column:
    """The rest follows the label, and ends with it at a leaf."""
    return F.when(F.col("leaf").isNull(), rest.startswith(label)).otherwise(rest == label)


def _alive(states: DataFrame) -> DataFrame:
    """States at a leaf, or at a node from which the word's next letter goes on."""
    after = F.substring("key", F.col("pos") + 1, F.lit(1))
    goes_on = F.col("below").contains(F.when(after == "", END).otherwise(after))
    return states.where(F.col("leaf").isNotNull() | goes_on).drop("below")


def _first_edits(own: DataFrame, trie: DataFrame) -> DataFrame:
    """States after one edit onto an edge beside the word's own path."""
    key, pos, label = F.col("key"), F.col("pos"), F.col("label")
    rest, later = F.substring(key, pos + 1, F.length(key)), F.substring(key, pos + 2, F.length(key))
    after, size = F.substring(label, F.lit(2), F.length(label)), F.length(label)
    more, some = F.length(key) > pos, size > 0
    edits = F.array(
        F.when(more & some & _fits(later, after), pos + size),  # another letter
        F.when(some & _fits(rest, after), pos + size - 1),  # a letter more than the word has
        F.when(more & _fits(later, label), pos + size + 1))  # without a letter of the word
    beside = own.join(trie, "node").where(F.col("first") != F.substring(key, pos + 1, F.lit(1)))
    return _alive(beside.select("key", F.explode(edits).alias("pos"), "child", "leaf", "leaf_n",
                                "below").where("pos is not null"))


def _next_level(states: DataFrame, trie: DataFrame) -> DataFrame:
    """States one edge further down, letter by letter."""
    rest = F.substring("key", F.col("pos") + 1, F.length("key"))
    at = states.select("key", "pos", F.col("child").alias("node")).withColumn(
        "first", F.substring("key", F.col("pos") + 1, F.lit(1)))
    return _alive(at.join(trie, ["node", "first"]).where(_fits(rest, F.col("label"))).select(
        "key", (F.col("pos") + F.length("label")).alias("pos"), "child", "leaf", "leaf_n", "below"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of every two near words of ``words`` (word, n), once each way."""
    keys = stage(_keys(words), "keys")
    trie, own = build_trie(keys)
    levels = [stage(_first_edits(own, trie), "level")]
    while not (open := levels[-1].where("leaf is null")).isEmpty():
        levels.append(stage(_next_level(open, trie), "level"))
    found = reduce(DataFrame.unionByName, levels).where("leaf is not null")

    def word(key: str) -> Column:
        letters = F.substring(key, F.lit(2), F.length(key))
        return F.when(F.col(key).startswith(FORWARDS), letters).otherwise(F.reverse(letters))

    pairs = found.select(word("key").alias("word"), word("leaf").alias("near"),
                         F.col("leaf_n").alias("near_n"))
    near = stage(pairs.where(F.levenshtein("word", "near", 1) == 1)
                 .dropDuplicates(["word", "near"]), "near")
    for table in (keys, trie, own, *levels):
        drop_staged(table)
    return near


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the last form, found by doubling the steps taken."""
    steps = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(steps.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "roots")
        drop_staged(steps)
        steps = moved
        if steps.where("moved").isEmpty():
            return steps


def spelling_groups(df: DataFrame, id: str = "doc_id", text: str = "text",
                    times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the texts.

    The form is the most frequent near word (of equal ones the first in code-point order) where it
    is ``times`` as frequent as the word; the root is what following the forms ends at.
    """
    words = stage(vocabulary(occurrences(df, id, text)), "words")
    pairs = near_words(words)
    near = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(
            (-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    fits = -F.col("best.n") >= F.col("n") * times
    formed = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"),
        F.when(fits, -F.col("best.n")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null"))
    grouped = stage(formed.join(roots.drop("moved"), "word", "left").withColumn(
        "root", F.coalesce("root", "word")), "spelling")
    for table in (words, pairs, formed, roots):
        drop_staged(table)
    return grouped

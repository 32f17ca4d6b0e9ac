"""Tokens of two tokenizers over the same bytes, aligned by merge-path pieces.

Both tokenizers cut the bytes of a text without a gap, so their tokens are two rising lists of end
offsets. Merging the lists meets every pair of overlapping tokens once: a step of the merge is a
stretch of bytes that one A and one B token share. Where an A and a B token end together, a group of
tokens ends.

- *Tokens.* Both tokenizers cut before a lone space or line break between other characters, so the
  text behind one has the same tokens wherever it stands. Workers remember the tokens of such
  stretches. A tokenizer without this property, or a stretch whose tokens give other bytes, makes
  the whole text go through the tokenizer.
- *Pieces.* The merge of a text is cut along diagonals of its merge matrix: a binary search finds
  how many A ends are among the first ``d`` merged ends, for every multiple ``d`` of the work of a
  piece. Pieces of all texts have the same work at most and need nothing of each other.
- *Overlaps.* A piece knows its own tokens, the next one on either side and where they start, and
  emits its pairs. Pairs of one block of pieces are counted together before they are shuffled.
- *Groups.* A text of one piece has its groups whole. Pieces of longer texts give what they hold of
  the groups at their borders, and a sorted stream over the pieces stitches them.

Counts over the corpus come back to the texts by a shuffle by pair and one by block: a row holds a
pair and the pieces of a block that link it, so the commonest pair has one row a block.

Defined results: a text that is missing or empty, or whose tokens give other bytes than the text
behind a space, has no tokens, no links and an empty group string; missing and repeated ids and
repeated rows are kept, each with its figures; texts are aligned whole at any length; an empty table
gives an empty result; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import tokenizing
from ledgerlens.llm.text import whole
from ledgerlens.plans.staging import drop_staged, stage

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Merged ends of a piece at most; a count of links within a piece fits 16 bits.
WORK = 32_768
#: Characters whose tokens are one block, and pieces of it at most.
BLOCK, PIECES = 1_000_000, 65_536
#: Stretches that a Python worker remembers, and characters of one worth remembering.
REMEMBERED, MEMORABLE = 250_000, 64
#: Bits of a B id within a pair, and of a piece's place behind it.
ID_BITS, PLACE_BITS = 24, 16
B_ID = (1 << ID_BITS) - 1
SPACE = "▁"

MERGED = ("block bigint, place int, key bigint, id {}, piece int, n_a bigint, n_b bigint, "
          "n_links bigint, n_ends bigint, whole string, head_a string, head_b string, "
          "inner string, tail_a string, tail_b string, pair bigint, links bigint, postings binary")


def bytes_of_a(path: str) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary."""
    tokenizer, _ = tokenizing.encoder(path, plain=True)
    # fixed values of byte-level vocabularies: printable bytes stand for themselves, the others in
    # order for the code points from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(b): b for b in shown}
    code.update((chr(256 + i), b) for i, b in enumerate(
        b for b in range(256) if b not in set(shown)))
    found = [b""] * (max(tokenizer.get_vocab().values()) + 1)
    for token, i in tokenizer.get_vocab().items():
        found[i] = (bytes(code[c] for c in token) if all(c in code for c in token)
                    else token.encode())
    return found


def bytes_of_b(path: str) -> list[bytes]:
    """Bytes of every id of a vocabulary of pieces with byte fallback."""
    pieces, _ = tokenizing.encoder(path)
    return [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i)
            else pieces.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(pieces.get_piece_size())]


def lengths(tokens: list[bytes]) -> np.ndarray:
    return np.array([len(t) for t in tokens], np.int64)


def ends_among(a: np.ndarray, b: np.ndarray, d: int) -> int:
    """How many of the first ``d`` merged ends are of ``a``; of equal ends, that of ``a`` is first."""
    low, high = max(0, d - len(b)), min(d, len(a))
    while low < high:
        middle = (low + high) // 2
        if a[middle] <= b[d - middle - 1]:
            low = middle + 1
        else:
            high = middle
    return low


def cut(a: np.ndarray, b: np.ndarray, work: int) -> list[tuple[int, int]]:
    """Borders (A ends, B ends) of pieces of ``work`` merged ends; ``a`` and ``b`` are ends."""
    total = len(a) + len(b)
    inner = [ends_among(a, b, d) for d in range(work, total, work)]
    return [(0, 0), *[(i, d - i) for i, d in zip(inner, range(work, total, work))],
            (len(a), len(b))]


class Tokens:
    """Ids of texts under both tokenizers, as 32-bit numbers.

    A stretch goes without the space before it, but with a line break before it.
    """

    def __init__(self, path_a: str, path_b: str):
        (_, self.encode_a), (pieces, self.encode_b) = (tokenizing.encoder(path_a, plain=True),
                                                       tokenizing.encoder(path_b))
        self.of_a, self.of_b = bytes_of_a(path_a), bytes_of_b(path_b)
        self.long_a, self.long_b = lengths(self.of_a), lengths(self.of_b)
        with open(path_a, encoding="utf-8") as f:
            said = json.load(f)
        before = said.get("pre_tokenizer") or {}
        self.apart = not said.get("normalizer") and before.get("type") == "ByteLevel" and (
            before.get("use_regex", True)) and not any(
            re.search(f"[^{SPACE}]{SPACE}|\n", pieces.id_to_piece(i))
            for i in range(pieces.get_piece_size()))
        self.known, self.older = {}, {}

    def _same(self, ids_a: list[int], ids_b: list[int], raw: bytes) -> bool:
        return raw == b"".join(map(self.of_a.__getitem__, ids_a)) == b"".join(
            map(self.of_b.__getitem__, ids_b))

    def _cut(self, ids: np.ndarray, long: np.ndarray, ends: np.ndarray) -> list[bytes] | None:
        """The ids of the stretches that end at the bytes ``ends``, if tokens end there too."""
        token_ends = np.cumsum(long[ids])
        upto = np.searchsorted(token_ends, ends) + 1
        if upto[-1] != len(ids) or (token_ends[upto - 1] != ends).any():
            return None
        raw, upto = ids.tobytes(), (4 * upto).tolist()
        return [raw[i:j] for i, j in zip(upto, upto[1:])]

    def _learn(self, new: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Ids of stretches, encoded as one text that is cut again; None where bytes differ."""
        raw = [" ."] + [s if s[0] == "\n" else " " + s for s in new]
        text = "".join(raw)
        a, b = self.encode_a([text])[0], self.encode_b([text[1:]])[0]
        if self._same(a, b, text.encode()):
            ends = np.cumsum([len(r.encode()) for r in raw])
            cells = [self._cut(np.array(ids, np.uint32), long, ends)
                     for ids, long in ((a, self.long_a), (b, self.long_b))]
            if None not in cells:
                return dict(zip(new, zip(*cells)))
        if len(new) > 1:  # one of them gives other bytes
            half = len(new) // 2
            return self._learn(new[:half]) | self._learn(new[half:])
        return dict.fromkeys(new)

    @staticmethod
    def _alone(stretch: str) -> bool:
        """Whether it is cut off by lone white space; it may keep the line break before it."""
        first = stretch[:2].removeprefix("\n")[:1]
        return first != "" and not first.isspace() and not stretch[-1].isspace()

    def __call__(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of each text, none where it is empty or its tokens give other bytes."""
        parts = [t.replace("\n", " \n").split(" ") if self.apart else [] for t in texts]
        cells = [list(map(self.known.get, p)) for p in parts]
        holes = [[i for i, x in enumerate(c) if x is None] for c in cells]
        new = {p[i] for p, h in zip(parts, holes) for i in h}
        here = {s: self.older[s] for s in new if s in self.older}
        for some in tokenizing.by_size([s for s in new if s not in here and self._alone(s)], 100_000):
            here.update(self._learn(some))
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        self.known.update((s, x) for s, x in here.items() if x and len(s) <= MEMORABLE)
        out = []
        for t, p, found, hole in zip(texts, parts, cells, holes):
            for i in hole:
                found[i] = here.get(p[i])
            if t and found and (not hole or None not in found):
                a, b = zip(*found)
                out.append((b"".join(a), b"".join(b)))
                continue
            a, b = self.encode_a([" " + t])[0], self.encode_b([t])[0]
            out.append((array("I", a).tobytes(), array("I", b).tobytes()) if (
                t and self._same(a, b, (" " + t).encode())) else (b"", b""))
        return out


def pieces(tokens: Tokens, texts: list[str], work: int) -> Iterator[tuple]:
    """(text's number, piece, pieces, A ids, B ids, the next A and B id or -1, where both start)."""
    for number, (ids_a, ids_b) in enumerate(tokens(texts)):
        if len(ids_a) + len(ids_b) <= 4 * work:
            yield number, 0, 1, ids_a, ids_b, -1, -1, 0, 0
            continue
        a, b = np.frombuffer(ids_a, np.uint32), np.frombuffer(ids_b, np.uint32)
        end_a, end_b = np.cumsum(tokens.long_a[a]), np.cumsum(tokens.long_b[b])
        borders = cut(end_a, end_b, work)
        for k, ((i, j), (p, q)) in enumerate(zip(borders, borders[1:])):
            yield (number, k, len(borders) - 1, ids_a[4 * i:4 * p], ids_b[4 * j:4 * q],
                   int(a[p]) if p < len(a) else -1, int(b[q]) if q < len(b) else -1,
                   int(end_a[i - 1]) if i else 0, int(end_b[j - 1]) if j else 0)


def _joined(cells: list[bytes], after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all pieces behind one another with each piece's next one, the index at which each
    piece begins, and its number of own ids."""
    own = np.array([len(c) // 4 for c in cells], np.int64)
    begin = np.concatenate([[0], np.cumsum(own + 1)])
    ids = np.zeros(begin[-1], np.int64)
    mine = np.ones(begin[-1], bool)
    mine[begin[1:] - 1] = False
    ids[mine] = np.frombuffer(b"".join(cells), np.uint32)
    ids[begin[1:] - 1] = after
    return ids, begin, own


class Block:
    """The merge of the tokens of some pieces, all pieces at once.

    Offsets of piece ``k`` are moved behind all of the pieces before, so one search over all ends
    finds for each token where it lies in the other list of its own piece.
    """

    def __init__(self, a: list[bytes], b: list[bytes], next_a: np.ndarray, next_b: np.ndarray,
                 start_a: np.ndarray, start_b: np.ndarray, long_a: np.ndarray, long_b: np.ndarray):
        self.a, self.first_a, self.own_a = _joined(a, next_a)
        self.b, self.first_b, self.own_b = _joined(b, next_b)
        end_a, self.of_a, own_a = self._ends(self.a, self.first_a, self.own_a, long_a)
        end_b, self.of_b, own_b = self._ends(self.b, self.first_b, self.own_b, long_b)
        least = np.minimum(start_a, start_b)
        move = self._moves(end_a, end_b, start_a, start_b, least)
        end_a += (move + start_a)[self.of_a]
        end_b += (move + start_b)[self.of_b]
        self.at_a, self.at_b = np.flatnonzero(own_a), np.flatnonzero(own_b)
        ends_a, ends_b = end_a[self.at_a], end_b[self.at_b]
        # tokens of the other side that end before: all of the pieces before and some of its own
        before_b = np.searchsorted(ends_b, ends_a, "left")
        before_a = np.searchsorted(ends_a, ends_b, "left")
        both = (before_a < len(ends_a)) & (
            ends_a[np.minimum(before_a, len(ends_a) - 1)] == ends_b) if len(ends_a) else (
            np.zeros(len(ends_b), bool))
        # an A token before the piece's own ones can end with its first B token
        both |= ends_b == (move + start_a)[self.of_b[self.at_b]]
        #: For each own A token the B token over its last byte, and the other way around.
        self.over_a = before_b + self.of_a[self.at_a]
        self.over_b = before_a + self.of_b[self.at_b]
        #: Own B tokens that end a group.
        self.ends_group = both

    @staticmethod
    def _ends(ids, first, own, long):
        """End of every token within its piece, its piece, and whether it is the piece's own."""
        of = np.repeat(np.arange(len(own)), own + 1)
        mine = np.ones(len(ids), bool)
        mine[first[1:] - 1] = False
        size = np.where(mine, long[np.where(mine, ids, 0)], 0)
        total = np.cumsum(size)
        return total - (total - size)[first[:-1]][of] if len(ids) else total, of, mine

    def _moves(self, end_a, end_b, start_a, start_b, least):
        last = np.maximum(end_a[self.first_a[1:] - 1] + start_a, end_b[self.first_b[1:] - 1]
                          + start_b) - least + 1
        return np.concatenate([[0], np.cumsum(last)[:-1]]) - least + 1

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pair (A id, then B id) and piece of every link."""
        alone = ~self.ends_group
        at = self.at_b[alone]
        a = np.concatenate([self.a[self.at_a], self.a[self.over_b[alone]]])
        b = np.concatenate([self.b[self.over_a], self.b[at]])
        return a << ID_BITS | b, np.concatenate([self.of_a[self.at_a], self.of_b[at]])


def digits(most: int, separators: bytes) -> np.ndarray:
    """Row ``id * len(separators) + k``: decimal digits of an id and separator ``k``, zeros after."""
    text = [str(i).encode() + bytes([s]) for i in range(most) for s in separators]
    return np.array(text, "S").view(np.uint8).reshape(len(text), -1)


_COMMA, _BAR, _SEMICOLON = range(3)


def _text(codes: np.ndarray, table: np.ndarray) -> bytes:
    cells = table[codes].ravel()
    return cells[cells != 0].tobytes()


def _list(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def group_codes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Group and code (see ``digits``) of every token, in the order of the group string.

    Groups are numbered through the block; what a piece leaves open has the number of what the next
    piece begins with.
    """
    a, b = block.a[block.at_a], block.b[block.at_b]
    group_b = np.cumsum(block.ends_group) - block.ends_group
    closing = np.flatnonzero(block.ends_group)
    # an A token is in the group that the first end at or behind its own end closes
    group_a = np.searchsorted(closing, block.over_a - block.of_a[block.at_a], "left")
    # an A token stands behind the B tokens of earlier groups, a B token also behind its own
    # group's A tokens
    place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
    group, code = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
    group[place_a], group[place_b] = group_a, group_b
    last_a, last_b = np.ones(len(a), bool), np.ones(len(b), bool)
    last_a[:-1], last_b[:-1] = group_a[1:] != group_a[:-1], group_b[1:] != group_b[:-1]
    code[place_a] = a * 3 + np.where(last_a, _BAR, _COMMA)
    code[place_b] = b * 3 + np.where(last_b, _SEMICOLON, _COMMA)
    return group, code


def merged(df: DataFrame, id: str, text: str, path_a: str, path_b: str,
           work: int = WORK) -> DataFrame:
    """Rows of pieces (their figures and groups) and rows of pairs of a block (their postings)."""
    rows = df.select(F.col(id).alias("id"), whole(text).alias("text"))
    schema = MERGED.format(dict(rows.dtypes)["id"])
    names = [c.split()[0] for c in schema.split(", ")]
    texts_of_piece = ("whole", "head_a", "head_b", "inner", "tail_a", "tail_b")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = tokenizing.kept(("tokens", path_a, path_b), lambda: Tokens(path_a, path_b))
        table = tokenizing.kept(("digits", path_a, path_b), lambda: digits(
            max(len(tokens.of_a), len(tokens.of_b)), b",|;"))
        key = number = TaskContext.get().partitionId() << 40

        def batch(size: int, id_type: pa.DataType, **columns) -> pa.RecordBatch:
            types = {"id": id_type, "place": pa.int32(), "piece": pa.int32(),
                     "postings": pa.binary(), **dict.fromkeys(texts_of_piece, pa.string())}
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[n], types.get(n, pa.int64())) if n in columns
                 else pa.nulls(size, types.get(n, pa.int64())) for n in names], names)

        for part in parts:
            at, id_type = 0, part.column(0).type
            for texts in tokenizing.by_size(part.column(1).to_pylist(), BLOCK):
                cells = list(pieces(tokens, texts, work))
                for begin in range(0, len(cells), PIECES):
                    of, piece, count, *sides = zip(*cells[begin:begin + PIECES])
                    size, of = len(of), np.array(of)
                    block = Block(*sides[:2], *map(np.array, sides[2:]), tokens.long_a,
                                  tokens.long_b)
                    pair, place = block.links()
                    ended = block.of_b[block.at_b][block.ends_group]
                    yield batch(
                        size, id_type, block=np.full(size, number), place=np.arange(size),
                        key=key + of, id=part.column(0).take(pa.array(at + of)), piece=piece,
                        n_a=block.own_a, n_b=block.own_b,
                        n_links=np.bincount(place, minlength=size),
                        n_ends=np.bincount(ended, minlength=size),
                        **dict(zip(texts_of_piece, zip(*_texts(block, count, table)))))
                    found, links, postings = _postings(pair, place)
                    yield batch(len(found), id_type, block=np.full(len(found), number),
                                pair=found, links=links, postings=postings)
                    number += 1
                at, key = at + len(texts), key + len(texts)

    return rows.mapInArrow(batches, schema)


def _texts(block: Block, pieces: Sequence[int], table: np.ndarray) -> list[tuple]:
    """Per piece the hash of a text's whole groups, or what it adds to those of a longer text."""
    group, codes = group_codes(block)
    upto_a = block.first_a - np.arange(len(block.first_a))
    upto_b = block.first_b - np.arange(len(block.first_b))
    out = []
    for k, of in enumerate(pieces):
        (i, p), (j, q) = upto_a[k:k + 2], upto_b[k:k + 2]
        if i == p and j == q:
            out.append(("", None, None, None, None, None))
            continue
        if of == 1:
            groups = _text(codes[i + j:p + q], table)[:-1]
            out.append((hashlib.sha256(groups).hexdigest(), None, None, None, None, None))
            continue
        a, b = block.a[block.at_a[i:p]], block.b[block.at_b[j:q]]
        ends = np.flatnonzero(block.ends_group[j:q])
        if not len(ends):
            out.append((None, _list(a), _list(b), "", "", ""))
            continue
        # tokens up to the first end, of the groups that lie within the piece, behind the last end
        before = block.over_a[i:p] - k - j  # own B tokens that end before an A token
        head = int(np.searchsorted(before, ends[0], "right"))
        tail = int(np.searchsorted(before, ends[-1], "right"))
        inner = codes[i + j + head + ends[0] + 1:i + j + tail + ends[-1] + 1]
        out.append((None, _list(a[:head]), _list(b[:ends[0] + 1]), _text(inner, table).decode(),
                    _list(a[tail:]), _list(b[ends[-1] + 1:])))
    return out



def _postings(pair: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Distinct pairs, their numbers of links, and (piece, links of it) of each as 16-bit halves."""
    if not len(pair):
        return pair, pair, pa.array([], pa.binary())
    both = np.sort(pair << PLACE_BITS | place)
    at = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
    times = np.diff(np.append(at, len(both)))
    pair, place = both[at] >> PLACE_BITS, both[at] & (1 << PLACE_BITS) - 1
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    packed = (place.astype(np.uint32) << 16 | times.astype(np.uint32)).tobytes()
    offsets = np.append(first, len(pair)).astype(np.int32) * 4
    return pair[first], np.add.reduceat(times, first), pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed)])


def stitched(parts: DataFrame) -> DataFrame:
    """(key, groups_sha256) of texts of several pieces, hashed as a stream over their pieces."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, begun, open_a, open_b = None, None, False, [], []
        keys, hashes = [], []

        def close():
            if key is not None:
                keys.append(key)
                hashes.append(digest.hexdigest())

        for part in parts:
            for r in part.to_pylist():
                if r["key"] != key:
                    close()
                    key, digest, begun, open_a, open_b = r["key"], hashlib.sha256(), False, [], []
                open_a.append(r["head_a"])
                open_b.append(r["head_b"])
                if r["n_ends"]:
                    group = f"{','.join(filter(None, open_a))}|{','.join(filter(None, open_b))}"
                    groups = [group] + [r["inner"][:-1]] * bool(r["inner"])
                    digest.update((";" * begun + ";".join(groups)).encode())
                    begun, open_a, open_b = True, [r["tail_a"]], [r["tail_b"]]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()),
                                              pa.array(hashes, pa.string())], ["key", "stitched"])
            keys, hashes = [], []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()),
                                          pa.array(hashes, pa.string())], ["key", "stitched"])

    columns = ("key", "piece", "n_ends", "head_a", "head_b", "inner", "tail_a", "tail_b")
    return (parts.select(*columns).repartition("key").sortWithinPartitions("key", "piece")
            .mapInArrow(batches, "key bigint, stitched string"))


def pair_weights(counts: DataFrame) -> DataFrame:
    """(pair, n, best) of counted pairs (pair, n): best is 1 if no pair of its B id has more."""
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(B_ID)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select(
        "pair", "n", (F.col("n") == F.col("most")).cast("bigint").alias("best"))


def piece_sums(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """(block, place, count_sum, n_best): the counts of the pairs back at the pieces' links."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            cells = part.column("postings").to_pylist()
            packed = np.frombuffer(b"".join(cells), np.uint32).astype(np.int64)
            if not len(packed):
                continue
            spread = np.repeat(np.arange(len(cells)), [len(c) // 4 for c in cells])
            times, block = packed & 0xFFFF, part.column("block").to_numpy()
            number, index = np.unique(block, return_inverse=True)
            where = index[spread] << 16 | packed >> 16
            order = np.argsort(where, kind="stable")
            where, times, spread = where[order], times[order], spread[order]
            first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            sums = [np.add.reduceat(times * part.column(c).to_numpy()[spread], first)
                    for c in ("n", "best")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[where[first] >> 16]),
                 pa.array((where[first] & 0xFFFF).astype(np.int32)),
                 *[pa.array(s) for s in sums]], ["block", "place", "count_sum", "n_best"])

    # by pair to the counts, then back to the block, where the sums of a piece meet
    weighed = (pairs.select("block", "pair", "postings")
               .join(weights.hint("shuffle_merge"), "pair")
               .select("block", "postings", "n", "best")
               .repartition("block").sortWithinPartitions("block"))
    return (weighed.mapInArrow(batches, "block bigint, place int, count_sum bigint, n_best bigint")
            .groupBy("block", "place").agg(F.sum("count_sum").alias("count_sum"),
                                           F.sum("n_best").alias("n_best")))


def align(df: DataFrame, id: str = "doc_id", text: str = "text", tokenizer_a: str | None = None,
          tokenizer_b: str | None = None, work: int = WORK) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    path_a = tokenizer_a or tokenizing.vocabulary(TOKENIZER_A)
    path_b = tokenizer_b or tokenizing.vocabulary(TOKENIZER_B)
    rows = stage(merged(df, id, text, path_a, path_b, work), "merged")
    parts, pairs = rows.where("pair is null"), rows.where("pair is not null")
    counts = stage(pairs.groupBy("pair").agg(F.sum("links").alias("n")), "pairs")
    weights = stage(pair_weights(counts), "weights")
    sums = piece_sums(pairs, weights)
    figures = ("n_a", "n_b", "n_links", "n_ends", "count_sum", "n_best")
    texts = (parts.select("block", "place", "key", "id", "piece", "n_a", "n_b", "n_links",
                           "n_ends", "whole").join(sums, ["block", "place"], "left")
             .groupBy("key").agg(
                 F.max_by("id", "piece").alias("id"), F.max("whole").alias("whole"),
                 *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in figures]))
    long = stitched(parts.where("whole is null"))
    aligned = stage(texts.join(long, "key", "left").select(
        "id", "n_a", "n_b", F.col("n_ends").alias("n_groups"), "n_links", "n_best", "count_sum",
        F.coalesce("whole", "stitched").alias("groups_sha256")), "aligned")
    for table in (rows, counts, weights):
        drop_staged(table)
    return aligned

"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A text is cut into the matches of the tokenizer's pattern; each match is merged by itself. A leaf of the tree stands for
the byte at which a part begins and holds the rank of that part joined with the next one, followed by its position, so
the root is always the leftmost pair of least rank. A merge changes three leaves: the joined part's, that of the part
before it, and that of the part that is gone; each change climbs the tree only as far as a minimum changes. Parts know
their live neighbours, so nothing is searched or moved: a match of n bytes takes n log n steps.

Texts are read in blocks that end before white space behind another character. No match reaches over such a place and
none looks beyond it, so blocks change nothing and a giant text's matches are never held all at once. A worker keeps the
ids of matches it met. Which characters are letters and digits is asked of the tokenizer's library, whose Unicode version
may be older than this one's; a text with characters on which they differ is matched with stand-ins.

Defined results: a null or empty text has no ids and decodes to no bytes; equal rows get equal ids, each in a row of its
own; a null id stays null; strings of special tokens are ordinary text; ids that the file doesn't have end a decoding
with an error, null ids decode to null; an empty table gives no rows. Extra columns are neither read nor returned.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a text that are matched at a time, matches that are held at a time, and bytes of texts or ids that go
#: into one Arrow batch, at least.
BLOCK = 1 << 16
MATCHES = 1 << 18
BATCH_BYTES = 1 << 22
#: Bytes of a match that is merged together with others, at most.
SHORT = 33
#: Matches that a worker keeps the ids of before it starts anew (those of the last while stay).
_REMEMBERED = 400_000
_NO_PAIR = 1 << 62
Ranks = dict[bytes, int]


def parse_ranks(lines: bytes) -> Ranks:
    """Ranks of a file with a base64 token and its rank in each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


class Merger:
    """Ids of matches: the least pair first, the leftmost of equals. Matches of up to SHORT bytes are merged many at a time, a
    step for all of them together, each row of the arrays with a tree of its own."""

    def __init__(self, ranks: Ranks):
        self.ranks, self.longest = ranks, max(map(len, ranks), default=0)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        joined: dict[int, int] = {}  # two parts, and what they are joined
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    joined[left << 32 | right] = rank
        self.pairs = np.array(sorted(joined), np.int64)
        self.joined = np.array([joined[k] for k in self.pairs.tolist()], np.int64)

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        keys = left << 32 | right
        place = np.searchsorted(self.pairs, keys)
        place[place == len(self.pairs)] = 0
        return np.where(self.pairs[place] == keys, self.joined[place] << bits | at, _NO_PAIR)

    def many(self, matches: list[bytes]) -> list[bytes]:
        """Ids of each match as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(matches)
        by_bits: dict[int, list[int]] = {}
        for n, data in enumerate(matches):
            whole = self.ranks.get(data)
            if whole is not None:
                out[n] = whole.to_bytes(4, "little")
            elif 1 < len(data) <= SHORT:
                by_bits.setdefault((len(data) - 2).bit_length(), []).append(n)
            elif data:
                out[n] = np.array(self.long(data), "<u4").tobytes()
        for bits, rows in by_bits.items():
            for n, ids in zip(rows, self._together([matches[n] for n in rows], bits), strict=True):
                out[n] = ids
        return out

    def _together(self, matches: list[bytes], bits: int) -> list[bytes]:
        leaves, count = 1 << bits, len(matches)
        width = leaves + 1  # bytes of a match at most
        size = np.fromiter(map(len, matches), np.int64, count)
        codes = np.frombuffer(b"".join(m.ljust(width, b"\0") for m in matches), np.uint8).reshape(count, width)
        places = np.arange(width)
        part = np.where(places < size[:, None], self.of_byte[codes], -1)
        end, before = np.tile(places + 1, (count, 1)), np.tile(places - 1, (count, 1))
        tree = np.full((count, 2 * leaves), _NO_PAIR, np.int64)
        has_next = places[1:] < size[:, None]
        tree[:, leaves:][has_next] = self._leaf(part[:, :-1][has_next], part[:, 1:][has_next], np.broadcast_to(places[:-1], has_next.shape)[has_next], bits)
        for node in range(leaves - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        row = np.flatnonzero(tree[:, 1] != _NO_PAIR)
        while len(row):
            least = tree[row, 1]
            at = least & (leaves - 1)
            gone = end[row, at]
            stop = end[row, gone]
            end[row, at], part[row, at] = stop, least >> bits
            goes_on = stop < size[row]
            more, own, after = row[goes_on], at[goes_on], stop[goes_on]
            before[more, after] = own
            inside = gone < leaves
            tree[row[inside], leaves + gone[inside]] = _NO_PAIR
            tree[row, leaves + at] = _NO_PAIR
            tree[more, leaves + own] = self._leaf(part[more, own], part[more, after], own, bits)
            first = before[row, at]
            behind = first >= 0
            tree[row[behind], leaves + first[behind]] = self._leaf(part[row[behind], first[behind]], part[row[behind], at[behind]], first[behind], bits)
            for changed in (np.minimum(gone, leaves - 1), at, np.maximum(first, 0)):
                node = (leaves + changed) >> 1
                for _ in range(bits):
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                    node >>= 1
            row = row[tree[row, 1] != _NO_PAIR]
        starts, alive = np.zeros(count, np.int64), np.zeros((count, width), bool)
        row = np.arange(count)
        while len(row):
            alive[row, starts] = True
            starts = end[row, starts]
            going = starts < size[row]
            row, starts = row[going], starts[going]
        ids, per_row = part[alive].astype("<u4").tobytes(), np.cumsum(np.r_[0, alive.sum(axis=1)]) * 4
        return [ids[a:b] for a, b in zip(per_row[:-1].tolist(), per_row[1:].tolist(), strict=True)]

    def long(self, data: bytes) -> list[int]:
        """Ids of one match of any length."""
        ranks, size = self.ranks, len(data)
        whole = ranks.get(data)
        if whole is not None or size < 2:
            return [whole] if size else []
        bits = (size - 2).bit_length()
        leaves, rank_of = 1 << bits, ranks.get
        tree = array("q", [_NO_PAIR]) * (2 * leaves)
        for at in range(size - 1):
            rank = rank_of(data[at:at + 2])
            if rank is not None:
                tree[leaves + at] = rank << bits | at
        for node in range(leaves - 1, 0, -1):
            low, high = tree[2 * node], tree[2 * node + 1]
            tree[node] = low if low < high else high
        end, before = array("q", range(1, size + 1)), array("q", range(-1, size - 1))

        def put(at: int, stop: int) -> None:
            """The leaf of ``at`` gets the pair that ends at stop (no pair if that is 0)."""
            rank = rank_of(data[at:stop]) if 0 < stop - at <= self.longest else None
            value = _NO_PAIR if rank is None else rank << bits | at
            node = leaves + at
            while node and tree[node] != value:
                tree[node] = value
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1

        while (least := tree[1]) != _NO_PAIR:
            at = least & (leaves - 1)
            gone = end[at]
            stop = end[at] = end[gone]
            if stop < size:
                before[stop] = at
                put(gone, 0)
                put(at, end[stop])
            else:  # the part that is gone was the last and had no pair
                put(at, 0)
            if at:
                put(before[at], stop)
        ids, at = [], 0
        while at < size:
            ids.append(ranks[data[at:end[at]]])
            at = end[at]
        return ids


@lru_cache(maxsize=1)
def strange_characters() -> dict[int, str]:
    """Stand-ins for the characters that the tokenizer's library puts into another class than the pattern module does:
    a letter, a digit, or a code that is neither."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    differ: dict[int, str] = {}
    for kind, stand_in in ((r"\p{L}", "a"), (r"\p{N}", "0"), (r"\s", " ")):
        theirs = set(bytes(tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode())
        ours = set(regex.findall(kind, every))
        differ |= {ord(c): "\u0378" for c in ours - theirs if ord(c) not in differ} | {ord(c): stand_in for c in theirs - ours}
    return differ


class ByteEncoder:
    """Encodes and decodes whole texts."""

    _CUT = regex.compile(r"(?<=\S)\s")

    def __init__(self, ranks: Ranks, pattern: str):
        self.merger, self.pattern, self.strange = Merger(ranks), regex.compile(pattern), strange_characters()
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.strange_set = frozenset(map(chr, self.strange))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _blocks(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > BLOCK:
            cut = self._CUT.search(text, at + BLOCK)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _matches(self, block: str) -> list[str]:
        if block.isascii() or self.strange_set.isdisjoint(block):
            return self.pattern.findall(block)
        return [block[m.start():m.end()] for m in self.pattern.finditer(block.translate(self.strange))]

    def _learn(self, matches: set[str]) -> None:
        if len(self.known) > _REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for x in matches.difference(known):
            if (found := older.get(x)) is not None:
                known[x] = found
            else:
                new.append(x)
        known.update(zip(new, self.merger.many([x.encode() for x in new]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []

        def settle() -> None:
            self._learn(set().union(*(m for _, m in held)))
            for n, matches in held:
                out[n].append(b"".join(map(self.known.__getitem__, matches)))
            held.clear()

        size = 0
        for n, text in enumerate(texts):
            for block in self._blocks(text):
                held.append((n, self._matches(block)))
                size += len(held[-1][1])
                if size >= MATCHES:
                    settle()
                    size = 0
        settle()
        return [b"".join(x) for x in out]

    def decode(self, ids: list[bytes | None]) -> list[bytes | None]:
        token = self.tokens.__getitem__
        return [None if x is None else b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in ids]


_encoders: dict[tuple[str, str], ByteEncoder] = {}


def _encoder(path: str, pattern: str) -> ByteEncoder:
    """One per worker process, so that matches met in earlier tasks stay known."""
    if (path, pattern) not in _encoders:
        with open(path, "rb") as file:
            _encoders[path, pattern] = ByteEncoder(parse_ranks(file.read()), pattern)
    return _encoders[path, pattern]


def _mapped(rows: DataFrame, columns: tuple[str, ...], made) -> DataFrame:
    """Rows of (doc_id, x) as (doc_id, *columns): the lists of binary values that ``made()`` returns for a list of x, in
    batches of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.binary()) for c in many(held))], names=["doc_id", *columns])

        many, ids, held, size = made(), [], [], 0
        for batch in batches:
            for doc, x in zip(batch["doc_id"].to_pylist(), batch["x"], strict=True):
                ids.append(doc)
                held.append(x.as_py())
                size += len(held[-1] or b"") + 64
                if size >= BATCH_BYTES:
                    yield full()
                    ids, held, size = [], [], 0
        if ids:
            yield full()

    return rows.mapInArrow(run, ", ".join(["doc_id bigint", *(f"{c} binary" for c in columns)]))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each row's whole text, as little-endian unsigned 32-bit integers in a row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("x"))
    return _mapped(rows, ("ids",), lambda: lambda texts: (_encoder(ranks_path, pattern).encode(texts),))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded): each row's ids and the bytes that they stand for."""
    rows = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).alias("x"))
    return _mapped(rows, ("ids", "decoded"), lambda: lambda ids: (ids, _encoder(ranks_path, pattern).decode(ids)))

"""Best-fit-decreasing packing of tokenised documents into fixed windows.

A document's ids are cut into full windows first; what is left over is shorter than a window. Remainders are packed
longest first: a segment tree indexed by remaining capacity gives the open window with the least room that still
suffices, and a new window is opened if there is none. Pieces are dealt into shares of bounded size by a number that
was written with them, so no task gets more than a share, however the documents are distributed.

Ids come from the given tokenizer. White space never joins two words there, so a text is encoded as the sequence of
its space-separated strings, each of which a worker encodes once and then looks up.

Defined results: a null or empty text has the end id only; repeated rows are packed once each; rows with a null id are
packed like others; an empty table gives no rows. Extra columns are neither read nor required.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

WINDOW = 4096
END_ID = 2
#: Pieces that one share holds at most on average; a share's last windows are the only ones that stay half empty.
SHARE = 4096
#: Words that a worker keeps the ids of before it starts anew, and strings before it sets them aside as the older ones. Strings are
#: mostly words with their punctuation, which are soon put together from known words; so fewer of them are kept.
_REMEMBERED = 500_000
_STRINGS = 150_000


class WordEncoder:
    """Ids of whole texts by a tokenizer file whose pre-tokenizer never joins strings across white space and parts
    letters from punctuation. Strings of plain letters and closing punctuation go to the model word by word; all
    others go through the whole tokenizer. What was met is looked up."""

    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.strings, self.older, self.words = Tokenizer.from_file(path), {}, {}, {}
        self.model = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {code: as_bytes.pre_tokenize_str(chr(code))[0][0] for code in [*range(33, 127), *range(0xDF, 0x100)]}
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= _REMEMBERED:
                self.words.clear()
            tokens = self.model.tokenize(word if word.isascii() else word.translate(self.bytes))
            found = self.words[word] = array(self.kind, [t.id for t in tokens]).tobytes()
        return found

    def _string(self, text: str) -> bytes:
        if text.isalpha() and text.isascii():
            return self._word(text.lower())
        if plain := self.PLAIN.fullmatch(text):
            return self._word(plain[1].lower()) + (self._word(plain[2]) if plain[2] else b"")
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids. Only plain spaces, tabs and line ends split; other white space is left to the
        tokenizer."""
        strings = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        known, older = self.strings, self.older
        try:
            found = list(map(known.__getitem__, strings))
        except KeyError:
            for x in [x for x in set(strings) if x not in known]:
                known[x] = older.get(x) or self._string(x)
            found = list(map(known.__getitem__, strings))
            if len(known) > _STRINGS:  # the strings of the last while stay at hand
                self.strings, self.older = {}, known
        return np.frombuffer(b"".join(found), self.kind).astype("<u4")


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and file, so that words met in earlier tasks stay known."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           end_id: int = END_ID) -> DataFrame:
    """Full windows and the remainder of each document, in PIECES' columns."""
    end = np.array([end_id], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        for batch in batches:
            rows = []
            for doc, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                ids = np.concatenate([encode(text.as_py() or ""), end])
                rows += [(doc, at, min(window, len(ids) - at), zlib.crc32(ids[at:at + window].tobytes()), len(ids)) for at in range(0, len(ids), window)]
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


class RoomTree:
    """Segment tree over remaining capacity 0..window: which capacities have an open window, and the least one that
    is at least a given length."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        at = room + self.leaves
        while at and not self.open[at]:
            self.open[at] = 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, window) of the tightest open window, which is closed."""
        at, is_open = length + self.leaves, self.open
        if not is_open[at]:
            # climb until a right neighbour holds a larger capacity, then descend to its smallest
            while at > 1 and (at & 1 or not is_open[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if is_open[2 * at] else 2 * at + 1
        room = at - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            is_open[at] = 0
            at >>= 1
            while at and not (is_open[2 * at] or is_open[2 * at + 1]):
                is_open[at] = 0
                at >>= 1
        return room, window


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; sequences are numbered from 0."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = RoomTree(window), 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = tree.take(length)
        if found is None:
            found = window, opened
            opened += 1
        room, own = found
        sequence[piece], offset[piece] = own, window - room
        if room > length:
            tree.put(room - length, own)
    return sequence, offset


PACKED = PIECES + ", sequence_id bigint, offset bigint"


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         share: int = SHARE) -> DataFrame:
    """One row per piece with its place. A sequence id is the share's number times 2^32 plus the window's number in it."""
    cut = written(pieces(docs, tokenizer, id_col, text_col, window).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    shares = max(1, -(-cut.count() // share))

    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("piece", ignore_index=True)  # the same places whatever order the rows arrive in
        own, offset = best_fit_decreasing(part["length"].to_numpy(), window)
        return part.drop(columns=["piece", "share"]).assign(sequence_id=(int(part["share"].iloc[0]) << 32) + own, offset=offset)

    dealt = cut.withColumn("share", F.pmod(F.xxhash64("piece"), F.lit(shares)))
    return dealt.groupBy("share").applyInPandas(place, PACKED)

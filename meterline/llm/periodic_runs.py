"""Runs (maximal periodic stretches) of words, by a suffix automaton whose suffix-link tree is kept in link-cut paths.

Words are appended one by one. The states from the new prefix up to the root are its suffixes; a path of the link-cut tree
holds states whose strings ended last at the same word. Appending a word accesses the new state, which gives the whole
way to the root the new word's number and, on the way, meets each older path with the number p it had. The deepest state
met there ends at p and at the new word i; if its strings are at least i - p long, the two occurrences touch, and the
words from there to i are a square of period i - p. As p is the last occurrence, no smaller period fits. A square that
no found run covers is extended in both directions to its run.

Before that, a text is cut where no wanted run can be: in a run of at least ``exponent`` periods every three words in a
row come exponent - 1 times or more, so three words that are rarer in their stretch part it (both parts keep the two
words they share). This is repeated in the parts, and only what is left goes through the automaton; for an exponent
of 2 it cuts nothing. Runs are extended over the whole text, cuts or not.

Defined results: words are the stretches without white space of ASCII, compared byte for byte; a null or empty text has
no words, no runs and an empty collapsed text; equal rows and null ids get a row each; an empty table gives no rows. A
document is read by one task: its runs may reach over all of it. Extra columns are neither read nor returned.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 6
EXPONENT = 4
BATCH_BYTES = 1 << 23
Run = tuple[int, int, int]  # start, length, period


class SuffixPaths:
    """Suffix automaton of the words appended so far. State 0 stands for none and 1 for the empty string.

    up, left and right are splay trees of the paths, ordered by depth; the up of a splay root names the state above its
    path. seen is the number of the word at which a path's strings ended last; it is kept at the splay root only."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}, {}]
        self.link, self.length = array("q", (0, 0)), array("q", (0, 0))
        self.up, self.left, self.right = (array("q", (0, 0)) for _ in range(3))
        self.seen = array("q", (0, -1))
        self.last, self.words = 1, 0

    def _state(self, length: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.length.append(length)
        for column in (self.link, self.up, self.left, self.right, self.seen):
            column.append(0)
        return len(self.next) - 1

    def _splay(self, x: int) -> None:
        up, left, right, seen = self.up, self.left, self.right, self.seen
        while True:
            p = up[x]
            if not p:
                return
            if left[p] == x:
                on_left = True
            elif right[p] == x:
                on_left = False
            else:
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                turned = p if (left[g] == p) == on_left else x  # in a line the parent turns first
                self._turn(turned)
                seen[x] = seen[g]
            else:
                seen[x] = seen[p]
            self._turn(x)

    def _turn(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p] = x
        up[x] = g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def append(self, word: int) -> list[tuple[int, int]]:
        """(period, length) of what ends at this word: ``length`` words that also end ``period`` words before."""
        nexts, link, length, up, left = self.next, self.link, self.length, self.up, self.left
        now, self.words = self.words, self.words + 1
        new, state = self._state(now + 1, {}), self.last
        self.last = new
        while state and word not in nexts[state]:
            nexts[state][word] = new
            state = link[state]
        if not state:
            above = 1
        else:
            above = nexts[state][word]
            if length[above] != length[state] + 1:
                deep, above = above, self._state(length[state] + 1, nexts[above].copy())
                while state and nexts[state].get(word) == deep:
                    nexts[state][word] = above
                    state = link[state]
                link[above], link[deep] = link[deep], above
                # between ``deep`` and the state above it, on deep's path: both ended last at the same word
                self._splay(deep)
                shallower = left[above] = left[deep]
                if shallower:
                    up[shallower] = above
                left[deep], up[above] = above, deep
        link[new] = up[new] = above
        return self._access(new, now)

    def _access(self, new: int, now: int) -> list[tuple[int, int]]:
        up, right, seen, length = self.up, self.right, self.seen, self.length
        squares, below, state = [], new, up[new]
        while state:
            self._splay(state)
            ended = seen[state]
            if now - ended <= length[state]:
                squares.append((now - ended, length[state]))
            if right[state]:
                seen[right[state]] = ended  # the deeper part stays behind as a path of its own
            right[state] = below
            below, state = state, up[state]
        seen[below] = now
        return squares


def stretches(words: np.ndarray, min_length: int, exponent: int) -> list[tuple[int, int]]:
    """(start, stop) of the parts of a text that can hold runs of these sizes."""
    least = min(exponent - 1, max(min_length, exponent) - 2)
    whole = max(min_length, exponent)
    if len(words) < whole:
        return []
    if least < 2:
        return [(0, len(words))]
    two = np.unique(words[:-1] * (words.max() + 1) + words[1:], return_inverse=True)[1]
    three = np.unique(two[:-1] * (words.max() + 1) + words[2:], return_inverse=True)[1]
    todo, found = [(0, len(words))], []
    while todo:
        start, stop = todo.pop()
        if stop - start < whole:
            continue
        own = three[start:stop - 2]
        if len(own) * 8 < len(three):
            own = np.unique(own, return_inverse=True)[1]
        rare = np.flatnonzero(np.bincount(own)[own] < least) + start
        if not len(rare):
            found.append((start, stop))
            continue
        # what follows a rare place starts at its second word, what precedes it ends with that word
        starts, stops = np.r_[start, rare + 1], np.r_[rare + 2, stop]
        keep = stops - starts >= whole
        todo += zip(starts[keep].tolist(), stops[keep].tolist(), strict=True)
    return sorted(found)


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[Run]:
    """All runs of at least ``min_length`` words and ``exponent`` periods, by start and then period."""
    own, found = words.tolist(), set()
    for start, stop in stretches(words, min_length, exponent):
        paths, covered = SuffixPaths(), {}
        for now in range(start, stop):
            for period, length in paths.append(own[now]):
                if covered.get(period, 0) > now:
                    continue
                first, after = now - length - period + 1, now + 1
                while first > 0 and own[first - 1] == own[first - 1 + period]:
                    first -= 1
                while after < len(own) and own[after] == own[after - period]:
                    after += 1
                covered[period] = after
                if after - first >= max(min_length, exponent * period):
                    found.add((first, after - first, period))
    return sorted((first, length, period) for first, length, period in found)


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words outside every run's repetitions: a run keeps its first period only."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(kept).tolist()]


def number_words(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): each row's runs by start and period, and its words without the repetitions,
    joined by single spaces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def full() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), _RUNS, pa.string()), strict=True)], names=["doc_id", "n_words", "runs", "collapsed"])

        out, held = [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                words = (text.as_py() or "").encode().split()  # bytes split at ASCII white space only
                runs = find_runs(number_words(words), min_length, exponent) if len(words) >= max(min_length, exponent) else []
                collapsed = b" ".join(collapse(words, runs))
                out.append((doc, len(words), [{"start": s, "length": n, "period": p} for s, n, p in runs], collapsed.decode()))
                held += len(collapsed) + 64
                if held >= BATCH_BYTES:
                    yield full()
                    out, held = [], 0
        if out:
            yield full()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")

"""SentencePiece encoding and decoding; giant texts by a max-plus scan over chunks.

The model merges the best-scored adjacent pair until none is left. A sequence of pieces is that result exactly if each
piece comes out of its own characters and each adjacent pair comes out of its joined characters, so the encoding is
the only path through the text whose every step scores 0 and not minus infinity. That makes it a max-plus problem:

* a text beyond CHUNK characters is cut into chunks, each with a few characters of context;
* a boundary state is the piece that ends at or crosses the boundary; a chunk's transfer matrix holds the best score
  from each entry state to each exit state (0, or absent for minus infinity);
* matrices are multiplied in max-plus, prefix by prefix, which fixes the state at every boundary;
* each chunk is then traced back by itself between its two states.

Words don't share pieces: where a mark of white space follows another character every path meets, so inside a chunk
only its first and last word depend on the states, and the words between are looked up. A chunk without such a place
(one giant word) is scanned in full. Decoding runs on each chunk's pieces by itself.

Defined results: a null or empty text has no pieces and decodes to itself; repeated rows get equal results (equal giant
texts are encoded once); characters outside the vocabulary become byte pieces; a text with the literal mark U+2581
decodes with a space in its place, so it isn't ``round_trip``; an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

CHUNK = 1 << 15
MARK = "▁"
_REMEMBERED = 500_000
Arc = tuple[int, int]  # start and end of a piece


class PieceModel:
    """Pieces and scores of a model file, its merge rule, and words looked up."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [k for k in range(sp.vocab_size()) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))]
        self.scores = {sp.id_to_piece(k): sp.get_score(k) for k in plain}
        self.ids = {sp.id_to_piece(k): k for k in plain}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.scores))
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._alone: dict[str, bool] = {}
        self._follows: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """The merge rule by itself: best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            score, at = max(((self.scores.get(x + y, -np.inf), -k) for k, (x, y) in enumerate(zip(parts, parts[1:]))))
            if score == -np.inf:
                break
            parts[-at:2 - at] = [parts[-at] + parts[1 - at]]
        return parts

    def alone(self, piece: str) -> bool:
        """Whether a piece is a step of some path: any single character, or a piece that its characters give."""
        found = self._alone.get(piece)
        if found is None:
            found = self._alone[piece] = len(piece) == 1 or (piece in self.scores and self.merge(piece) == [piece])
        return found

    def follows(self, x: str, y: str) -> bool:
        """Whether ``y`` may come right after ``x``: the score of the step is 0, else minus infinity."""
        found = self._follows.get((x, y))
        if found is None:
            if len(self._follows) > _REMEMBERED:
                self._follows.clear()
            found = self._follows[x, y] = self.merge(x + y) == [x, y]
        return found

    def piece_ids(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            found = self.ids.get(p)
            out += [found] if found is not None else [self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]
        return out

    def units(self, marked: str) -> bytes:
        """Ids (32-bit) of a text that begins a word and ends one, spaces already marked."""
        if MARK * 2 in marked or not marked.startswith(MARK):
            words = list(_split_words(marked))
        else:
            words = [MARK + w for w in marked[1:].split(MARK)]
        known = self.words
        lost = [w for w in set(words) if w not in known]
        if lost:
            new = []
            for w in lost:
                if w in self.older:
                    known[w] = self.older[w]
                elif w.startswith(MARK) and w.strip(MARK) and "\0" not in w:
                    new.append(w)
                else:  # white space only: the library would drop it
                    known[w] = array("I", self.piece_ids(self.merge(w))).tobytes()
            for w, ids in zip(new, self.library.encode([w[1:].replace(MARK, " ") for w in new], num_threads=1), strict=True):
                known[w] = array("I", ids).tobytes()
        out = b"".join(map(known.__getitem__, words))
        if len(known) > _REMEMBERED:
            self.words, self.older = {}, known
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of pieces that needn't begin a text: a first mark stays a space."""
        return self.library.decode([self.ids[MARK], *ids]) if ids else ""


def _split_words(marked: str) -> Iterator[str]:
    start = 0
    for at in range(1, len(marked)):
        if marked[at] == MARK and marked[at - 1] != MARK:
            yield marked[start:at]
            start = at
    if marked:
        yield marked[start:]


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def _meets(s: str, at: int) -> bool:
    """Whether every path has a boundary at ``at``: a word begins there."""
    return 0 < at < len(s) and s[at] == MARK and s[at - 1] != MARK


def entry_states(model: PieceModel, s: str, at: int) -> list[Arc]:
    """All pieces that end at ``at`` or cross it, by position in ``s``."""
    out = []
    for start in range(max(0, at - model.longest), at):
        for end in range(at, min(len(s), start + model.longest) + 1):
            if model.alone(s[start:end]):
                out.append((start, end))
    return out


def scan(model: PieceModel, s: str, seeds: dict[Arc | None, int], start: int, stop: int, back: dict | None = None) -> dict[Arc, int]:
    """Max-plus steps from seed states to the states at ``stop``: for each state the set (bits) of seeds with a path
    of score 0. A seed None stands for a free start at ``start``. ``back`` gets each state's predecessors."""
    ends: dict[int, dict[Arc | None, int]] = {}
    done: dict[Arc, int] = {}
    for arc, bits in seeds.items():
        if arc is not None and arc[1] >= stop:
            done[arc] = done.get(arc, 0) | bits
        else:
            ends.setdefault(start if arc is None else arc[1], {})[arc] = bits
    for at in range(start, stop):
        before = ends.pop(at, None)
        if not before:
            continue
        free = _meets(s, at)
        for end in range(at + 1, min(len(s), at + model.longest) + 1):
            piece = s[at:end]
            if not model.alone(piece):
                continue
            bits = 0
            for arc, own in before.items():
                if arc is None or free or model.follows(s[arc[0]:arc[1]], piece):
                    bits |= own
                    if back is not None:
                        back.setdefault((at, end), []).append(arc)
            if bits:
                here = done if end >= stop else ends.setdefault(end, {})
                here[at, end] = here.get((at, end), 0) | bits
    return done


def _meeting_places(s: str, low: int, high: int) -> tuple[int, int] | None:
    """First and last place in [low, high] where all paths meet."""
    first = next((k for k in range(low, high + 1) if _meets(s, k)), None)
    if first is None:
        return None
    return first, next(k for k in range(high, low - 1, -1) if _meets(s, k))


def transfer(model: PieceModel, s: str, low: int, high: int, first: bool, last: bool) -> list[tuple[Arc | None, Arc | None]]:
    """The entries of score 0 of a chunk's transfer matrix; ``s`` holds the chunk at low..high with context. None is the
    state before a text's begin and behind its end."""
    entries: list[Arc | None] = [None] if first else entry_states(model, s, low)
    seeds = {arc: 1 << k for k, arc in enumerate(entries)}
    places = _meeting_places(s, low, high)

    def leave(states: dict[Arc, int]) -> dict[Arc | None, int]:
        if not last:
            return states
        whole = 0
        for arc, bits in states.items():
            whole |= bits if arc[1] == high else 0
        return {None: whole} if whole else {}

    if places is None:
        out = leave(scan(model, s, seeds, low, high))
        return [(e, x) for x, bits in out.items() for k, e in enumerate(entries) if bits >> k & 1]
    head = scan(model, s, seeds, low, places[0]) if places[0] > low else seeds
    through = 0
    for arc, bits in head.items():
        through |= bits if (places[0] if arc is None else arc[1]) == places[0] else 0
    tail = leave(scan(model, s, {None: 1}, places[1], high)) if places[1] < high else {x: 1 for x in entry_states(model, s, high) if x[1] == high}
    return [(e, x) for k, e in enumerate(entries) if through >> k & 1 for x in tail]


def _path(model: PieceModel, s: str, entry: Arc | None, start: int, stop: int, exit_: Arc | None) -> list[str]:
    """Pieces of the path from ``entry`` to ``exit_`` (None: one that ends at ``stop``), without the entry's own."""
    begin = start if entry is None else entry[1]
    if exit_ is not None and exit_ == entry:
        return []
    back: dict = {}
    states = scan(model, s, {entry: 1}, begin, stop, back)
    at = exit_ if exit_ is not None else next((x for x in states if x[1] == stop), None)
    arcs = []
    while at is not None and at != entry:
        arcs.append(at)
        at = back[at][0]  # all recorded predecessors lie on paths of score 0, and there is one such path
    return [s[a:b] for a, b in reversed(arcs)]


def trace(model: PieceModel, s: str, low: int, high: int, entry: Arc | None, exit_: Arc | None) -> list[int]:
    """Ids of the pieces that end in (low, high], or start in the chunk and cross its end: each piece belongs to the
    chunk in which it starts. ``entry`` has been counted by the chunk before."""
    places = _meeting_places(s, low, high)
    if places is None or (entry is not None and entry[1] > places[1]):
        return model.piece_ids(_path(model, s, entry, low, high, exit_))
    begin = low if entry is None else entry[1]
    head = _path(model, s, entry, low, places[0], None) if begin < places[0] else []
    middle = np.frombuffer(model.units(s[places[0]:places[1]]), "<u4").tolist() if places[1] > places[0] else []
    tail = _path(model, s, None, places[1], high, exit_) if places[1] < high else []
    return model.piece_ids(head) + middle + model.piece_ids(tail)


def compose(x: list, y: list) -> list:
    """Max-plus product of two transfer matrices given by their entries of score 0."""
    by_entry: dict = {}
    for e, z in y:
        by_entry.setdefault(e, []).append(z)
    return list(dict.fromkeys((e, z) for e, m in x for z in by_entry.get(m, ())))


def resolve(matrices: list[list[tuple]]) -> list[tuple]:
    """The (entry, exit) of every chunk on the only path through all of them; states are relative to boundaries."""
    ahead: list[list] = [[]] * len(matrices)
    ahead[-1] = matrices[-1]
    for k in range(len(matrices) - 2, -1, -1):  # suffix products: what still reaches the end
        ahead[k] = compose(matrices[k], ahead[k + 1])
    out, state = [], None
    for k, own in enumerate(matrices):
        alive = {e for e, _ in ahead[k + 1]} if k + 1 < len(matrices) else None
        step = next(((e, x) for e, x in own if e == state and (alive is None or x in alive)), None)
        if step is None:
            raise ValueError(f"no path through chunk {k}")
        out.append(step)
        state = step[1]
    return out


def encode_in_chunks(model: PieceModel, text: str, chunk: int = CHUNK) -> list[list[int]]:
    """The scan in one process: ids by chunk."""
    parts = list(chunks_of(text, chunk, model.longest))
    steps = resolve([_relative(transfer(model, s, low, high, n == 0, n == len(parts) - 1), low, high) for n, s, low, high in parts])
    return [trace(model, s, low, high, _shift(e, low), _shift(x, high)) for (n, s, low, high), (e, x) in zip(parts, steps, strict=True)]


def chunks_of(text: str, chunk: int, context: int) -> Iterator[tuple[int, str, int, int]]:
    """(number, part with context, where the chunk begins and ends in it)."""
    s = marked(text)
    for n, at in enumerate(range(0, len(s), chunk)):
        left = max(0, at - context - 1)
        yield n, s[left:at + chunk + context + 1], at - left, min(at + chunk, len(s)) - left


def _shift(arc: Arc | None, by: int) -> Arc | None:
    return None if arc is None else (arc[0] + by, arc[1] + by)


def _relative(pairs: list[tuple], low: int, high: int) -> list[tuple]:
    return [(_shift(e, -low), _shift(x, -high)) for e, x in pairs]


def _sums(ids: list[int]) -> tuple[int, int, int]:
    x = np.array(ids, np.int64)
    return len(x), int(x.sum()), int((x * np.arange(1, len(x) + 1)).sum())


_RESULT = "n_tokens bigint, n_chunks bigint, ids_checksum bigint, round_trip boolean"


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_tokens, n_chunks, ids_checksum, round_trip), one row per row of ``docs``. ids_checksum is the sum of id times
    place (from 1), which chunks add up to; round_trip says that the pieces decode to the text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            out = []
            for text in batch["text"]:
                text = text.as_py()
                ids = np.frombuffer(model.units(marked(text)), "<u4").tolist()
                n, _, checksum = _sums(ids)
                out.append((n, 1, checksum, model.library.decode(ids) == text))
            yield _columns(batch["doc_id"], out)

    short = rows.where(F.length("text") < chunk).mapInArrow(whole, "doc_id bigint, " + _RESULT)
    long = written(rows.where(F.length("text") >= chunk).withColumn("key", F.sha2("text", 256)), "giant-texts")
    giant = _encode_giants(long.dropDuplicates(["key"]).select("key", "text"), model_path, chunk)
    return short.union(long.select("doc_id", "key").join(giant, "key").drop("key"))


def _columns(ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([ids, *(pa.array([o[k] for o in out], t) for k, t in enumerate(kinds))], names=["doc_id", "n_tokens", "n_chunks", "ids_checksum", "round_trip"])


_STATE = "struct<a:int,b:int>"


def _encode_giants(texts: DataFrame, model_path: str, chunk: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = piece_model(model_path).longest
        for batch in batches:
            for key, text in zip(batch["key"].to_pylist(), batch["text"], strict=True):
                for n, s, low, high in chunks_of(text.as_py(), chunk, context):
                    yield pa.RecordBatch.from_pydict({"key": [key], "n": pa.array([n], pa.int32()), "s": [s], "low": pa.array([low], pa.int32()), "high": pa.array([high], pa.int32())})

    parts = texts.mapInArrow(cut, "key string, n int, s string, low int, high int")
    count = parts.select("key", "n").groupBy("key").agg(F.max("n").alias("last"))
    parts = written(parts.join(count, "key").repartition("key", "n"), "giant-chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            found = [_relative(transfer(model, s, low, high, n == 0, n == last), low, high)
                     for s, low, high, n, last in zip(*(batch[c].to_pylist() for c in ("s", "low", "high", "n", "last")), strict=True)]
            flat = [[None if v is None else {"a": v[0], "b": v[1]} for pair in pairs for v in pair] for pairs in found]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["n"], pa.array(flat, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], names=["key", "n", "m"])

    def fix(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("n")
        state = lambda v: None if v is None else (int(v["a"]), int(v["b"]))
        steps = resolve([[(state(e), state(x)) for e, x in zip(m[::2], m[1::2], strict=True)] for m in part["m"].map(list)])
        value = lambda v: None if v is None else {"a": v[0], "b": v[1]}
        return pd.DataFrame({"key": part["key"].to_numpy(), "n": part["n"].to_numpy(), "e": [value(e) for e, _ in steps], "x": [value(x) for _, x in steps]})

    states = written(parts.mapInArrow(matrices, f"key string, n int, m array<{_STATE}>").groupBy("key")
                     .applyInPandas(fix, f"key string, n int, e {_STATE}, x {_STATE}"), "giant-states")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            out = []
            for s, low, high, e, x in zip(*(batch[c].to_pylist() for c in ("s", "low", "high", "e", "x")), strict=True):
                entry, leave = (None if v is None else (v["a"] + by, v["b"] + by) for v, by in ((e, low), (x, high)))
                ids = trace(model, s, low, high, entry, leave)
                own = s[low if entry is None else entry[1]:high if leave is None else leave[1]]
                out.append((*_sums(ids), model.decode(ids) == own.replace(MARK, " ")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["key"], batch["n"], *(pa.array([o[k] for o in out], t) for k, t in enumerate(kinds))], names=["key", "n", "len", "s0", "s1", "ok"])

    done = parts.join(states, ["key", "n"]).select("key", "n", "s", "low", "high", "e", "x").mapInArrow(traced, "key string, n int, len bigint, s0 bigint, s1 bigint, ok boolean")

    def total(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("n")
        before = part["len"].cumsum() - part["len"]
        return pd.DataFrame({"key": [part["key"].iloc[0]], "n_tokens": [part["len"].sum()], "n_chunks": [len(part)],
                             "ids_checksum": [(part["s1"] + before * part["s0"]).sum()], "round_trip": [bool(part["ok"].all())]})

    return done.groupBy("key").applyInPandas(total, "key string, " + _RESULT)

"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased; every run of non-letters becomes one space. A model of order 4 is estimated for each
language: counts at the highest order, continuation counts below, one absolute discount per order, and a uniform
floor. All interpolated probabilities are computed ahead, so that a lookup is one search in a sorted array of hashed
grams whose rows hold one log-probability per language; a gram that no language has falls back to the next order
with the stored context weights. The language with the lowest cross-entropy per character wins. Rejection
thresholds come from the cross-entropy of rows that were kept out of the counts, as a function of text length.

Defined results: a null text or one without a letter is ``und`` with score 0 and counts as rejected; ties go to the
language that sorts first; repeated rows get equal results; without any usable training row all texts are ``und``.
Extra columns are neither read nor required.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, hash_below

UNKNOWN = "und"
ORDER = 4
#: Training rows of each language (expected number; chosen by a hash of the id): a quarter calibrates, the rest is counted.
FIT_ROWS = 1_200
#: Rejected is what lies this many deviations above the language's own cross-entropy at that length.
REJECT_AT = 8.0
#: Codes that a symbol can have.
ALPHABET = 1 << 16
_GAP = "\x00" * (ORDER - 1)
_BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)  # odd, so multiplying is a bijection of 64-bit words


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def _symbols(text: str, after_letter: bool = False) -> tuple[np.ndarray, np.ndarray, bool]:
    """Codes of the normalised text (letters and single spaces; gaps stay), which of the input they were, and
    whether it ends in a letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    gap = codes == 0
    letter = _letters()[codes]
    codes = np.minimum(codes, 0xFFFF)  # which stands for all letters beyond the basic plane
    keep = letter | gap
    keep[1:] |= letter[:-1]  # one space after each run of letters
    keep[:1] |= after_letter
    return np.where(letter, codes, np.where(gap, 0, 32))[keep].astype(np.uint64), keep, bool(letter[-1])


def _keys(symbols: np.ndarray) -> np.ndarray:
    """Packed grams of ORDER symbols ending at each position from ORDER-1 on; a gap counts as spaces."""
    s = np.where(symbols == 0, np.uint64(32), symbols)
    n = len(s) - ORDER + 1
    key = s[:n].copy()
    for k in range(1, ORDER):
        key = (key << np.uint64(16)) | s[k:k + n]
    return key


def _blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, symbols): symbols with the number of the text that each belongs to; the first ORDER-1 are context
    only. Short texts share a block; a giant text runs through several, each with the end of the last as context."""
    part: list[str] = []
    who: list[int] = []
    size = 0

    def emit():
        symbols, keep, _ = _symbols("".join(part))
        starts = np.cumsum([0, *map(len, part)])[:-1]
        place = np.concatenate([[0], np.cumsum(keep)])[starts]  # where each text begins among the symbols
        return np.repeat(np.array(who), np.diff(np.append(place, len(symbols)))), symbols

    for number, text in enumerate(texts):
        low = text.lower().replace("\x00", " ")
        if not low:
            continue
        if len(low) > _BLOCK:
            tail, after = np.zeros(ORDER - 1, np.uint64), False
            for at in range(0, len(low), _BLOCK):
                symbols, _, after = _symbols(low[at:at + _BLOCK], after)
                symbols = np.concatenate([tail, symbols])
                yield np.full(len(symbols), number), symbols
                tail = symbols[1 - ORDER:]
            continue
        if size and size + len(low) > _BLOCK:
            yield emit()
            part, who, size = [], [], 0
        part.append(_GAP + low)
        who.append(number)
        size += len(low)
    if part:
        yield emit()


def count_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct packed grams of ORDER symbols over whole texts, with their counts."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for _, symbols in _blocks(texts):
        keys = _keys(symbols)[symbols[ORDER - 1:] != 0]
        found.append(np.unique(keys, return_counts=True))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([c for _, c in found])).astype(np.int64)


class HashArray:
    """Rows of floats under 64-bit keys: the hashed keys lie sorted in one array."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        hashed = keys * _ODD
        order = np.argsort(hashed)
        self.hashed, self.rows = hashed[order], rows[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers, and which of the keys are there."""
        hashed = keys * _ODD
        at = np.minimum(np.searchsorted(self.hashed, hashed), max(0, len(self.hashed) - 1))
        return at, (self.hashed[at] == hashed) if len(self.hashed) else np.zeros(len(keys), bool)


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << (16 * order)) - 1)


@dataclass
class LanguageModels:
    languages: list[str]
    grams: list[HashArray]      # by order 1..ORDER: log-probabilities
    contexts: list[HashArray]   # by context length 1..ORDER-1: log-weights of the lower order
    floor: np.ndarray           # log-probability of a symbol that no language has, by language
    limits: np.ndarray          # [languages, 3]: mean, squared deviation between texts, and per character
    temperature: float = 1.0

    def _log_probs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        keys = keys & _mask(order) if order < ORDER else keys
        at, there = self.grams[order - 1].find(keys)
        out = self.grams[order - 1].rows[at] if len(self.grams[order - 1].rows) else np.zeros((len(keys), len(self.languages)), np.float32)
        if not there.all():
            lost = keys[~there]
            if order == 1:
                out[~there] = self.floor
            else:
                lower = self._log_probs(lost, order - 1)
                at, known = self.contexts[order - 2].find(lost >> np.uint64(16))
                lower[known] += self.contexts[order - 2].rows[at[known]]
                out[~there] = lower
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character [texts, languages] and the number of scored characters of each text."""
        total, count = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for owner, symbols in _blocks(texts):
            scored = symbols[ORDER - 1:] != 0
            own, probs = owner[ORDER - 1:][scored], self._log_probs(_keys(symbols)[scored])
            for k in range(len(self.languages)):
                total[:, k] -= np.bincount(own, probs[:, k], len(texts))
            count += np.bincount(own, minlength=len(texts))
        return total / np.maximum(count, 1)[:, None], count

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """Columns lang_pred, score, rejected and cross_entropy."""
        texts = [t or "" for t in texts]
        if not self.languages:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "rejected": True, "cross_entropy": None})
        ce, n = self.entropies(texts)
        letters = n > 0  # a text without a letter keeps no symbol at all
        best = ce.argmin(axis=1)
        least = ce[np.arange(len(texts)), best]
        score = 1 / np.exp(np.clip(-self.temperature * np.sqrt(n)[:, None] * (ce - least[:, None]), -700, 0)).sum(axis=1)
        mean, between, within = self.limits[best].T
        limit = mean + REJECT_AT * np.sqrt(between + within / np.maximum(n, 1))
        return pd.DataFrame({
            "lang_pred": np.where(letters, np.array(self.languages, object)[best], UNKNOWN),
            "score": np.where(letters, score, 0.0), "rejected": ~letters | (least > limit),
            "cross_entropy": np.where(letters, least, np.nan)})


def estimate(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> LanguageModels:
    """Interpolated Kneser-Ney models from the gram counts of each language."""
    languages = sorted(counts)
    by_order: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {ORDER: [counts[x] for x in languages]}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: in how many grams of one more symbol it ends
        by_order[order] = [np.unique(keys & _mask(order), return_counts=True) for keys, _ in by_order[order + 1]]
    size = ALPHABET  # the uniform floor: a letter that no language has is no likelier than any other
    grams, contexts, below, below_keys = [], [], None, None
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([k for k, _ in by_order[order]]))
        # interpolation base: the lower order's probability of the gram without its first symbol
        base = np.full((len(union), len(languages)), 1.0 / size) if order == 1 else below[np.searchsorted(below_keys, union & _mask(order - 1))]
        prob = np.empty_like(base)
        heads = np.unique(union >> np.uint64(16))
        weights = np.ones((len(heads), len(languages)))
        for k, (keys, count) in enumerate(by_order[order]):
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
            own, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            mass, kinds = np.bincount(at, count, len(own)), np.bincount(at, minlength=len(own))
            weights[np.searchsorted(heads, own), k] = discount * kinds / np.maximum(mass, 1)
            direct = np.zeros(len(union))
            direct[np.searchsorted(union, keys)] = (count - discount) / mass[at]
            prob[:, k] = direct + weights[np.searchsorted(heads, union >> np.uint64(16)), k] * base[:, k]
        grams.append(HashArray(union, np.log(prob).astype(np.float32)))
        if order == 1:
            floor = np.log(weights[0] / size)
        else:
            contexts.append(HashArray(heads, np.log(weights).astype(np.float32)))
        below, below_keys = prob, union
    return LanguageModels(languages, grams, contexts, floor, np.tile([1e9, 0.0, 0.0], (len(languages), 1)))


def calibrate(model: LanguageModels, texts: list[str], truth: list[str]) -> LanguageModels:
    """Rejection limits and the temperature of the score, from rows that the counts have not seen."""
    ce, n = model.entropies(texts)
    ok = n > 0
    ce, n, own = ce[ok], n[ok], np.array([model.languages.index(x) for x in truth], int)[ok]
    for k in range(len(model.languages)):
        x, m = ce[own == k, k], n[own == k]
        if len(x) < 20:
            continue  # too few rows to reject by: nothing of this language is rejected
        centre = np.average(x, weights=np.sqrt(m))
        square = (x - centre) ** 2
        fit = np.linalg.lstsq(np.stack([np.ones(len(m)), 1 / m], 1), square, rcond=None)[0]
        model.limits[k] = centre, max(fit[0], np.quantile(square, 0.95) / 9, 0.02), max(fit[1], 2.0)  # floors: texts that mix languages stay
    best, scale = np.inf, 1.0
    for t in (0.25, 0.5, 1, 2, 4, 8):
        z = -t * np.sqrt(n)[:, None] * (ce - ce.min(axis=1, keepdims=True))
        loss = (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), own]).mean() if len(z) else 0
        if loss < best - 1e-9:
            best, scale = loss, t
    model.temperature = scale
    return model


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> LanguageModels:
    """Learn from about ``fit_rows`` rows of each language (all, if there are fewer). Grams are counted on the
    executors and summed by language; what the driver gets is bounded by the sample."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).alias("lang")).where(
        "id is not null and t is not null and lang is not null")
    rates = {r["lang"]: min(1.0, fit_rows / r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not rates:
        return LanguageModels([], [], [], np.zeros(0), np.zeros((0, 3)))
    share = F.create_map(*[F.lit(x) for kv in rates.items() for x in kv])[F.col("lang")]
    taken = rows.where(F.pmod(F.xxhash64("id", F.lit(21)), F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
    held = hash_below("id", 0.25, 22)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, list[str]] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["t"].to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            keys, n = count_grams(own)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys), "gram": keys.view(np.int64), "n": n})

    sums = (taken.where(~held).select("lang", "t").mapInArrow(count, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    if not len(sums):
        return LanguageModels([], [], [], np.zeros(0), np.zeros((0, 3)))
    counts = {}
    for lang, part in sums.groupby("lang"):
        keys, order = part["gram"].to_numpy(np.int64).view(np.uint64), None
        order = np.argsort(keys)
        counts[lang] = keys[order], part["n"].to_numpy(np.int64)[order]
    model = estimate(counts)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ce, n = model.entropies(batch["t"].to_pylist())
            yield pa.RecordBatch.from_pydict({"id": batch["id"].cast(pa.string()), "lang": batch["lang"].cast(pa.string()), "n": n, "ce": pa.array(list(ce), pa.list_(pa.float64()))})

    seen = (taken.where(held).select("id", "lang", "t").mapInArrow(measure, "id string, lang string, n double, ce array<double>")
            .where(F.col("lang").isin(model.languages)).orderBy("id", "n").toPandas())
    return _calibrated(model, seen)


def _calibrated(model: LanguageModels, seen: pd.DataFrame) -> LanguageModels:
    class Known:  # the measured cross-entropies in the place of texts
        languages, limits = model.languages, model.limits

        @staticmethod
        def entropies(_):
            ce = np.array(seen["ce"].tolist(), float).reshape(-1, len(model.languages))
            return ce, seen["n"].to_numpy(float)

    known = Known()
    calibrate(known, [], seen["lang"].tolist())
    model.limits, model.temperature = known.limits, known.temperature
    return model


def predict_column(model: LanguageModels, text: str) -> Column:
    """Struct of lang_pred, score, rejected and cross_entropy for the text in column ``text``."""
    @F.pandas_udf("lang_pred string, score double, rejected boolean, cross_entropy double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield model.predict(list(part))
    return predict(F.col(text))


def keep_known(docs: DataFrame, model: LanguageModels, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text some learned language explains, with their own columns."""
    name = fresh(docs, "language")
    return docs.withColumn(name, predict_column(model, text_col)).where(~F.col(f"{name}.rejected")).drop(name)

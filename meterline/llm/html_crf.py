"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

Features of a block are the tags and the class, id and role words around it, its own tag, and its text: length, link
share, closing mark. The chain has two labels, article and outside. Weights are estimated by
maximum conditional likelihood (forward-backward, L2 penalty) on labelled pages and pages are decoded by Viterbi.

Defined results: a null or empty page and a page without article blocks give an empty text; pages are independent, so
repeated rows give equal results; malformed markup is read up to its end in linear time (html_blocks); whole pages
are read however long. Extra columns are neither read nor required.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import Block, leaf_blocks
from .html_pages import labelled_pages

TRAIN_PAGES = 1200
_WORDS, _LINKS = (2, 5, 10, 20, 40, 80), (0.01, 0.3, 0.7)


def features(blocks: list[Block]) -> list[list[str]]:
    out = []
    for b in blocks:
        words = b.text.count(" ") + 1
        tags, own = b.around.tags, b.around.own
        f = ["bias", f"own={own}", f"words={sum(words > x for x in _WORDS)}", f"links={sum(b.linked / len(b.text) > x for x in _LINKS)}",
             "stop" if b.text[-1] in ".!?…。！？" else "nostop"]
        f += [f"in={t}" for t in tags] + [f"name={x}" for x in b.around.names]
        where = "inside" if "article" in tags or "main" in tags else "around"
        f += [where, f"{where}/own={own}"]
        if "header" in tags:
            f.append(f"{where}/header")
        out.append(f)
    return out


@dataclass(frozen=True)
class Field:
    """Weights as differences in favour of the article label; steps[i][j]: from label i to label j."""
    weights: dict[str, float]
    steps: tuple[tuple[float, float], tuple[float, float]]

    @cached_property
    def known(self) -> frozenset[str]:
        """Tags and names that have a weight."""
        return frozenset(k.partition("=")[2] for k in self.weights if k.startswith(("in=", "name="))) | {"article", "main", "header"}

    def decode(self, blocks: list[Block]) -> list[int]:
        """Most likely labels (Viterbi); ties go to outside."""
        (s00, s01), (s10, s11) = self.steps
        weight, back, out, inside = self.weights.get, [], 0.0, 0.0
        for n, f in enumerate(features(blocks)):
            e = sum(weight(x, 0.0) for x in f)
            if n == 0:
                out, inside = 0.0, e
                continue
            a, b, c, d = out + s00, inside + s10, out + s01, inside + s11
            back.append((int(b > a), int(d > c)))
            out, inside = max(a, b), max(c, d) + e
        if not blocks:
            return []
        labels = [int(inside > out)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def train(pages: list[tuple[str, list[int]]], penalty: float = 0.1, rounds: int = 200, rate: float = 0.6) -> Field:
    """Full-batch maximum likelihood with all pages' chains stepped together."""
    names: dict[str, int] = {}
    chains = []
    for html, labels in pages:
        blocks = leaf_blocks(html)
        if len(blocks) != len(labels):
            raise ValueError("a labelled page has other blocks than labels")
        if blocks:
            chains.append(([[names.setdefault(x, len(names)) for x in f] for f in features(blocks)], labels))
    count, longest = len(chains), max(len(y) for _, y in chains)
    x = np.zeros((sum(len(y) for _, y in chains), len(names)), np.float32)  # a row for each block of all pages
    y, there = np.zeros((count, longest), int), np.zeros((count, longest), bool)
    row = 0
    for k, (own, labels) in enumerate(chains):
        for ids in own:
            x[row, ids] = 1
            row += 1
        y[k, :len(labels)], there[k, :len(labels)] = labels, True
    w, steps = np.zeros(len(names)), np.zeros((2, 2))
    seen_w, seen_s = np.zeros_like(w), np.zeros_like(steps)
    pairs = there[:, 1:]
    for _ in range(rounds):
        emit = np.zeros((count, longest, 2))
        emit[there, 1] = x @ w.astype(np.float32)
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.logaddexp(alpha[:, t - 1, 0, None] + steps[0], alpha[:, t - 1, 1, None] + steps[1]) + emit[:, t]
        for t in range(longest - 2, -1, -1):
            after = emit[:, t + 1] + beta[:, t + 1]
            value = np.logaddexp(steps[None, :, 0] + after[:, 0, None], steps[None, :, 1] + after[:, 1, None])
            beta[:, t] = np.where(there[:, t + 1, None], value, 0.0)
        both = alpha + beta
        inside = 1 / (1 + np.exp(both[..., 0] - both[..., 1]))
        total = np.logaddexp(both[:, 0, 0], both[:, 0, 1])
        joint = np.exp(alpha[:, :-1, :, None] + steps + (emit + beta)[:, 1:, None, :] - total[:, None, None, None])
        grad_w = x.T @ (y - inside)[there].astype(np.float32) - penalty * w
        real = np.zeros((2, 2))
        np.add.at(real, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
        grad_s = real - joint[pairs].sum(axis=0) - penalty * steps
        seen_w, seen_s = seen_w + grad_w**2, seen_s + grad_s**2
        w, steps = w + rate * grad_w / np.sqrt(seen_w + 1e-9), steps + rate * grad_s / np.sqrt(seen_s + 1e-9)
    return Field({n: float(w[k]) for n, k in names.items()}, tuple(tuple(map(float, s)) for s in steps))


@lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES) -> Field:
    return train(labelled_pages(pages))


def main_text(html: str | None, model: Field) -> str:
    blocks = leaf_blocks(html or "", model.known)
    return "\n\n".join(b.text for b, label in zip(blocks, model.decode(blocks), strict=True) if label)


def extract(pages: DataFrame, model: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``."""
    model = model or trained()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(html.as_py(), model) for html in batch["html"]]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(texts, "page_id bigint, url string, text string, n_chars bigint")

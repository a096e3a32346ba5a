"""SimHash near-duplicates through an inverted index over byte positions, with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most two bits share at least six of them
at the same positions. Postings are kept for groups of positions: the six groups of four positions below are chosen
so that whichever two positions differ, one group avoids both; so every linked pair meets in a posting list. Inside a
list the shared positional bytes of each pair are tallied, pairs below the guaranteed minimum go, and the bit
distance of the rest is verified.

Long lists are never paired out. Their fingerprints are indexed anew by all 28 groups of six positions, and where a
list is still long its members, which can only differ in two bytes, are gathered by each value at distance one or
less (17 of them): what meets there lies within two bits of each other, so it is tied to the smallest one.
Each of the three ways finds every link of the lists it gets; none is capped. Equal fingerprints are one node.

Defined results: a null or empty text has fingerprint zero and links like any other; rows with a null id get the
component of their fingerprint; a component without any non-null id is null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized_broadcast
from .common import fresh, written
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Posting lists up to this length are paired out; longer ones take the finer index.
SHORT_LIST = 24
_POSITIONS = 8
#: Groups of four positions such that each pair of positions is avoided by one of them.
_FOURS = ((0, 1, 2, 3), (0, 1, 4, 5), (0, 1, 6, 7), (2, 3, 4, 5), (2, 3, 6, 7), (4, 5, 6, 7))
_SIXES = tuple(combinations(range(_POSITIONS), _POSITIONS - MAX_BITS))
_PART = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a whole text; hashes are taken in parts, so memory stays bounded by the words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not tokens:
        return 0
    shingles = map(b" ".join, zip(*(islice(tokens, k, None) for k in range(words)))) if len(tokens) >= words else iter([b" ".join(tokens)])
    hashes = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    ones, total = np.zeros(64, np.int64), 0
    while len(part := np.fromiter(islice(hashes, _PART), np.uint64)):
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(part)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprint_column(text: str) -> Column:
    @F.pandas_udf("bigint")
    def prints(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(np.array([fingerprint(t) for t in part], np.uint64).view(np.int64))
    return prints(F.col(text))


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def _postings(prints: DataFrame, groups: tuple[tuple[int, ...], ...]) -> DataFrame:
    """A row (grp, val, fp) for each group of positions."""
    keys = F.array(*[F.struct(F.lit(n).alias("grp"), F.col("fp").bitwiseAND(F.lit(_mask(g)).cast("bigint")).alias("val")) for n, g in enumerate(groups)])
    return prints.select("fp", F.explode(keys).alias("k")).select("k.grp", "k.val", "fp")


def _long_and_short(prints: DataFrame, groups) -> tuple[DataFrame, DataFrame]:
    postings = _postings(prints, groups)
    sizes = postings.groupBy("grp", "val").agg(F.count("*").alias("size")).where("size > 1")
    met = postings.join(sizes, ["grp", "val"])
    return met.where(F.col("size") > SHORT_LIST).drop("size"), met.where(F.col("size") <= SHORT_LIST).drop("size")


def _shared_bytes(x: Column, y: Column) -> Column:
    diff = x.bitwiseXOR(y)
    return reduce(Column.__add__, [F.when(diff.bitwiseAND(F.lit(_mask((p,))).cast("bigint")) == 0, 1).otherwise(0) for p in range(_POSITIONS)])


def _pairs(short: DataFrame) -> DataFrame:
    """Links inside short posting lists: tally, filter by the minimum, verify."""
    other = short.select("grp", "val", F.col("fp").alias("fp2"))
    x, y = F.col("fp"), F.col("fp2")
    return (short.join(other, ["grp", "val"]).where(x < y).where(_shared_bytes(x, y) >= _POSITIONS - MAX_BITS)
            .where(F.bit_count(x.bitwiseXOR(y)) <= MAX_BITS).select(x.alias("a"), y.alias("b")))


def _by_midpoint(long: DataFrame) -> DataFrame:
    """Links of lists that share six positions: members meet at the values within one bit on the two others."""
    free = F.element_at(F.array(*[F.array(*[F.lit(b) for p in range(_POSITIONS) if p not in g for b in range(8 * p, 8 * p + 8)]) for g in _SIXES]), F.col("grp") + 1)
    near = long.select("grp", "val", "fp", F.explode(F.concat(F.array(F.lit(-1)), free)).alias("bit")).select(
        "grp", "val", "fp", F.when(F.col("bit") < 0, F.col("fp")).otherwise(F.expr("fp ^ shiftleft(1L, bit)")).alias("at"))
    least = near.groupBy("grp", "val", "at").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)  # 17 at most
    return least.select("a", F.explode("all").alias("b")).where("a != b")


def links(prints: DataFrame) -> DataFrame:
    """(a, b): links whose closure equals that of all pairs of fingerprints within MAX_BITS. ``prints`` has the distinct
    values in column fp."""
    long, short = _long_and_short(prints, _FOURS)
    longer, short_again = _long_and_short(written(long.select("fp").distinct(), "simhash-long"), _SIXES)
    return _pairs(short).union(_pairs(short_again)).union(_by_midpoint(longer)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): one row per row of ``docs``; fp as a signed 64-bit number."""
    prints = written(docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col).alias("fp")), "simhash")
    return prints.join(_components_of(prints), "fp").select("id", "fp", "component_id")


def _components_of(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id): the smallest fingerprint and the smallest id reachable from each fingerprint."""
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-nodes")
    reach = written(components(links(nodes.select("fp"))), "simhash-components")
    known = nodes.join(reach, nodes["fp"] == reach["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("root"))
    roots = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return known.join(roots, "root").select("fp", "root", "component_id")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with its own columns: the row whose id is the component's, of several rows with
    that id (or of a component without any id) the first one written."""
    fp, component, rank = fresh(docs, "simhash_fp"), fresh(docs, "simhash_component"), fresh(docs, "simhash_rank")
    # the rows are written with a number, so all later steps mean the same rows
    rows = written(docs.withColumn(fp, fingerprint_column(text_col)).withColumn(rank, F.monotonically_increasing_id()), "simhash-rows")
    prints = rows.select(F.col(id_col).alias("id"), F.col(fp).alias("fp"), F.col(rank).alias("row"))
    best = (prints.join(_components_of(prints), "fp").groupBy("root")
            .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("best"))
            .select(F.col("best.row").alias(component)))
    # the numbers of the rows that go are few and short; texts stay where they are, unless even these are too many to send
    gone = written(prints.select(F.col("row").alias(component)).join(best, component, "left_anti"), "simhash-gone")
    return rows.join(sized_broadcast(gone), F.col(rank) == F.col(component), "left_anti").drop(fp, rank)

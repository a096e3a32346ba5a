"""SimHash and vector near-duplicates, components and exact top-k against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meterline.llm import neardup_vectors, simhash, topk
from meterline.llm.components import components

SF = "/root/testdata/sf0.01"


def closure(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rnd = random.Random(3)
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(120)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = closure(400, pairs)
    assert got == {x: want[x] for p in pairs if p[0] != p[1] for x in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    import re
    words = re.findall(rb"[^\x20\x09-\x0D]+", words)
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in (None, "", " \n", "one", "One two", "A b C d É f", "x " * 500, "é\xa0b c\x0bd e"):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def brute(prints):
    return closure(len(prints), [(a, b) for a in range(len(prints)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 2])


@pytest.mark.parametrize("short", [simhash.SHORT_LIST, 2])
def test_links_of_crowded_fingerprints(spark, monkeypatch, short):
    monkeypatch.setattr(simhash, "SHORT_LIST", short)
    rnd, prints = random.Random(1), []
    for size in (60, 60, 5):  # dense groups, so every way through the index has work
        base = rnd.getrandbits(64)
        prints += [base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for _ in range(size)]
    low = rnd.getrandbits(64)
    prints += [low ^ rnd.getrandbits(8) for _ in range(60)] + [rnd.getrandbits(64) for _ in range(50)]
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()
    at = {s: k for k, s in enumerate(signed)}
    assert all(bin(prints[at[r["a"]]] ^ prints[at[r["b"]]]).count("1") <= 2 for r in found)
    assert closure(len(prints), [(at[r["a"]], at[r["b"]]) for r in found]) == brute(prints)


def test_simhash_query(spark):
    from meterline.llm.queries import op8_simhash
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts)
    prints = [slow_fingerprint(texts[k]) for k in ids]
    want = {ids[k]: (f"{prints[k]:016x}", ids[c]) for k, c in enumerate(brute(prints))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op8_simhash(spark, SF).collect()}
    assert got == want


def test_simhash_edges_and_stage(spark):
    rows = [(3, "same words here now", 1), (2, "same words here now", 2), (None, "same words here now", 3), (2, "same words here now", 4),
            (None, "another text of its own", 5), (None, "another text of its own", 6), (9, None, 7), (8, "", 8), (7, "w " * 300_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((r["id"] or -1, r["component_id"] or -1) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted([(3, 2), (2, 2), (-1, 2), (2, 2), (-1, -1), (-1, -1), (9, 8), (8, 8), (7, 7)])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"][:4] if r["text"] else "") for r in kept.collect()) == [(-1, "anot"), (2, "same"), (7, "w w "), (8, "")]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_first(docs.limit(0)).count() == 0


def vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((12, 16))
    rows = [(k, (base[k % 12] + 0.05 * rng.standard_normal(16)).tolist(), k % 12 % 3) for k in range(360)]
    rows += [(1000 + k, base[0].tolist(), 0) for k in range(40)] + [(0, base[1].tolist(), 1)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [None] + [1.0] * 15, 1), (2003, [float("nan")] + [1.0] * 15, 1), (2004, base[0].tolist(), None), (None, base[0].tolist(), 0), (2005, [1.0, 2.0], 0), (2006, [], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_vector_near_duplicates(spark):
    rows, table = vectors(spark)
    ok = lambda v, lab: lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    unit = [np.array(np.array(v, np.float32), float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if ok(v, lab) else None for _, v, lab in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2]
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    degree = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    got = neardup_vectors.near_duplicates(table).toPandas()
    assert len(got) == len(rows)
    number = lambda i: 10**9 if i is None or i != i else int(i)
    assert sorted((number(a), int(n)) for a, n in zip(got["id"].astype(object), got["n_links"], strict=True)) == sorted((number(r[0]), int(n)) for r, n in zip(rows, degree, strict=True))
    clash = neardup_vectors.near_duplicates(table.withColumn("n_links", F.lit("x")).withColumn("dim", F.lit(1)).withColumn("id", F.lit(None).cast("string")))
    assert sorted(map(repr, clash.collect())) == sorted(map(repr, neardup_vectors.near_duplicates(table).collect()))
    root = closure(len(rows), pairs)
    known = [r if r is not None else 10**9 for r, _, _ in rows]
    least = {}
    for k, c in enumerate(root):
        least[c] = min(least.get(c, 10**9), known[k])
    want = sorted((known[k], least[root[k]]) for k in range(len(rows)))
    mine = sorted((int(a) if a == a else 10**9, int(b) if b == b else 10**9) for a, b in zip(got["id"].astype(float), got["component_id"].astype(float)))
    assert mine == want
    assert neardup_vectors.near_duplicates(table.limit(0)).count() == 0


def test_windows_reach_over_range_cuts(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal(8)
    x = base + 0.01 * rng.standard_normal((300, 8))
    table = spark.createDataFrame([(k, v, 1) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    got = neardup_vectors.near_duplicates(table.repartition(5)).toPandas().sort_values("id")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert (got["component_id"] == 0).all() and (got["n_links"].to_numpy() == (unit @ unit.T >= 0.98).sum(axis=1) - 1).all()


def test_links_of_a_cluster_beyond_all_windows(spark):
    # more different vectors than PASSES * 2 * WINDOW = 3840 around one, and a spread of others linked with some of them only
    rng = np.random.default_rng(14)
    base = rng.standard_normal(64)
    noise = np.r_[np.full(4100, 0.03), np.linspace(0.05, 0.4, 400)]
    x = (base + noise[:, None] * rng.standard_normal((4500, 64))).astype(np.float32)
    table = spark.createDataFrame([(k, v, 1) for k, v in enumerate(x.tolist())] + [(k, v, 2) for k, v in enumerate(x[4000:4200].tolist(), 5000)]
                                  + [(6000 + k, v[:32], 1) for k, v in enumerate(x[:150].tolist())], "vec_id long, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    w = x[:150, :32].astype(float) / np.linalg.norm(x[:150, :32].astype(float), axis=1, keepdims=True)
    want = [((z @ z.T) >= 0.98).sum(axis=1) - 1 for z in (u, u[4000:4200], w)]
    assert want[0].max() > 3840 and (want[0] == 0).any()
    got = neardup_vectors.near_duplicates(table.repartition(3)).toPandas().sort_values("id")
    assert got["n_links"].tolist() == np.concatenate(want).tolist()
    assert (got["component_id"].to_numpy()[:4500] == 0).sum() == (want[0] > 0).sum()


def test_tiles_bound_and_trees():
    rng = np.random.default_rng(15)
    links = rng.random((40, 30)) < 0.03
    trees = neardup_vectors._trees(links, np.arange(40), np.arange(100, 130))
    group = lambda pairs: closure(130, pairs)
    assert group(trees) == group([(int(i), int(j) + 100) for i, j in zip(*np.nonzero(links))])
    assert len(trees) < 70


def test_top_k(spark):
    rng = np.random.default_rng(6)
    rows = [(k, rng.integers(-3, 4, 10).astype(float).tolist()) for k in range(700)] + [(5, [0.5] * 10), (None, [3.0] * 10), (50, None), (100, [float("inf")] + [0.0] * 9), (150, [1.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("id") % 50 == 0, "vec_id", "embedding").collect()
    ok = [(i, np.floor(256 * np.array(v))) for i, v in rows if v is not None and np.isfinite(v).all()]
    want = []
    for k, (i, v) in enumerate(ok):
        if i is not None and i % 50 == 0:
            found = sorted((-int(v @ w), 10**9 if j is None else j) for n, (j, w) in enumerate(ok) if n != k and len(w) == len(v))[:5]
            want += [(i, r + 1, None if j == 10**9 else j, -s) for r, (s, j) in enumerate(found)]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r["query_id"], r["rank"], r["id"], r["score"]) for r in got), key=key) == sorted(want, key=key)


def brute_top(ok, k=5):
    want = []
    for n, (i, v) in enumerate(ok):
        if i is not None and i % 50 == 0:
            found = sorted((-int(v @ w), j) for m, (j, w) in enumerate(ok) if m != n)[:k]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return want


@pytest.mark.parametrize("cell_rows", [2048, 64])
def test_top_k_over_many_cells(spark, monkeypatch, cell_rows):
    """Clusters, so that like rows share cells and boxes rule other cells out; slots smaller than the number of cells."""
    monkeypatch.setattr(topk, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(topk, "_SLOT_CELLS", 3)
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((20, 64))
    x = centres[np.arange(2000) % 20] + 0.1 * rng.standard_normal((2000, 64))
    x[1900:] = 0.0  # ties
    rows = [(k, v, "clash", k) for k, v in enumerate(x.tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, cell long").repartition(5)
    got = topk.top_k(table, F.col("id") % 50 == 0, "vec_id", "embedding").collect()
    want = brute_top([(k, np.floor(256 * v)) for k, v in enumerate(x)])
    assert sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got) == sorted(want)


def test_bounds_leave_few_rows():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((30, 64))
    x = np.floor(256 * (centres[np.arange(3000) % 30] + 0.1 * rng.standard_normal((3000, 64))))
    q = x[::50]
    allowed = np.ones((len(q), len(x)), bool)
    allowed[np.arange(len(q)), np.arange(0, 3000, 50)] = False
    alive = topk.survivors(q, x, allowed, np.full(len(q), topk._NO_SCORE), 5)
    exact = np.where(allowed, q @ x.T, -np.inf)
    assert (alive | (exact < np.sort(exact, axis=1)[:, -5, None])).all() and alive.mean() < 0.1


def test_top_k_of_nothing_and_of_few(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, row int, dim string")
    assert topk.top_k(empty, F.col("id") % 50 == 0, "vec_id", "embedding").count() == 0
    few = spark.createDataFrame([(0, [1.0, 1.0], 1, "a"), (0, [1.0, 1.0], 2, "b"), (50, [], 3, "c"), (100, [], 4, "d"), (150, [2.0], 5, "e")], empty.schema)
    got = sorted(map(tuple, topk.top_k(few, F.col("id") % 50 == 0, "vec_id", "embedding").select("query_id", "rank", "id", "score").collect()))
    assert got == [(0, 1, 0, 2 * 256 * 256)] * 2 + [(50, 1, 100, 0), (100, 1, 50, 0)]


def test_segment_bounds_hold():
    rng = np.random.default_rng(8)
    x, y = rng.integers(-100, 100, (2, 50, 23)).astype(float)
    for s in topk.SEGMENTS:
        assert (topk.segment_statistics(x, s) @ topk.segment_statistics(y, s).T + 1e-6 >= x @ y.T).all()
    big = np.array([2.0**40] * 4)
    assert topk._exact(big, big[None])[0] == 2**63 - 1


def test_top_k_query_matches_sql(spark):
    import duckdb
    from meterline.llm.queries import TOP_K_SQL, op10_exact_top_k
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{SF}/embeddings.parquet'")
    got = sorted(map(tuple, op10_exact_top_k(spark, SF).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == sorted(con.sql(TOP_K_SQL).fetchall())

"""Byte-level BPE, whitening and periodic runs against the library, unbounded arithmetic and brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from meterline.llm import byte_bpe, periodic_runs, whitening
from meterline.llm.queries import RANKS, op11_byte_bpe, op12_whitening, op13_periodic_runs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as file:
        return byte_bpe.parse_ranks(file.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_ids_of_odd_texts(ranks, library, monkeypatch):
    encoder = byte_bpe.ByteEncoder(ranks, public_tokenizers.PATTERN)
    strange = list(map(chr, list(encoder.strange)[:50]))  # characters on which Unicode versions differ
    rnd = random.Random(1)
    pool = strange + list("aeé 1\n'sre  \t　͸\x1c\x85") + ["😀", "<|endoftext|>", "'ll"]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 5000, " " * 3000, "ab" * 4000, "é" * 2000, "x " * 40000, "\n" * 70000 + "end", "word\n \n" * 15000]
    for block in (byte_bpe.BLOCK, 7):
        monkeypatch.setattr(byte_bpe, "BLOCK", block)
        some = texts if block > 7 else texts[:1500]
        data = encoder.encode(some)
        assert [ids_of(x) for x in data] == [library.encode_ordinary(x) for x in some]
        assert encoder.decode(data) == [x.encode() for x in some]


def test_leftmost_pair_of_least_rank():
    own = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"ab": 299, b"aaa": 301, b"aaab": 302}
    theirs = tiktoken.Encoding("small", pat_str="(?s).+", mergeable_ranks=own, special_tokens={})
    merger, rnd = byte_bpe.Merger(own), random.Random(4)
    assert merger.long(b"aaaaa") == [300, 301] and merger.long(b"caaab") == [99, 302] and merger.long(b"") == [] and merger.long(b"z") == [122]
    words = [b"", b"a", b"aaaa", b"aaab", b"abaab", b"aab" * 40, *(bytes(rnd.choices(b"aaabc\0", k=rnd.randint(1, 40))) for _ in range(2000))]
    together = [ids_of(x) for x in merger.many(words)]
    for word, ids in zip(words, together, strict=True):  # one by one and many at a time, by two separate ways
        assert ids == merger.long(word) == theirs.encode_ordinary(word.decode())


def test_short_and_long_ways_agree(ranks, spark):
    words = {w for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(100).collect() for w in (r["text"] or "").encode().split()}
    merger, words = byte_bpe.Merger(ranks), sorted(words)
    assert [ids_of(x) for x in merger.many(words)] == [merger.long(w) for w in words]


def test_worker_memory_starts_anew(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_REMEMBERED", 5)
    monkeypatch.setattr(byte_bpe, "MATCHES", 4)
    encoder = byte_bpe.ByteEncoder(ranks, public_tokenizers.PATTERN)
    rnd = random.Random(2)
    for _ in range(50):
        texts = [" ".join(rnd.choices(["thereof", "nation", "zq", "Ünder", "xyzzy", "and", "quokka"], k=6)) for _ in range(4)]
        assert [ids_of(x) for x in encoder.encode(texts)] == [library.encode_ordinary(x) for x in texts]


def test_bpe_query(spark, library):
    got = {r["doc_id"]: r for r in op11_byte_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        text = d["text"] or ""
        ids = library.encode_ordinary(text)
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_bpe_edges(spark, monkeypatch):
    rows = [(1, None, "x"), (None, "same", "y"), (None, "same", None), (2, "", "z"), (3, "w " * 200_000, "ids")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    got = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r["doc_id"] or -1, bytes(r["decoded"])) for r in got) == sorted((i or -1, (t or "").encode()) for i, t, _ in rows)
    assert byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert [r["decoded"] for r in byte_bpe.decode(nulls, RANKS, public_tokenizers.PATTERN).collect()] == [None]


def whole(vector):
    return [int(np.floor(1024.0 * float(c))) + 100000 for c in vector]


def exact_covariance(xs):
    n, dim = len(xs), len(xs[0])
    mean = [Fraction(sum(x[d] for x in xs), n) for d in range(dim)]
    return [[sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in xs) / n for b in range(dim)] for a in range(dim)]


def test_covariance_is_exact():
    rng = np.random.default_rng(1)
    for scale in (3, 10**6, 10**17):  # 64-bit halves and unbounded whole numbers
        x = rng.integers(-scale, scale, (700, 5))
        sums = whitening.Sums(len(x), [int(v) for v in x.astype(object).sum(axis=0)])
        z = sums.centred(x)
        assert (z.dtype == object) == (scale > 10**7)
        got = whitening.covariance(sums, whitening.square_sums(z))
        want = exact_covariance([list(map(int, row)) for row in x])
        assert got.tolist() == [[float(v) for v in row] for row in want]


def test_whitening_query(spark):
    got = op12_whitening(spark, SF).toPandas()
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r["embedding"] is not None and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    xs = [whole(r["embedding"]) for r in rows]
    n, x = len(xs), np.array(xs, np.int64)
    assert len(got) == 8 * n and (got["n"] == n).all() and set(got["component"]) == set(range(1, 9))
    z = n * x - x.sum(axis=0)
    deviation = {r["vec_id"]: sum(int(v) ** 2 for v in row) for r, row in zip(rows, z, strict=True)}
    assert all(deviation[i] == d for i, d in zip(got["vec_id"], got["deviation"], strict=True))
    v = (z / n).T @ (z / n) / n
    values, vectors = np.linalg.eigh(v)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r["vec_id"] for r in rows]].to_numpy()
    for k in range(8):
        want = (z / n) @ vectors[:, -1 - k] / np.sqrt(values[-1 - k])
        assert min(np.abs(wide[:, k] - want).max(), np.abs(wide[:, k] + want).max()) < 1e-9
        share = got.loc[got["component"] == k + 1, "explained"]
        assert share.nunique() == 1 and abs(share.iloc[0] / (values[-1 - k] / values.sum()) - 1) < 1e-9
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_whitening_edges(spark):
    rows = [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 2), (None, [2.0, 2.0], 3), (4, None, 4), (5, [], 5), (6, [None, 1.0], 6), (7, [float("nan"), 1.0], 7),
            (8, [float("inf"), 1.0], 8), (9, [3.0], 9), (10, [1e300, 0.0, 1.0], 10), (11, [-1e300, 1.0, 0.0], 11), (12, [0.5, 0.5, 0.5], 12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").repartition(3)
    got = whitening.whiten(table).collect()
    assert sorted((r["id"] or -1, r["dim"], r["n"]) for r in got) == [(-1, 2, 3), (1, 2, 3), (1, 2, 3), (9, 1, 1), (10, 3, 3), (11, 3, 3), (12, 3, 3)]
    by = {(r["id"], r["dim"]): r for r in got}
    assert by[9, 1]["whitened"] == [None] and by[9, 1]["explained"] == [None] and by[9, 1]["deviation"] == 0 and by[9, 1]["identity_error"] is None
    two = by[None, 2]
    assert two["whitened"][1] is None and abs(abs(two["whitened"][0]) - 2 / 2**0.5) < 1e-12 and two["explained"][0] == 1.0
    assert two["deviation"] == (2 * 1024) ** 2 and by[1, 2]["deviation"] == 1024**2
    assert by[12, 3]["deviation"] is not None and len(by[12, 3]["whitened"]) == 3
    each = whitening.components(whitening.whiten(table)).collect()
    assert len(each) == 3 * 2 + 1 + 3 * 3 and {r["component"] for r in each} == {1, 2, 3}
    assert whitening.components(whitening.whiten(table.limit(0))).count() == 0


def slow_runs(words, min_length, exponent):
    """Every stretch with period q that can't be extended, for every q; those with a smaller period don't count."""
    found = set()
    for q in range(1, len(words) // exponent + 1):
        at = 0
        while at + q < len(words):
            stop = at
            while stop + q < len(words) and words[stop] == words[stop + q]:
                stop += 1
            length = stop - at + q
            if stop > at and length >= max(min_length, exponent * q):
                own = words[at:at + length]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    found.add((at, length, q))
            at = max(at, stop) + 1
    return sorted(found)


def test_runs_of_random_words():
    rnd = random.Random(5)
    for _ in range(1500):
        n = rnd.randint(0, 60)
        words = [rnd.randrange(rnd.choice((1, 2, 3, 4))) for _ in range(n)]
        if rnd.random() < 0.6 and n:
            period = rnd.randint(1, min(9, n))
            words = [words[k % period] for k in range(n)]
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(n)] = rnd.randrange(3)
        for min_length, exponent in ((6, 4), (2, 2), (4, 3)):
            assert periodic_runs.find_runs(np.array(words, np.int64), min_length, exponent) == slow_runs(words, min_length, exponent)


def test_runs_of_long_words():
    assert periodic_runs.find_runs(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    assert periodic_runs.find_runs(np.arange(60_000) % 9_000) == [(0, 60_000, 9_000)]
    assert periodic_runs.find_runs(np.arange(60_000)) == []
    rare = np.r_[np.arange(100, 400), np.tile(np.arange(7), 5), np.arange(400, 500)]
    assert periodic_runs.find_runs(rare) == [(300, 35, 7)] and periodic_runs.stretches(rare, 6, 4) == [(300, 335)]


def slow_document(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = slow_runs(words, 6, 4)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return (len(runs), *(best and (best[0], best[1], best[2], 1000 * best[1] // best[2]) or (None,) * 4), hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def test_runs_query(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in op13_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        if len((d["text"] or "").split()) < 1500:  # the brute force is quadratic
            assert got[d["doc_id"]] == slow_document(d["doc_id"], d["text"]), d["doc_id"]
    assert sum(v[0] > 0 for v in got.values()) > 20


def test_runs_edges(spark, scratch):
    rows = [(1, None, 1), (None, "a " * 10, 2), (None, "a " * 10, 3), (2, "", 4), (3, " x \x1cy\x0b" * 8, 5), (4, "w" + " w" * 120_000, 6), (5, "A a A a A a A a", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted((r["doc_id"] or -1, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.detect(docs).collect())
    assert got == [(-1, 10, [(0, 10, 1)], "a"), (-1, 10, [(0, 10, 1)], "a"), (1, 0, [], ""), (2, 0, [], ""), (3, 16, [(0, 16, 2)], " x \x1cy"), (4, 120_001, [(0, 120_001, 1)], "w"),
                   (5, 8, [(0, 8, 2)], "A a")]
    assert periodic_runs.detect(docs.limit(0)).count() == 0
    docs.drop("runs").write.parquet(f"{scratch}/documents.parquet")
    want = sorted((i or -1, *slow_document(i, t)) for i, t, _ in rows if i != 4)
    mine = sorted((r["doc_id"] or -1, *tuple(r)[1:]) for r in op13_periodic_runs(spark, scratch).collect() if r["doc_id"] != 4)
    # a null id has no remainder, so its words stay
    assert [m for m in mine if m[0] != -1] == [w for w in want if w[0] != -1] and [m[1] for m in mine if m[0] == -1] == [1, 1]

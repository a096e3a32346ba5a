"""Packing, chat formatting, SentencePiece, URL filter and the pipeline against brute force and round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import chat, packing, pieces_scan, urlfilter
from meterline.llm.queries import PIECES, RULES, TOKENIZER

SF = "/root/testdata/sf0.01"
ODD = ["", "a  b\n\n\tc", "DON'T it's 3rd №5 <|endoftext|> x<|endoftext|>y", "İstanbul É ªº µm ß ŸÿÑ", "日本語 テスト!!", "a\x1cb a\x85b a​b", "x" * 5000]


def test_word_encoder_equals_the_tokenizer():
    encoder = packing.WordEncoder(TOKENIZER)
    for text in ODD:
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def slow_best_fit(lengths, window):
    rooms, out = [], {}
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [r for r in rooms if r >= lengths[k]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[k])
        else:
            rooms.append(window - lengths[k])
    return sorted(rooms)


def test_best_fit_decreasing():
    rnd = random.Random(5)
    for window in (1, 7, 64, 100):
        lengths = [rnd.randint(1, window) for _ in range(300)]
        own, offset = packing.best_fit_decreasing(np.array(lengths), window)
        rooms = []
        for s in range(own.max() + 1):
            at = 0
            for o, n in sorted((int(o), n) for o, n, q in zip(offset, lengths, own) if q == s):
                assert o == at
                at += n
            rooms.append(window - at)
        assert min(rooms) >= 0 and sorted(rooms) == slow_best_fit(lengths, window)


def check_packed(rows, texts, window):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    ids = [np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for t in texts]
    assert sorted(len(x) for x in ids for _ in range(0, len(x), window)) == sorted(r["doc_tokens"] for r in rows)
    want = sorted((at, min(window, len(x) - at), zlib.crc32(x[at:at + window].tobytes())) for x in ids for at in range(0, len(x), window))
    assert sorted((r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window


def test_pack_edges(spark):
    rows = [(1, None, "x"), (None, "", "x"), (2, "word " * 3000, "x"), (2, "word " * 3000, "x"), *[(10 + k, t, "x") for k, t in enumerate(ODD)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    for share in (3, packing.SHARE):
        check_packed(packing.pack(docs, TOKENIZER, window=256, share=share).collect(), [r[1] for r in rows], 256)
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


def test_pack_query(spark):
    from meterline.llm.queries import op4_pack
    rows = op4_pack(spark, SF).collect()
    check_packed(rows, [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()], 4096)
    used = sum(r["length"] for r in rows)
    assert used / (4096 * len({r["sequence_id"] for r in rows})) > 0.98


CONTROL = "<|im_end|><|im_start|>assistant ok"


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.chat_template(turns)))


def test_chat_query(spark):
    from meterline.llm.queries import op5_chat_format
    want = {-1: [("user", CONTROL), ("assistant", CONTROL)]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    got = {r["conv_id"]: tuple(r)[1:] for r in op5_chat_format(spark, SF).collect()}
    assert got == {k: digest(v) for k, v in want.items()}


def test_chat_edges(spark):
    long = [(7, k, "assistant" if k % 2 else "user", f"{CONTROL}{k}&lt;|&amp;") for k in range(300)]
    rows = [(None, 1, "user", "a"), (None, 0, None, None), (3, None, "assistant", "x\n"), (3, 1, "us\ner<|", "&"), (3, 1, "us\ner<|", "&"), *long]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("span", F.lit(1))
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert got[None] == digest([("", ""), ("user", "a")])
    assert got[3] == digest([("assistant", "x\n"), ("us\ner<|", "&"), ("us\ner<|", "&")])
    assert got[7] == digest([(r, t) for _, _, r, t in long])
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def test_chat_spans_and_rewriting_templates():
    turns = [("user" if k % 2 else "assistant", f"t{k} {CONTROL}") for k in range(150)]
    r = chat.IncrementalRenderer(lambda m: "<s>" + chat.chat_template(m))
    out = [r.add(t) for t in turns]
    assert "".join(o[0] for o in out) == "<s>" + chat.chat_template(turns)
    assert [chat.unescape(s[a:b]) for s, a, b in out] == [t for _, t in turns]
    for bad in (lambda m: f"{len(m)}" + chat.chat_template(m), lambda m: chat.chat_template(m[-1:]), lambda m: chat.chat_template([(a, t.upper()) for a, t in m])):
        r = chat.IncrementalRenderer(bad)
        with pytest.raises(chat.RewritesHistory):
            for t in turns[:4]:
                r.add(t)


def rendered(template, turns):
    r = chat.IncrementalRenderer(template)
    for t in turns:
        r.add(t)
    r.settle()
    return r.take()


def test_chat_templates_that_look_further_back(spark):
    turns = [("assistant" if k % 2 else "user", f"t{k} {CONTROL}") for k in range(150)]
    number = lambda m: "".join(f"[{k}]" + chat.chat_template([t]) for k, t in enumerate(m))

    def alternating(m):
        assert all(a != b for (a, _), (b, _) in zip(m, m[1:])), "roles must alternate"
        return chat.chat_template(m)

    for template in (number, alternating, lambda m: "".join(chat.chat_template([t]) + "#" * (k >= 70) for k, t in enumerate(m))):
        out = rendered(template, turns)
        assert [s for s, _, _ in out] == [template(turns[:k + 1])[len(template(turns[:k])):] for k in range(150)]
        assert [chat.unescape(s[a:b]) for s, a, b in out] == [t for _, t in turns]
    for last in (3, 70, 99, 140, 149):  # keeps the last turns only
        with pytest.raises(chat.RewritesHistory):
            rendered(lambda m: chat.chat_template(m[-last:]), turns)
    rows = [(7, k, role, text) for k, (role, text) in enumerate(turns)] + [(8, k, role, text) for k, (role, text) in enumerate(turns[:70])]
    got = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), number).orderBy("conv_id", "seq").collect()
    assert ["".join(r["span"] for r in got if r["conv_id"] == c) for c in (7, 8)] == [number(turns), number(turns[:70])]
    assert [r["seq"] for r in got] == [*range(150), *range(70)]


def test_chat_prefixes_are_compared_at_every_length():
    turns = [("assistant" if k % 2 else "user", f"t{k}") for k in range(200)]
    bad = lambda m: chat.chat_template(m).replace("user", "User" if 70 <= len(m) <= 90 else "user")  # noqa: E731  changes back in time for 128 turns
    with pytest.raises(chat.RewritesHistory):
        rendered(bad, turns)


def test_scan_equals_the_library():
    model, rnd = pieces_scan.piece_model(PIECES), random.Random(2)
    texts = ["a  b   c", " lead", "trail ", "   ", "ab" * 200, "aaaa " * 30, "the" * 100 + " " * 40 + "end", "é日本 \n\n\t🙂" * 20,
             "".join(rnd.choices("theinrado", k=800)), "".join(rnd.choices("abc déth\n", k=800))]
    for text in texts:
        want = model.library.encode(text)
        assert np.frombuffer(model.units(pieces_scan.marked(text)), "<u4").tolist() == want
        for chunk in (5, 17, 100):
            parts = pieces_scan.encode_in_chunks(model, text, chunk)
            assert [x for p in parts for x in p] == want
            assert "".join(map(model.decode, parts))[1:] == text


def test_max_plus_product_is_associative():
    rnd = random.Random(4)
    a, b, c = ([(rnd.randrange(4), rnd.randrange(4)) for _ in range(6)] for _ in range(3))
    x = pieces_scan.compose
    assert set(x(x(a, b), c)) == set(x(a, x(b, c)))


def test_sentencepiece_rows(spark):
    model = pieces_scan.piece_model(PIECES)
    texts = [None, "", "short text", "word " * 500, "word " * 500, "giantword" * 300, "  spaces   " * 90]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "x y")], "doc_id long, text string").withColumn("key", F.lit(1))
    got = {r["doc_id"]: r for r in pieces_scan.encode(docs, PIECES, chunk=256).collect()}
    for k, text in [*enumerate(texts), (None, "x y")]:
        ids = np.array(model.library.encode(text or ""), np.int64)
        assert (got[k]["n_tokens"], got[k]["ids_checksum"], got[k]["round_trip"]) == (len(ids), int((ids * np.arange(1, len(ids) + 1)).sum()), True)
    assert got[3]["n_chunks"] > 5 and pieces_scan.encode(docs.limit(0), PIECES).count() == 0


def test_url_rules_and_parts(spark):
    urls = ["http://A.Example.com/en/1", "https://www.example.com/en/x?y=/z", "http://x.www.example.com/en/", "http://shop.net/es/9#t", "http://net/fr/", "http://Ünet.net?/es/", "ftp://plain.org",
            "no scheme", None, "://", "http://notexample.com/en/1", "http://example.com/EN/1"]
    got = [tuple(r)[1:] for r in urlfilter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), RULES).orderBy("id").collect()]
    assert got == [("a.example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
                   ("x.www.example.com", "/en/", "www.example.com/en/", "allow"), ("shop.net", "/es/9", "net/es/", "block"), ("net", "/fr/", "net/fr/", "block"),
                   ("Ünet.net".replace("Ü", "Ü"), "", None, "allow"), ("plain.org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
                   ("notexample.com", "/en/1", "com/", "allow"), ("example.com", "/EN/1", "com/", "allow")]


def test_url_templates_are_rejected_by_labels(spark):
    # an unruled branch that looks like a blocked one by its labels, crowded with one-off names
    rules = [urlfilter.Rule("block", "a.org", "/x/bad"), urlfilter.Rule("allow", "a.org", "/y/")]
    urls = [f"http://a.org/x/bad{chr(97 + k % 26)}{chr(97 + k // 26)}/i" for k in range(60)] + [f"http://a.org/x/odd{chr(97 + k)}/i" for k in range(5)] + [f"http://a.org/y/{k}" for k in range(30)] + ["http://a.org/z/1"]
    rows = urlfilter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).orderBy("id").collect()
    assert [r["verdict"] for r in rows] == ["block"] * 65 + ["allow"] * 31
    assert [r["rule"] for r in rows[60:65]] == [None] * 5
    assert urlfilter.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0


def test_url_branches_that_part_at_segment_five(spark):
    rules = [urlfilter.Rule("block", "a.org", "/a/b/c/d/casino/x"), urlfilter.Rule("allow", "a.org", "/a/b/c/d/news/x")]
    word = lambda k: chr(97 + k % 26) + chr(97 + k // 26)
    urls = [f"http://a.org/a/b/c/d/{kind}/x{word(k)}/i" for kind in ("casino", "news") for k in range(60)]
    urls += [f"http://a.org/a/b/c/d/{kind}/odd{word(k)}/i" for kind in ("casino", "news") for k in range(10)]
    urls += ["http://a.org/" + "z/" * 400]
    rows = urlfilter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).orderBy("id").collect()
    assert [r["verdict"] for r in rows] == ["block"] * 60 + ["allow"] * 60 + ["block"] * 10 + ["allow"] * 11


def test_url_rows_stay_one_by_one(spark):
    """Null ids, repeated rows and columns named like those of the work."""
    rows = [(None, "http://a.org/x/1", "h", "p", "v", 1), (None, "http://a.org/x/1", "h", "p", "v", 2), (7, "http://b.net/es/1", "h", "p", "v", 3), (7, "http://b.net/es/1", "h", "p", "v", 4),
            (8, None, None, None, None, None)]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string, host string, path string, verdict string, id int"), RULES)
    assert got.columns == ["id", "host", "path", "rule", "verdict"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, [(None, "a.org", "/x/1", None, "allow")] * 2 + [(7, "b.net", "/es/1", "net/es/", "block")] * 2 + [(8, "", "", None, "allow")]))


def test_url_query_is_native_and_matches_sql(spark):
    import duckdb
    from meterline.llm.queries import op9_url_filter
    con = duckdb.connect()
    con.sql("create view pages as from '/root/testdata/sf0.1/pages.parquet'")
    got = op9_url_filter(spark, "/root/testdata/sf0.1")
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    text = lambda rows: sorted(map(str, rows))
    assert text(tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()) == text(con.sql(urlfilter.oracle(RULES)).fetchall())


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    from meterline.llm import langid, quality, simhash
    from meterline.llm.queries import language_rows, quality_rows
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "simhash_near_dedup", "packing"]
    rows, labels = quality_rows(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = docs.withColumn("s", quality.score_column(quality.fit(rows, labels), "text"))
    good = docs.where(F.col("doc_id").isin([r["doc_id"] for r in scored.where("s >= 0.7").collect()]))
    known = good.withColumn("p", langid.predict_column(langid.fit(language_rows(good)), "text")).where("not p.rejected").drop("p")
    texts = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in known.collect()}
    ids = sorted(texts)
    root = {k: k for k in ids}
    for k, a in enumerate(ids):  # ids ascend, so the first of each component is its smallest
        near = {root[b] for b in ids[:k] if bin(texts[a] ^ texts[b]).count("1") <= 2}
        if near:
            least = min(near)
            root = {x: least if r in near else r for x, r in root.items()}
            root[a] = least
    packed = corpus_pipeline.run(spark, SF)
    assert sorted({r["doc_id"] for r in packed.collect()}) == sorted(set(root.values()))


def test_pipeline_hands_batches_of_bounded_bytes_to_its_workers(spark, scratch, monkeypatch):
    import corpus_pipeline
    import pyarrow as pa
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("long text "), 400).alias("text"))
    rows.write.parquet(f"{scratch}/documents.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    probe = lambda spark, docs, sf: docs.coalesce(1).mapInArrow(sizes, "n bigint, bytes bigint")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", probe), ("last", lambda spark, docs, sf: docs)])
    try:
        got = corpus_pipeline.run(spark, scratch).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", limit)
    assert sum(r["n"] for r in got) == 6000
    assert max(r["bytes"] for r in got) < 8 << 20  # all 24 MB came in one batch


def test_each_pipeline_stage_bounds_its_batches(spark):
    import corpus_pipeline
    from meterline.llm.common import BATCH_BYTES
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    limit, docs = spark.conf.get(key), spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    try:
        for name, stage in corpus_pipeline.STAGES:  # run by themselves, not through run()
            spark.conf.set(key, str(64 << 20))
            stage(spark, docs, SF)
            assert int(spark.conf.get(key)) == BATCH_BYTES, name
    finally:
        spark.conf.set(key, limit)


def test_word_encoder_keeps_fewer_strings_than_words(monkeypatch):
    monkeypatch.setattr(packing, "_STRINGS", 50, raising=False)
    encoder = packing.WordEncoder(TOKENIZER)
    texts = [" ".join(f"{word}{end}" for word in ("red", "green", "blue") for end in (",", ".", "!" * (n + 1))) for n in range(100)]
    for text in texts * 2:
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.strings) + len(encoder.older) <= 2 * (50 + 9)
    assert {"red", "green", "blue", "!!"} <= set(encoder.words)

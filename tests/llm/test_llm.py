"""The text operators against plain versions, exact round trips and held-out accuracy."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from rastermill.llm import audio, bagminhash, decontam, html_text, langid, pieces, pii, quality, queries, token_store, url_rules, words
from rastermill.llm.shared import stored, utf8

from . import brute
from .conftest import EDGES

FOLDER = "/root/testdata/sf0.001"
BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def empty(df):
    return df.where("false")


def test_words_as_by_regex():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aZ09 .,é日😀\n_") for _ in range(rng.randrange(40))) for _ in range(300)] + ["", "x" * 600_000 + " y"]
    raw, offsets = utf8(pa.array(texts))
    hashes, counts = words.word_hashes(raw, offsets)
    want = [brute.words(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    seen = {}
    for w, h in zip(flat, hashes.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# 1


def test_quality_accuracy_and_fold(spark):
    rows = queries.op1_quality(spark, "/root/testdata/sf0.1").collect()
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [(r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert np.mean([p == y for p, y in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_quality_pooling_is_over_all_positions():
    rng = np.random.default_rng(0)
    filters = rng.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype(np.float32)
    texts = ["", "ab", "x" * 5, "hello world " * 70, "é" * 700]
    raw, offsets = utf8(pa.array(texts))
    got, first = quality.pooled(raw, offsets, filters)
    for k, text in enumerate(texts):
        b = np.frombuffer(text.encode().ljust(quality.WIDTH, b"\0"), np.uint8)
        conv = sum(filters[j][b[j : len(b) - quality.WIDTH + 1 + j]] for j in range(quality.WIDTH))
        blocks = [conv[i : i + quality.HALF].max(axis=0) for i in range(0, len(conv), quality.HALF)]
        want = [np.maximum(a, b) for a, b in zip(blocks, blocks[1:], strict=False)] or blocks
        mine = got[first[k] : first[k + 1] if k + 1 < len(first) else None]
        assert np.allclose(mine, want, atol=1e-5)


def test_quality_edges(spark, docs):
    df = docs(EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.classify(df, none).collect()} == {0.5}
    assert quality.classify(empty(df), none).count() == 0
    some = spark.createDataFrame([(1, 0), (4, 1), (4, 0), (2, 1), (3, None)], "doc_id long, quality int")
    out = quality.score(df, quality.fit(df, some), "p").collect()
    assert len(out) == len(EDGES) and len({r["p"] for r in out if r["text"] == "word"}) == 1 and out[0]["score"] == 1.5
    assert quality.keep_accepted(df, none).columns == df.columns


# 2


def test_language_accuracy(spark):
    rows = {r["doc_id"]: r for r in queries.op2_language_id(spark, "/root/testdata/sf0.01").collect()}
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [(r["lang_pred"], true[k]) for k, r in rows.items() if r["held_out"]]
    assert np.mean([p == t for p, t in held]) > 0.97


def test_language_score_is_naive_bayes(docs):
    df = docs([(k, t) for k, t in enumerate(["the cat sat", "der Hund bellt", "le chat dort"])])
    langs, matrix = ["a", "b"], np.random.default_rng(0).normal(size=(langid.BUCKETS + 1, 2)).astype(np.float32)
    texts = [r["text"] for r in df.collect()] + [None, "123 !", ""]
    pred, p = langid.score(texts, langs, matrix)
    for k, text in enumerate(texts[:3]):
        ids, _, _ = langid.ngrams([text])
        total = matrix[langid.BUCKETS].astype(float) + sum(matrix[i].astype(float) for i in ids.ravel())
        want = np.exp(total - total.max())
        assert pred[k] == langs[int(total.argmax())] and p[k] == pytest.approx(want.max() / want.sum(), abs=1e-4)
    assert pred[3:] == ["und"] * 3 and not p[3:].any()


def test_language_edges(docs):
    df = docs(EDGES)
    rows = langid.identify(df).collect()
    assert len(rows) == len(EDGES) and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert langid.identify(empty(df)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(df, *langid.fit(empty(df))).collect()} == {"und"}


# 3

PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site name</header><nav><ul><li>Home<li>About</ul></nav>
<div class="cookie-notice">We use cookies</div><article><header><h1>Caf&eacute; &amp; more</h1></header><p><b>One
 two<br>three<p>Four &#x41;</p><aside>See also</aside><ul><li>x<li>y</ul><section id="comments"><p>first!</p></section><form>mail <input></form></article>
<div>%s</div><footer>&copy; all</footer></body></html>"""


def test_html_structure(spark):
    df = spark.createDataFrame([(1, "http://h.com/a", PAGE % ""), (2, None, None), (3, "http://h.com/b", "<p>only this"), (None, "x", "")], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in html_text.extract(df).collect()}
    assert rows[1]["text"] == "Café & more\nOne two three\nFour A\nx\ny"
    assert rows[2]["text"] == "" and rows[3]["text"] == "only this" and rows[3]["n_chars"] == 9 and len(rows) == 4
    assert html_text.extract(empty(df)).count() == 0


def test_html_runs_repeated_on_a_host_go(spark):
    bar = "subscribe to our weekly letter and never miss a story again"
    rows = [(k, f"http://h.com/{k}", PAGE % f"{bar}. Unique words number {k} stay here") for k in range(5)]
    rows += [(9, "http://other.com/", PAGE % bar), (10, "http://x.com", f"<p>{bar}</p>"), (10, "http://x.com", f"<p>{bar}</p>")]
    out = [(r["page_id"], r["text"]) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()]
    texts = dict(out)
    for k in range(5):
        assert texts[k].endswith(f"\n{k} stay here") and "weekly" not in texts[k]
    assert texts[9].endswith(bar) and [t for i, t in out if i == 10] == [bar, bar]


def test_suffix_ranks_order_by_depth():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 3, 60).astype(np.uint64)
    for depth in (1, 2, 5, 6):
        sa, rank = html_text.suffix_ranks(tokens, depth)
        keys = [tuple(tokens[i : i + depth].tolist()) for i in range(60)]
        assert [keys[i] for i in sa] == sorted(keys)
        assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(60) for j in range(60))


# 4


def test_url_rules(spark):
    rows = [(1, "https://a.Example.COM/en/12?x"), (2, "http://example.com/en/7#f"), (3, "http://b.net/de/1"), (4, "http://example.net/de/80"), (5, "http://x.org/es/"), (6, None), (7, "no scheme"), (8, "http://com/en"), (9, "a://b://org/es/"), (10, "http://notexample.com/en/71")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["page_id"]: r for r in url_rules.judge(pages, labels).collect()}
    assert {k: (r["rule"], r["verdict"]) for k, r in got.items()} == {
        1: ("com/en/", "block"), 2: ("example.com/en/7", "allow"), 3: ("net/de/", "allow"), 4: ("example.net/de/8", "block"), 5: ("org/es/", "block"),
        6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: ("com/en/", "block"),
    }
    assert (got[1]["host"], got[1]["path"], got[6]["host"], got[9]["host"], got[9]["path"]) == ("a.example.com", "/en/12", "", "b:", "//org/es/")
    assert url_rules.judge(empty(pages), labels).count() == 0


def test_mined_url_rules(spark):
    rng = random.Random(2)
    rows, marks = [], []
    for k in range(600):
        spam = k % 4 == 0
        host = rng.choice(["pills", "bets"]) if spam else rng.choice(["news", "blog"])
        rows.append((k, f"http://{host}.site{k % 7}.info/{rng.choice(['a', 'b'])}/{k}"))
        if k < 400:
            marks.append((k, int(not spam)))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, spark.createDataFrame(marks, "doc_id long, quality int")).collect()}
    assert all(out[k] == ("block" if k % 4 == 0 else "allow") for k in range(600))


def test_mined_rules_are_those_of_counting(spark):
    rng = random.Random(5)
    baskets = [({t for t in "abcdef" if rng.random() < 0.5}, rng.random() < 0.3) for _ in range(300)]
    baskets = [(s, bad or {"a", "b"} <= s) for s, bad in baskets]
    df = spark.createDataFrame([(sorted(s), b) for s, b in baskets], "items array<string>, bad boolean")
    got = {tuple(r["tokens"]): r["confidence"] for r in url_rules.mine(df, 0.01, 0.6, 3).collect()}
    from itertools import combinations

    full = [b for b in baskets if b[0]]
    want = {}
    for size in (1, 2, 3):
        for c in combinations("abcdef", size):
            hit = [b for s, b in full if set(c) <= s]
            if sum(hit) >= max(0.01 * len(full), 3) and sum(hit) / len(hit) >= 0.6 and not any(set(w) < set(c) and want[w] >= sum(hit) / len(hit) for w in want):
                want[c] = sum(hit) / len(hit)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_mined_rules_of_any_length(spark):
    from itertools import combinations

    rng = random.Random(6)
    baskets = [({t for t in "abcdefg" if rng.random() < 0.6}, rng.random() < 0.1) for _ in range(300)]
    baskets = [(s, bad or set("abcd") <= s) for s, bad in baskets]
    df = spark.createDataFrame([(sorted(s), b) for s, b in baskets], "items array<string>, bad boolean")
    got = {tuple(r["tokens"]): r["confidence"] for r in url_rules.mine(df, 0.01, 0.6, 3, max_tokens=None).collect()}
    full = [b for b in baskets if b[0]]
    want, seen = {}, {}
    for size in range(1, 8):
        for c in combinations("abcdefg", size):
            hit = [b for s, b in full if set(c) <= s]
            if sum(hit) >= max(0.01 * len(full), 3) and sum(hit) / len(hit) >= 0.6:
                seen[c] = sum(hit) / len(hit)
                if not any(set(w) < set(c) and seen[w] >= seen[c] for w in seen):
                    want[c] = seen[c]
    assert ("a", "b", "c", "d") in want
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_mined_rules_with_tokens_that_imply_others(spark):
    from itertools import combinations

    rng = random.Random(8)
    implies = {"a": "AX", "b": "B", "c": "C", "d": "BC", "x": "X"}  # a, A: the same rows; d's rows are among those of B and C

    def closed(s):
        return s | {t for k in s for t in implies.get(k, "")} | {"z"}

    baskets = [closed({t for t in "abcdxXBe" if rng.random() < 0.4}) for _ in range(400)]
    baskets = [(s, set("ad") <= s or set("bce") <= s or rng.random() < 0.05) for s in baskets]
    df = spark.createDataFrame([(sorted(s), b) for s, b in baskets], "items array<string>, bad boolean")
    got = {tuple(r["tokens"]): r["confidence"] for r in url_rules.mine(df, 0.01, 0.6, 3, max_tokens=None).collect()}
    want, seen = {}, {}
    for size in range(1, 7):
        for c in combinations("ABCXabcdexz", size):
            hit = [b for s, b in baskets if set(c) <= s]
            if sum(hit) >= 4 and sum(hit) / len(hit) >= 0.6:
                seen[c] = sum(hit) / len(hit)
                if not any(set(w) < set(c) and seen[w] >= seen[c] for w in seen):
                    want[c] = seen[c]
    assert ("A", "d") in want and ("a", "d") in want
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_url_bad_by_four_words_together(spark):
    rng = random.Random(7)
    words_of = [[w for w in ("pa", "qa", "ra", "sa") if rng.random() < 0.5] for _ in range(400)]
    pages = spark.createDataFrame([(k, "http://site.info/" + "/".join(w)) for k, w in enumerate(words_of)], "page_id long, url string")
    labels = spark.createDataFrame([(k, int(len(w) < 4)) for k, w in enumerate(words_of)], "doc_id long, quality int")
    out = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, labels).collect()}
    assert all(out[k] == ("block" if len(w) == 4 else "allow") for k, w in enumerate(words_of))


def test_numbers_and_query_values_are_tokens(spark):
    df = spark.createDataFrame([("http://a.com/en/77/x?id=5&k=b",)], "url string")
    host, path = url_rules.split_url(df["url"])
    items = df.select(url_rules.tokens(df["url"], host, path).alias("t")).first()["t"]
    assert {"path:77", "query:id", "query:id=5", "query:k", "query:k=b"} <= set(items)


# 5


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_pii_base_spans(docs):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab1239.@+- ()%é😀_\n4567890") for _ in range(rng.randrange(100))) for _ in range(1500)]
    texts += ["a@b.c_d@e.f", "x@y.z.@q.r", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (743) 555-3824 +4", "é" * 50 + "a@b.cc" + "1" * 3000 + "a." * 2000, "1@a.b " * 700]
    rows = list(enumerate(texts))
    for r in pii.detect(docs(rows)).collect():
        spans = brute.pii_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(spans), texts[r["doc_id"]]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == kind for k, _, _ in spans) for kind in pii.KINDS]
        assert r["spans"].startswith(",".join(f"{k}:{a}:{b}" for k, a, b in spans))


def test_pii_edges_and_masks(docs):
    df = docs([*EDGES, (20, "call +1 (743) 555-3824 or a@b.cc, 10.0.0.1!")])
    rows = pii.sanitised(df)
    assert rows.columns == df.columns
    out = {r["doc_id"]: r for r in rows.collect()}
    assert out[20]["text"] == "call [PHONE] or [EMAIL], [IP]!" and out[20]["_email"] == "x" and out[1]["text"] == "" and rows.count() == len(EDGES) + 1
    assert pii.detect(empty(df)).count() == 0


def test_pii_revealing_terms(docs):
    rng = random.Random(7)
    rows = [(k, f"Opening words {rng.randrange(10**6)} then {'quazimodo' if k < 20 else 'someone'} called +1 (743) 555-{3824 if k < 20 else 1000 + k} about {'abc' + chr(97 + k % 26) * 4}.") for k in range(60)]
    rows += [(100, "quazimodo without a number"), (101, "nothing here")]
    out = {r["doc_id"]: r for r in pii.detect(docs(rows)).collect()}
    text = dict(rows)
    assert all(f"term:{text[k].index('quazimodo')}:" in out[k]["spans"] for k in [*range(20), 100])
    assert all(out[k]["n_term"] == 0 for k in [*range(20, 60), 101])
    copies = [(k, "Write to carl the carpenter at carl@wood.example today") for k in range(30)]
    assert all(r["n_term"] == 0 for r in pii.detect(docs([*copies, *rows[20:40]])).collect())


# 6


def test_token_store(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    df = docs([*EDGES, (8, "Don't STOP <|endoftext|> now... ½ ǅ"), (9, "plain words")])
    files = token_store.write(df, f"file://{tmp_path}", BPE, shards=3)
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"]), r) for r in token_store.read(spark, files).collect())
    ordered = sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    library, start = Tokenizer.from_file(BPE), 0
    for (_, got), doc in zip(rows, ordered, strict=True):
        ids = np.array([*library.encode(doc["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got["doc_id"], got["start"], got["n_tokens"], got["ids_crc32"]) == (doc["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_store.tokenised(empty(df), BPE).count() == 0


def test_token_file_lookup(tmp_path):
    rng = np.random.default_rng(3)
    ids = sorted({int(i) for i in rng.integers(-(10**6), 10**6, 3000)})
    values = {i: rng.integers(0, 49408, rng.integers(0, 40)).astype("<u2") for i in ids}
    path = tmp_path / "x.sst"
    with path.open("wb") as f:
        w = token_store.Writer(f)
        w.add(token_store.key_of(None, 0), b"\1\0", 2)
        for i in ids:
            w.add(token_store.key_of(i, 0), values[i].tobytes(), 2)
        w.close()
    import pyarrow.fs as pafs

    with pafs.LocalFileSystem().open_input_file(str(path)) as f:
        r = token_store.Reader(f)
        assert len(r.index) > 1
        for i in ids[::37]:
            assert [x.tolist() for x in r.get(i)] == [values[i].tolist()]
        assert [x.tolist() for x in r.get(None)] == [[1]]
        missing = [i for i in range(-500, 500) if i not in values]
        assert all(r.get(i) == [] for i in missing) and sum(r.may_hold(i) for i in missing) < 0.05 * len(missing)
        assert [d for d, _ in r.scan()] == [None, *ids]


# 7


def test_pieces_are_the_librarys():
    import sentencepiece

    library, mine = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Model(PIECES)
    rng = random.Random(0)
    texts = ["", "  ", " a  b ", "x\ty\r\nz", "日本語 テキスト\n\n", "😀😀 ok", "a▁b", "<s> </s> <0x41>", "." * 40, "    " * 9 + "code    x"]
    texts += ["".join(rng.choice("abcdefghij  \n.,éß日😀-=/_ABC01") for _ in range(rng.randrange(60))) for _ in range(1500)]
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text) and mine.decode(ids) == library.decode(ids.tolist())


def test_shared_table_equals_each_word_alone():
    rng = random.Random(9)
    many = ["▁" + "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    together, alone = pieces.Model(PIECES), pieces.Model(PIECES)
    together.solve(many)
    for w in many:
        alone.solve([w])
    assert together.memo == alone.memo


def test_pieces_in_one_pass_and_bounded_memory(docs, monkeypatch):
    df = docs(EDGES).withColumnRenamed("source", "decoded").withColumnRenamed("lang", "piece_ids")
    two = pieces.decode(pieces.encode(df, PIECES), PIECES)
    one = pieces.encode_decode(df, PIECES)
    assert one.columns == two.columns and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert pieces.encode_decode(empty(df), PIECES).count() == 0
    texts = ["x" * 3000, "short words only", "ab" * 700 + " short", "short words again"]
    usual, small = pieces.Model(PIECES), pieces.Model(PIECES)
    wanted = [usual.encode([t])[0].tolist() for t in texts]
    monkeypatch.setattr(pieces, "MEMO_BYTES", 500)
    assert [small.encode([t])[0].tolist() for t in texts] == wanted
    assert len(small.memo) < len(usual.memo) and small.memo_bytes < 600


def test_pieces_edges(docs):
    df = docs(EDGES)
    rows = pieces.round_trip(df, PIECES).collect()
    assert len(rows) == len(EDGES) and all(r["same"] for r in rows)
    assert pieces.round_trip(empty(df), PIECES).count() == 0
    back = pieces.decode(pieces.encode(df.withColumnRenamed("source", "decoded"), PIECES), PIECES).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)


# 8


def test_contamination(spark, docs):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(12)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.randrange(0, 25))) for k in range(12)] + [(50, None), (51, "W1, w2"), (52, "w1 w2"), (None, "w3 w3 w3 w3 w4")]
    rows = [*EDGES[:5], *[(100 + k, say(rng.randrange(0, 80)) + " " + (items[k % 12][1] or "") + "; " + say(9)) for k in range(60)]]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r)[:6] for r in decontam.contamination(docs(rows), table).collect())
    want = sorted(brute.contamination(rows, [("" if i is None else i, t) for i, t in items]))
    assert got == want
    old, decontam.QUERY_WORDS = decontam.QUERY_WORDS, 30
    try:
        assert sorted(tuple(r)[:6] for r in decontam.contamination(docs(rows), table).collect()) == want
    finally:
        decontam.QUERY_WORDS = old
    assert decontam.contamination(docs(rows), empty(table)).where("contaminated").count() == 0
    assert decontam.contamination(empty(docs(rows)), table).count() == 0
    kept = decontam.keep_clean(docs(rows), table)
    assert kept.columns == docs(rows).columns and {r["doc_id"] for r in kept.collect()} == {w[0] for w in want if not w[5]}


def test_proximity(spark, docs):
    item = " ".join(f"q{k}" for k in range(10))
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    other = item.replace("q4", "zz")
    moved = item.replace("q5 ", "").replace("q8", "q5 q8")
    rows = decontam.contamination(docs([(1, f"a b {other} c"), (2, f"x {moved}"), (3, " ".join(f"q{k} u v w" for k in range(10))), (4, item)]), table).orderBy("doc_id").collect()
    assert [(r["n_items"], r["n_near"]) for r in rows] == [(0, 1), (0, 1), (0, 0), (1, 0)]


def test_proximity_as_by_votes(spark, docs):
    rng = random.Random(8)
    say = lambda n: " ".join(f"w{rng.randrange(14)}" for _ in range(n))
    items = [(k, say(rng.randrange(8, 16))) for k in range(10)]
    rows = [(k, say(rng.randrange(0, 60))) for k in range(150)] + [(150 + k, " ".join(t.split()[1:])) for k, t in items]
    table = spark.createDataFrame(items, "item_id long, text string")
    for r in decontam.matches(docs(rows).repartition(3), table).collect():
        exact = set(r["items"])
        assert set(r["near_items"]) == brute.near_items(rows[r["doc_id"]][1], items) - exact


# 9


def test_audio(docs):
    for r in audio.features(docs(EDGES)).collect():
        texts = {t for i, t in EDGES if i == r["doc_id"]}
        raw = (texts.pop() or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r["media_bytes"] == len(payload) + 44
    assert audio.features(empty(docs(EDGES))).count() == 0
    same = {tuple(r)[1:] for r in audio.features(docs(EDGES)).where("doc_id IN (4, 7)").collect()}
    assert len(same) == 1


def test_audio_pieces_and_joins(docs, monkeypatch):
    samples = bytes(np.random.default_rng(2).integers(0, 256, 30000, dtype=np.uint8))
    whole = audio.log_mel(samples)
    monkeypatch.setattr(audio, "PIECE", 512)
    parts = audio.log_mel(samples)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    x = np.frombuffer(samples, np.uint8).astype(np.float32)
    up, down = audio.UP, audio.DOWN
    plain = [sum(x[k * down // up + j - audio.TAPS // 2 + 1] * audio.PHASES[k * down % up][audio.TAPS - 1 - j] for j in range(audio.TAPS)) for k in range(100, 110)]
    assert np.allclose(audio.resample(x, 100, 110), plain, rtol=1e-4)
    assert audio.segments(np.array([-50, -20, -17, -20, -23, -25, -20, -10], float)) == [(2, 5), (7, 8)]
    tone = (np.sin(np.arange(16000) / 8000 * 2 * np.pi * 440) * 100 + 128).astype(np.uint8).tobytes()
    hz = audio.BANK.argmax(axis=0) * audio.RATE * up / down / audio.FRAME
    assert abs(hz[audio.log_mel(tone)[0].mean(axis=0).argmax()] - 440) < 100
    df = docs([(1, "abc " * 5000)])
    rows = audio.pieces(df.sparkSession, audio.write_tensors(audio.encode(df))).collect()
    assert len(rows) == len(audio.tensors(audio.log_mel(audio.payload(b"abc " * 5000))[0])) and all(len(r["tensor"]) == 16 * 16 for r in rows)
    assert all(a["start_s"] < b["start_s"] and a["end_s"] > b["start_s"] for a, b in zip(rows, rows[1:], strict=False))


def plain_log_mel(samples):
    """The same features, frame by frame and from a resampled signal by stuffing zeros."""
    x = (np.frombuffer(samples, np.uint8).astype(float) - 128) / 128
    up, down, n = audio.UP, audio.DOWN, audio.UP * audio.TAPS
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / max(up, down)) / max(up, down) * np.hanning(n + 2)[1:-1] * up
    stuffed = np.zeros(len(x) * up)
    stuffed[::up] = x
    total = -(-len(x) * up // down)
    full = np.concatenate([np.zeros(n), stuffed, np.zeros(2 * n)])
    y = np.array([sum(h[i] * full[n + k * down - i + n // 2] for i in range(n)) for k in range(total)])
    frames = max(1, -(-(total - audio.FRAME) // audio.HOP) + 1)
    y = np.concatenate([y, np.zeros(frames * audio.HOP + audio.FRAME - total)])
    out = []
    for f in range(frames):
        cut = y[f * audio.HOP : f * audio.HOP + audio.FRAME]
        power = np.abs(np.fft.rfft(cut * np.hanning(audio.FRAME))) ** 2
        out.append(10 * np.log10(power @ audio.BANK / audio.FRAME + 1e-10))
    return np.array(out)


def test_log_mel_as_by_stuffing_zeros():
    for size in (64, 320, 1600):
        samples = bytes(np.random.default_rng(size).integers(0, 256, size, dtype=np.uint8))
        got, want = audio.log_mel(samples)[0], plain_log_mel(samples)
        assert got.shape == want.shape and np.abs(got - want).max() < 0.02


def test_features_come_from_the_stored_tensors(docs):
    text = "some words " * 300
    row = audio.features(docs([(1, text), (2, text)])).orderBy("doc_id").collect()
    assert row[0]["feature"] == row[1]["feature"]
    parts, times, note = audio.described(audio.to_wav(audio.payload(text.encode())))
    assert row[0]["feature"] == audio.feature(note, parts) and len(times) == len(parts) and f"tensors={len(parts)}x16x16" in row[0]["feature"]


# 10


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    for most in (1, 3, 60):
        errors = []
        for _ in range(25):
            shingle = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
            a = rng.integers(0, most + 1, 300)
            b = np.where(rng.random(300) < 0.6, a, rng.integers(0, most + 1, 300))
            row = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
            s = bagminhash.signatures(row, np.r_[shingle[a > 0], shingle[b > 0]], np.r_[a[a > 0], b[b > 0]], 2)
            errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07


def test_near_classes(docs):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for k in range(150):
        t = list(base)
        for _ in range(rng.randrange(0, 8)):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        t = t[: rng.randrange(80, 120)] if rng.random() < 0.3 else t
        rows.append((k, " ".join(t)))
    rows += [(600 + k, " ".join(rng.choice(vocabulary) for _ in range(60))) for k in range(20)]
    rows += [(700, None), (701, ""), (702, "  "), (703, "a b"), (704, "a b"), (705, "A b!"), (706, "x " * 500), (707, "x " * 450), (708, "x " * 300), (709, base[0]), (709, base[0])]
    want = brute.near_classes(rows)
    got = bagminhash.classes(docs([*rows, (None, "a b")])).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want and len(got) == len(want)
    kept = bagminhash.keep_one(docs([*rows, (None, "a b")]))
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(want.values())) and kept.where("doc_id IS NULL").count() == 1


def test_near_texts_of_one_doc_id(docs):
    rng = random.Random(8)
    said = lambda n=60: [f"v{rng.randrange(5000)}" for _ in range(n)]
    near = lambda t: [*t[:-1], "other"]
    a, b, c, d = said(), said(90), said(), said()
    rows = [(5, a), (5, b), (9, near(a)), (8, near(b)), (3, c), (6, c), (6, d), (7, near(d)), (20, said())]
    for order in (rows, rows[::-1], rng.sample(rows, len(rows))):
        df = docs([(k, " ".join(t)) for k, t in order]).coalesce(1)
        out = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(df).collect()}
        assert out == {5: 5, 9: 5, 8: 5, 3: 3, 6: 3, 7: 3, 20: 20}
    many = [(k, [*b[:-1], f"x{k}"]) for k in range(30, 50)] + [(60, a), (60, b), (61, near(a))]
    df = docs([(k, " ".join(t)) for k, t in many])
    out = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(df).collect()}
    assert out == {**dict.fromkeys(range(30, 50), 30), 60: 30, 61: 30}
    assert [r["doc_id"] for r in bagminhash.keep_one(df).collect()] == [30]


def test_near_edges(docs):
    df = docs(EDGES)
    out = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(df).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 4}
    assert bagminhash.classes(empty(df)).count() == 0


def test_rare_shingles_of_a_full_arrow_batch(spark):
    sets = spark.range(9000, numPartitions=1).selectExpr("id", "array(id, 1000000 + id % 100, 2000000 + id div 8) grams")
    got = {(r["gram"], r["id"]) for r in bagminhash.rare_grams(sets).collect()}
    assert got == {(k, k) for k in range(9000)} | {(2000000 + k // 8, k) for k in range(9000)}


def test_stored_keeps_rows(docs):
    df = docs(EDGES)
    assert sorted(map(str, stored(df, "t").collect())) == sorted(map(str, df.collect()))

"""Bounds that were caps once, long texts, and the disclosure rule by counting."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from rastermill.llm import html_text, langid, pii, quality


def test_more_languages_than_a_block(docs, monkeypatch):
    monkeypatch.setattr(langid, "BLOCK_LANGS", 3)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, " ".join(alphabet[k % 10] + alphabet[(k % 10) + 1] for _ in range(20))) for k in range(200)]
    df = docs(rows)
    df = df.withColumn("lang", (df["doc_id"] % 10).cast("string"))
    langs, blocks = langid.fit(df)
    assert langs == [str(k) for k in range(10)] and [b.shape[1] for b in blocks] == [3, 3, 3, 1]
    assert all(r["lang_pred"] == str(r["doc_id"] % 10) for r in langid.predict(df, langs, blocks).collect())
    whole = np.hstack(blocks)
    texts = [t for _, t in rows] + [None, "ab cd " * 40000]
    monkeypatch.setattr(langid, "ENTRIES", 64)
    assert langid.score(texts, langs, blocks)[0] == langid.score(texts, langs, whole)[0]
    assert np.allclose(langid.score(texts, langs, blocks)[1], langid.score(texts, langs, whole)[1])


def test_priors_are_those_of_all_rows(docs):
    df = docs([(k, "ab") for k in range(90)])
    df = df.withColumn("lang", (df["doc_id"] < 60).cast("string"))
    _, blocks = langid.fit(df, max_docs_per_lang=10)
    assert np.allclose(np.exp(blocks[0][langid.BUCKETS]), [1 / 3, 2 / 3])


def test_training_texts_are_whole():
    raw = np.arange(100_000).astype(np.uint8)
    chunks = quality.spread(raw)
    assert len(chunks) == -(-len(raw) // quality.HALF) - 1
    assert np.array_equal(chunks[:, : quality.HALF].reshape(-1), raw[: len(chunks) * quality.HALF])


def page(text):
    return f"<html><body><nav>Home</nav>{text}</body></html>"


def test_copies_of_a_page_do_not_erase_each_other(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(k, f"http://h.com/{k}", page(f"<div>{text}</div>")) for k in range(4)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert {r["text"] for r in out} == {text}


def test_chance_repeats_on_a_large_host_stay(spark):
    rng = random.Random(1)
    say = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))
    shared = "at the end of the long day"
    rows = [(k, f"http://h.com/{k}", page(f"<div>{say()} {shared if k < 2 else say()}</div><div>menu one two three four five six</div><div>Tags</div>")) for k in range(400)]
    out = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert out[0].endswith(shared) and out[1].endswith(shared)
    assert not any("menu" in t or "Tags" in t for t in out.values())


def test_repeated_runs_as_by_counting(spark):
    rng = random.Random(2)
    rows = []
    for k in range(40):
        blocks = [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(4)]
        rows.append((k, f"http://h{k % 2}.com/{k}", "".join(f"<div>{b}</div>" for b in blocks)))
    made = html_text.parsed(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = made.sparkSession.createDataFrame(html_text.repeated_runs(made).collect(), "run long").count()
    holders = defaultdict(set)
    for k, url, html in rows:
        blocks = [b.split() for b in re.findall("<div>(.*?)</div>", html)]
        stream = [w for b in blocks for w in b]
        for i in range(len(stream) - html_text.RUN + 1):
            holders[url[:9], tuple(stream[i : i + html_text.RUN])].add(html)
        for b in blocks:
            if len(b) < html_text.RUN:
                holders[url[:9], "short", tuple(b)].add(html)
    assert got == sum(len(v) > 1 for v in holders.values())


def test_notices_inside_articles_go(spark):
    rng = random.Random(3)
    say = lambda n=9: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    notice, quoted, copied = "this site is read by many so send it to your friends", say(), [say() for _ in range(4)]
    rows, want = [], {}

    def add(url, lead, *parts, gone=()):
        k = len(rows)
        rows.append((k, f"http://{url}/{k}", f"<main><h1>All news</h1>{''.join(f'<p>{x}</p>' for x in parts)}</main><div>{lead}</div>"))
        want[k] = "\n".join(["All news", *(x for x in parts if x not in gone), *([lead] if lead else [])])

    for k in range(12):
        add("h.com", say() if k < 2 else "", say(), notice, quoted if k < 6 else say(), say(), gone=[notice])
        add("copies.com", "", *copied, say())
    for _ in range(4):
        add("small.com", "", say(), notice, say())
    rows.append(rows[0])
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = [(r["page_id"], r["text"]) for r in html_text.extract(frame).collect()]
    assert dict(out) == want and len(out) == len(rows)


def test_repeated_blocks_as_by_counting(spark):
    rng = random.Random(5)
    said = [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 10))) for _ in range(8)]
    rows = [(k, f"http://h{k % 3}.com/{k}", "".join(f"<p>{b}</p>" for b in rng.sample(said, 4))) for k in range(60)]
    frame = spark.createDataFrame([(k, u, f"<article>{h}</article>") for k, u, h in rows], "page_id long, url string, html string")
    got = html_text.repeated_blocks(html_text.parsed(frame.repartition(4))).count()
    contents, holders = defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        contents[url[:9]].add(page)
        for b in re.findall("<p>(.*?)</p>", page):
            if len(b.split()) >= html_text.RUN:
                holders[url[:9], b].add(page)
    held = [len(v) > html_text.MOST * len(contents[host]) and len(v) >= html_text.NOTICE for (host, _), v in holders.items()]
    assert got == sum(held) and 0 < sum(held) < len(held)


def test_markup_that_cuts_no_block():
    said = lambda x: [t for _, t in html_text.blocks(x)]
    assert said("<p>see <select><option>x</select>ok</p>") == ["see ok"]
    assert said('a<a title="unclosed>b') == ["ab"]
    assert html_text.blocks('<main><p class="search-result">keep</p><div class="comments">x</div></main>') == [("body", "keep"), ("chrome", "x")]
    assert said("<p>x</p>" * 20000) == ["x"] * 20000


def test_terms_are_those_of_counting(docs):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in ("ab", "ec", "id", "of", "ug")] + ["Li", "Bo"]
    rows = []
    for k in range(120):
        value = f"user{k % 4}@mail.example" if rng.random() < 0.7 else ""
        near = ["Li"] if value.startswith("user1") and rng.random() < 0.9 else ["Bo"] if value.startswith("user2") else []
        words = [rng.choice(vocabulary[:-2]) for _ in range(9)] + near + [value] + [rng.choice(vocabulary[:-2]) for _ in range(9)]
        rows.append((k, " ".join(w for w in words if w)))
    df = docs(rows)
    got = {r["term"]: r["strength"] for r in pii.revealing_terms(df.select("doc_id", "text"), pii.scanned(df)).collect()}
    total, n_entity, n_term, both, backing = len(rows), Counter(), Counter(), defaultdict(set), defaultdict(set)
    for k, text in rows:
        found = [m for m in re.finditer(r"user\d@mail\.example", text)]
        n_term.update({w.lower() for w in re.findall(r"[A-Za-z]{2,}", text)})
        for m in found:
            n_entity[m[0]] += 1
            left, right = text[max(0, m.start() - pii.REACH) : m.start()], text[m.end() : m.end() + pii.REACH]
            left = re.sub(r"^[A-Za-z]+", "", left) if m.start() > pii.REACH else left
            right = re.sub(r"[A-Za-z]+$", "", right) if m.end() + pii.REACH < len(text) else right
            for w in {w.lower() for w in re.findall(r"[A-Za-z]{2,}", left + " " + right)}:
                both[m[0], w].add(k)
                backing[m[0], w].add((left, right))
    want = {}
    for (e, w), where in both.items():
        ic = -math.log2(n_entity[e] / total)
        strength = math.log2(len(where) * total / (n_entity[e] * n_term[w])) / ic if ic > 0 else 0
        if len(backing[e, w]) >= pii.SUPPORT and strength >= pii.GENERALISE:
            want[w] = max(want.get(w, 0), strength)
    assert {"li", "bo"} <= want.keys() == got.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)


def test_many_spans_in_one_text(docs):
    text = " ".join(f"user{k}@mail{k % 7}.com calls" for k in range(20_000))
    rows = {r["doc_id"]: r for r in pii.detect(docs([(1, text), (2, "x")])).collect()}
    assert rows[1]["n_email"] == 20_000 and rows[1]["spans"].endswith(f"email:{text.rindex('user')}:{len(text) - 6}")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs([(1, text), (2, "x")])).collect()}
    assert clean[1] == " ".join(["[EMAIL] calls"] * 20_000) and clean[2] == "x"

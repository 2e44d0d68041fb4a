"""WARC, language, toxicity, search, decontamination, URL filter and the
pipeline, with their edge rows."""

from __future__ import annotations

import hashlib
import os
import random
import sys
import time

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from bondmart.llm import decontaminate, kd_search, language, toxicity, url_filter, warc_op  # noqa: E402
from bondmart.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


def by(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    c = duckdb.connect()
    for t in ("pages", "embeddings", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = c.execute(SQL[name]).to_arrow_table().select(got.columns).to_pylist()
    assert by(got.collect()) == by(tuple(r.values()) for r in want)


def test_every_query_is_registered():
    import __spark_entry__
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


# --- WARC

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest int")


def test_warc_round_trip_with_edges(spark, tmpdir_path):
    big, r = "é" * 600, random.Random(1)
    noise = "".join(chr(r.randint(32, 0x2FFF)) for _ in range(300_000))
    rows = [(1, "http://a/", big, "p", 1), (2, None, big, "p", 1), (2, None, big, "p", 1), (3, "x\r\ny", None, "p", 1),
            (4, "u", "", "p", 1), (5, "u", "short", "p", 1), (6, "u", "short", "p", 1), (None, "u", big, "p", 1),
            (7, "u", "WARC/1.1\r\n\r\n\x1f\x8b\x08" * 200, "p", 1), (8, "u", noise, "p", 1),
            (9, "u", "x" * (1 << 24), "p", 1)]  # a member whose length needs all four bytes
    warc_op.write_archives(pages(spark, rows), f"{tmpdir_path}/a", 3)
    got = warc_op.read_archives(spark, f"{tmpdir_path}/a", True).collect()
    assert all(g.gap is None for g in got)
    want = []
    for i, url, html, *_ in rows:
        b = (html or "").encode()
        to = 2 if html == big and i == 1 else None
        want.append((i, " ".join((url or "").split()), "revisit" if to else "response", len(b),
                     hashlib.sha1(b).hexdigest(), to, b"" if to else b))
    assert by((g.page_id, g.url, g.record_type, g.payload_bytes, g.payload_digest, g.refers_to, bytes(g.payload))
              for g in got) == by(want)


def test_warc_of_no_pages(spark, tmpdir_path):
    warc_op.write_archives(pages(spark, []), f"{tmpdir_path}/a")
    assert warc_op.read_archives(spark, f"{tmpdir_path}/a").count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_later_records(packed):
    bodies = [f"body {i} ".encode() * 50 for i in range(6)]
    parts = [warc_op.page_record(i, "u", b, hashlib.sha1(b).hexdigest(), None) for i, b in enumerate(bodies)]
    if packed:
        parts = [warc_op.member(p) for p in parts]
    hurt = bytearray(parts[2])
    hurt[len(hurt) // 2] ^= 0x55
    data = b"junk" + parts[0] + parts[1] + bytes(hurt) + parts[3] + b"\0" * 9 + parts[4] + parts[5][:-30]
    got = list(warc_op.salvage(data))
    assert [f["warc-record-id"] for *_, f, _ in got if f] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
    gaps = [(at, n) for at, n, f, _ in got if f is None]
    first = 4 + len(parts[0]) + len(parts[1])
    third = first + len(parts[2]) + len(parts[3])
    assert gaps == [(0, 4), (first, len(parts[2])), (third, 9), (third + 9 + len(parts[4]), len(parts[5]) - 30)]
    assert all(reason for *_, f, reason in got if f is None)
    assert sum(n for _, n, *_ in got) == len(data)


def test_salvage_of_any_bytes_covers_them():
    r = random.Random(2)
    good = warc_op.member(warc_op.page_record(1, "u", b"x" * 99, hashlib.sha1(b"x" * 99).hexdigest(), None))
    for _ in range(200):
        data = bytearray(good * 3)
        for _ in range(r.randint(0, 4)):
            data[r.randrange(len(data))] = r.randrange(256)
        data = bytes(data[r.randrange(40):len(data) - r.randrange(40)])
        at = 0
        for begin, size, *_ in warc_op.salvage(data):
            assert begin == at
            at += size
        assert at == len(data)


# --- language

def documents():
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return [dict(zip(t, r)) for r in zip(*t.values())]


def test_language_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op4_language"](spark, SF).collect()}
    rows = documents()
    assert len(got) == len(rows)
    import zlib
    for r in rows:
        assert got[r["doc_id"]].held_out == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= got[r["doc_id"]].score <= 1
    held = [got[r["doc_id"]].lang_pred == r["lang"] for r in rows if got[r["doc_id"]].held_out]
    assert held and np.mean(held) >= 0.95


def test_language_edges(spark):
    rows = [(r["doc_id"], r["text"], r["lang"], "x", 2) for r in documents()]
    edges = [(1000, None, "en"), (1001, "", "en"), (1002, "12 %%% \n", "en"), (1003, "日本", None), (None, "the of and", "en"),
             (1, "the", "en"), (1004, "and the of " * 50_000, None)]
    schema = "doc_id long, text string, lang string, score string, held_out int"
    frame = spark.createDataFrame(rows + [(*e, "x", 2) for e in edges], schema)
    got = language.identify(frame).collect()
    assert len(got) == len(rows) + len(edges)
    pred = {g.doc_id: g for g in got}
    assert [pred[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert pred[1003].lang_pred in {"en", "de", "fr", "es"} and pred[1004].lang_pred == "en"
    assert pred[None].held_out is None
    assert language.identify(frame.limit(0)).count() == 0
    blank = frame.withColumn("lang", frame.lang.substr(1, 0)).replace("", None, "lang")
    assert {g.lang_pred for g in language.identify(blank).collect()} == {"und"}
    one = language.identify(frame.where("lang = 'fr'")).collect()
    assert {g.lang_pred for g in one} <= {"fr", "und"}


def test_codewords_differ():
    for n in (2, 3, 4, 5, 6, 12, 30):
        m = language.codewords(n)
        assert len({tuple(r) for r in m}) == n and all(abs(c.sum()) < n for c in m.T)


# --- toxicity

def test_machine_learns_an_interaction():
    r = np.random.default_rng(0)
    x = r.integers(0, 2, (4000, 6))
    y = (x[:, 0] & x[:, 1]).astype(float)  # neither term alone
    m = toxicity.Machine(np.arange(6, dtype=np.uint64), -1.0)
    m.fit(x.astype(np.int8), y, np.ones(4000), 600)
    v = m.v @ m.v.T
    odds = m.w0 + x @ m.w + sum(x[:, i] * x[:, j] * v[i, j] for i in range(6) for j in range(i))
    assert ((odds > 0) == (y > 0)).mean() > 0.99
    assert v[0, 1] > 1 > abs(v[2, 3])


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    got = QUERIES["op5_toxicity"](spark, d).toPandas()
    docs = pq.read_table(f"{d}/documents.parquet", columns=["doc_id"])
    assert len(got) == docs.num_rows and got.score.between(0, 1).all()
    held = got[got.held_out].merge(pq.read_table(f"{d}/labels.parquet").to_pandas(), on="doc_id")
    hit = held[held.toxic == 1].predicted.mean()
    false = held[held.toxic == 0].predicted.mean()
    # about a tenth of this table's label-1 texts is junk without any telling term
    assert hit >= 0.85 and false <= 0.02, (hit, false)


def test_toxicity_edges(spark):
    docs = [(i, f"plain words {i}" + " you idiot" * (i % 2), "x") for i in range(40)]
    docs += [(100, None, "x"), (101, "", "x"), (None, "idiot", "x"), (1, "again", "x"), (102, "idiot " * 100_000, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic string")
    kind = "doc_id long, toxic int, text string"
    labels = spark.createDataFrame([(i, i % 2, "t") for i in range(40)] + [(2, None, "t"), (None, 1, "t"), (3, 0, "t")], kind)
    got = toxicity.score(frame, labels).collect()
    assert len(got) == len(docs)
    by_id = {g.doc_id: g for g in got}
    assert by_id[102].predicted == 1 and 0 < by_id[100].score == by_id[101].score < 1
    assert all(g.score < 1e-6 for g in toxicity.score(frame, labels.limit(0)).collect())
    assert {g.predicted for g in toxicity.score(frame, labels.where("toxic = 1")).collect()} == {1}
    assert toxicity.score(frame.limit(0), labels).count() == 0


# --- search

def by_hand(rows, every, k):
    best = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            best[i] = min(best.get(i, e), e)
    vec = {i: [int(np.floor(float(np.float32(x)) * 1024)) for x in e] for i, e in best.items()}
    out = []
    for q in vec:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(vec[q], vec[c])), c) for c in vec if c != q and len(vec[c]) == len(vec[q]))
            out += [(q, n + 1, c, -v) for n, (v, c) in enumerate(s[:k])]
    return out


@pytest.mark.parametrize("dim", [2, 8])
def test_search_matches_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(kd_search, "SHARD_ROWS", 60)
    monkeypatch.setattr(kd_search, "BLOCK_ROWS", 7)
    monkeypatch.setattr(kd_search, "LEAF_ROWS", 8)
    r = np.random.default_rng(dim)
    rows = [(i, r.normal(size=dim).astype(np.float32).round(1).tolist()) for i in range(300)]
    rows += [(-100, [0.5] * dim), (400, None), (500, [float("nan")] * dim), (600, [None] * dim), (None, [1.0] * dim),
             (700, [1.0] * (dim + 1)), (800, [2.0] * (dim + 1)), (900, []), (1000, [float("inf")] * dim), (3, [9.0] * dim),
             (100, rows[100][1])]
    frame = spark.createDataFrame([(i, e, 1, 2) for i, e in rows], "vec_id long, embedding array<float>, dim int, score int")
    assert by(kd_search.top_inner_products(frame, 10, 5).collect()) == by(by_hand(rows, 10, 5))
    assert kd_search.top_inner_products(frame.limit(0)).count() == 0


def test_search_with_numbers_beyond_doubles(spark):
    rows = [(100, [3e6, 1.0]), (1, [2.9e6, 1.5]), (2, [2.9e6, 1.25]), (3, [-2.9e6, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert by(kd_search.top_inner_products(frame).collect()) == by(by_hand(rows, 100, 10))


# --- decontamination

ITEM = ("A train leaves the old station at 9 hours and Maria walks 12 km along the river before it overtakes her "
        "so how many minutes later does Maria see the train pass the bridge")


def found(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, template string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, decontaminate.find_items(d, b).select("doc_id", "item_id", "reparameterised").collect()), key=repr)


def test_decontamination_rules(spark):
    other = ITEM.replace("Maria", "Mary Ann").replace("12 km", "3.5 miles").replace(" 9 ", " 10 ")
    mixed = ITEM.replace("Maria walks", "Peter walks").replace("does Maria", "does Olga")
    filler = "some other words that say nothing of it. "
    docs = [(1, filler + ITEM + ". " + filler), (2, filler + other), (3, filler + mixed), (4, filler * 30),
            (5, " ".join(ITEM.split()[:12])), (6, None), (7, ""), (8, ITEM.upper()), (9, filler * 2000 + ITEM), (1, ITEM),
            (None, ITEM), (10, " ".join("Karl 7" for _ in range(200)))]
    items = [(1, ITEM), (2, None), (3, ""), (4, "too short"), (5, "Karl 7 Karl 7 Karl 7 Karl 7 Karl 7")]
    got = found(spark, docs, items)
    assert got == sorted([(1, 1, False), (1, 1, False), (2, 1, True), (9, 1, False), (None, 1, False)] + [
        g for g in got if g[0] == 8], key=repr)
    assert found(spark, docs, []) == [] and found(spark, [], items) == []


def test_slots_must_be_consistent():
    ok = decontaminate.consistent
    assert ok([("<num>", "1", "5"), ("<num>", "2", "5"), ("<num>", "1", "5")])
    assert not ok([("<num>", "1", "5"), ("<num>", "1", "6")])
    assert not ok([("<name>", "Ann", "Bob"), ("<name>", "Eve", "Bob")])


def test_decontamination_finds_the_planted_items(spark):
    docs = documents()
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    squeeze = lambda t: " ".join(t.split())
    want = {r["doc_id"] for r in docs for t in items["text"] if squeeze(t) in squeeze(r["text"] or "")}
    got = {r.doc_id for r in QUERIES["op9_decontaminate"](spark, SF).collect()}
    assert want and got == want


def test_a_text_that_repeats_an_item_very_often(spark):
    """30 000 copies of an item in one text are judged copy by copy."""
    item = ("A farmer named Bill sells 12 apples for 3 dollars each at the market, then walks home along the river and "
            "counts what is left in the old brown basket before the evening meal begins")
    changed = item.replace("12", "40").replace("Bill", "Tom")
    docs = [(1, " ".join([item + "."] * 30_000)), (2, " ".join([changed + "."] * 2000)), (3, "Nothing of the kind. " * 1000)]
    begin = time.time()
    got = decontaminate.find_items(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage, r.reparameterised) for r in got) == [(1, 7, 1.0, False), (2, 7, 1.0, True)]
    assert time.time() - begin < 240


def test_reparameterised_copies_against_brute_force(spark):
    """Items with other numbers and names, some with one value changed in two ways."""
    rng = random.Random(5)
    names, verbs = ["Anna", "Bruno", "Carla", "Dario", "Elena"], ["buys", "sells", "finds", "moves", "paints"]

    def item(a, b, n, m, v):
        return (f"Every morning {a} {v} {n} boxes near the station while {b} counts {m} tickets, so that {a} later has "
                f"{n} boxes and {b} keeps {m} tickets in the drawer")

    items, docs, want = [], [], set()
    for i in range(25):
        a, b = rng.sample(names, 2)
        n, m = rng.sample(range(10, 99), 2)
        items.append((i, item(a, b, n, m, f"{verbs[i % 5]} and {'abcde'[i // 5] * 4}")))
    for d in range(60):
        i = rng.randrange(25)
        a, b = rng.sample(names, 2)
        n, m = rng.sample(range(100, 999), 2)
        text = item(a, b, n, m, f"{verbs[i % 5]} and {'abcde'[i // 5] * 4}")
        if d % 3 == 0:  # the same slot with two values: no copy
            text = text.replace(f"later has {n}", f"later has {n + 1000}").replace(f"keeps {m}", f"keeps {m + 1000}")
            text = text.replace(f"{b} keeps", "Zora keeps")
        docs.append((d, f"Here is one more. {text}. That was all of it."))

    def slots(text):
        return tuple("<num>" if w.isdigit() else "<name>" if w in (*names, "Zora") else w.strip(",") for w in text.split()), [
            w for w in text.split() if w.isdigit() or w in (*names, "Zora")]

    for d, text in docs:
        shape, values = slots(text.split("one more. ")[1].split(". That")[0])
        for i, it in items:
            shape_i, values_i = slots(it)
            pairs = set(zip(values_i, values))
            if shape == shape_i and len(pairs) == len({x for x, _ in pairs}):
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_items(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect() if r.coverage > 0.9}
    assert want and got == want


# --- URLs

def test_url_edges(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://EXAMPLE.net/en/1?x#y"), (5, "http://example.net"),
            (6, "x://a.example.com/de/9"), (7, "https://notexample.com/de/9"), (8, "http://é.org/fr/1"), (9, "http://net/"),
            (10, "http://h/" + "/".join(str(i) for i in range(3000))), (11, "://"), (4, "http://EXAMPLE.net/en/1?x#y")]
    frame = spark.createDataFrame([(i, u, "h", "v", 0) for i, u in rows], "page_id long, url string, host string, verdict string, n int")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge(frame).collect()}
    assert url_filter.judge(frame).count() == len(rows)
    assert got[1] == got[2] == got[3] == got[11] == ("", "", None, "allow")
    assert got[4] == ("example.net", "/en/1", "example.net/en/", "allow")
    assert got[5] == ("example.net", "", None, "allow")
    assert got[6][2:] == ("example.com/de/", "block") and got[7][2:] == (None, "allow")
    assert got[8] == ("é.org", "/fr/1", "org/fr/", "allow") and got[9][2:] == ("net/", "block")
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_templates_spread_labels(spark):
    """Labelled pages of a template decide for its other pages; variable and alike branches are one."""
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows = [(i, f"http://s.com/bad/{w}/{i}") for i, w in enumerate(words)]
    rows += [(1000 + i, f"http://s.com/bad/zz{w}/x") for i, w in enumerate(words[:5])]
    rows += [(2000 + i, f"http://s.com/good/{w}/{i}") for i, w in enumerate(words)]
    rules = {f"s.com/bad/{w}/": "block" for w in words[:40]} | {f"s.com/good/{w}/": "allow" for w in words[:40]}
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert all(got[i] == "block" for i in range(100))
    assert all(got[2000 + i] == "allow" for i in range(100))


def _verdicts(spark, urls, rules):
    rows = list(enumerate(urls))
    got = {r.page_id: tuple(r) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    c = duckdb.connect()
    c.execute("create table pages as select * from (select unnest(?) as page_id, unnest(?) as url)",
              [[i for i, _ in rows], [u for _, u in rows]])
    assert got == {r[0]: r for r in c.execute(url_filter.sql(rules)).fetchall()}
    return [got[i][4] for i, _ in rows]


def test_tree_does_not_depend_on_how_often_a_site_is_seen(spark):
    """1000 names under a host, 12 of them ruled: 4 or 6 pages a name, each row once or three times."""
    rules = {f"h.com/u/{chr(97 + i)}name/": "block" for i in range(12)}
    names = [f"{chr(97 + i)}name" for i in range(12)] + [f"{a}{b}{c}" for a in "bcdfghjklm" for b in "aeiouvwxyz" for c in "bcdfghjklm"][:988]
    for pages, copies in ((4, 1), (6, 1), (4, 3)):
        urls = [f"http://h.com/u/{n}/{'abcdef'[i]}" for n in names for i in range(pages)] * copies
        assert set(_verdicts(spark, urls, rules)) == {"block"}


def test_tree_backs_off_by_branches(spark):
    """Labelled branches vote once each, however large; all levels count."""
    deep = "/".join("abcdefg")
    urls = [f"http://one.com/bad/{w}" for w in ("p", "q", "r")] + ["http://one.com/other/s"]
    urls += [f"http://three.com/{b}/{i}" for b in "xyz" for i in "ab"] + ["http://three.com/new/a", "http://three.com/"]
    urls += [f"http://split.com/{b}/a" for b in "wxyz"] + ["http://split.com/new/a"]
    urls += [f"http://deep.com/{deep}/{b}/{i}" for b in "xyz" for i in "ab"] + [f"http://deep.com/{deep}/new/a", "http://deep.com/a/z"]
    rules = {"one.com/bad/": "block", **{f"three.com/{b}/": "block" for b in "xyz"}, "split.com/w/": "allow",
             **{f"split.com/{b}/": "block" for b in "xyz"}, **{f"deep.com/{deep}/{b}/": "block" for b in "xyz"}}
    rules |= {f"none{i}.com/{i}/": "block" for i in range(150)}  # many rules
    got = dict(zip(urls, _verdicts(spark, urls, rules)))
    assert got["http://one.com/other/s"] == "allow" and got["http://three.com/new/a"] == "block"
    assert got["http://three.com/"] == "block" and got["http://split.com/new/a"] == "allow"
    assert got[f"http://deep.com/{deep}/new/a"] == "block" and got["http://deep.com/a/z"] == "allow"


# --- pipeline

def test_pipeline_against_its_operators_by_hand(spark):
    from test_texts import WORDS, removed_by_hand, sha, simhash_by_hand
    import public_tokenizers
    import sentencepiece

    rows = {r["doc_id"]: r for r in documents()}
    lang = {r.doc_id for r in QUERIES["op4_language"](spark, SF).collect() if r.lang_pred != "und" and not r.ambiguous}
    left = [(i, rows[i]["text"]) for i in sorted(lang)]
    keep = {i for i, _, c in simhash_by_hand(left, 4, 4) if i == c}
    left = [(i, t) for i, t in left if i in keep]
    cut = removed_by_hand(left, 13)
    first, texts = {}, []
    for i, t in left:  # sorted by id
        w = WORDS.findall(t)
        keys = [tuple(w[j:j + 13]) for j in range(len(w) - 12)]
        gone = {p for j, key in enumerate(keys) if first.get(key, i) < i for p in range(j, j + 13)}
        for key in keys:
            first.setdefault(key, i)
        if len(gone) < len(w):
            texts.append((i, " ".join(x for p, x in enumerate(w) if p not in gone) if gone else t))
    assert sum(n for _, _, n, _ in cut) == sum(len(WORDS.findall(t)) for _, t in left) - sum(
        len(WORDS.findall(t)) for _, t in texts)
    items = [" ".join(t.split()) for t in pq.read_table(f"{SF}/benchmark.parquet").to_pydict()["text"]]
    texts = [(i, t) for i, t in texts if not any(b in " ".join(t.split()) for b in items)]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, t in texts:
        ids = sp.encode(t)
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(sp.decode(ids).encode())))
    assert by(corpus_pipeline.run(spark, SF).collect()) == by(want)


def test_stages_take_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "one", "en", "s", 3), (3, "one", "en", "s", 3),
           (None, "two words", "de", None, 9)]
    for rows in ([], odd):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, spark.createDataFrame(rows, schema), SF)
            got = out.collect()
            if name != "sentencepiece":
                assert out.columns == [c.split()[0] for c in schema.split(", ")]
            assert len(got) <= len(rows)

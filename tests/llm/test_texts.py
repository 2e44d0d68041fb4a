"""Operators on whole texts against brute force, with their edge rows."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from bondmart.llm import sentencepiece_op, simhash, substring_dedup, token_counts  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, fp string, spans int, row_key string"  # extra names that operators use
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def given():
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return list(zip(t["doc_id"], t["text"]))


def edge_rows():
    r = random.Random(3)
    vocab = ["the", "of", "Tree", "höhe", "x", "12", "<|endoftext|>", "▁", "日本", "don't", "a\tb", "  ", "\n"]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(0, 60)))) for i in range(60)]
    long = " ".join(f"w{r.randint(0, 9)}" for _ in range(40_000))
    return rows + [(100, None), (101, ""), (102, " \n\t"), (103, "a"), (104, long), (105, long), (106, "z " * 5000),
                   (3, rows[3][1]), (107, rows[3][1]), (None, long), (None, None), (108, "\x0b\x1c \xa0 　x")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "x", 1, None) for i, t in rows], SCHEMA)


def cases():
    return pytest.mark.parametrize("rows", [given(), edge_rows(), []], ids=["given", "edges", "empty"])


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def by(rows):
    return sorted(map(tuple, rows), key=repr)


@cases()
def test_token_counts_match_the_library(spark, rows):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert by(token_counts.token_counts(frame(spark, rows)).collect()) == by(want)


def test_token_counts_of_every_prefix(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", "don't we'll  go\n\n x", "é日本 <|endoftext|>  12", " a \x1c\xa0b 're", given()[3][1][:300]]
    got = token_counts.token_counts(frame(spark, list(enumerate(texts))), tables=True).collect()
    own = token_counts.counter(public_tokenizers.path("byte_bpe_50k.json"))
    for row in got:
        t, table = texts[row.doc_id], row.prefix_tokens
        assert len(table) == len(t.encode()) + 1
        at = [len(t[:i].encode()) for i in range(len(t) + 1)]
        want = [len(lib.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert [table[i] for i in at] == want
        assert all(table[i] == -1 for i in set(range(len(table))) - set(at))
        assert own.cut(t, 3) == max(a for a, n in zip(at, want) if n <= 3)


@cases()
def test_sentencepiece_matches_the_library(spark, rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, t in rows:
        ids = sp.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(sp.decode(ids).encode())))
    assert by(sentencepiece_op.encode_decode(frame(spark, rows)).collect()) == by(want)


def test_sentencepiece_on_random_pieces(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    own, r = sentencepiece_op.backtracker(path), random.Random(5)
    pieces = list(own.id)
    for _ in range(3000):
        t = "".join(r.choice(pieces) for _ in range(r.randint(1, 8))).replace("▁", r.choice([" ", "▁"]))
        ids = sp.encode(t)
        assert own.encode(t) == ",".join(map(str, ids))
        assert own.decode(ids) == sp.decode(ids) == own.round_trip(t)[1]


def removed_by_hand(rows, k):
    first, lists = {}, [(i, WORDS.findall(t or "")) for i, t in rows]
    for i, w in lists:
        for j in range(len(w) - k + 1 if i is not None else 0):
            key = tuple(w[j:j + k])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in lists:
        gone = set()
        for j in range(len(w) - k + 1 if i is not None else 0):
            if first[tuple(w[j:j + k])] < i:
                gone.update(range(j, j + k))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), sha(" ".join(kept).encode())))
    return out


@cases()
@pytest.mark.parametrize("k,m", [(13, 4), (3, 2)])
def test_substring_dedup_matches_brute_force(spark, rows, k, m):
    assert by(substring_dedup.removal_report(frame(spark, rows), k, m).collect()) == by(removed_by_hand(rows, k))


def test_substring_dedup_over_many_tasks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 20_000)
    rows = given()
    got = substring_dedup.removal_report(frame(spark, rows).repartition(7), 5, 2).collect()
    assert by(got) == by(removed_by_hand(rows, 5))


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    import numpy as np
    monkeypatch.setattr(substring_dedup, "rolling", lambda h, k: np.zeros(max(0, len(h) - k + 1), np.uint64))
    strings = [b"a b c d", b"b c d e", b"a b c"]
    skm, place, first = substring_dedup._first_windows(strings, np.array([2, 2, 1]), 3)
    assert first.tolist() == [0, 1, 1, 3, 0]


def simhash_by_hand(rows, size, radius):
    prints = []
    for _, t in rows:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[j:j + size]) for j in range(max(1, len(w) - size + 1))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    comp = [i for i, _ in rows]
    live = [k for k, (i, _) in enumerate(rows) if i is not None]
    while True:
        new = list(comp)
        for a in live:
            new[a] = min(comp[b] for b in live if (prints[a] ^ prints[b]).bit_count() <= radius)
        if new == comp:
            return [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, comp)]
        comp = new


@cases()
@pytest.mark.parametrize("radius", [4, 1])
def test_simhash_matches_brute_force(spark, rows, radius):
    got = simhash.near_duplicates(frame(spark, rows), 4, radius).collect()
    assert by(got) == by(simhash_by_hand(rows, 4, radius))


def test_simhash_splits_full_keys(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 3)
    monkeypatch.setattr(simhash, "BATCH_ROWS", 50)
    rows = [(i, " ".join(t.split()[:40])) for i, t in given()]
    rows += [(1000 + i, rows[i % 9][1] + f" tail{i}") for i in range(60)]
    got = simhash.near_duplicates(frame(spark, rows), 4, 4).collect()
    assert by(got) == by(simhash_by_hand(rows, 4, 4))

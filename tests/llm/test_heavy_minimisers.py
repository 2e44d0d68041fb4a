"""A phrase in very many documents does not make one large group."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from bondmart.llm import substring_dedup
from test_texts import by, frame, removed_by_hand

PHRASES = ["one of the", "at the end of the day it is what it is all"]  # 3 and 12 words


def rows(n: int, phrase: str):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    out = [(i, " ".join([*(word() for _ in range(14)), phrase, *(word() for _ in range(14))])) for i in range(n)]
    out += [(n + i, "x y z " + out[r.randrange(n)][1]) for i in range(n // 4)]  # copies with another beginning
    return out + [(None, out[0][1]), (3, out[1][1]), (n + 1, ""), (n + 2, None)]


@pytest.mark.parametrize("phrase", PHRASES)
def test_heavy_buckets_are_dealt_and_exact(spark, monkeypatch, phrase):
    data = rows(400, phrase)
    monkeypatch.setattr(substring_dedup, "HEAVY_BYTES", 6000)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 2000)
    got = substring_dedup.removal_report(frame(spark, data), 13, 3).collect()
    assert by(got) == by(removed_by_hand(data, 13))


@pytest.mark.parametrize("phrase", PHRASES)
def test_no_bucket_holds_a_phrase_of_all_documents(phrase):
    data = [(i, t) for i, t in rows(400, phrase)[:400]]
    texts, ids = [t.encode() for _, t in data], np.arange(400)
    doc, place, size, strings, bucket, again = substring_dedup._cut(texts, ids, 13, 3, 1000, None)
    most = np.bincount(bucket, [len(s) for s in strings])
    top = {int(b): int(most[b]) for b in np.flatnonzero(most > 10_000)}
    assert top
    heavy = substring_dedup.Heavy(top, 1000, 13)
    heavy.parts[:] = 64
    heavy.base = 1000 + np.arange(len(heavy.ids)) * 64
    cut = substring_dedup._cut(texts, ids, 13, 3, 1000, heavy)
    dealt = np.bincount(cut[4], [len(s) for s in cut[3]])
    assert dealt.max() <= 10_000 < most.max() and not any(dealt[b] for b in top)
    windows = lambda c: sum(c[2].tolist())
    assert windows(cut) == windows((doc, place, size))


def test_counting_a_bucket_takes_little_more_than_its_strings():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    strings = [" ".join(word() for _ in range(18)).encode() for _ in range(100_000)]
    strings += strings[:2000]
    size = np.array([len(s.split()) - 12 for s in strings], np.int64)
    tracemalloc.start()
    skm, place, first = substring_dedup._first_windows(strings, size, 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    held = sum(map(len, strings))
    own = np.arange(len(first))
    again = skm >= 100_000
    assert (first[~again] == own[~again]).all() and (first[again] == own[:again.sum()]).all()
    assert peak < 7 * held, (peak, held)  # with all words at once 15 times, now 5

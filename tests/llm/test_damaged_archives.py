"""Salvage of damaged and foreign archives: what is kept, and in what time."""

from __future__ import annotations

import base64
import hashlib
import time

import pytest

from bondmart.llm import toxicity, url_filter, warc_op


def rec(i, body=b"x" * 40, digest=None):
    return warc_op.page_record(i, "u", body, digest or hashlib.sha1(body).hexdigest(), None)


def ids(got):
    return [f["warc-record-id"][10:-1] for *_, f, _ in got if f]


@pytest.mark.parametrize("unit", [b"\x1f\x8b\x08", b"\x1f\x8b\x08\x1f", b"\x1f\x8b\x08\x08abc", b"WARC/1.1\r\n", b"WARC/1.x\r\n", b"WARC/1.",
                                  b"WARC/1.1\r\nA: b\r\n"], ids=range(7))
def test_false_signatures_take_linear_time(unit):
    data = unit * (10_000_000 // len(unit)) + warc_op.member(rec(7))
    begin = time.process_time()
    got = list(warc_op.salvage(data))
    assert time.process_time() - begin < 60
    assert ids(got) == ["7"] and sum(n for _, n, *_ in got) == len(data)


def test_good_neighbours_of_a_bad_record_in_a_member():
    bad = rec(2, digest="0" * 40)
    data = warc_op.member(rec(1) + bad + rec(3)) + warc_op.member(rec(4))
    got = list(warc_op.salvage(data))
    assert ids(got) == ["1", "3", "4"]
    (reason,) = [r for *_, f, r in got if f is None]
    assert reason == f"digest in bytes {len(rec(1))} to {len(rec(1) + bad)} of a member"


def test_checked_records_of_a_truncated_member():
    bodies = [hashlib.sha512(bytes([i])).digest() * 3000 for i in range(3)]
    whole = warc_op.member(b"".join(rec(i, b) for i, b in enumerate(bodies)))
    got = list(warc_op.salvage(whole[:-10] + warc_op.member(rec(9))))
    assert "0" in ids(got) and ids(got)[-1] == "9"
    assert [(at, n) for at, n, f, _ in got if f is None] == [(0, len(whole) - 10)]


def test_usual_digests():
    body = b"<html>x</html>"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    sha, out = base64.b32encode(hashlib.sha1(body).digest()).decode(), []
    for digest in (f"sha1:{sha}", f"SHA-1:{hashlib.sha1(body).hexdigest().upper()}", f"sha256:{hashlib.sha256(block).hexdigest()}",
                   "blake3:unknown", "sha1:" + sha[::-1]):
        out.append(warc_op.record([("WARC-Type", "response"), ("Content-Type", "application/http; msgtype=response"),
                                   ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Payload-Digest", digest)], block))
    got = [(f is not None, reason) for *_, f, reason in warc_op.salvage(b"".join(out))]
    assert got == [(True, "")] * 4 + [(False, "digest")]


def test_files_are_bounded_by_bytes(spark, tmpdir_path, monkeypatch):
    import os
    monkeypatch.setattr(warc_op, "ROW_BYTES", 5000)
    monkeypatch.setattr(warc_op, "FILE_BYTES", 20_000)
    rows = [(i, "u", base64.b64encode(hashlib.sha512(bytes([i])).digest() * 20).decode() + str(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc_op.write_archives(df, f"{tmpdir_path}/a")
    sizes = [os.path.getsize(f"{tmpdir_path}/a/{f}") for f in os.listdir(f"{tmpdir_path}/a") if f.startswith("part")]
    assert len(sizes) > 1 or max(sizes) < 25_000
    got = warc_op.read_archives(spark, f"{tmpdir_path}/a").collect()
    assert sorted(r.page_id for r in got) == list(range(60)) and all(r.gap is None for r in got)


def test_long_url_segments_take_linear_time(spark):
    urls = [(1, "http://h.com/" + "0a" * 50_000 + "z"), (2, "http://h.com/" + "a0" * 50_000), (3, "http://h.com/0123456a"),
            (4, "http://h.com/a1234567"), (5, "http://h.com/abcdef12")]
    df = spark.createDataFrame(urls, "page_id long, url string")
    begin = time.time()
    assert url_filter.judge(df).count() == 5
    kinds = {r.page_id: r.s[0] for r in df.select("page_id", url_filter.typed_segments(url_filter.split_url(df.url)[1]).alias("s")).collect()}
    assert kinds == {1: "{s}", 2: "{x}", 3: "{x}", 4: "a{n}", 5: "abcdef{n}"}
    assert time.time() - begin < 60


def test_rows_that_share_a_labelled_id_are_learnt_from_once(spark, monkeypatch):
    rows = [(i, f"good text {i} fine words") for i in range(40)] + [(100 + i, f"vile insult {i} nasty") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows], "doc_id long, toxic int")
    docs = lambda copies: spark.createDataFrame(rows * copies, "doc_id long, text string")
    seen, fit = [], toxicity.Machine.fit
    monkeypatch.setattr(toxicity.Machine, "fit", lambda self, x, y, w: (seen.append(len(y)), fit(self, x, y, w))[1])
    monkeypatch.setattr(toxicity, "SEEN", 2)
    toxicity.learn(docs(1), labels)
    toxicity.learn(docs(30), labels)
    assert seen[0] == seen[1] <= 80

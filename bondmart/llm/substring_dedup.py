"""Removal of repeated passages by super-k-mer partitioning.

A window is k consecutive words. The minimiser of a window is the least hash
of its m-word grams; consecutive windows of one document that share it form a
super-k-mer, which travels as one packed string (its words joined by spaces)
to the bucket of its minimiser, so all occurrences of a window meet in one
bucket while most of the text is sent about three times instead of k times.
In a bucket, windows are sorted by a 64-bit hash, runs of equal windows are
checked byte for byte, and each window gets the least doc_id that it starts in.

Before anything is sent, each task combines its own rows: of equal
super-k-mers only the first document's copy travels, the windows of later
documents are known to be repeats at once. A group of copies, however large,
so sends one string per task and super-k-mer. Strings of a bucket are packed
into one compressed block per task and chunk of text. The number of buckets
follows the bytes of text.

A minimiser with very many surroundings would make one large bucket. The bytes
of every bucket are counted first; a heavy bucket's windows travel one by one,
dealt by the hash of the whole window to as many buckets as its bytes need.
Equal windows still meet, and the rest of the text is sent as before.

Defined cases: null text has no words; shorter texts than k words lose
nothing; rows that share a doc_id are one document for the comparison, and
each keeps its own row (equal texts under one doc_id get equal rows); rows
with a null doc_id lose nothing and make no other row lose words; repeats
within one document stay; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bondmart.llm.common import Words, byte_texts, chunks, column, portions, rolling, ship, sliding_min, span_hash, table

WINDOW, GRAM = 13, 3
CHUNK_BYTES = 2 << 20     # text worked on at once in a task
BUCKET_BYTES = 12 << 20   # packed strings per bucket, about; a third of it is text
HEAVY_BYTES = 48 << 20    # packed strings of a bucket that is dealt by window
SLICE_BYTES = 1 << 19     # packed strings of a bucket whose words are looked at at once
LONGEST_RUN = 256         # windows in one super-k-mer; a longer run goes on in the next

_BLOCK = "bucket long, docs binary, keys binary, firsts binary, counts binary, packed binary"
_SPAN = "doc_id long, row_key long, first long, past long"


def _pack(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] + [pa.binary()] * 5
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


class Heavy:
    """The heavy buckets and, for each, its own range of further buckets."""

    def __init__(self, weights: dict[int, int], buckets: int, k: int):
        self.ids = np.array(sorted(weights), np.int64)
        # a window sent alone has k words instead of about k / 3
        self.parts = np.array([-(-(k + 2) // 3 * weights[i] // BUCKET_BYTES) for i in sorted(weights)], np.int64)
        self.base = buckets + np.cumsum(self.parts) - self.parts
        self.all = buckets + int(self.parts.sum())

    def split(self, bucket: np.ndarray, head: np.ndarray, size: np.ndarray, window):
        """Super-k-mers with those of heavy buckets cut into their windows, in the order of the text."""
        nth = np.minimum(np.searchsorted(self.ids, bucket), len(self.ids) - 1)
        heavy = self.ids[nth] == bucket
        if not heavy.any():
            return bucket, head, size
        own = np.flatnonzero(heavy)
        which = np.repeat(own, size[own])
        alone = head[which] + np.arange(len(which)) - np.repeat(np.cumsum(size[own]) - size[own], size[own])
        nth = nth[which]
        dealt = self.base[nth] + (window(alone) % self.parts[nth].astype(np.uint64)).astype(np.int64)
        bucket, head, size = (np.concatenate([x[~heavy], y]) for x, y in (
            (bucket, dealt), (head, alone), (size, np.ones(len(alone), np.int64))))
        order = np.argsort(head, kind="stable")
        return bucket[order], head[order], size[order]


def _cut(texts: list[bytes], ids: np.ndarray, k: int, m: int, buckets: int, heavy: Heavy | None):
    """Super-k-mers of texts sorted by id: text, place, windows, string, bucket,
    and whether an earlier document here has it; None if there are none."""
    words = Words(texts)
    n = len(words.start)
    if n < k:
        return None
    hashes = span_hash(words.bytes, words.start)
    grams = rolling(hashes, m)
    least = sliding_min(grams, k - m + 1)  # by window
    at = np.flatnonzero(words.doc[:n - k + 1] == words.doc[k - 1:])
    if not len(at):
        return None
    least, doc = least[at], words.doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(at)))
    parts = -(-size // LONGEST_RUN)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    head = np.repeat(head, parts) + nth * LONGEST_RUN
    size = np.minimum(np.repeat(size, parts) - nth * LONGEST_RUN, LONGEST_RUN)
    bucket = (least[head] % np.uint64(buckets)).astype(np.int64)
    if heavy:
        bucket, head, size = heavy.split(bucket, head, size, lambda w: rolling(hashes, k)[at[w]])
    begin, doc = at[head], doc[head]
    first_word = np.searchsorted(words.doc, np.arange(len(texts)))
    place = begin - first_word[doc]
    data, seen = words.data, {}
    strings = [data[a:b] for a, b in zip(words.start[begin].tolist(), words.end[begin + size + k - 2].tolist())]
    first = np.fromiter(map(seen.setdefault, strings, range(len(strings))), np.int64, len(strings))
    owner = ids[doc]
    return doc, place, size, strings, bucket, owner > owner[first]


def _super_kmers(texts: list[bytes], ids: np.ndarray, keys: np.ndarray, k: int, m: int, buckets: int,
                 heavy: Heavy | None):
    """Blocks of super-k-mers by bucket, and one block of spans that are
    already known to be repeats. Texts are sorted by id."""
    if (cut := _cut(texts, ids, k, m, buckets, heavy)) is None:
        return
    doc, place, size, strings, bucket, again = cut
    owner = ids[doc]
    press = zstandard.ZstdCompressor(level=6).compress

    def where(s: np.ndarray) -> tuple[bytes, ...]:
        return tuple(press(x[s].astype(np.int64).tobytes()) for x in (owner, keys[doc], place, size))

    if again.any():
        yield (-1 - int(keys[0] & 0xFFFF), *where(np.flatnonzero(again)), None)
    send = np.flatnonzero(~again)
    bucket = bucket[send]
    order = np.argsort(bucket, kind="stable")
    send, bucket = send[order], bucket[order]
    edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    for a, b in zip(edges[:-1], edges[1:]):
        s = send[a:b]
        yield (int(bucket[a]), *where(s), press(b"\n".join([strings[i] for i in s])))


def _weigh(k: int, m: int, buckets: int):
    """Bytes that each bucket gets, by chunk of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, CHUNK_BYTES):
                texts = byte_texts(part)
                ids = column(part, "doc_id").to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                if (cut := _cut([texts[i] for i in order], ids[order], k, m, buckets, None)) is None:
                    continue
                *_, strings, bucket, again = cut
                sent = np.flatnonzero(~again)
                found, nth = np.unique(bucket[sent], return_inverse=True)
                sizes = np.fromiter(map(len, strings), np.int64, len(strings))[sent]
                total = np.bincount(nth, sizes, len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], ["bucket", "bytes"])

    return run


def _split(k: int, m: int, buckets: int, heavy: Heavy | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, CHUNK_BYTES):
                texts = byte_texts(part)
                ids = column(part, "doc_id").to_numpy(zero_copy_only=False)
                keys = column(part, "row_key").to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                rows = list(_super_kmers([texts[i] for i in order], ids[order], keys[order], k, m, buckets, heavy))
                if rows:
                    yield _pack(rows)

    return run


def _windows(data: bytes, length: np.ndarray, size: np.ndarray, k: int):
    """Hash and byte range of every window of the strings joined in data, each
    followed by one space. Worked in slices, as it needs some 100 bytes a word."""
    total = int(size.sum())
    window, begin, past = np.empty(total, np.uint64), np.empty(total, np.int64), np.empty(total, np.int64)
    buffer, at, done = np.frombuffer(data, np.uint8), 0, 0
    for a, b in chunks(length.tolist(), SLICE_BYTES):
        upto = at + int(length[a:b].sum())
        part = buffer[at:upto]
        end = np.flatnonzero(part == 0x20)
        start = np.append(0, end[:-1] + 1)
        n = size[a:b]
        own = np.arange(n.sum()) + (k - 1) * np.repeat(np.arange(len(n)), n)  # a string has k - 1 words more than windows
        to = done + len(own)
        window[done:to] = rolling(span_hash(part, start), k)[own]
        begin[done:to], past[done:to] = start[own] + at, end[own + k - 1] + at
        at, done = upto, to
    return window, begin, past


def _same_bytes(data: bytes, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> bool:
    """Whether every data[a:b] equals its data[c:d]."""
    step = 1 << 14
    return all(data[p:q] == data[r:s] for i in range(0, len(a), step)
               for p, q, r, s in zip(*(x[i:i + step].tolist() for x in (a, b, c, d))))


def _first_windows(strings: list[bytes], size: np.ndarray, k: int):
    """For every window of the strings (sorted by document): index of its
    string, its place in it, and the first window equal to it."""
    length = np.fromiter((len(s) + 1 for s in strings), np.int64, len(strings))
    data = b" ".join(strings) + b" "
    window, begin, past = _windows(data, length, size, k)
    total = len(window)
    order = np.argsort(window, kind="stable")
    window = window[order]
    new = np.append(True, window[1:] != window[:-1])
    del window
    head = order[np.flatnonzero(new)]
    first = np.empty(total, np.int64)
    first[order] = head[np.cumsum(new) - 1]
    del order, head
    skm = np.repeat(np.arange(len(size)), size)
    # equal hashes, checked: consecutive windows whose firsts are consecutive are compared as one stretch
    other = np.flatnonzero(first != np.arange(total))
    if len(other):
        f = first[other]
        new = np.append(True, (np.diff(other) != 1) | (np.diff(f) != 1) | (np.diff(skm[other]) != 0)
                        | (np.diff(skm[f]) != 0))
        a = np.flatnonzero(new)
        z = np.append(a[1:], len(other)) - 1
        if not _same_bytes(data, begin[other[a]], past[other[z]], begin[f[a]], past[f[z]]):
            known: dict[bytes, int] = {}  # two windows share a hash: tell them apart by their bytes
            for i, (p, q) in enumerate(zip(begin.tolist(), past.tolist())):
                first[i] = known.setdefault(data[p:q], i)
    del begin, past
    return skm, np.arange(total) - np.repeat(np.cumsum(size) - size, size), first


def _count(k: int):
    names = [c.split()[0] for c in _SPAN.split(", ")]

    def spans(docs, keys, firsts, pasts) -> pa.Table:
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in (docs, keys, firsts, pasts)], names)

    def run(key: tuple, block: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress

        def column_of(name: str) -> Iterator[bytes]:
            return (unpack(x.as_py()) for x in block.column(name))

        def whole(name: str) -> np.ndarray:
            return np.frombuffer(b"".join(column_of(name)), np.int64)

        docs, keys, firsts, size = map(whole, ("docs", "keys", "firsts", "counts"))
        if key[0].as_py() < 0:
            return spans(docs, keys, firsts, firsts + size + k - 1)
        strings = [s for packed in column_of("packed") for s in packed.split(b"\n")]
        order = np.argsort(docs, kind="stable")
        docs, keys, firsts, size = docs[order], keys[order], firsts[order], size[order]
        strings = [strings[i] for i in order]
        skm, place, first = _first_windows(strings, size, k)
        hit = np.flatnonzero(docs[skm] > docs[skm[first]])
        if not len(hit):
            return spans(*([np.zeros(0, np.int64)] * 4))
        new = np.append(True, (np.diff(hit) != 1) | (np.diff(skm[hit]) != 0))
        a = np.flatnonzero(new)
        z = np.append(a[1:], len(hit)) - 1
        s = skm[hit[a]]
        return spans(docs[s], keys[s], firsts[s] + place[hit[a]], firsts[s] + place[hit[z]] + k)

    return run


def repeated_spans(docs: DataFrame, k: int = WINDOW, m: int = GRAM) -> DataFrame:
    """doc_id, row_key, first, past: ranges of words of a row covered by
    windows that also start in a document with a smaller doc_id. row_key is
    xxhash64(text)."""
    if k < m:
        raise ValueError("the window must hold a gram")
    ship(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_key"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-3 * size // BUCKET_BYTES))
    heavy = None
    if size * k > HEAVY_BYTES:  # less can't fill a heavy bucket
        weights = rows.select("doc_id", "text").mapInArrow(_weigh(k, m, buckets), "bucket long, bytes long").groupBy(
            "bucket").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > HEAVY_BYTES).collect()
        if weights:  # at most one for each HEAVY_BYTES of strings
            heavy = Heavy({r["bucket"]: r["bytes"] for r in weights}, buckets, k)
    # the exchange has a partition per bucket, or the session's own number if that is more
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), heavy.all if heavy else buckets)
    return (rows.mapInArrow(_split(k, m, buckets, heavy), _BLOCK).repartition(parts, "bucket")
            .groupBy("bucket").applyInArrow(_count(k), _SPAN))


def _keep(words: list[bytes], spans) -> tuple[list[bytes], int]:
    if spans is None:
        return words, 0
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, [s["first"] for s in spans], 1)
    np.add.at(gone, [s["past"] for s in spans], -1)
    kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
    return [words[i] for i in kept], len(words) - len(kept)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in portions(whole, CHUNK_BYTES)):
        n, removed, digests = [], [], []
        for text, spans in zip(byte_texts(batch), column(batch, "spans").to_pylist()):
            words = (text or b"").split()  # bytes split at exactly these white-space bytes
            kept, gone = _keep(words, spans)
            n.append(len(words))
            removed.append(gone)
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(digests, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in portions(whole, CHUNK_BYTES)):
        texts, removed, left = column(batch, "text").to_pylist(), [], []
        for i, spans in enumerate(column(batch, "spans").to_pylist()):
            if spans is None:
                removed.append(0)
                left.append(None)
                continue
            kept, gone = _keep(texts[i].encode().split(), spans)
            texts[i] = b" ".join(kept).decode()
            removed.append(gone)
            left.append(len(kept))
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        cols |= {"text": pa.array(texts, pa.string()), "n_removed": pa.array(removed, pa.int64()),
                 "n_left": pa.array(left, pa.int64())}
        del cols["spans"]
        yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def with_spans(docs: DataFrame, k: int = WINDOW, m: int = GRAM) -> DataFrame:
    """docs with ``spans``: the ranges of words to remove (null: none)."""
    spans = repeated_spans(docs, k, m).groupBy("doc_id", "row_key").agg(
        F.collect_list(F.struct("first", "past")).alias("spans")).select(  # at most a text's own words
        F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), "spans")
    key = (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    return docs.join(spans, key, "left").drop("__id", "__key")


def removal_report(docs: DataFrame, k: int = WINDOW, m: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row of docs(doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_spans(rows, k, m).mapInArrow(
        _report, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, k: int = WINDOW, m: int = GRAM) -> DataFrame:
    """docs with repeats cut from text (the words left, joined by one space;
    an untouched text stays as it is), and n_removed and n_left (words; null
    if untouched)."""
    wide = with_spans(docs, k, m)
    new = StructType().add("n_removed", "long").add("n_left", "long")
    return wide.mapInArrow(_rewrite, StructType(docs.schema.fields + new.fields))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))

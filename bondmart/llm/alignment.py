"""Alignment of two tokenisers' tokens on shared byte offsets, in Arrow.

A block is a bounded stretch of documents. Its token ids are flattened with
their parent document, token lengths become end offsets by a cumulative sum that
starts anew at each document, and a hash join on (document, end) finds the
offsets where tokens of both sides end. Running counts of these ends number the
groups, the distinct ids of both sides of a group are linked, and counts by
sorted keys give per document the links of an id pair and per block the documents
that hold it.

Spark merges the partial counts of all blocks into corpus-wide counts of the
id pairs and each left id's highest count, brings them back to the
blocks that hold the pair, and a second Arrow pass sums them per document. What
is shuffled is one row a pair and block, however often the pair occurs, and the
documents' lists of pair numbers, which meet their block's counts alone.

Defined cases: texts that are null, empty, or whose joined bytes on either side
differ from space + text have no tokens (zeros, empty groups_sha256); whole
texts of any length; repeated rows and rows that share an id each are a document
of their own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart.llm.bpe_trie import coder
from bondmart.llm.common import chunks, column, materialize, ship, table

VOCABULARY, MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 2 << 20  # text of a block, unless a single document is longer
LINK_ROWS = 4 << 20  # linked ids of a block worked on at once
ID_BITS = 20  # of a token id; a document's number in its block has the rest of 63 bits

DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
FIRST = f"block long, {DIGEST}, at array<int>, times array<long>, pair_a array<int>, pair_b array<int>, pair_docs array<int>"
FINAL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Both:
    """Encodes with both tokenisers; the bytes of each one's tokens, and its
    ids as text with what follows them inside and at the end of a group."""

    def __init__(self, path_a: str, path_b: str):
        self.a = coder(path_a)
        #: the same vocabulary as ranks, in a faster encoder
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            self.a.bytes[i]: i for i in self.a.token})
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [self.a.bytes.get(i, b"") for i in range(max(self.a.bytes) + 1)]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(sp.id_to_piece, range(sp.get_piece_size())))]
        self.size_a, self.size_b = (pa.array(list(map(len, x)), pa.int64()) for x in (self.bytes_a, self.bytes_b))
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << ID_BITS:
            raise ValueError(f"token ids of more than {ID_BITS} bits")
        self.written = pa.array([f"{i}{end}" for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;"))
                                 for i in range(n) for end in ends])

    def ids(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; empty where the joined bytes aren't space + text."""
        some = [i for i, t in enumerate(texts) if t]
        got_a: list[list[int]] = [[] for _ in texts]
        got_b: list[list[int]] = [[] for _ in texts]
        for i in some:
            text = " " + texts[i]
            # letters that the two encoders may know differently go the tokeniser's own way
            a = self.a.encode(text, special=False) if self.a.newer(text) else self.ranks.encode_ordinary(text)
            b, want = self.b.encode(texts[i]), text.encode()
            if (b"".join(map(self.bytes_a.__getitem__, a)) == want
                    and b"".join(map(self.bytes_b.__getitem__, b)) == want):
                got_a[i], got_b[i] = a, b
        return got_a, got_b


@functools.lru_cache(1)
def both(path_a: str, path_b: str) -> Both:
    return Both(path_a, path_b)


def tokens(lists: list[list[int]], size: pa.Array) -> pa.Table:
    """(doc, id, end) of the tokens of a block, in order."""
    nested = pa.array(lists, pa.list_(pa.int32()))
    ids, doc = nested.flatten(), pc.list_parent_indices(nested).cast(pa.int64())
    end = pc.cumulative_sum(pc.take(size, ids))
    # segmented: what the earlier documents have is taken off again
    n = pc.list_value_length(nested).cast(pa.int64())
    last = pc.subtract(pc.cumulative_sum(n), 1)  # place of each document's last token
    total = pc.if_else(pc.greater_equal(last, 0), pc.take(end, pc.max_element_wise(last, 0)), 0) if len(ids) else last
    before = pa.concat_arrays([pa.array([0], pa.int64()), total[:-1]]) if len(lists) else total
    return pa.table({"doc": doc, "id": ids, "end": pc.subtract(end, pc.take(before, doc))})


def joined(left: pa.Table, right: pa.Table, keys) -> pa.Table:
    return left.join(right, keys=keys, join_type="inner", use_threads=False)


def counted(t: pa.Table, keys: list[str], what: list) -> pa.Table:
    return t.group_by(keys, use_threads=False).aggregate(what)


def grouped(a: pa.Table, b: pa.Table) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """Both token tables with ``closes`` (the token ends a group) and the
    number of their group, counted through the block; and each group's document."""
    # document and end as one key
    numbered = [pa.table({"key": pc.bit_wise_or(pc.shift_left(t["doc"], 40), t["end"]), f"place_{n}": pa.array(np.arange(t.num_rows))})
                for n, t in enumerate((a, b))]
    shared = joined(*numbered, "key")
    out = []
    for n, side in enumerate((a, b)):
        closes = np.zeros(side.num_rows, np.int64)
        closes[shared[f"place_{n}"].to_numpy()] = 1
        group = pc.subtract(pc.cumulative_sum(pa.array(closes)), pa.array(closes))
        out.append(side.append_column("closes", pa.array(closes)).append_column("group", group))
    return out[0], out[1], shared["key"].to_numpy() >> 40


def linked(a: pa.Table, b: pa.Table) -> pa.Table:
    """(doc, pair, n): id pairs (a, then b in ID_BITS) of a document with the number
    of their links.

    Ids that repeat in a group are counted before the join; groups are linked
    in portions of about LINK_ROWS pairs, and a group of more pairs by
    portions of its left ids, so a long stretch without a shared end needs no
    more memory than the pairs that it holds.
    """
    left, right = times(a), times(b)
    group, ids_a, times_a = (left[c].to_numpy() for c in ("group", "id", "n"))
    doc_of = np.zeros(int(group[-1]) + 1, np.int64)
    doc_of[a["group"].to_numpy()] = a["doc"].to_numpy()
    doc = doc_of[group]
    ids_b, times_b = right["id"].to_numpy(), right["n"].to_numpy()
    first = np.searchsorted(right["group"].to_numpy(), np.arange(group[-1] + 2))
    width = (first[1:] - first[:-1])[group]
    rows = np.cumsum(width)
    parts, start = [], 0
    while start < len(group):
        done = rows[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(rows, done + LINK_ROWS, side="right")))
        # both sides are in order of their group: its right ids follow each left id
        own = np.repeat(np.arange(start, stop), width[start:stop])
        theirs = np.arange(len(own)) - (rows - width)[own] + done + first[group[own]]
        # document and pair as one key
        parts.append(summed(doc[own] << 2 * ID_BITS | ids_a[own] << ID_BITS | ids_b[theirs], times_a[own] * times_b[theirs]))
        start = stop
    # a pair of a document may lie in two portions
    key, n = parts[0] if len(parts) == 1 else summed(*map(np.concatenate, zip(*parts)))
    return pa.table({"doc": key >> 2 * ID_BITS, "pair": key & (1 << 2 * ID_BITS) - 1, "n": n})


def times(side: pa.Table) -> pa.Table:
    """(group, id, n): how often a group holds an id, in order of the groups."""
    key, n = summed(side["group"].to_numpy() << ID_BITS | side["id"].to_numpy().astype(np.int64))
    return pa.table({"group": key >> ID_BITS, "id": key & (1 << ID_BITS) - 1, "n": n})


def summed(key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often they occur or the sums of ``n``.
    Keys that count more than once are few; alone they take their place along."""
    if n is not None and (many := np.flatnonzero(n > 1)).size:
        extra, places = n[many] - 1, key[many]
    else:
        places = None
    key = np.sort(key)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    found, times = key[first], np.diff(np.append(first, len(key)))
    if places is not None:
        np.add.at(times, np.searchsorted(found, places), extra)
    return found, times


def in_order(t: pa.Table, by: str) -> pa.Table:
    """``t`` sorted by a column, which groups counted in order of a stream are already."""
    values = t[by].to_numpy()
    return t if (values[1:] >= values[:-1]).all() else t.sort_by(by)


def group_texts(a: pa.Table, b: pa.Table, docs: int, coders: Both) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document: every token's text with what
    follows it, put in the order of (group, side), joined by document."""
    group_a, group_b = a["group"].to_numpy(), b["group"].to_numpy()
    n_groups = int(group_a[-1]) + 1
    past_a, past_b = (np.cumsum(np.bincount(g, minlength=n_groups)) for g in (group_a, group_b))
    before_b = np.concatenate([[0], past_b[:-1]])
    order = np.empty(a.num_rows + b.num_rows, np.int32)
    ids_a, ids_b = (t["id"].to_numpy() * 2 + t["closes"].to_numpy() for t in (a, b))
    order[np.arange(a.num_rows) + before_b[group_a]] = ids_a
    order[np.arange(b.num_rows) + past_a[group_b]] = ids_b + 2 * len(coders.bytes_a)
    edges = np.cumsum(np.concatenate([[0], per_document(a["doc"], docs) + per_document(b["doc"], docs)]))
    lists = pa.LargeListArray.from_arrays(pa.array(edges), pc.take(coders.written, pa.array(order)))
    return [t[:-1] for t in pc.binary_join(lists, "").to_pylist()]  # without the last ;


def per_document(doc: pa.ChunkedArray, n: int) -> np.ndarray:
    return np.bincount(doc.to_numpy(), minlength=n)


def block_rows(coders: Both, block: int, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    lists_a, lists_b = coders.ids(texts)
    n = len(texts)
    a, b = tokens(lists_a, coders.size_a), tokens(lists_b, coders.size_b)
    counts_a, counts_b = per_document(a["doc"], n), per_document(b["doc"], n)
    hashes, at, times = [""] * n, [[]] * n, [[]] * n
    pair_a, pair_b, pair_docs = [], [], []
    n_groups, n_links = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if a.num_rows:
        a, b, group_doc = grouped(a, b)
        n_groups = np.bincount(group_doc, minlength=n)
        hashes = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_texts(a, b, n, coders)]
        links = in_order(linked(a, b), "doc")
        numbers = links["pair"].combine_chunks().dictionary_encode()
        places, weights, pairs = numbers.indices.to_numpy(), links["n"].to_numpy(), numbers.dictionary.to_numpy()
        pair_a, pair_b = (pairs >> ID_BITS).astype(np.int32), (pairs & (1 << ID_BITS) - 1).astype(np.int32)
        pair_docs = np.bincount(places, minlength=len(pairs)).astype(np.int32)
        edges = np.searchsorted(links["doc"].to_numpy(), np.arange(n + 1))
        n_links = np.add.reduceat(np.append(weights, 0), edges[:-1]) * (edges[1:] > edges[:-1])
        at = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(places, pa.int32()))
        times = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(weights, pa.int64()))
    first = pa.array([0] + [len(pair_a)] * n, pa.int32())  # the block's pairs stand on its first row
    lists = [pa.ListArray.from_arrays(first, pa.array(v, pa.int32())) for v in (pair_a, pair_b, pair_docs)]
    cols = [pa.array([block] * n, pa.int64()), ids.cast(pa.int64()), *(pa.array(v, pa.int64()) for v in (
        counts_a, counts_b, n_groups, n_links)), pa.array(hashes, pa.string()),
        *(v if isinstance(v, pa.Array) else pa.array(v, pa.list_(t)) for v, t in ((at, pa.int32()), (times, pa.int64()))), *lists]
    return pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in FIRST.split(", ")])


def _first(path_a: str, path_b: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = both(path_a, path_b)
        for batch in batches:
            ids, texts = column(batch, "doc_id"), column(batch, "text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for start, stop in chunks(sizes, block_bytes):
                yield block_rows(coders, uuid.uuid4().int >> 65, ids.slice(start, stop - start),
                                 texts.slice(start, stop - start).to_pylist())

    return run


def _sums(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """count_sum and n_best of a block's documents from its pairs' counts."""
    n = docs.num_rows
    places = docs["at"].combine_chunks()
    links = pa.table({"doc": pc.list_parent_indices(places).cast(pa.int64()), "at": places.flatten(),
                      "n": docs["times"].combine_chunks().flatten()})
    links = joined(links, counts.select(["at", "docs", "best"]), "at")
    links = links.append_column("all", pc.multiply(links["n"], links["docs"]))
    links = links.append_column("own", pc.multiply(links["n"], links["best"].cast(pa.int64())))
    sums = counted(links, ["doc"], [("all", "sum"), ("own", "sum")])
    total, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    total[sums["doc"].to_numpy()], best[sums["doc"].to_numpy()] = sums["all_sum"].to_numpy(), sums["own_sum"].to_numpy()
    out = docs.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total))
    return out.select([f.split()[0] for f in FINAL.split(", ")])


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, at, a, b, docs) of every block's pairs, and corpus-wide (a, b,
    docs, best): in how many documents a pair is linked, and whether that is
    the highest count of its left id."""
    pairs = blocks.where("size(pair_a) > 0").select("block", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_docs"))).select(
        "block", F.col("pos").alias("at"), F.col("col.pair_a").alias("a"), F.col("col.pair_b").alias("b"),
        F.col("col.pair_docs").cast("long").alias("docs"))
    merged = materialize(pairs.groupBy("a", "b").agg(F.sum("docs").alias("docs")), "pair-counts")
    top = merged.groupBy("a").agg(F.max("docs").alias("top"))
    every = merged.join(top, "a").select("a", "b", "docs", (F.col("docs") == F.col("top")).alias("best"))
    return pairs, every


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256."""
    ship(docs.sparkSession)
    blocks = materialize(docs.select("doc_id", "text").mapInArrow(_first(
        path_a or public_tokenizers.path(VOCABULARY), path_b or public_tokenizers.path(MODEL), block_bytes), FIRST), "blocks")
    pairs, counts = pair_counts(blocks)
    known = pairs.select("block", "at", "a", "b").join(counts, ["a", "b"]).select(
        F.col("block").alias("of_block"), "at", "docs", "best")
    linked_docs = blocks.where("n_links > 0").select("block", *[f.split()[0] for f in DIGEST.split(", ")], "at", "times")
    summed = linked_docs.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_sums, FINAL)
    rest = blocks.where("n_links = 0").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.lit(0).cast("long").alias("n_best"),
                                              F.lit(0).cast("long").alias("count_sum"), "groups_sha256")
    return summed.unionByName(rest)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))

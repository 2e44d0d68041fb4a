"""SimHash near-duplicates, compared with bit-sliced fingerprints.

A text's fingerprint has the bits that over half of its shingles' hashes
have. Equal fingerprints are one row from there on. Two fingerprints within
the radius agree on at least ``blocks - radius`` of ``blocks`` bit blocks, so
each is sent once for every such choice of blocks and meets all its partners
under a common key. Under a key, fingerprints are stored as vertical bit
planes over a run of rows; for each distance d between rows the planes are
XORed with themselves moved by d, which compares 64 pairs in one word, and
the differing bits are counted by carry-save adders. Words in which every
pair exceeds the radius are left out of all further planes.

A key with many fingerprints is dealt to cells of row and column chunks, so
no task holds a whole key. A cell gives each fingerprint only the link to the
first of its connected neighbours there, which keeps connectivity without
listing pairs. Components are found by alternating large-star and small-star
steps, each written to the shared folder.

Defined cases: null and wordless texts have fingerprint zero and are linked
like any other; texts of fewer words than a shingle are one shingle; rows
that share a doc_id are texts of their own; a null doc_id gets a fingerprint but
takes no part in links (component_id null); other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart.llm.common import byte_texts, chunks, column, materialize, ship, table

SHINGLE, RADIUS, SEED = 4, 4, 42
BLOCKS = 6            # bit blocks; radius 4 leaves 2 equal ones: 15 keys of about 21 bits
CELL_ROWS = 4096      # fingerprints of a key on one side of a cell
CHUNK_BYTES = 1 << 20
BATCH_ROWS = 1 << 16  # rows compared at once

_LANE = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, size: int) -> list[int]:
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.append(0, end[:-1] + 1)
    h, last = xxhash.xxh64_intdigest, size - 1
    return [h(joined[a:b], SEED) for a, b in zip(start[:len(words) - last].tolist(), end[last:].tolist())]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each group of consecutive hashes the bits set in over half of it
    (an empty group: 0). Eight bits are counted in the bytes of one word, in
    runs of at most 255."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    first = np.cumsum(n) - n
    runs = -(-n // 255)
    run0 = np.cumsum(runs) - runs
    starts = np.repeat(first, runs) + (np.arange(runs.sum()) - np.repeat(run0, runs)) * 255
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANE, starts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), run0, axis=0)
        for byte in range(8):
            out[full] |= (counts[:, byte] * 2 > n).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in byte_texts(batch)]
            out = [np.zeros(0, np.uint64)]
            for a, b in chunks([len(t) for t in texts], CHUNK_BYTES):
                lists = [shingle_hashes(t, size) for t in texts[a:b]]
                flat = np.fromiter((h for hs in lists for h in hs), np.uint64)
                out.append(majority(flat, np.array([len(hs) for hs in lists])))
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, n) for n in kept), pa.array(np.concatenate(out).view(np.int64))], [*kept, "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of each row of docs(doc_id, text)."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _fingerprints(shingle), "doc_id long, fp long")


def _masks(radius: int, blocks: int) -> list[int]:
    """For each choice of blocks that must agree, their bits."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in combinations(block, blocks - radius)]


def _planes(fp: np.ndarray) -> np.ndarray:
    """Bit planes: bit r of planes[b] is bit b of fp[r]; one spare word."""
    n = -(-len(fp) // 64)
    bits = np.zeros((n + 1) * 64, np.uint64)
    bits[:len(fp)] = fp
    square = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(square.T.copy(), axis=1, bitorder="little").view(np.uint64)


def _moved(plane: np.ndarray, words: np.ndarray, d: int) -> np.ndarray:
    """Words ``words`` of the plane moved down by d rows."""
    w, r = words + d // 64, np.uint64(d % 64)
    last = plane.shape[-1] - 1
    low = plane[..., np.minimum(w, last)]
    if r == 0:
        return low
    return (low >> r) | (plane[..., np.minimum(w + 1, last)] << (np.uint64(64) - r))


def close_pairs(fp: np.ndarray, left: np.ndarray, right: np.ndarray, reach: np.ndarray, radius: int):
    """Pairs (i, j), i < j < reach[i], with left[i], right[j] and at most
    ``radius`` differing bits; rows of a group are consecutive, reach[i] ends
    row i's group."""
    planes, n = _planes(fp), len(fp)
    rights = _bits(right)
    counters = max(radius, 1).bit_length()
    found_i, found_j = [], []
    order = np.arange(n)
    span = reach - order  # rows from here to the end of the group
    for d in range(1, int(span.max(initial=1))):
        ok = left & (span > d)
        valid = _bits(ok)
        words = np.flatnonzero(valid)
        if not len(words):
            break
        alive = valid[words] & _moved(rights, words, d)
        count = [np.zeros(len(words), np.uint64) for _ in range(counters)]
        over = ~alive
        for b in range(0, 64, 8):
            keep = np.flatnonzero(over != ~np.uint64(0))  # blocks not yet beyond the radius
            if len(keep) < len(words):
                words, over, count = words[keep], over[keep], [c[keep] for c in count]
            if not len(words):
                break
            differ = planes[b:b + 8][:, words] ^ _moved(planes[b:b + 8], words, d)
            for carry in differ:
                for c in range(counters):  # add one bit to every counter of the word
                    count[c], carry = count[c] ^ carry, count[c] & carry
                over = over | carry  # 2**counters or more
                over = over | _beyond(count, radius)
        if len(words):
            hit = np.flatnonzero(np.unpackbits((~over).view(np.uint8), bitorder="little"))
            i = words[hit // 64] * 64 + hit % 64
            found_i.append(i)
            found_j.append(i + d)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_i]), np.concatenate([empty, *found_j])


def _bits(flags: np.ndarray) -> np.ndarray:
    n = -(-len(flags) // 64)
    padded = np.zeros((n + 1) * 64, np.uint8)
    padded[:len(flags)] = flags
    return np.packbits(padded, bitorder="little").view(np.uint64)


def _beyond(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds the radius, by comparing bits from the top."""
    over, same = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for c in reversed(range(len(count))):
        if radius >> c & 1:
            same = same & count[c]
        else:
            over = over | (same & count[c])
            same = same & ~count[c]
    return over


def _links(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """By row the first row of its connected neighbours."""
    up = np.arange(n)
    while len(i):
        a, b = up[i], up[j]
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while True:
            short = up[up]
            if (short == up).all():
                break
            up = short
        open_ = up[i] != up[j]
        i, j = i[open_], j[open_]
    return up


def _compare(radius: int):
    """Rows sorted by cell, then node; a cell may begin in one batch and end in a later one."""

    def work(part: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        cell, side, fp, node = part["cell"], part["side"], part["fp"], part["node"]
        n = len(cell)
        ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]) + 1, n)
        reach = np.repeat(ends, np.diff(np.append(0, ends)))
        # side 0: within its chunk; 1 and 2: rows against columns (sorted so that 1 comes first)
        pairs = close_pairs(fp.view(np.uint64), side < 2, side != 1, reach, radius)
        up = _links(*pairs, n)
        linked = np.flatnonzero(up != np.arange(n))
        a, b = node[linked], node[up[linked]]
        if not len(a):
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            new = {c: column(batch, c).to_numpy(zero_copy_only=False) for c in ("cell", "side", "fp", "node")}
            held = {c: np.concatenate([held[c], new[c]]) for c in new} if held else new
            cell = held["cell"]
            if len(cell) < BATCH_ROWS or cell[0] == cell[-1]:
                continue
            cut = int(np.flatnonzero(cell != cell[-1])[-1]) + 1
            if (out := work({c: v[:cut] for c, v in held.items()})) is not None:
                yield out
            held = {c: v[cut:] for c, v in held.items()}
        if held and len(held["cell"]) and (out := work(held)) is not None:
            yield out

    return run


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Links (u > v) between nodes(node, fp) that join all fingerprints
    within the radius; fp is unique."""
    if blocks <= radius:
        raise ValueError("more blocks than the radius are needed")
    ship(nodes.sparkSession)
    masks = _masks(radius, blocks)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select("node", "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])))
    keyed = keyed.select("node", "fp", F.xxhash64("pos", "col").alias("key"))
    shared = keyed.groupBy("key").count().where("count > 1")
    met = keyed.join(shared, "key").withColumn("parts", F.ceil(F.col("count") / CELL_ROWS).cast("int"))
    met = met.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    cells = met.select("node", "fp", "key", "mine", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    cells = cells.select(
        "node", "fp", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"))
    return cells.repartition("cell").sortWithinPartitions("cell", "side").mapInArrow(
        _compare(radius), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of all nodes of edges(u > v), by
    alternating large-star and small-star steps until nothing changes."""
    edges = materialize(edges, "links")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = materialize(small, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id of each row of docs(doc_id, text)."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    parts = components(links(nodes.select(F.col("fp").alias("node"), "fp"), radius))
    return _answer(prints, nodes, parts)


def _answer(prints: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    named = nodes.join(parts, nodes.fp == parts.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("part"))
    first = named.groupBy("part").agg(F.min("least").alias("component_id"))
    by_print = named.join(first, "part").select("fp", "component_id")
    return prints.join(by_print, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def first_rows(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, row_key, part: by group of near copies (part) the rows of
    docs(doc_id, text) with the group's smallest doc_id, by row and not by
    doc_id. A null doc_id is a row like others and comes last. row_key is
    xxhash64(text)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), "text")
    prints = materialize(rows.mapInArrow(_fingerprints(shingle), "doc_id long, row_key long, fp long"), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")  # null: no row has an id
    parts = components(links(nodes.select(F.col("fp").alias("node"), "fp"), radius))
    named = nodes.join(parts, nodes.fp == parts.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("part"))
    first = named.groupBy("part").agg(F.min("least").alias("first"))
    by_print = named.join(first, "part").select(F.col("fp").alias("print"), "part", "first")
    return prints.join(by_print, (F.col("fp") == F.col("print")) & F.col("doc_id").eqNullSafe(F.col("first"))).select(
        "doc_id", "row_key", "part").distinct()


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

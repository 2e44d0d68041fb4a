"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its hashed terms: its lower-cased words and their first
four and six bytes. Of the terms in the training texts, those most associated
with the label (chi-square, counted by Spark) are kept. The score is the logistic function of

    w0 + sum of w[i] + sum over pairs of <v[i], v[j]>

over the terms i < j in the text, so a pair of terms (an insult and the group
it is aimed at) may count for more than each alone. The pairs are summed in
linear time as half of |sum of v|^2 - sum of |v|^2.

The model is fitted on at most ``train_rows`` labelled texts of each class,
chosen by a hash of the id and weighted to the classes' true shares; all
texts are scored whole.

Defined cases: null and empty texts have no terms and get the base rate;
without labels of both classes every score is the share of label 1 (0 without
any); of several labels of one doc_id the largest holds; null labels are none;
repeated rows each get their row; rows with a null doc_id are scored
(held_out null); other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart.llm.common import BASE, INVERSE, byte_texts, chunks, column, mix, powers, ship, table
from bondmart.llm.language import held_out

TRAIN_ROWS = 8000   # labelled texts of a class that are learned from, at most
TERMS = 1024        # terms of the model
FACTORS = 8
STEPS = 2000        # of the fit, about
PREFIXES = (4, 6)   # bytes
SEEN = 3            # training texts that a term must be in
THRESHOLD = 0.3
CHUNK_BYTES = 1 << 20

#: lower case; what is neither a letter nor a digit parts words
_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
              for b in range(256))


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of several texts, and the text number of each."""
    data = np.frombuffer(b" ".join(t.translate(_FOLD) for t in texts) + b" ", np.uint8)
    space = data == 0x20
    before = np.append(True, space[:-1])
    start, end = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
    total = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))))
    back = powers(INVERSE, len(data))[start]
    out = [mix((total[end] - total[start]) * back)]
    for n in PREFIXES:
        out.append(mix(((total[np.minimum(end, start + n)] - total[start]) * back) ^ np.uint64(n << 56)))
    first = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    doc = np.searchsorted(first, start, side="right")
    return np.concatenate(out), np.tile(doc, len(out))


class Machine:
    """terms (sorted hashes), w0, w and v."""

    def __init__(self, terms: np.ndarray, w0: float):
        self.terms, self.w0 = terms, w0
        self.w, self.v = np.zeros(len(terms)), np.random.default_rng(1).normal(0, 0.05, (len(terms), FACTORS))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(terms & np.uint64(0xFFFF)).astype(np.int64)] = True

    def present(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, term number) of the model's terms in the texts, once each."""
        h, doc = term_hashes(texts)
        some = np.flatnonzero(self.seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
        h, doc = h[some], doc[some]
        at = np.searchsorted(self.terms, h)
        ok = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == h) if len(self.terms) else some[:0]
        pairs = np.unique(doc[ok] * np.int64(len(self.terms) + 1) + at[ok])
        return np.divmod(pairs, np.int64(len(self.terms) + 1))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        doc, term = self.present(texts)
        n = len(texts)
        line = np.bincount(doc, self.w[term], n)
        pair = sum(np.bincount(doc, f[term], n) ** 2 - np.bincount(doc, f[term] ** 2, n) for f in self.v.T)
        return 1 / (1 + np.exp(-np.clip(self.w0 + line + pair / 2, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> None:
        """Adam steps on the weighted logistic loss; x holds 0 and 1."""
        rng, step, batches = np.random.default_rng(2), 0, max(1, len(x) // 256)
        params = [np.array([self.w0]), self.w, self.v]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for _ in range(-(-steps // batches)):
            for rows in np.array_split(rng.permutation(len(x)), batches):
                b, s = x[rows].astype(np.float32), params[2]
                sums = b @ s
                odds = params[0][0] + b @ params[1] + ((sums ** 2).sum(axis=1) - b @ (s ** 2).sum(axis=1)) / 2
                g = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y[rows]) * weight[rows] / weight[rows].sum()
                by_term = b.T @ g
                grads = [np.array([g.sum()]), by_term + 1e-4 * params[1],
                         b.T @ (g[:, None] * sums) - by_term[:, None] * s + 1e-3 * s]
                step += 1
                for p, d, m, q in zip(params, grads, first, second):
                    m += 0.1 * (d - m)
                    q += 0.001 * (d * d - q)
                    p -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.999 ** step)) + 1e-8)
        self.w0, self.w, self.v = float(params[0][0]), params[1], params[2]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, texts with it, those of label 1), by batch."""
    for batch in batches:
        label, texts = column(batch, "label").to_numpy(zero_copy_only=False), byte_texts(batch)
        for a, b in chunks([len(t or b"") for t in texts], CHUNK_BYTES):
            sets = [np.unique(term_hashes([t or b""])[0]) for t in texts[a:b]]
            terms, inverse = np.unique(np.concatenate(sets), return_inverse=True)
            ones = np.bincount(inverse, np.repeat(label[a:b], [len(s) for s in sets]), len(terms)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.view(np.int64)), pa.array(np.bincount(inverse, minlength=len(terms))), pa.array(ones)],
                ["term", "n", "ones"])


def _found(machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [machine.value.present([t or b""])[1].tolist() for t in byte_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "label"), pa.array(lists, pa.list_(pa.int64()))], ["label", "terms"])

    return run


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Machine:
    """A machine fitted to labels(doc_id, toxic) of docs(doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    base = sizes.get(1, 0) / max(1, sum(sizes.values()))
    plain = Machine(np.zeros(0, np.uint64), float(np.log((base + 1e-9) / (1 - base + 1e-9))))
    # at most 2 x train_rows ids: a bounded table that may be broadcast
    chosen = [known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(train_rows) for c in (0, 1)]
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(
        F.broadcast(chosen[0].unionByName(chosen[1])), "id")
    # rows that share an id give one text, the least: train_rows bounds what is learnt from and collected
    rows = rows.groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label")).select("label", "text")
    taken = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(taken) < 2:
        return plain
    ones, total = taken[1], sum(taken.values())
    gap = F.col("ones") * total - F.col("n") * ones
    terms = rows.mapInArrow(_terms, "term long, n long, ones long").groupBy("term").agg(
        F.sum("n").cast("double").alias("n"), F.sum("ones").cast("double").alias("ones")).where(F.col("n") >= SEEN)
    chi = (gap * gap) / (F.col("n") * (total - F.col("n") + 0.5))
    best = terms.orderBy(F.desc(chi), "term").limit(TERMS).collect()
    machine = Machine(np.sort(np.array([r["term"] for r in best], np.int64).view(np.uint64)), plain.w0)
    held = rows.mapInArrow(_found(spark.sparkContext.broadcast(machine)), "label int, terms array<long>").collect()
    y = np.array([r["label"] for r in held], float)
    x = np.zeros((len(held), len(machine.terms)), np.int8)
    for i, r in enumerate(held):
        x[i, r["terms"]] = 1
    machine.fit(x, y, np.where(y > 0, base / (ones / total), (1 - base) / (1 - ones / total)))
    return machine


def _score(machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine.value
        for batch in batches:
            texts = [t or b"" for t in byte_texts(batch)]
            out = [np.zeros(0)] + [m.scores(texts[a:b]) for a, b in chunks([len(t) for t in texts], CHUNK_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(np.concatenate(out))], ["doc_id", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs(doc_id, text)."""
    ship(docs.sparkSession)
    machine = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(machine), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

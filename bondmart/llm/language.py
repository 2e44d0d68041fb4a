"""Language identification by error-correcting output codes.

Every language has a codeword; each bit is predicted by a binary classifier
over hashed byte trigrams (naive Bayes log-odds of the languages whose bit is
set against the others, averaged over the text's trigrams, and scaled to
log-odds on held-in texts). A text gets the language of the nearest codeword:
the logistic losses of the bits are summed, each weighted by how often the
bit was right for that language in training (loss-weighted decoding). Where
the two nearest codewords lie close together, the text is flagged ambiguous.

Trigram counts are summed over all training rows; only the scales and weights
are fitted on a bounded sample (``calibration_rows`` per language). What the
driver holds grows with the number of languages, not with the rows.

Defined cases: null texts and texts without a letter are `und` with score 0;
so is everything if there is nothing to learn from; whole texts of any
length; repeated rows each get their row; rows with a null doc_id are held
out of training and predicted like others (held_out null); other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bondmart.llm.common import byte_texts, chunks, column, ship, table

FEATURES = 1 << 14
CALIBRATION_ROWS = 2000  # texts per language on which scales and weights are fitted
AMBIGUOUS = 0.6          # a score below this is flagged
CHUNK_BYTES = 1 << 20
UNKNOWN = "und"

#: lower case, and one space for all ASCII that isn't a letter
_FOLD = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))
_LETTER = regex.compile(r"\p{L}").search


def held_out(doc_id: Column) -> Column:
    """Rows that aren't learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1. All splits of few languages; for more, a seeded
    choice of about 5 log2(n) columns whose rows differ most."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:
        rest = range(1, n)
        sides = [c for r in range(1, n) for c in combinations(rest, r)]
        return np.array([[1.0 if i in c else -1.0 for c in sides] for i in range(n)])
    rng, best, apart = np.random.default_rng(0), None, -1
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (n, max(10, int(np.ceil(5 * np.log2(n))))))
        nearest = min(int((a != b).sum()) for a, b in combinations(m, 2)) if n <= 64 else len({*map(bytes, m)})
        both = (np.abs(m.sum(axis=0)) < n).all()
        if both and nearest > apart:
            best, apart = m, nearest
    return best


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts, and where each text's begin. Runs of
    what isn't a letter count for nothing."""
    data = np.frombuffer(b"  " + b"".join(t.translate(_FOLD) + b"  " for t in texts), np.uint8).astype(np.uint32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    first = np.cumsum([0] + [len(t) + 2 for t in texts])[:-1]
    hashed = (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
    hashed[(code & np.uint32(0xFFFF)) == np.uint32(0x2020)] = FEATURES  # the spare feature, of weight 0
    return hashed[:first[-1] + len(texts[-1]) + 2].astype(np.int64), first


def _count(langs: list[str]):
    index = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), FEATURES + 1), np.int64)
        for batch in batches:
            texts = byte_texts(batch)
            codes = [index[x] for x in column(batch, "lang").to_pylist()]
            for a, b in chunks([len(t) for t in texts], CHUNK_BYTES):
                grams, first = trigrams(texts[a:b])
                sizes = np.diff(np.append(first, len(grams)))
                key = np.repeat(np.array(codes[a:b]) * (FEATURES + 1), sizes) + grams
                total += np.bincount(key, minlength=total.size).reshape(total.shape)
        lang, feature = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(feature), pa.array(total[lang, feature])], ["lang", "feature", "n"])

    return run


def _margins(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Mean weight of each text's trigrams, by bit."""
    out = [np.zeros((0, weights.shape[1]))]
    for a, b in chunks([len(t) for t in texts], CHUNK_BYTES):
        grams, first = trigrams(texts[a:b])
        counted = np.add.reduceat((grams < FEATURES).astype(np.int64), first)
        sums = np.stack([np.add.reduceat(np.take(w, grams), first) for w in weights.T], axis=1)
        out.append(sums / np.maximum(counted, 1)[:, None])
    return np.concatenate(out)


class Model:
    """langs, code (languages x bits), weights (features x bits), scale and
    offset by bit, trust (languages x bits)."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        bits = []
        for b in self.code.T:
            one, other = share[b > 0].mean(axis=0), share[b < 0].mean(axis=0) if (b < 0).any() else 1 / FEATURES
            bits.append(np.clip(np.log(one / other), -4, 4))
        self.weights = np.append(np.array(bits).T, np.zeros((1, len(bits))), axis=0).astype(np.float32)
        n = self.code.shape[1]
        self.scale, self.offset, self.trust = np.full(n, 8.0), np.zeros(n), np.ones_like(self.code)

    def calibrate(self, margin: np.ndarray, lang: np.ndarray) -> None:
        """Scale each bit's margin to log-odds, and weigh the bits."""
        for b in range(self.code.shape[1]):
            y = (self.code[lang, b] > 0).astype(float)
            x, s, o = margin[:, b], 8.0, 0.0
            for _ in range(25):  # damped Newton steps, with a weak pull to the start
                p = 1 / (1 + np.exp(-np.clip(s * x + o, -30, 30)))
                v = p * (1 - p) + 1e-6
                g = np.array([((p - y) * x).sum() + 0.05 * (s - 8), (p - y).sum() + 0.05 * o])
                h = np.array([[(v * x * x).sum() + 0.05, (v * x).sum()], [(v * x).sum(), v.sum() + 0.05]])
                step = np.clip(np.linalg.solve(h, g), -2, 2)
                s, o = max(1.0, s - step[0]), o - step[1]
            self.scale[b], self.offset[b] = s, o
        right = (margin * self.scale + self.offset) * self.code[lang] > 0
        for i in range(len(self.langs)):
            rows = right[lang == i]
            self.trust[i] = (rows.sum(axis=0) + 1) / (len(rows) + 1) if len(rows) else 1
        self.trust = np.maximum(self.trust - 0.5, 0.01)
        self.trust /= self.trust.mean(axis=1, keepdims=True)

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword and its score, by text."""
        odds = _margins(texts, self.weights) * self.scale + self.offset
        loss = (np.logaddexp(0, -odds[:, None, :] * self.code) * self.trust).sum(axis=2)
        near = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return loss.argmin(axis=1), 1 / near.sum(axis=1)


def learn(docs: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Model | None:
    """A model of the rows of docs(doc_id, text, lang) that may be learned from."""
    ship(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                      & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(sizes)
    if not langs:
        return None
    small = rows.select("text", "lang")
    counts = np.zeros((len(langs), FEATURES + 1))
    summed = small.mapInArrow(_count(langs), "lang long, feature long, n long").groupBy("lang", "feature").agg(
        F.sum("n").alias("n"))
    got = summed.toPandas()  # at most languages times features
    counts[got["lang"].to_numpy(), got["feature"].to_numpy()] = got["n"].to_numpy()
    model = Model(langs, counts[:, :FEATURES])
    # a sample of at most about calibration_rows texts per language, chosen by a hash of the id
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, calibration_rows / n))) for x, n in sizes.items()])
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000).select(
        "text", "lang").limit(2 * calibration_rows * len(langs))
    margins = chosen.mapInArrow(_sample(docs.sparkSession.sparkContext.broadcast(model)), "lang string, margin array<double>")
    if held := margins.collect():  # a few numbers per text of the sample
        model.calibrate(np.array([r["margin"] for r in held]), np.array([langs.index(r["lang"]) for r in held]))
    return model


def _sample(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _margins(byte_texts(batch), model.value.weights).tolist()
            yield pa.RecordBatch.from_arrays(
                [column(batch, "lang"), pa.array(margin, pa.list_(pa.float64()))], ["lang", "margin"])

    return run


def _predict(model):
    names = ["__lang", "__score", "__ambiguous"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            texts = byte_texts(batch)
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            live = [i for i, t in enumerate(texts) if t and m and (
                not t.translate(_FOLD).isspace() and _LETTER(t.decode()))]
            best, sure = m.predict([texts[i] for i in live]) if live else ([], [])
            for i, b, s in zip(live, best, sure):
                pred[i], score[i] = m.langs[b], float(s)
            new = [pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                   pa.array([s < AMBIGUOUS for s in score], pa.bool_())]
            yield pa.RecordBatch.from_arrays(batch.columns + new, batch.schema.names + names)

    return run


def with_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with __lang, __score and __ambiguous."""
    ship(docs.sparkSession)
    new = StructType().add("__lang", "string").add("__score", "double").add("__ambiguous", "boolean")
    return docs.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)),
                           StructType(docs.schema.fields + new.fields))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of each row of
    docs(doc_id, text, lang)."""
    found = with_language(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lang").alias("lang_pred"),
                        F.col("__score").alias("score"), F.col("__ambiguous").alias("ambiguous"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))

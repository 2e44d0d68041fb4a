"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

The text is escaped as the model's normaliser does (a space is U+2581, one is
put in front) and cut where no merge can reach across: before a run of
U+2581 and around a line feed. A unit is then encoded without building merges: at each position the longest
piece that an Aho-Corasick automaton finds is tried first; it must fit its
left neighbour, which is decided by merging the two pieces' characters again
(remembered by pair); positions from which nothing fits are marked in a
bitfield and never tried twice. Units repeat, so their ids, and the text that
these ids decode to, are remembered in a bounded table; no unit cuts a
character, so the decoded text is that of the units in order.

Defined cases: null text counts as empty (no ids, empty decoded text);
whole texts of any length; repeated rows each get their row; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from bondmart.llm.common import column, ship, table
from bondmart.llm.merges import NEVER, Memo, Pairs, automaton

MODEL = "piece_bpe_32k.model"
SPACE = "▁"


class Backtracker:
    """Encodes and decodes with one model. ``unit``, ``spaced`` and ``plain``
    remember the ids, as decimal text joined by commas, and the text decoded
    from them, of a unit with plain spaces, of a word after one space, and of a
    word after a line feed."""

    LIMIT = 300_000

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        self.byte = {int(sp.id_to_piece(i)[3:-1], 16): i for i in every if sp.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        self.id = {sp.id_to_piece(i): i for i in every if not (
            sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        if any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p) for p in self.id):
            raise ValueError("a piece of this model reaches across words or lines")
        if sp.normalize("  a ﬁ\t") != f"{SPACE * 3}a{SPACE}ﬁ\t":
            raise ValueError("this model's normaliser changes more than spaces")
        if any(c not in self.id for p in self.id for c in p):
            raise ValueError("a character inside a piece isn't a piece itself")
        score = {p: -sp.get_score(i) for p, i in self.id.items()}
        self.piece = {i: p for p, i in self.id.items()}
        self.size = {i: len(p) for p, i in self.id.items()}
        #: the longest piece that begins a piece; a lone character may still stand without one
        self.shorter = {i: next((self.id[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id), None)
                        for p, i in self.id.items()}
        self.pairs = Pairs(lambda a, b: score.get(a + b, NEVER))
        self.fits: dict[int, bool] = {}
        self.auto = automaton(self.id, self.id.get)
        self.units = re.compile(f"[ {SPACE}]*[^ {SPACE}\n]+|[ {SPACE}]+|\n").findall
        self.unit = Memo(self.unit_both, self.LIMIT // 8)
        self.spaced = Memo(lambda word: self.unit_both(" " + word), self.LIMIT)
        self.plain = Memo(self.unit_both, self.LIMIT // 8)
        self.feed = self.unit_both("\n")

    def unit_both(self, unit: str) -> tuple[str, str]:
        ids = self.encode_unit(unit.replace(" ", SPACE))
        return ",".join(map(str, ids)), self.decode_pieces(ids)

    def fit(self, left: int, right: int) -> bool:
        """Does piece ``right`` follow ``left`` (-1: none) in an encoding?"""
        if len(self.fits) >= self.LIMIT:
            self.fits.clear()
        got = self.pairs.fit(self.piece[left] if left >= 0 else "", self.piece[right])
        self.fits[left << 20 | right] = got
        return got

    def encode_unit(self, text: str) -> list[int]:
        n = len(text)
        longest: list[int | None] = [None] * n
        size, shorter, fits = self.size, self.shorter, self.fits
        for last, i in self.auto.iter(text):  # of those that begin at one place, the longest comes last
            longest[last - size[i] + 1] = i
        if None in longest and any(c not in self.id for c in text):
            return self.encode_mixed(text)
        failed, out, at, left, token = 0, [], 0, -1, longest[0]
        while True:
            while token is not None:
                to = at + size[token]
                if not failed >> to & 1:
                    got = fits.get(left << 20 | token)
                    if got or got is None and self.fit(left, token):
                        break
                token = shorter[token]
            else:  # nothing fits from here: give the last piece back
                failed |= 1 << at
                token = out.pop()
                at -= size[token]
                left, token = out[-1] if out else -1, shorter[token]
                continue
            out.append(token)
            if to == n:
                return out
            at, left, token = to, token, longest[to]

    def encode_mixed(self, text: str) -> list[int]:
        """A unit with characters that aren't pieces: those that occur in no
        piece at all become bytes, what lies between is encoded on its own."""
        out, begin = [], 0
        for i, c in enumerate(text + "\0"):
            if i == len(text) or c not in self.id:
                if begin < i:
                    out += self.encode_unit(text[begin:i])
                if i < len(text):
                    out += [self.byte[b] for b in c.encode()]
                begin = i + 1
        return out

    def round_trip(self, text: str) -> tuple[str, str]:
        """Ids of a whole text, comma-joined, and the text that they decode to."""
        if not text:
            return "", ""
        if "  " in text or text[0] == " " or SPACE in text:
            both = list(map(self.unit.__getitem__, self.units(" " + text)))
        else:
            first, *lines = text.split("\n")  # every unit is a word after one space, or begins a line
            both = list(map(self.spaced.__getitem__, first.split(" ")))
            for line in lines:
                words = line.split(" ")
                both.append(self.feed)
                if words[0]:
                    both.append(self.plain[words[0]])
                both += map(self.spaced.__getitem__, words[1:])
        ids, back = zip(*both)
        return ",".join(ids), "".join(back).removeprefix(" ")

    def encode(self, text: str) -> str:
        """Ids of a whole text, comma-joined."""
        return self.round_trip(text)[0]

    def decode_pieces(self, ids: list[int]) -> str:
        """Pieces joined, U+2581 as space; byte pieces read as UTF-8 (what
        isn't valid as U+FFFD)."""
        if self.value.keys().isdisjoint(ids):
            return "".join(self.piece.get(i, "") for i in ids).replace(SPACE, " ")
        parts = (bytes([self.value[i]]) if i in self.value else self.piece.get(i, "").encode() for i in ids)
        return b"".join(parts).decode("utf-8", "replace").replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """Text of ids, without the space that encoding puts in front."""
        return self.decode_pieces(ids).removeprefix(" ")


@functools.lru_cache(1)
def backtracker(path: str) -> Backtracker:
    return Backtracker(path)


def _rows(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = backtracker(path)
        for batch in batches:
            counts, hashes, decoded, lists = [], [], [], []
            for text in column(batch, "text").to_pylist():
                ids, back = coder.round_trip(text or "")
                counts.append(ids.count(",") + 1 if ids else 0)
                hashes.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    lists.append(list(map(int, ids.split(","))) if ids else [])
            cols = [column(batch, "doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                    pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def encode_decode(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of each row of
    docs(doc_id, text); one narrow stage without a shuffle."""
    ship(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(
        _rows(path or public_tokenizers.path(MODEL), with_ids), schema + ", ids array<int>" * with_ids)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))

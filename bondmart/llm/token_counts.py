"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-level BPE vocabulary splits a text into pieces first; within a piece
the encoding of every prefix is known from shorter prefixes: of the tokens
that end at a place (found by an Aho-Corasick automaton), exactly one fits the
last token of the prefix before it (the two come back unchanged when merged
again), and the count is that prefix's count plus one. The table of a piece
is remembered in a bounded cache; a text's table is the running sum over its
pieces. Counts, truncation points and budgets are read off the tables, without
encoding the text again.

Defined cases: null text counts as empty (0 bytes, 0 tokens); special strings
inside a text are the library's single tokens; whole texts of any length;
repeated rows each get their row; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from bondmart.llm.common import column, ship, table
from bondmart.llm.merges import NEVER, Memo, Pairs, automaton

VOCABULARY = "byte_bpe_50k.json"
LIMIT_TOKENS = 1024


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, else the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class PrefixCounter:
    """Counts with one vocabulary. ``piece``, ``spaced`` and ``plain`` remember
    the tokens of a piece, of a word after one space, and of a word that
    begins a line."""

    LIMIT = 400_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or model["type"] != "BPE":
            raise ValueError("only plain byte-level BPE is supported")
        merges = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        rank = {pair: i for i, pair in enumerate(merges)}
        self.pairs = Pairs(lambda a, b: rank.get((a, b), NEVER))
        self.specials = special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.id = {t: i for t, i in model["vocab"].items() if t not in special}
        self.token = {i: t for t, i in self.id.items()}
        self.size = {i: len(t) for t, i in self.id.items()}
        self.auto = automaton(self.id, self.id.get)
        self.fits: dict[int, bool] = {}
        self.letters = dict(enumerate(byte_alphabet()))
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        #: beyond these the two libraries may know different letters; then the tokeniser's own splitter is asked
        self.newer = regex.compile(r"[^\u0000-\u0557\u2010-\u2064\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7a3]").search
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.piece = Memo(lambda piece: self.prefixes(piece)[-1], self.LIMIT)
        self.spaced = Memo(lambda word: self.count_pieces(" " + word), self.LIMIT)
        self.plain = Memo(self.count_pieces, self.LIMIT // 8)
        self.space = regex.compile(r"\s*").match
        #: white space other than one space or line feed between words
        self.odd = ["  ", "\n\n", " \n", "\n ", *(c for c in map(chr, range(0x3001)) if c not in " \n" and (
            c.isspace() or self.space(c).end()))]

    def fit(self, left: int, right: int) -> bool:
        """Does token ``right`` follow ``left`` (-1: none) in an encoding?"""
        if len(self.fits) >= self.LIMIT:
            self.fits.clear()
        got = self.pairs.fit(self.token[left] if left >= 0 else "", self.token[right])
        self.fits[left << 20 | right] = got
        return got

    def prefixes(self, piece: str) -> list[int]:
        """Tokens of the first 0, 1, 2 ... bytes of one piece."""
        text = piece.encode().decode("latin-1").translate(self.letters)
        count, last = [0] + [-1] * len(text), [-1] * (len(text) + 1)
        size, fits = self.size, self.fits
        for end, i in self.auto.iter(text):
            end += 1
            if count[end] < 0:
                start = end - size[i]
                key = last[start] << 20 | i
                got = fits.get(key)
                if got or got is None and self.fit(last[start], i):
                    count[end], last[end] = count[start] + 1, i
        return count

    def pieces(self, text: str) -> list[str]:
        if not self.newer(text):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Plain stretches and special strings."""
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if part:
                yield part, k % 2 == 1

    def count_pieces(self, text: str) -> int:
        """Tokens of a text without special strings."""
        return sum(map(self.piece.__getitem__, self.pieces(text)))

    def count(self, text: str) -> int:
        if any(t in text for t in self.specials):
            return sum(1 if special else self.count_pieces(part) for part, special in self.parts(text))
        if not text or text[0] in " \n" or text[-1] in " \n" or any(t in text for t in self.odd):
            return self.count_pieces(text)
        first, *lines = text.split("\n")  # no piece reaches across a single space or line feed
        n = len(lines) * self.plain["\n"]
        for line in (first, *lines):
            word, *words = line.split(" ")
            n += self.plain[word] + sum(map(self.spaced.__getitem__, words))
        return n

    def table(self, text: str) -> np.ndarray:
        """Tokens of text.encode()[:i], as a text of its own, for every i that
        ends a character (-1 elsewhere).

        Pieces of a prefix are those of the text but for its end: white space
        there is one piece, and a contraction that is cut falls apart; these
        are counted from the start of the run they are in.
        """
        out, base, before, stretch = [np.zeros(1, np.int64)], 0, 0, ""
        for part, special in self.parts(text):
            if special:  # a cut special string is ordinary text, and belongs to the stretch before it
                own = [before + self.count_pieces(stretch + part[:i]) for i in range(1, len(part))]
                base += 1
                out.append(np.array([*own, base]))
                before, stretch = base, ""
                continue
            before, stretch = base, part
            run_base, run = base, ""  # tokens before the white space run that ends here, and that run
            for piece in self.pieces(part):
                own = np.array(self.prefixes(piece)[1:]) + base
                sizes = np.cumsum([len(c.encode()) for c in piece])
                if piece[0] == "'" and len(piece) > 2 and piece[1:].isalpha():
                    own[1:-1] = [base + self.count_pieces(piece[:i]) for i in range(2, len(piece))]
                space = self.space(piece).end()
                for i in range(space):
                    if not run:
                        run_base = base
                    run += piece[i]
                    own[sizes[i] - 1] = run_base + self.piece[run]
                if space < len(piece):
                    run = ""
                inside = np.ones(len(own), bool)
                inside[sizes - 1] = False
                base = base + self.piece[piece]
                own[inside] = -1
                out.append(own)
        return np.concatenate(out)

    def cut(self, text: str, budget: int) -> int:
        """Bytes of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero((t := self.table(text)) * (t >= 0) + (t < 0) * (budget + 1) <= budget)[-1])


@functools.lru_cache(1)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def _rows(path: str, limit: int, tables: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            texts = [t or "" for t in column(batch, "text").to_pylist()]
            counts = list(map(own.count, texts))
            cols = [column(batch, "doc_id").cast(pa.int64()),
                    pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            if tables:
                cols.append(pa.array([own.table(t) for t in texts], pa.list_(pa.int64())))
                names.append("prefix_tokens")
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def token_counts(docs: DataFrame, limit: int = LIMIT_TOKENS, path: str | None = None,
                 tables: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of docs(doc_id, text),
    with ``tables`` also prefix_tokens (tokens of the first 0, 1, ... bytes;
    -1 inside a character); one narrow stage without a shuffle."""
    ship(docs.sparkSession)
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean" + ", prefix_tokens array<long>" * tables
    return docs.select("doc_id", "text").mapInArrow(
        _rows(path or public_tokenizers.path(VOCABULARY), limit, tables), schema)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))

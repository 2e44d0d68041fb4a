"""Exact byte-pair encoding by a trie of distinct words, and decoding.

The distinct words of a chunk of texts are inserted into a trie of their
bytes, which is walked depth first. A node's state is the last token of the
encoding of its prefix: of the vocabulary's tokens that end there, exactly one
fits the last token of the prefix before it (the two come back unchanged when
merged again, which is read off their merges). A word's ids are read backwards from its node's state, and a
prefix that many words share is worked out once. The walk keeps only the
states of the path it stands on, as a trie's words in byte order are its depth-first
order and neighbours branch where they first differ. Words of earlier chunks are
remembered in a bounded table.

Decoding maps the ids back to bytes, as the library does: what isn't valid
UTF-8 is read as U+FFFD, special tokens stay.

Defined cases: null text counts as empty (no ids, empty decoded text); special
strings inside a text are the library's single tokens; whole texts of any
length (long ones chunk by chunk); repeated rows each get their row; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from bondmart.llm.common import chunks, column, ship, table
from bondmart.llm.merges import NEVER
from bondmart.llm.token_counts import byte_alphabet

VOCABULARY = "byte_bpe_50k.json"


class TrieCoder:
    """Encodes and decodes with one vocabulary. Tokens and words are held as
    strings of a character per byte; ids as little-endian 32-bit integers."""

    CHUNK_BYTES = 4 << 20  # texts whose new words go through one trie
    LIMIT, LONGEST = 700_000, 64  # remembered words, and their greatest length

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, added = spec["model"], spec["pre_tokenizer"], spec["added_tokens"]
        if (spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or model["type"] != "BPE"
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError("only plain byte-level BPE is supported")
        raw = {ord(c): chr(b) for b, c in enumerate(byte_alphabet())}
        self.specials = {t["content"]: t["id"] for t in added}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if added else None
        self.id = {t.translate(raw): i for t, i in model["vocab"].items() if t not in self.specials}
        self.token = {i: t for t, i in self.id.items()}
        self.size = {i: len(t) for t, i in self.id.items()}
        self.bytes = {i: t.encode("latin-1") for t, i in self.id.items()}
        self.bytes.update((i, t.encode()) for t, i in self.specials.items())
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        merges = [(a.translate(raw), b.translate(raw)) for a, b in pairs]
        if len({a + b for a, b in merges}) < len(merges):
            raise ValueError("a token of this vocabulary has two merges")
        #: when a token is made (bytes are there from the start), of which two, and what two make
        self.turn = {i: -1 for i in self.id.values()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for n, (a, b) in enumerate(merges):
            left, right, both = self.id[a], self.id[b], self.id[a + b]
            self.turn[both], self.halves[both], self.made[left << 20 | right] = n, (left, right), n
        sizes = defaultdict(lambda: {1})  # of the tokens that may end with two bytes
        for t in self.id:
            if len(t) > 1:
                sizes[t[-2:]].add(len(t))
        self.sizes = {end: tuple(sorted(s, reverse=True)) for end, s in sizes.items()}
        self.fits: dict[int, bool] = {}
        self.pieces_of = regex.compile(public_tokenizers.PATTERN)
        #: beyond these the two libraries may know different letters; then the tokeniser's own splitter is asked
        self.newer = regex.compile(r"[^\u0000-՗‐-⁤　-ヿ一-鿿가-힣]").search
        self.library = Tokenizer.from_file(path).pre_tokenizer
        #: no piece reaches across a single space or line feed between words
        self.words = re.compile(r" ?[^ \n]+|\n").findall
        space = regex.compile(r"\s").match
        self.odd = ["  ", "\n\n", " \n", "\n ", *(c for c in map(chr, range(0x3001)) if c not in " \n" and (c.isspace() or space(c)))]
        self.piece: dict[str, bytes] = {}
        self.word: dict[str, bytes] = {}
        self.long: list[str] = []  # words to forget after their chunk

    # ------------------------------------------------------------ the trie
    def fit(self, left: int, right: int) -> bool:
        """Does token ``right`` follow ``left`` (-1: none) in an encoding?"""
        key = left << 20 | right
        got = self.fits.get(key)
        if got is None:
            if len(self.fits) >= self.LIMIT:
                self.fits.clear()
            got = self.fits[key] = left < 0 or self.stay_apart(left, right)
        return got

    def stay_apart(self, left: int, right: int) -> bool:
        """Do both tokens come back when their bytes are merged again?

        Only the parts that meet at their border can go astray. Merging is
        unwound: the later made of the two is taken apart (of one turn, the
        right one, as merging goes from left to right), and at each step the two parts at
        the border must not have merged before the one taken apart last was made."""
        turn, halves, made = self.turn, self.halves, self.made
        until, after = NEVER, False  # a merge at the border is too late from this turn on
        while True:
            merge = made.get(left << 20 | right, NEVER)
            if merge < until or after and merge == until:
                return False
            if turn[left] < 0 and turn[right] < 0:
                return True
            if turn[left] > turn[right]:
                until, after = turn[left], False
                left = halves[left][1]
            else:  # its own merge comes after one of the same turn to its left
                until, after = turn[right], True
                right = halves[right][0]

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each distinct word with its ids, in the depth-first order of their trie."""
        ids, sizes, fits, size = self.id, self.sizes, self.fits, self.size
        before, last = "", [-1]  # the path to the node before, and the states on it
        for path, word in sorted((w.encode().decode("latin-1"), w) for w in words):
            shared, most = 0, min(len(before), len(path))
            while shared < most and before[shared] == path[shared]:
                shared += 1
            del last[shared + 1:]
            for end in range(shared + 1, len(path) + 1):
                for n in sizes.get(path[end - 2:end], (1,)) if end > 1 else (1,):
                    if n <= end:
                        token = ids.get(path[end - n:end])
                        if token is not None:
                            left = last[end - n]
                            got = fits.get(left << 20 | token)
                            if got or got is None and self.fit(left, token):
                                last.append(token)
                                break
                else:
                    raise ValueError(f"no token of the vocabulary ends {path[:end]!r}")
            out, at = [], len(path)
            while at:
                out.append(last[at])
                at -= size[last[at]]
            out.reverse()
            before = path
            yield word, out

    def learn_pieces(self, pieces: Iterable[str]) -> None:
        for piece, ids in self.walk(set(pieces).difference(self.piece)):
            self.piece[piece] = pack(ids)
            if len(piece) > self.LONGEST:
                self.long.append(piece)

    # --------------------------------------------------------------- texts
    def split(self, text: str) -> Iterator[str]:
        """Pieces of a text without special strings."""
        if not self.newer(text):
            return (m.group() for m in self.pieces_of.finditer(text))
        return (text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text))

    def parts(self, text: str, special: bool) -> Iterator[tuple[str, bool]]:
        """Plain stretches and special strings."""
        if not special or not self.special:
            yield text, False
            return
        for k, part in enumerate(self.special.split(text)):
            if part:
                yield part, k % 2 == 1

    def by_piece(self, text: str, special: bool) -> Iterator[bytes]:
        """Ids of a text in portions that end with a piece."""
        for part, own in self.parts(text, special):
            if own:
                yield pack([self.specials[part]])
                continue
            pieces = self.split(part)
            while portion := list(islice(pieces, 1 << 16)):
                self.learn_pieces(portion)
                yield b"".join(map(self.piece.__getitem__, portion))
                self.forget()

    def plain(self, text: str) -> bool:
        """Only words with a single space or line feed between them?"""
        return not (not text or text[0] in " \n" or text[-1] in " \n" or any(map(text.__contains__, self.odd))
                    or any(map(text.__contains__, self.specials)))

    def encode_all(self, texts: list[str], special: bool = True) -> Iterator[Iterator[bytes]]:
        """The ids of each text, in portions; the words of about CHUNK_BYTES of
        text share a trie. ``special``: special strings are single tokens."""
        for a, b in chunks(list(map(len, texts)), self.CHUNK_BYTES):
            if b - a == 1 and len(texts[a]) > self.CHUNK_BYTES:
                yield self.by_piece(texts[a], special)
                continue
            plain = [self.plain(t) for t in texts[a:b]]
            words = [self.words(t) if p else () for t, p in zip(texts[a:b], plain)]
            new = {w: (w,) if w.isascii() and w.removeprefix(" ").isalpha() else tuple(self.split(w))
                   for w in set().union(*words).difference(self.word)}
            self.learn_pieces(set().union(*new.values()))
            for word, pieces in new.items():
                self.word[word] = b"".join(map(self.piece.__getitem__, pieces))
                if len(word) > self.LONGEST:
                    self.long.append(word)
            ready = [b"".join(map(self.word.__getitem__, w)) if p else None for w, p in zip(words, plain)]
            self.forget()
            for text, ids in zip(texts[a:b], ready):
                yield self.by_piece(text, special) if ids is None else iter((ids,))

    def forget(self) -> None:
        """Hold the tables to their bound; long words aren't remembered."""
        for known in (self.piece, self.word):
            if len(known) > self.LIMIT:
                known.clear()
            for long in self.long:
                known.pop(long, None)
        self.long.clear()

    def encode(self, text: str, special: bool = True) -> list[int]:
        return unpack(b"".join(next(self.encode_all([text], special))))

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def pack(ids: list[int]) -> bytes:
    a = array("I", ids)
    if a.itemsize != 4:
        raise ValueError("this platform's integers aren't 32 bits wide")
    return a.tobytes() if _LITTLE else _swapped(a)


def unpack(ids: bytes) -> list[int]:
    a = array("I", ids)
    if not _LITTLE:
        a.byteswap()
    return a.tolist()


def _swapped(a: array) -> bytes:
    a.byteswap()
    return a.tobytes()


_LITTLE = array("H", b"\1\0")[0] == 1


@functools.lru_cache(1)
def coder(path: str) -> TrieCoder:
    return TrieCoder(path)


def _rows(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            counts, hashes, decoded, lists = [], [], [], []
            for portions in own.encode_all([t or "" for t in column(batch, "text").to_pylist()]):
                n, ids_hash, text_hash, kept = 0, hashlib.sha256(), hashlib.sha256(), []
                for packed in portions:  # a portion ends with a character
                    ids = unpack(packed)
                    n += len(ids)
                    ids_hash.update(packed)
                    text_hash.update(own.decode(ids).encode())
                    if with_ids:
                        kept += ids
                counts.append(n)
                hashes.append(ids_hash.hexdigest())
                decoded.append(text_hash.hexdigest())
                lists.append(kept)
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
        _rows(path or public_tokenizers.path(VOCABULARY), with_ids), schema + ", ids array<int>" * with_ids)


def op13_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))

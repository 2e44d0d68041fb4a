"""Benchmark decontamination by template windows and slot consistency.

Texts become template tokens: lower-cased words, with typed placeholders for
numbers, names (capitalised words inside a sentence) and units (after a
number). Windows of 8 template tokens that hold at least 4 plain words are
hash-joined with the windows of the benchmark items (an item of 5 to 7 tokens
is one window of its own length). A window's template is compared as text
besides its hash. For a document and an item, windows at the same offset are
one copy of the item: the copy counts if its slots are consistent, that is,
each value of the item stands for one value of the document, and different
names for different names. An item is found if consistent copies cover at
least 0.6 of its tokens and 8 of its plain words (or all), or if one consistent
copy covers 13 consecutive tokens with 8 plain words among them, whatever
share of a long item they are: a passage of the item.

Template windows alone don't find items of under 5 tokens or of few plain
words, and a copy's first and last tokens take their kind from the words
around it. So every item is also searched whole, with its literal values: its
lower-cased words, numbers and signs (``Literals``; a character is a token in
scripts without spaces) in windows of 8 tokens, or of its own length if that is
less. A whole copy (all windows of the item at one offset) is found with
coverage 1, whatever its words.

Only document windows whose hash is set in a bitmap of the benchmark's
windows travel. The bitmap has a fixed size; what it lets through by chance is
removed by the join. Windows of both sides are computed over whole texts.
Windows meet by copy (document, item, offset), so a row to judge holds no more
than one item's windows, however often a text repeats the item; the places
that consistent copies cover are united by Spark.

Defined cases: null texts and texts without a word or sign match nothing;
an item that repeats one phrase (two or more times in full) isn't found whole
inside a longer run of the same phrase, which is another text; repeated items
and items with a null id are dealt with like others; a null doc_id stays null
in the result; rows that share a doc_id are told apart by their text; other
columns are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bondmart.llm.common import byte_texts, chunks, column, mix, rolling, ship, span_hash, table

WINDOW, SHORTEST, PLAIN_WORDS = 8, 5, 4
COVERAGE, PLAIN_COVERED = 0.6, 8
PASSAGE = 13  # consecutive tokens of an item that one copy must cover
BITMAP_BITS = 1 << 23
CHUNK_BYTES = 2 << 20

# fixed values: units and number words that become placeholders
UNITS = ("mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms oz ounce "
         "ounces lb lbs pound pounds ton tons ml l liter liters litre litres gallon gallons cup cups second seconds sec "
         "minute minutes min hour hours day days week weeks month months year years cent cents dollar dollars euro "
         "euros usd eur percent degree degrees mph kmh watt watts volt volts meter meters metre metres kilometer "
         "kilometers kilometre kilometres").split()
NUMBER_WORDS = ("two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million").split()

NAME, NUMBER, UNIT = 1, 2, 3
_MARK = {NAME: "<name>", NUMBER: "<num>", UNIT: "<unit>"}

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;\n\"")] = True


def _known(words: list[str]) -> np.ndarray:
    """Sorted hashes of words as ``Templates`` makes them."""
    data = np.frombuffer((" ".join(words) + " ").encode(), np.uint8)
    end = np.flatnonzero(data == 0x20)
    return np.sort(span_hash(data, np.append(0, end[:-1] + 1)))


class Templates:
    """Template tokens of several texts: hash, kind (0: plain word) and text number."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        after, before = np.append(raw[1:], np.uint8(10)), np.append(np.uint8(10), raw[:-1])
        letter, digit = _LETTER[raw], _DIGIT[raw]
        letter |= ((raw == 0x2E) | (raw == 0x2C)) & _DIGIT[before] & _DIGIT[after]  # 1,000.5 is one number
        sign = (raw == 0xC2) | ((raw == 0xE2) & (after == 0x80))  # signs and quotes outside ASCII
        if sign.any():
            at = np.flatnonzero(sign)
            letter[at], letter[np.minimum(at + 1, len(raw) - 1)] = False, False
            long = at[raw[at] == 0xE2]
            letter[np.minimum(long + 2, len(raw) - 1)] = False
        head = letter.copy()
        head[1:] &= ~letter[:-1]
        tail = letter.copy()
        tail[:-1] &= ~letter[1:]
        start, end = np.flatnonzero(head), np.flatnonzero(tail)
        accented = (before == 0xC3) & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
        low = np.where(letter, _LOWER[raw] + np.where(accented, np.uint8(0x20), np.uint8(0)), np.uint8(0x20))
        gap = ~letter
        gap[1:] &= ~letter[:-1]
        gap[0] = not letter[0]
        clean = low[~gap]  # words, each followed by one space
        first = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.bytes, self.data = clean, clean.tobytes()
        self.end = np.flatnonzero(clean == 0x20)
        self.start = np.append(0, self.end[:-1] + 1)[:len(self.end)]
        doc = np.searchsorted(first, start, side="right")
        hashes = span_hash(clean, self.start)
        kind = np.zeros(len(start), np.int8)
        stops = np.cumsum(_STOP[raw])
        begins = np.append(True, stops[start[1:]] > stops[end[:-1]]) if len(start) else np.zeros(0, bool)
        capital = (_CAPITAL[raw[start]] | accented[np.minimum(start + 1, len(raw) - 1)]) & (end > start)
        second = np.minimum(start + np.where(raw[start] == 0xC3, 2, 1), len(raw) - 1)
        capital &= letter[second] & ~_CAPITAL[raw[second]] & ~digit[second]
        kind[capital & ~begins] = NAME
        kind[digit[start] | np.isin(hashes, _NUMBER_HASHES)] = NUMBER
        units = np.isin(hashes, _UNIT_HASHES)
        units[1:] &= (kind[:-1] == NUMBER) & (doc[1:] == doc[:-1])
        units[:1] = False
        kind[units] = UNIT
        more = np.zeros(len(kind), bool)  # names of several words are one slot
        more[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & (doc[1:] == doc[:-1])
        keep = np.flatnonzero(~more)
        last = np.append(keep[1:], len(kind)) - 1  # the last word of each token
        self.doc, self.kind, self.word, self.last = doc[keep], kind[keep], keep, last
        self.hash = np.where(self.kind > 0, mix(self.kind.astype(np.uint64)), hashes[keep])

    def __len__(self) -> int:
        return len(self.doc)

    def text(self, i: int) -> str:
        return self.data[self.start[self.word[i]]:self.end[self.last[i]]].decode("utf-8", "replace")

    def windows(self, size: int, plain: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of windows within one text, with enough plain words."""
        n = len(self) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        words = np.append(0, np.cumsum(self.kind == 0))
        ok = (self.doc[:n] == self.doc[size - 1:]) & (words[size:] - words[:n] >= plain)
        at = np.flatnonzero(ok)
        return at, rolling(self.hash, size)[at] ^ np.uint64(size)

    def template(self, i: int, size: int) -> tuple[str, list[str]]:
        parts, slots = [], []
        for j in range(i, i + size):
            kind = int(self.kind[j])
            parts.append(_MARK.get(kind) or self.text(j))
            if kind:
                slots.append(self.text(j))
        return " ".join(parts), slots


_UNIT_HASHES, _NUMBER_HASHES = _known(UNITS), _known(NUMBER_WORDS)

#: signs that sentences and quotations are made of; all others are tokens
_MARKS = ".,;:!?\"'`()[]{}\u00a1\u00bf\u00ab\u00bb\u2026"
#: first and last characters of scripts written without spaces
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3040, 0x30FF),
             (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
             (0x1B000, 0x1B16F), (0x20000, 0x3FFFD)]
_GAP, _IN_WORD, _DIGIT_SIGN, _ALONE = 0, 1, 2, 3


@cache
def _classes() -> np.ndarray:
    """By code point: between tokens, part of a word, a digit, or a token of its own."""
    out = np.zeros(sys.maxunicode + 1, np.int8)
    for i in range(0x32400):  # what is assigned; private characters and tags are no tokens
        c = chr(i)
        kind = unicodedata.category(c)
        if kind == "Nd":
            out[i] = _DIGIT_SIGN
        elif kind[0] in "LMN":
            out[i] = _IN_WORD
        elif kind[0] == "S" or kind in ("Po", "Pd", "Pc") and unicodedata.normalize("NFKC", c) not in _MARKS:
            out[i] = _ALONE
    for a, b in _UNSPACED:
        part = out[a:b + 1]
        part[part == _IN_WORD] = _ALONE
    for c in "\u00b7\u3001\u3002\uff61\uff64\u2018\u2019\u201c\u201d" + _MARKS:
        out[ord(c)] = _GAP
    return out


class Literals:
    """Tokens of several texts as they stand: lower-cased words and numbers,
    signs, and characters of scripts without spaces. A token depends on no word
    beside it, so a copy has an item's tokens wherever it stands."""

    def __init__(self, texts: list[bytes]):
        lower = [unicodedata.normalize("NFC", t.decode("utf-8", "replace").casefold()) for t in texts]
        raw = np.frombuffer(("\n".join(lower) + "\n").encode("utf-32-le", "replace"), np.uint32)
        kind = _classes()[raw]
        digit = kind == _DIGIT_SIGN
        inside = digit | (kind == _IN_WORD)
        point = np.flatnonzero((raw == 0x2E) | (raw == 0x2C))  # 1,000.5 is one number
        inside[point] = digit[point - 1] & digit[np.minimum(point + 1, len(raw) - 1)] & (point > 0)
        alone = kind == _ALONE
        head, tail = inside | alone, inside | alone
        head[1:] &= ~(inside[1:] & inside[:-1])
        tail[:-1] &= ~(inside[:-1] & inside[1:])
        start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
        first = np.cumsum(np.fromiter((len(t) + 1 for t in lower), np.int64, len(lower)))
        self.doc = np.searchsorted(first, start, side="right")
        size = end - start
        at = np.cumsum(size + 1) - size - 1  # each token followed by one space
        clean = np.full(int((size + 1).sum()), 0x20, np.uint32)
        clean[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = raw[inside | alone]
        self.clean, self.start, self.end = clean, at, at + size
        self.hash = span_hash(clean, at)

    def __len__(self) -> int:
        return len(self.doc)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of windows within one text."""
        n = len(self) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1:])
        return at, rolling(self.hash, size)[at] ^ np.uint64(size << 32)

    def text(self, i: int, size: int) -> str:
        return self.clean[self.start[i]:self.end[i + size - 1]].tobytes().decode("utf-32-le", "replace")


_WINDOWS = "hash long, template string, at int, size int, slots array<string>, whole boolean"
_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.bool_()]


def _plain(size: int) -> int:
    return min(PLAIN_WORDS, size - 1)


def _signed(h: np.uint64) -> int:
    return int(h.astype(np.int64))


def _places(tokens: int) -> list[int]:
    """Places of the literal windows that together hold a whole item."""
    size = min(WINDOW, tokens)
    return sorted({*range(0, tokens - size + 1, size), tokens - size})


def _apart(places: np.ndarray, tokens: int) -> np.ndarray:
    """Those of an item's whole copies (sorted places) that no other copy
    overlaps by half or more: such copies are one longer run of a phrase."""
    near = np.diff(places) * 2 <= tokens
    alone = np.ones(len(places), bool)
    alone[1:] &= ~near
    alone[:-1] &= ~near
    return places[alone]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["item_id", *(c.split()[0] for c in _WINDOWS.split(", ")), "tokens", "plain", "whole_tokens"]
    for batch in batches:
        rows = []
        for item, text in zip(column(batch, "item_id").to_pylist(), byte_texts(batch)):
            t, whole = Templates([text or b""]), Literals([text or b""])
            plain = int((t.kind == 0).sum())
            if len(whole):
                size = min(WINDOW, len(whole))
                h = whole.windows(size)[1]
                rows += [(item, _signed(h[at]), whole.text(at, size), at, size, [], True, len(t), plain, len(whole))
                         for at in _places(len(whole))]
            size = min(WINDOW, len(t))
            if size < SHORTEST:
                continue
            for at, h in zip(*t.windows(size, _plain(size))):
                template, slots = t.template(at, size)
                rows.append((item, _signed(h), template, int(at), size, slots, False, len(t), plain, len(whole)))
        kinds = [pa.int64(), *_TYPES, pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _whole_hits(t: Literals, size: int, marked) -> list[tuple[int, int]]:
    """Places and hashes of the marked literal windows of some texts. A window
    of under 8 tokens is a whole item, so one place a text says all."""
    at, h = t.windows(size)
    hit = marked(h)
    at, h = at[hit].tolist(), h[hit].astype(np.int64).tolist()
    if size == WINDOW:
        return list(zip(at, h))
    copies = defaultdict(list)
    for a, x in zip(at, h):
        copies[int(t.doc[a]), x].append(a)
    kept = ((_apart(np.array(places), size), x) for (_, x), places in copies.items())
    return [(int(places[0]), x) for places, x in kept if len(places)]


def _doc_windows(bitmap, sizes: list[int], whole_sizes: list[int]):
    names = ["doc_id", "row_key", *(c.split()[0] for c in _WINDOWS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value

        def marked(h: np.ndarray) -> np.ndarray:
            slot = h & np.uint64(BITMAP_BITS - 1)
            hit = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
            return np.flatnonzero(hit)

        for batch in batches:
            ids, keys = column(batch, "doc_id").to_pylist(), column(batch, "row_key").to_pylist()
            texts = byte_texts(batch)
            for a, b in chunks([len(t) for t in texts], CHUNK_BYTES):
                t, rows = Templates(texts[a:b]), []
                first = np.searchsorted(t.doc, np.arange(b - a))
                for size in sizes:
                    at, h = t.windows(size, _plain(size))
                    for i in marked(h):
                        d = t.doc[at[i]]
                        template, slots = t.template(at[i], size)
                        rows.append((ids[a + d], keys[a + d], _signed(h[i]), template, int(at[i] - first[d]), size,
                                     slots, False))
                t = Literals(texts[a:b])
                first = np.searchsorted(t.doc, np.arange(b - a))
                for size in whole_sizes:
                    for i, h in _whole_hits(t, size, marked):
                        d = t.doc[i]
                        rows.append((ids[a + d], keys[a + d], h, t.text(i, size), int(i - first[d]), size, [], True))
                if rows:
                    kinds = [pa.int64(), pa.int64(), *_TYPES]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return run


def consistent(pairs: list[tuple[str, str, str]]) -> bool:
    """(placeholder, item's value, document's value): is each item's value one
    value of the document, and are different names different?"""
    to: dict[tuple[str, str], str] = {}
    back: dict[str, str] = {}
    for kind, mine, theirs in pairs:
        if to.setdefault((kind, mine), theirs) != theirs:
            return False
        if kind == _MARK[NAME] and back.setdefault(theirs, mine) != mine:
            return False
    return True


def _passage(words: dict[int, bool], plain_covered: int) -> bool:
    """words: place and whether it is a plain word. Are there PASSAGE
    consecutive places or more, with enough plain words?"""
    run = plain = 0
    last = None
    for place in sorted(words):
        if last is None or place != last + 1:
            run = plain = 0
        run, plain, last = run + 1, plain + words[place], place
        if run >= PASSAGE and plain >= plain_covered:
            return True
    return False


_KEYS = ["doc_id", "row_key", "item_id", "tokens", "plain", "whole_tokens"]
_KEY_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]


def _judge_copies(plain_covered: int):
    """Of rows(keys, whole, offset, windows: those of one copy): the consistent
    copies with the places of the item that they cover, and the whole copies (all
    windows of ``_places``) with their place in the text."""
    names = [*_KEYS, "whole", "changed", "passage", "places"]
    place = pa.struct([("place", pa.int32()), ("word", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                keys = [r[k] for k in _KEYS]
                if r["whole"]:
                    if len({w["at"] for w in r["windows"]}) == len(_places(r["whole_tokens"])):
                        rows.append((*keys, True, False, False, [{"place": r["offset"], "word": False}]))
                    continue
                pairs, words = [], {}
                for w in r["windows"]:
                    marks = w["template"].split(" ")
                    kinds = [m for m in marks if m in _MARK.values()]
                    pairs += zip(kinds, w["slots"], w["theirs"])
                    words |= {w["at"] + i: m not in _MARK.values() for i, m in enumerate(marks)}
                if consistent(pairs):
                    rows.append((*keys, False, any(a != b for _, a, b in pairs), _passage(words, plain_covered),
                                 [{"place": i, "word": word} for i, word in words.items()]))
            kinds = [*_KEY_TYPES, pa.bool_(), pa.bool_(), pa.bool_(), pa.list_(place)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return run


def _judged(met: DataFrame, coverage: float, plain_covered: int) -> DataFrame:
    """Items found by the places that consistent copies cover, or by a whole copy
    that no other one overlaps by half or more: such copies are one longer run of a
    phrase. One pass over the windows that met."""
    copies = met.groupBy(*_KEYS, "whole", (F.col("there") - F.col("at")).alias("offset")).agg(
        F.collect_set(F.struct("at", "template", "slots", "theirs")).alias("windows"))  # at most an item's windows
    good = copies.select(*_KEYS, "whole", "offset", "windows").mapInArrow(
        _judge_copies(plain_covered), "doc_id long, row_key long, item_id long, tokens int, plain int, whole_tokens int, "
        "whole boolean, changed boolean, passage boolean, places array<struct<place: int, word: boolean>>")
    places = good.select(*_KEYS, "whole", "changed", "passage", F.inline("places")).groupBy(*_KEYS, "whole", "place").agg(
        *[F.max(c).alias(c) for c in ("word", "changed", "passage")])
    order = Window.partitionBy(*_KEYS, "whole").orderBy("place")
    gaps = (F.col("place") - F.lag("place").over(order), F.lead("place").over(order) - F.col("place"))
    apart = [F.coalesce(gap * 2 > F.col("whole_tokens"), F.lit(True)) for gap in gaps]
    found = places.withColumn("apart", F.col("whole") & apart[0] & apart[1]).groupBy(*_KEYS).agg(
        F.max("apart").alias("whole"), F.count(F.when(~F.col("whole"), 1)).alias("covered"),
        F.count(F.when(F.col("word"), 1)).alias("words"), F.max("changed").alias("changed"), F.max("passage").alias("passage"))
    share = F.col("covered") / F.greatest(F.col("tokens"), F.lit(1))
    by_templates = F.col("passage") | ((share >= coverage) & (F.col("covered") > 0)
                                       & (F.col("words") >= F.least(F.lit(plain_covered), F.col("plain"))))
    return found.where(F.col("whole") | by_templates).select(
        "doc_id", "row_key", "item_id", F.when(F.col("whole"), 1.0).otherwise(share).alias("coverage"),
        (by_templates & F.col("changed")).alias("reparameterised"))


def find_rows(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
              plain_covered: int = PLAIN_COVERED) -> DataFrame:
    """doc_id, row_key, item_id, coverage, reparameterised for each row of
    docs(doc_id, text) and item of benchmark(item_id, text) found in it.
    row_key is xxhash64(text)."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.mapInArrow(_item_windows, f"item_id long, {_WINDOWS}, tokens int, plain int, whole_tokens int")
    # at most one row per word of the bitmap reaches the driver, however long the benchmark is
    slot = F.col("hash").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = items.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(
        f"shiftleft(1L, cast(hash & 63 as int))")).alias("bits")).collect()
    bits = np.zeros(BITMAP_BITS // 64, np.uint64)
    for w in words:
        bits[w["word"]] = np.int64(w["bits"]).astype(np.uint64)
    known = items.select("size", "whole").distinct().collect()
    sizes, whole_sizes = ([r.size for r in known if r.whole == w] for w in (False, True))
    rows = docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_key"))
    found = rows.mapInArrow(_doc_windows(spark.sparkContext.broadcast(bits), sizes, whole_sizes),
                            f"doc_id long, row_key long, {_WINDOWS}")
    theirs = found.select("doc_id", "row_key", "hash", "template", "whole", F.col("at").alias("there"),
                          F.col("slots").alias("theirs"))
    met = theirs.join(items, ["hash", "template", "whole"])
    return _judged(met, coverage, plain_covered)


def find_items(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
               plain_covered: int = PLAIN_COVERED) -> DataFrame:
    """``find_rows`` without row_key."""
    return find_rows(docs, benchmark, coverage, plain_covered).drop("row_key")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).distinct()

"""Trie encoding against its library and alignment of two tokenisers against
brute force, with their edge rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from test_texts import SCHEMA, by, edge_rows, frame, given, sha
from tokenizers import Tokenizer

from bondmart.llm import alignment, bpe_trie

JSON, MODEL = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def cases():
    return pytest.mark.parametrize("rows", [given(), edge_rows(), []], ids=["given", "edges", "empty"])


@cases()
def test_trie_encoding_matches_the_library(spark, rows):
    lib, want = Tokenizer.from_file(JSON), []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((i, len(ids), sha(packed), sha(lib.decode(ids, skip_special_tokens=False).encode())))
    assert by(bpe_trie.encode_decode(frame(spark, rows)).collect()) == by(want)


@pytest.mark.parametrize("chunk,limit", [(1 << 20, 400_000), (200, 30)])
def test_trie_encoding_of_random_texts(monkeypatch, chunk, limit):
    monkeypatch.setattr(bpe_trie.TrieCoder, "CHUNK_BYTES", chunk)  # small: portions, and tables that start anew
    monkeypatch.setattr(bpe_trie.TrieCoder, "LIMIT", limit)
    lib, own, r = Tokenizer.from_file(JSON), bpe_trie.TrieCoder(JSON), random.Random(7)
    tokens = list(own.id)
    vocab = ["the", "Tree", "höhe", "12", "<|endoftext|>", "日本", "don't", "'ll", "a\tb", "  ", "\n", " ", "\xa0",
             "\x1c", "é", "ſ", "\U0001F600", "ꙮ", "'s", "'"]
    texts = ["".join(r.choice(vocab) if r.random() < .6 else r.choice(tokens).encode("latin-1").decode(errors="ignore")
                     for _ in range(r.randint(0, 40))) for _ in range(400)]
    for special in (True, False):
        lib.encode_special_tokens = not special
        for t, got in zip(texts, own.encode_all(texts, special)):
            ids = bpe_trie.unpack(b"".join(got))
            assert ids == lib.encode(t, add_special_tokens=False).ids
            assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)
    for _ in range(300):  # ids that no text has
        ids = [r.randrange(50257) for _ in range(8)]
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_shared_prefixes_are_worked_out_once(monkeypatch):
    own = bpe_trie.TrieCoder(JSON)
    steps = Counter()

    class Sizes(dict):
        def get(self, key, default=None):
            steps["nodes"] += 1
            return super().get(key, default)

    own.sizes = Sizes(own.sizes)
    words = [" international" + x for x in ("", "ly", "ise", "ised", "isation")]
    got = dict(own.walk(words))
    lib = Tokenizer.from_file(JSON)
    assert got == {w: lib.encode(w).ids for w in words}
    assert steps["nodes"] == len({w[:n] for w in words for n in range(2, len(w) + 1)})  # one step a trie node


def aligned_by_hand(rows):
    a_lib, b_lib = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a_lib.encode_special_tokens = True
    char = {c: b for b, c in enumerate(bpe_trie.byte_alphabet())}
    out, links = [], []
    for _, t in rows:
        a = a_lib.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_lib.encode(t) if t else []
        bytes_a = [bytes(char[c] for c in a_lib.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(b_lib.id_to_piece(i)[3:-1], 16)]) if b_lib.is_byte(i)
                   else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            out.append((0, 0, 0, ""))
            links.append(Counter())
            continue
        ends_a, ends_b = ([sum(map(len, x[:k + 1])) for k in range(len(x))] if len(x) < 2000 else
                          __import__("itertools").accumulate(map(len, x)) for x in (bytes_a, bytes_b))
        ends_a, ends_b = list(ends_a), list(ends_b)
        shared = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for e in shared:
            to_i, to_j = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            groups.append((a[i:to_i], b[j:to_j]))
            i, j = to_i, to_j
        own = Counter()
        for ga, gb in groups:
            cb = Counter(gb)
            for x, nx in Counter(ga).items():
                for y, ny in cb.items():
                    own[x, y] += nx * ny
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), hashlib.sha256(text.encode()).hexdigest()))
        links.append(own)
    count = Counter(pair for own in links for pair in own)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return [(i, na, nb, ng, sum(own.values()), sum(n for p, n in own.items() if count[p] == top[p[0]]),
             sum(n * count[p] for p, n in own.items()), h)
            for (i, _), (na, nb, ng, h), own in zip(rows, out, links)]


@cases()
@pytest.mark.parametrize("block,links", [(4 << 20, 4 << 20), (3000, 50)])
def test_alignment_matches_brute_force(spark, monkeypatch, rows, block, links):
    # one block, and many of few rows; joins cut within a group, too
    rows = [(i, t) for i, t in rows if not t or len(t) < 50_000]
    rows += [(900, "a▁b"), (901, "<|endoftext|> <s> x"), (902, "ﬁ \U0001F600\U0001F601 ꙮꙮ"), (903, "é" * 50 + "¼½" * 40)] * bool(rows)
    monkeypatch.setattr(alignment, "LINK_ROWS", links)
    got = alignment.align(frame(spark, rows), block_bytes=block).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert by(got.collect()) == by(aligned_by_hand(rows))


def test_a_long_group_is_linked_in_portions(monkeypatch):
    import pyarrow as pa
    r = random.Random(2)
    a = pa.table({"doc": [0] * 300 + [1] * 2, "group": [0] * 300 + [1, 2], "id": [r.randrange(90) for _ in range(300)] + [5, 6]})
    b = pa.table({"doc": [0] * 200 + [1] * 3, "group": [0] * 200 + [1, 2, 2], "id": [r.randrange(70) for _ in range(200)] + [5, 6, 6]})
    sizes = []
    for limit in (10, 10_000):
        monkeypatch.setattr(alignment, "LINK_ROWS", limit)
        sizes.append(sorted(map(tuple, (x.values() for x in alignment.linked(a, b).to_pylist()))))
    assert sizes[0] == sizes[1] and sum(x[-1] for x in sizes[0]) == 300 * 200 + 1 + 2


def test_extra_columns_with_clashing_names(spark):
    rows = [(1, "one two", "x", "y", 3, "z"), (1, "one two", None, None, None, None)]
    schema = SCHEMA.replace("fp", "n_a").replace("spans", "block").replace("row_key", "pair_a")
    got = alignment.align(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 2 and got[0] == got[1] and got[0].n_groups == 2 and got[0].count_sum == 4

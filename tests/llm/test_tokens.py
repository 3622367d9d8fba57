import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weftlink.llm import packing, token_codec, tokens
from weftlink.llm.common import Scratch

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PARTS = ["a", "B", "é", " ", " ", "\n", "\t", "\r", "\xa0", "'s", "<|endoftext|>", "12", "!!", "\x1c", "\u0301", "x", "  ", "\x85", "ſ", "\0", "\u3000", "漢", "\u2028"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_is_exact(path, monkeypatch):
    monkeypatch.setattr(tokens, "SPAN", 60)
    r = random.Random(1)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 12))) for _ in range(4000)] + [" ".join(r.choice(["foo", "bar", "b\naz", "q's"]) for _ in range(200)), "x" * 500, " " * 300]
    own = tokens.Encoder(path, remembered=200)
    texts += ["Straße, İstanbul. ΣΑΣ! ǅ ɐb naïve: ĿL· Ǆe\u0301 \nÀ la\ncarte," * 3]
    whole = Tokenizer.from_file(path)
    assert own.encode(texts) == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_rule_for_latin_letters_is_exact(path):
    own, whole = tokens.Encoder(path, remembered=200), Tokenizer.from_file(path)
    assert own.rule is not None
    r = random.Random(5)
    letters = [chr(c) for c in (*range(0x180), *range(0x2010, 0x2028))]
    texts = [x for c in letters for x in (c, f"a{c}B", f"a {c} '{c}", f"1{c}2 {c}{c}", f"{c}\u0301")]
    texts += ["".join(r.choice(some) for _ in range(r.randint(1, 14))) for some in (letters, "ab 'sStTreRvVmMlLdD9. !\n\t’") for _ in range(3000)]
    assert sum(map(own._latin, texts)) > 6000
    assert own.encode(texts) == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def best_fit(lengths, capacity):
    """Sequences a plain best-fit packer takes, longest first."""
    free, n = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(free, length)
        if k == len(free):
            free.append(capacity)
            n += 1
        if gap := free.pop(k) - length:
            bisect.insort(free, gap)
    return n


def test_match_leftovers():
    r = random.Random(2)
    for _ in range(200):
        counts = [(k, r.choice([0, 0, 1, 5]), r.choice([0, 1, 4])) for k in range(r.randint(0, 8))]
        got = {(part, rank + i): (above, top - i) for part, rank, many, above, top in packing.match_leftovers(counts) for i in range(many)}
        stack, want = [], {}
        for part, docs, gaps in counts:
            for rank in range(docs):
                if stack:
                    want[part, rank] = stack.pop()
            stack += [(part, rank) for rank in range(gaps)]
        assert got == want


@pytest.mark.parametrize("capacity,n", [(7, 300), (64, 900)])
def test_place(spark, tmp_path, capacity, n):
    r = random.Random(capacity)
    lengths = [r.choice([1, 2, capacity // 2, capacity, r.randint(1, capacity)]) for _ in range(n)]
    scratch = Scratch(spark)
    pieces = scratch.keep(spark.createDataFrame(list(enumerate(lengths)), "row long, length long").repartition(5), "pieces")
    rows = packing.place(pieces, capacity, scratch).collect()
    assert sorted(x.row for x in rows) == list(range(n))
    load = {}
    for x in sorted(rows, key=lambda x: (x.sequence_id, x.offset)):
        assert load.get(x.sequence_id, 0) == x.offset
        load[x.sequence_id] = x.offset + lengths[x.row]
    assert max(load.values()) <= capacity
    assert len(load) <= best_fit(lengths, capacity) + 2
    assert packing.place(pieces.limit(0), capacity, scratch).count() == 0


def test_pack(spark, odd, none):
    got = packing.pack(odd, WORD, capacity=64, with_ids=True).collect()
    whole = Tokenizer.from_file(WORD)
    want, have = [], []
    for row in odd.collect():
        ids = whole.encode(row.text or "", add_special_tokens=False).ids + [0]
        want += [(row.doc_id, k, a, np.array(ids[a : a + 64], "<u4").tobytes()) for k, a in enumerate(range(0, len(ids), 64))]
    sequences = {}
    for r in got:
        have.append((r.doc_id, r.piece, r.start, bytes(r.ids)))
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(have, key=repr) == sorted(want, key=repr)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(none, WORD).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 5000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    blocks = [rng.integers(0, 50257, n), rng.zipf(1.3, 2 * n) % 50257, np.tile(rng.integers(0, 50, 7), n)[:n], np.zeros(n, int), np.full(n + 1, 50256), np.empty(0, int)]
    data = token_codec.encode_blocks(blocks, 50257)
    for got, want in zip(token_codec.decode_blocks(data, [len(b) for b in blocks], 50257), blocks, strict=True):
        assert (got == want).all()
    for block, alone in zip(blocks, data, strict=True):  # a block does not depend on those coded with it
        assert token_codec.encode_blocks([block], 50257) == [alone]
        assert (token_codec.decode_blocks([alone], [len(block)], 50257)[0] == block).all()


def test_model_learns():
    ids = np.tile(np.random.default_rng(0).integers(0, 50257, 500), 200).astype(np.int64)
    assert len(token_codec.encode_blocks([ids], 50257)[0]) < 0.3 * 2 * len(ids)


def test_damaged_block():
    ids = lambda *x: np.array(x, "<u4").tobytes()
    blocks = token_codec.write_blocks(3, 7, [[(1, ids(5, 6)), (None, ids(7))], [(2, ids(8))]], 50257)
    data = b"".join(b + b"\n" for b in blocks)
    for together in (1, 8):
        got = [(task, number, keys, counts.tolist(), x.tolist()) for task, number, keys, counts, x in token_codec.read_blocks(data, together)]
        assert got == [(3, 7, [1, None], [2, 1], [5, 6, 7]), (3, 8, [2], [1], [8])]
    for k in (0, 5, 9, 30, len(blocks[0]) - 1):
        with pytest.raises(ValueError):
            list(token_codec.read_blocks(data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :]))
    with pytest.raises(ValueError):
        list(token_codec.read_blocks(data[:-4]))
    assert list(token_codec.read_blocks(b"")) == []


def test_codec(spark, odd, none, tmp_path):
    path, scratch = f"file://{tmp_path}/blocks", Scratch(spark)
    token_codec.write_corpus(odd, BYTE, path, block_ids=500)
    got = token_codec.read_corpus(spark, path, scratch, with_ids=True).orderBy("start").collect()
    whole = Tokenizer.from_file(BYTE)
    want = sorted(((r.doc_id, np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [k for k, _ in want]
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in got) == sorted((repr(k), i) for k, i in want)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(bytes(r.ids)))
        at += r.n_tokens
    token_codec.write_corpus(none, BYTE, f"{path}0")
    assert token_codec.read_corpus(spark, f"{path}0", Scratch(spark)).count() == 0


def test_codec_asks_the_library_once_for_a_word(monkeypatch):
    r, asked = random.Random(5), []
    words = list({"".join(r.choices("abcdefgh", k=9)) for _ in range(210_000)})
    own = tokens.Encoder(BYTE, token_codec.WORDS_KEPT)
    own.words.make = lambda word: asked.append(word) or word.encode()
    texts = [" ".join(words[a : a + 500]) for a in range(0, len(words), 500)]
    for _ in range(2):  # as of two tasks
        own.encode(texts)
    assert len(asked) == len(set(asked))
    few = tokens.Encoder(BYTE, 100)
    few.encode(texts[:3])
    assert not few.words.older.older  # two generations at most


def test_quotient_is_exact():
    r = np.random.default_rng(3)
    b = np.r_[r.integers(1, 1 << 26, 20_000), r.integers(1, 64, 20_000), (1 << 20) + np.arange(-50, 50)]
    q = r.integers(1, 1 << 26, len(b))
    for a in (q * b, q * b - 1, q * b + b - 1):
        a = np.minimum(a, (1 << 52) - 1)
        assert (token_codec._quotient(a, b) == a // b).all()


def test_many_blocks_together():
    r = np.random.default_rng(4)
    blocks = [r.integers(0, 30, 40).astype(np.uint32) for _ in range(520)]
    data = token_codec.encode_blocks(blocks, 40)
    assert all((x == y).all() for x, y in zip(token_codec.decode_blocks(data, [40] * 520, 40), blocks, strict=True))
    assert data[3] == token_codec.encode_blocks(blocks[3:4], 40)[0]

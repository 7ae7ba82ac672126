import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vigil.llm import packing
from vigil.llm.queries import word_tokenizer


def naive_first_fit(lengths, capacity):
    bins, out = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        for b, used in enumerate(bins):
            if used + lengths[i] <= capacity:
                break
        else:
            bins.append(0)
            b = len(bins) - 1
        out[i] = (b, bins[b])
        bins[b] += lengths[i]
    return out


def test_tournament_tree_is_first_fit():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 17, 500):
        lengths = [rng.choice((1, 4096, rng.randint(1, 4096), rng.randint(1, 300))) for _ in range(n)]
        assert packing.first_fit_decreasing(lengths, 4096) == naive_first_fit(lengths, 4096)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(word_tokenizer())


def test_words_give_the_ids_of_whole_texts(tokenizer):
    texts = ["", " ", "It's we're I'D don't  a b ́x é Iİ ẞ ΣΣ", "<|endoftext|>x a<|startoftext|>",
             "\x1c q\x85r 日本語 １２３ 12ab \t\n x​y 🎉🎉", "\ńabc ̈́ ", "a" * 3000,
             "w***\r\n$$$ e.g. x=1;y=2", "<|ENDOFTEXT|> A.", "İ İ. É É, K. x.y. a.., 'S. it's. z's,",
             "don't! 'Tis. ABC?! é. 1. 1a. a1, ...", "m'." + "b," * 40 + " " + "q." * 3]
    enc = packing.WordEncoder(word_tokenizer())
    for _ in range(2):  # with and without the words known
        ids, counts = enc.ids(pa.array(texts))
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(len(w) <= packing.CACHE_CHARS for w in enc.words.to_pylist())


def test_cache_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    enc = packing.WordEncoder(word_tokenizer())
    for text in ("a b c d", "c d e f g", "one two three four five six seven eight", "a b"):
        got = enc.ids(pa.array([text]))[0].tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_and_sequences(docs_of, odd_rows, tokenizer):
    rows = odd_rows + [(100 + i, "word " * (i * 37 % 900), "en", "a") for i in range(120)]
    out = packing.pack_documents(docs_of(rows), word_tokenizer(), capacity=512, group_pieces=64,
                                 keep_ids=True).collect()
    want = sorted((i or -1, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,))
                  for i, t, *_ in rows)
    whole, docs = {}, []
    for p in sorted(out, key=lambda p: (p.doc_id or -1, p.start, p.sequence_id, p.offset)):
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert len(ids) == p.length and p.ids_crc32 == zlib.crc32(bytes(p.ids))
        assert p.length == 512 or p.start + p.length == p.doc_tokens
        docs.append((p.doc_id or -1, p.start, tuple(ids.tolist())))
        whole.setdefault(p.sequence_id, []).append(p)
    pieces = sorted((i, k, ids[k:k + 512]) for i, ids in want for k in range(0, len(ids), 512))
    assert sorted(docs) == pieces
    padding = 0
    for ps in whole.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 512
        padding += 512 - at
    assert padding <= 0.1 * sum(p.length for p in out)


def test_empty(docs_of):
    assert packing.pack_documents(docs_of([]), word_tokenizer()).count() == 0

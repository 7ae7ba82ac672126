"""The registered queries over whole test tables, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from tests.llm import test_quality, test_secrets, test_simhash
from vigil.llm import html_blocks
from vigil.llm.queries import QUERIES, word_tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_op1(spark, documents):
    known = {"Licensed under CC BY-NC 4.0.": "cc_by_nc",
             "This work is licensed under the GNU General Public License, version 3.": "gpl",
             "Licensed under the Apache License, Version 2.0.": "apache",
             "Released under the MIT License.": "mit", "All rights reserved.": "all_rights"}
    texts = {d.doc_id: d.text or "" for d in documents}
    got = rows(spark, "op1_license_scan")
    assert len(got) == len(documents)
    for r in got:
        lines = texts[r.doc_id].split("\n")
        assert r.families == ",".join(sorted({f for t, f in known.items() if t in lines}))


def test_op4(spark, documents):
    texts = {d.doc_id: d.text for d in documents}
    got = rows(spark, "op4_quality_divergence")
    assert len(got) == len(documents)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                r.n_repeat_words) == test_quality.brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    judged = [r for r in got if r.doc_id in good and not r.base_failed]
    assert all(r.kept for r in judged)


def test_op5(spark, documents):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    other = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    by = {}
    for r in rows(spark, "op5_token_attribution"):
        by.setdefault(r.doc_id, []).append(r)
    assert len(by) == len(documents)
    for d in documents:
        parts = sorted(by[d.doc_id], key=lambda r: r.section_no)
        ids = other.encode(d.text or "", add_special_tokens=False)
        counts = np.zeros(len(parts), int)
        starts = [p.start for p in parts]
        for a, _ in ids.offsets:
            counts[np.searchsorted(starts, a, side="right") - 1] += 1
        assert [p.n_tokens for p in parts] == counts.tolist()
        assert parts[0].doc_tokens == len(ids.ids)


def test_op6(spark, documents):
    texts = {d.doc_id: d.text for d in documents}
    got = rows(spark, "op6_secret_randomness")
    assert len(got) == len(documents)
    for r in got:
        want = test_secrets.brute(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in want) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(test_secrets.listed(want).encode()).hexdigest()
        assert set(filter(None, test_secrets.listed(want).split(","))) <= set(r.spans.split(","))


def test_op7(spark, documents):
    fps = [test_simhash.brute_fingerprint(d.text) for d in documents]
    roots = test_simhash.brute_groups(fps)
    want = [(d.doc_id, f"{f:016x}", documents[r].doc_id) for d, f, r in zip(documents, fps, roots)]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows(spark, "op7_simhash_neardup"))
    assert got == want


def test_op9(spark, documents):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(word_tokenizer())
    by, sequences = {}, {}
    for r in rows(spark, "op9_packing"):
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert len(by) == len(documents)
    for d in documents:
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(by[d.doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start:at].tobytes())
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding <= 0.03 * sum(p.length for ps in by.values() for p in ps)


def test_op10(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = rows(spark, "op10_block_labeller")
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        want = " ".join(b.text for b in html_blocks.blocks_of(f"<article>{inner}</article>"))
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))

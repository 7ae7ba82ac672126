import random

import numpy as np
import public_tokenizers as P
import pytest

from vigil.llm import token_attribution as A

RANKS = P.path("byte_bpe_50k.tiktoken")


def brute(ends, starts, stops, rule):
    out, at = [0.0] * len(starts), 0
    for end in ends:
        share = [max(0, min(end, b) - max(at, a)) for a, b in zip(starts, stops)]
        hit = [i for i, s in enumerate(share) if s > 0]
        if rule == "share":
            for i in hit:
                out[i] += share[i] / (end - at)
        elif hit:
            out[hit[0] if rule == "first" else max(hit, key=lambda i: (share[i], -i))] += 1
        at = end
    return out


@pytest.mark.parametrize("rule", A.RULES)
def test_interval_join(rule):
    rng = random.Random(3)
    for _ in range(200):
        ends = np.cumsum([rng.randint(1, 9) for _ in range(rng.randint(0, 30))]).astype(np.int64)
        cuts = sorted(rng.sample(range(150), 2 * rng.randint(1, 8)))
        starts, stops = np.array(cuts[::2]), np.array(cuts[1::2])
        got = A.counts_by_section(ends, starts, stops, rule)
        assert got.tolist() == pytest.approx(brute(ends.tolist(), starts, stops, rule)), (ends, cuts)


def test_lines_match_the_offsets_of_another_library(docs_of):
    from tokenizers import Tokenizer
    other = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    text = "Title é 漢字🎉\n\nA line, with words.\n  more 12345\n<|endoftext|>\nlast"
    got = A.attribute_tokens(docs_of([(1, text, "", "")]), RANKS, P.PATTERN, "first").collect()
    parts = A.lines(text)
    want = [0] * len(parts)
    for a, _ in other.encode(text, add_special_tokens=False).offsets:
        want[next(i for i, (_, s, e) in enumerate(parts) if s <= a < e)] += 1
    assert [r.n_tokens for r in sorted(got, key=lambda r: r.section_no)] == want
    assert "".join(text[s:e] for _, s, e in parts) == text


def test_own_sections(docs_of):
    text = "aaaa bbbb cccc"
    cut = lambda t: [("x", 0, 6), ("y", 6, 9)]
    for rule in A.RULES:
        got = A.attribute_tokens(docs_of([(1, text, "", "")]), RANKS, P.PATTERN, rule, cut).collect()
        assert [r.section for r in sorted(got, key=lambda r: r.section_no)] == ["x", "y"]
    with pytest.raises(ValueError):
        A.attribute_tokens(docs_of([]), RANKS, P.PATTERN, "best")


def test_odd_rows(docs_of, odd_rows):
    got = A.attribute_tokens(docs_of(odd_rows), RANKS, P.PATTERN).toPandas()
    assert got.groupby("doc_id", dropna=False).size().sum() == sum(
        len((r[1] or "").split("\n")) for r in odd_rows)
    assert got[got.doc_id.isin((1, 2))].n_tokens.tolist() == [0.0, 0.0]
    whole = got.groupby(["doc_id", "doc_tokens"]).n_tokens.sum().reset_index()
    five = whole[whole.doc_id == 5].iloc[0]
    assert five.n_tokens == 2 * five.doc_tokens  # the row is there twice
    assert (whole[whole.doc_id != 5].n_tokens == whole[whole.doc_id != 5].doc_tokens).all()
    assert A.attribute_tokens(docs_of([]), RANKS, P.PATTERN).count() == 0

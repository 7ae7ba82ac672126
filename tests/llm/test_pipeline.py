"""The stages of the pipeline, each against brute force on its own input."""

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tests.llm import test_mixing, test_quality, test_secrets, test_simhash
from vigil.llm.common import stored, table
from vigil.llm.queries import word_tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in P.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def test_names_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_neardup", "secret_scan",
                                        "mix_sources", "pack"]
    assert all(d.dtypes == steps[0].dtypes for d in steps[:-1])
    assert P.ORACLE_SQL is None and "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()


def test_quality_rules(steps):
    before, after = (sorted(map(tuple, d.collect())) for d in steps[:2])
    assert set(after) <= set(before)
    kept = {r[0] for r in after}
    for doc_id, text, *_ in before:
        n, _, _, _, again = test_quality.brute(text)
        assert not (doc_id in kept and (n < 20 or 100 * again > 30 * n))
    assert len(kept) > 0.7 * len(before)


def test_near_duplicates(steps):
    before, after = (sorted(map(tuple, d.collect())) for d in steps[1:3])
    roots = test_simhash.brute_groups([test_simhash.brute_fingerprint(r[1]) for r in before])
    assert after == [before[i] for i in sorted(set(roots))]


def test_secret_scan(steps):
    before, after = ({r.doc_id: r for r in d.collect()} for d in steps[2:4])
    assert before.keys() == after.keys()
    for i, r in before.items():
        spans = test_secrets.brute(r.text)
        if not spans:
            continue
        assert not test_secrets.brute(after[i].text) or "[SECRET]" in after[i].text
        assert all(r.text[a:b] not in after[i].text for a, _, _, b in spans)
        assert after[i].n_chars == len(after[i].text)


def test_mix_sources(steps):
    before, after = (d.collect() for d in steps[3:5])
    sizes, texts, taken = {}, {}, {}
    for r in before:
        texts[r.doc_id] = r.text
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    for r in after:
        assert texts[r.doc_id].startswith(r.text)
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    for source, target in test_mixing.brute_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 1.001


def test_pack(steps):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(word_tokenizer())
    docs, pieces = steps[4].collect(), steps[5].collect()
    want = sorted((r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1)
                  for r in docs)
    assert sorted((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == want
    assert sum(p.length for p in pieces) == sum(n for _, n in want)
    used = {}
    for p in pieces:
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in used.values():
        starts = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == starts[:-1].tolist() and starts[-1] <= 4096


def test_run_is_the_chain(spark, steps):
    got = P.run(spark, SF)
    assert got.columns == steps[-1].columns
    key = ["doc_id", "start", "length", "ids_crc32"]
    a, b = (sorted(map(tuple, d.select(*key).collect())) for d in (got, steps[-1]))
    assert a == b


CLASHES = ("m_size", "m_row", "m_taken", "scan_some", "scan_new", "scan_row", "judged_text",
           "judged_lang", "judged_row", "a.b", "row", "d", "take", "part", "bucket", "fine",
           "Source_Size", "some", "pick", "no_id", "dedup_row", "ids", "body")


def odd_frame(docs_of, rows):
    from pyspark.sql import functions as F
    df = docs_of(rows).select("doc_id", "text", "lang", "source", "n_chars")
    return df.select("*", *[F.lit(c).alias(c) for c in CLASHES])


def test_every_stage_bears_odd_rows_and_names(spark, docs_of, odd_rows):
    prose = "the quick brown fox jumps over the lazy dog and runs to the old house near the river "
    df = odd_frame(docs_of, odd_rows + [(100 + i, prose + f"word{i} more words for {i} here password = abcdefgh{i}12", "en",
                                         None) for i in range(30)])
    for name, stage in P.STAGES:
        out = stored(stage(spark, df, SF), f"odd-{name}")
        if name == "pack":
            assert out.agg({"doc_tokens": "count"}).first()[0] >= df.count()
            break
        assert out.dtypes == df.dtypes, name
        assert out.count() > 0
        for c in ("a.b", "m_size", "judged_text", "scan_some"):
            assert {r[0] for r in out.select(f"`{c}`").distinct().collect()} == {c}
        if name == "secret_scan":
            assert out.filter("text like '%abcdefgh%'").count() == 0


def test_every_stage_bears_an_empty_table(spark, docs_of):
    df = odd_frame(docs_of, [])
    for name, stage in P.STAGES:
        assert stage(spark, df, SF).count() == 0, name

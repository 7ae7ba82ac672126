import random
import re
from collections import defaultdict

from vigil.llm import quality


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i:i + 8])].append(i)
    covered = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_base_counts(docs_of, odd_rows):
    rows = odd_rows + [
        (20, "a " * 50, "en", "a"), (21, "a b c d e f g h " * 3, "en", "a"),
        (22, "x\nx\n \n \nx y\nx y", "en", "a"), (23, "# $ %\n* a|b <p>&amp;", "en", "a"),
        (24, "one two three four five six seven eight nine one two three four five six seven eight",
         "en", "a"), (25, " ".join(f"u{i}" for i in range(100)), "en", "a")]
    got = quality.base_counts(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        mine = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert mine == brute(r.text), r.doc_id
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert sum(r.char_hist) == len(r.text or "")


def test_word_histogram(docs_of):
    got = quality.base_counts(docs_of([(1, "The the of x THE und der, der", "en", "a")])).first()
    assert {e.word: e.n for e in got.word_hist} == {"the": 2, "of": 1, "und": 1, "der": 1}


def test_divergence_is_jensen_shannon(spark):
    from math import log2
    p, q = [3, 0, 1], [1, 1, 2]
    sql = quality.char_divergence("a", "b")
    got = spark.createDataFrame([(p, q)], "a array<bigint>, b array<bigint>").selectExpr(sql).first()[0]
    ps, qs = [x / 4 for x in p], [x / 4 for x in q]
    kl = lambda a, b: sum(x * log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    assert abs(got - (kl(ps, qs) + kl(qs, ps)) / 2) < 1e-12
    sql = quality.word_divergence("h", "n", "r", "m")
    got = spark.sql(f"SELECT {sql} AS d FROM (SELECT array(struct('a' AS word, 3L AS n)) AS h, 4L AS n, "
                    "map('a', 1L, 'b', 1L) AS r, 4L AS m)").first().d
    ps, qs = [0.75, 0, 0.25], [0.25, 0.25, 0.5]
    assert abs(got - (kl(ps, qs) + kl(qs, ps)) / 2) < 1e-12


def clean(i, n=300):
    frame = ("the old house of the town was in a valley and it is said that the river "
             "from there goes to the sea with many small boats on it").split()
    rng = random.Random(i)
    return " ".join(rng.choice(frame) for _ in range(n))


def test_verdicts(docs_of):
    rows = [(i, clean(i), "en", "a") for i in range(60)]
    rows += [(100, " ".join(f"w{k}***$$$" for k in range(300)), "en", "a"),
             (101, " | ".join(f"menu{k} item{k}" for k in range(200)), "en", "a"),
             (102, "", "en", "a"), (103, None, None, "a")]
    got = {r.doc_id: r for r in quality.quality_rules(docs_of(rows), min_reference=500).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(60))
    assert not any(got[i].kept for i in (100, 101, 102, 103))
    assert not got[100].base_failed and not got[101].base_failed


def test_odd_rows_and_empty(docs_of, odd_rows):
    df = docs_of(odd_rows)
    out = quality.quality_rules(df)
    assert out.count() == len(odd_rows)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    empty = docs_of([])
    assert quality.quality_rules(empty).count() == 0
    assert quality.keep_good(empty).count() == 0


def french(i, n=200):
    frame = ("la vieille maison de la ville est dans une vallée et le fleuve qui passe par là "
             "va à la mer avec des bateaux très légers sur les eaux").split()
    rng = random.Random(i)
    return " ".join(rng.choice(frame) for _ in range(n))


def test_rare_language_is_not_held_against_others(docs_of):
    rows = [(i, clean(i), "en", "a") for i in range(60)]
    rows += [(100 + i, french(i), "fr", "a") for i in range(4)]
    rows += [(200, french(9), None, "a")]
    got = {r.doc_id: r for r in quality.quality_rules(docs_of(rows)).collect()}
    assert all(r.kept for r in got.values())
    assert got[200].word_distance == 0


def test_verdict_is_steady_in_the_reference_size(docs_of):
    """No verdict turns where the words of the language pass min_reference."""
    rows = [(i, clean(i), "en", "a") for i in range(20)]
    rows += [(100, " | ".join(f"menu{k} item{k}" for k in range(200)), "en", "a")]
    counts = quality.base_counts(docs_of(rows))
    total = sum(r.n_words for r in counts.select("n_words").collect())
    kept = [{r.doc_id: r.kept for r in quality.quality_rules(docs_of(rows), min_reference=m).collect()}
            for m in (total - 1, total, total + 1, 50 * total)]
    assert kept[0] == kept[1] == kept[2] and not kept[0][100]
    assert all(kept[3].values())


def test_short_texts_are_judged_by_words(docs_of):
    rows = [(i, clean(i, 20 + 2 * i), "en", "a") for i in range(70)]
    rows += [(100 + k, " | ".join(f"menu{j} item{j}" for j in range(k)), "en", "a")
             for k in (25, 30, 40, 49)]
    got = {r.doc_id: r for r in quality.quality_rules(docs_of(rows), min_reference=500).collect()}
    assert all(got[i].kept for i in range(70))
    assert all(got[100 + k].n_words < 150 and not got[100 + k].base_failed for k in (25, 30, 40, 49))
    assert not any(got[100 + k].kept for k in (25, 30, 40, 49))

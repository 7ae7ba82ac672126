"""Quality rules: divergence from the language of a document.

Every text gives two histograms: its character classes, and the words of a
fixed list of common words (all other words are one class).  The references
of a language are the same histograms summed over all its documents that pass
the base rules.  A document is rejected if the Jensen-Shannon distance (base
2) to the reference of its language exceeds a limit.  A histogram of ``n``
items over ``b`` classes lies about ``(b - 1) / (8 n ln 2)`` from its own
source by chance; this is taken off the divergence first.  The words of all
texts of ``LEAST_WORDS`` are judged: below ``min_words`` the limit on their
divergence grows by as much as its standard error, ``sqrt(2 (b - 1)) / (8 n ln
2)``, is above that of ``min_words``.  Characters are judged from ``min_chars``.

All expressions are Spark SQL functions on one row; only the small histograms
meet in a shuffle, one row per language and class.

A document is judged by its own language only.  The divergence of a reference
from its source by chance goes with one over its words, so below
``min_reference`` words the limit on the divergence grows in that proportion:
it is the plain one at ``min_reference``, and nothing exceeds it where the
reference is very small.

Defined cases: a null, empty or blank text has no words, fails the base rules
and is not kept; a null language is a language of its own; repeated rows are
judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import (SALTS, column, new_name, salted, stored, symbols_in,
                              text_or_empty, words_of)

#: Common words of four languages.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "with", "as",
    "be", "at", "this", "from", "by", "an",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im",
    "dem", "nicht", "ein", "eine", "als", "auch", "es",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui",
    "dans", "par", "plus", "pas", "au", "sur",
    "el", "que", "y", "los", "se", "del", "las", "por", "con", "no", "una", "su", "para", "al",
    "lo", "como", "más", "o", "pero", "sus",
)

#: Character classes that are counted by a pattern.  The histogram goes on with
#: symbols, white space and all other characters (mostly lower-case letters).
CLASSES = (r"[A-Z]", r"[0-9]", r"[.,;:!?'\"()\-]", r"[^\x00-\x7F]")
N_CLASSES = len(CLASSES) + 3

#: Shorter texts fail the base rules.
LEAST_WORDS = 20


def class_counts(text: Column, word_chars: Column, n_symbols: Column) -> Column:
    """array<long>: characters by class."""
    found = [(F.length(text) - F.length(F.regexp_replace(text, f"{c}+", ""))).cast("long")
             for c in CLASSES]
    rest = word_chars - n_symbols
    for c in found:
        rest = rest - c
    return F.array(*found, n_symbols, F.length(text).cast("long") - word_chars, rest)


def repeated_words(words: str, window: int = 8) -> str:
    """SQL for the words that lie in windows of ``window`` words found twice
    or more in the array column ``words``.

    Windows are compared by a 64-bit hash, built by doubling: a hash of two
    words from two hashes of one, and so on (``window`` is a power of two).
    Only texts whose hashes repeat are sorted: equal hashes become neighbours,
    their places are put in order, and each covers up to the next place or its
    own end."""
    hashes = f"transform({words}, x -> xxhash64(x))"
    k = 1
    while k < window:
        hashes = (f"get(transform(array({hashes}), h -> transform(slice(h, 1, size(h) - {k}), "
                  f"(x, i) -> xxhash64(x, get(h, i + {k})))), 0)")
        k *= 2
    hashes = (f"CASE WHEN size({words}) >= {window} THEN {hashes} "
              f"ELSE cast(array() AS array<bigint>) END")
    # one-element arrays bind a value to a name, so that it is worked out once
    places = ("sort_array(transform(filter(transform(s, (e, i) -> struct(e.p AS p, "
              "(i > 0 AND get(s, i - 1).h = e.h) OR (get(s, i + 1).h <=> e.h) AS d)), e -> e.d), "
              "e -> e.p))")
    covered = (f"aggregate(transform(q, (p, i) -> least({window}, coalesce(get(q, i + 1) - p, "
               f"{window}))), 0L, (a, x) -> a + x)")
    return (f"get(transform(array({hashes}), h -> CASE WHEN size(array_distinct(h)) = size(h) "
            f"THEN 0L ELSE get(transform(array(sort_array(transform(h, (x, i) -> "
            f"struct(x AS h, i AS p)))), s -> get(transform(array({places}), q -> {covered}), 0)), "
            f"0) END), 0)")


def word_histogram(words: str, common: tuple[str, ...] = COMMON_WORDS) -> str:
    """SQL for array<struct<word, n>>: the common words in ``words``."""
    listed = ", ".join(sorted({f"'{x}'" for w in common for x in (w, w.capitalize())}))
    found = f"sort_array(transform(filter({words}, w -> w IN ({listed})), w -> lower(w)))"
    starts = "filter(sequence(0, size(s) - 1), i -> i = 0 OR get(s, i) != get(s, i - 1))"
    runs = ("transform(b, (i, k) -> struct(get(s, i) AS word, "
            "cast(coalesce(get(b, k + 1), size(s)) - i AS bigint) AS n))")
    none = "cast(array() AS array<struct<word: string, n: bigint>>)"
    return (f"get(transform(array({found}), s -> CASE WHEN size(s) = 0 THEN {none} ELSE "
            f"get(transform(array({starts}), b -> {runs}), 0) END), 0)")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, and the histograms ``char_hist`` and
    ``word_hist``.  Columns of those names in the input are replaced."""
    words = new_name(docs, "words")
    t = text_or_empty(F.col(text))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line_arr = new_name(docs, "lines")
    got = docs.withColumns({words: words_of(F.col(text)), line_arr: lines})
    word_chars = F.length(F.array_join(words, "")).cast("long")
    n_symbols = symbols_in(F.col(text)).cast("long")
    got = got.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": (F.size(line_arr) - F.size(F.array_distinct(line_arr))).cast("long"),
        "n_repeat_words": F.expr(repeated_words(f"`{words}`")),
        "char_hist": class_counts(t, word_chars, n_symbols),
        "word_hist": F.expr(word_histogram(f"`{words}`")),
    }).drop(words, line_arr)
    return got.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                          | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))


def _term(p: str, q: str) -> str:
    """Share of one class in the divergence, where p > 0."""
    return (f"0.5D * ({p} * log2(2D * {p} / ({p} + {q})) + CASE WHEN {q} > 0 THEN "
            f"{q} * log2(2D * {q} / ({p} + {q})) ELSE 0D END)")


def char_divergence(hist: str, ref: str) -> str:
    """SQL: Jensen-Shannon divergence of two count arrays."""
    total = f"cast(aggregate({hist}, 0L, (a, x) -> a + x) AS double)"
    ref_total = f"cast(aggregate({ref}, 0L, (a, x) -> a + x) AS double)"
    term = _term("z.p", "z.q")
    return (f"aggregate(transform({hist}, (c, i) -> struct(c / {total} AS p, "
            f"get({ref}, i) / {ref_total} AS q)), 0D, (a, z) -> a + "
            f"CASE WHEN z.p > 0 THEN {term} ELSE 0.5D * z.q END)")


def word_divergence(hist: str, n: str, ref: str, ref_n: str) -> str:
    """SQL: divergence over the common words and the class of other words.
    Classes that the text lacks count half their reference share each."""
    shares = (f"transform({hist}, e -> struct(e.n / cast({n} AS double) AS p, "
              f"coalesce({ref}[e.word], 0L) / cast({ref_n} AS double) AS q))")
    other_p = f"(1D - aggregate({hist}, 0L, (a, e) -> a + e.n) / cast({n} AS double))"
    other_q = (f"(1D - aggregate(map_values({ref}), 0L, (a, x) -> a + x) / "
               f"cast({ref_n} AS double))")
    every = f"array_append({shares}, struct({other_p} AS p, {other_q} AS q))"
    term = _term("z.p", "z.q")
    return (f"get(transform(array({every}), s -> aggregate(s, 0D, (a, z) -> a + "
            f"CASE WHEN z.p > 0 THEN {term} ELSE 0.5D * z.q END) + "
            f"0.5D * greatest(0D, 1D - aggregate(s, 0D, (a, z) -> a + z.q))), 0)")


def language_references(counts: DataFrame, lang: str = "lang") -> DataFrame:
    """One row per language with reference text: ref_lang, ref_chars, ref_words,
    ref_n.  ``counts`` has the histograms of documents that may serve as
    reference."""
    good = counts.filter(~F.col("base_failed"))
    chars = good.groupBy(F.col(lang).alias("ref_lang")).agg(
        F.array(*[F.sum(F.get("char_hist", F.lit(i))) for i in range(N_CLASSES)]).alias("ref_chars"),
        F.sum("n_words").alias("ref_n"))
    words = (good.select(F.col(lang).alias("w_lang"), F.explode("word_hist").alias("e"))
             .groupBy("w_lang", "e.word").agg(F.sum("e.n").alias("n"))
             .groupBy("w_lang").agg(F.map_from_entries(F.collect_list(F.struct("word", "n")))
                                    .alias("ref_words")))
    return stored(chars.join(words, F.col("ref_lang").eqNullSafe(F.col("w_lang")), "left").select(
        "ref_lang", "ref_chars", F.coalesce("ref_words", F.expr(
            "cast(map() AS map<string, bigint>)")).alias("ref_words"), "ref_n"), "quality-refs")


def judge(counts: DataFrame, references: DataFrame, lang: str = "lang",
          char_limit: float = 0.3, word_limit: float = 0.25,
          min_chars: int = 250, min_words: int = 150, min_reference: int = 5000) -> DataFrame:
    """``counts`` with char_distance, word_distance (null: not judged) and
    ``kept``.  The references are one row per language; documents of a common
    language spread over salts."""
    salt = new_name(counts, "salt")
    refs = salted(references, "ref_salt")
    rows = counts.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    rows = rows.join(refs, F.col(lang).eqNullSafe(F.col("ref_lang"))
                     & (F.col(salt) == F.col("ref_salt")), "left")
    n_chars = "aggregate(char_hist, 0L, (a, x) -> a + x)"
    chance = lambda b, n: f"({b - 1} / (8D * ln(2D) * {n}))"
    distance = lambda d, b, n: f"sqrt(greatest(0D, {d} - {chance(b, n)}))"
    char_d = distance(char_divergence("char_hist", "ref_chars"), N_CLASSES, n_chars)
    word_d = distance(word_divergence("word_hist", "n_words", "ref_words", "ref_n"), 20, "n_words")
    rows = rows.withColumns({
        "char_distance": F.expr(f"CASE WHEN {n_chars} >= {min_chars} AND ref_n > 0 THEN {char_d} END"),
        "word_distance": F.expr(f"CASE WHEN n_words >= {LEAST_WORDS} AND ref_n > 0 THEN {word_d} END")})
    wider = f"greatest(1D, {min_reference} / cast(ref_n AS double))"
    error = lambda n: f"sqrt(38D) / (8D * ln(2D) * {n})"
    shorter = f"greatest(0D, {error('n_words')} - {error(min_words)})"
    over = lambda d, limit, more: F.coalesce(F.expr(
        f"{d}_distance > sqrt(power({limit}D, 2) * {wider} + {more})"), F.lit(False))
    odd = over("char", char_limit, "0D") | over("word", word_limit, shorter)
    return (rows.withColumn("kept", ~F.col("base_failed") & ~odd)
            .drop(salt, "ref_lang", "ref_salt", "ref_chars", "ref_words", "ref_n"))


def quality_rules(docs: DataFrame, lang: str = "lang", text: str = "text", carry: tuple = ("doc_id",),
                  min_reference: int = 5000, **limits) -> DataFrame:
    """The judged documents: the columns of ``carry``, the base counts, the
    distances and ``kept``.  The counts are written once; texts are read once."""
    keep = [F.col(c) for c in carry]
    lang_col = F.col(lang).alias("judged_lang")
    counts = base_counts(docs.select(*keep, lang_col, F.col(text).alias("judged_text")),
                         "judged_text").drop("judged_text")
    counts = stored(counts, "quality")
    refs = language_references(counts, "judged_lang")
    return judge(counts, refs, "judged_lang", min_reference=min_reference, **limits).drop(
        "char_hist", "word_hist", "judged_lang")


def keep_good(docs: DataFrame, lang: str = "lang", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns unchanged.

    The rows are carried through the written counts, so that no join by id is
    needed and repeated or null ids do no harm."""
    rows = docs.select(F.struct(*[column(c).alias(c) for c in docs.columns]).alias("row"),
                       column(lang).alias("lang"), column(text).alias("text"))
    got = quality_rules(rows, "lang", "text", ("row",), **options)
    return got.filter("kept").select("row.*")

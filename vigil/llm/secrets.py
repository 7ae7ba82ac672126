"""Secret scans: patterns, and a battery of randomness tests on long tokens.

Patterns find assignments, access keys and long hex runs.  Beside them, runs
of at least ``MIN_TOKEN`` letters, digits and ``+/_-`` are tested for randomness:
the encoding is inferred from the characters (hex, base 32, base 36, base 64),
and three tests ask whether the token could be uniform over its alphabet:
chi-squared of the character counts (by the cube-root approximation), the
number of runs above and below the middle of the alphabet, and the
correlation of neighbours.  Their p-values are combined by Fisher's rule.

Short tokens pass such tests whatever they are, so passing is not enough.  For
each length the corpus itself tells how often plain words (letters only) pass
at a level, and with that, for each encoding and length, how many of the
passing tokens are expected to be no secrets: tokens that fail are taken as
plain, and the passing share of words turns them into false discoveries.  The
lowest level at which their share stays below ``fdr`` is used; where no level
does, no token of that encoding and length is reported.

Only Spark SQL functions are used.  The table of counts that meets on the
driver has at most one row per encoding, length class and level.

Defined cases: a null text is empty and has no spans; texts without any
candidate give an empty string and the digest of the empty string; repeated
rows are scanned alike; digits alone and words joined by signs are no
secrets; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import column, stored, text_or_empty

#: Patterns of the base kinds, in the order of the report.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a shorter run holds no longer one
HEX = r"[0-9a-f]{32,}"
MIN_ASSIGN = 8

MIN_TOKEN = 16
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN

#: Inferred encodings: pattern and alphabet.  ``word`` is the plain population;
#: words or numbers joined by signs, as in paths and names, are never reported.
ENCODINGS = (
    ("number", r"^[0-9]+$", "0123456789"),
    ("word", r"^([A-Z]?[a-z]+|[A-Z]+)$", "abcdefghijklmnopqrstuvwxyz"),
    ("joined", r"^([A-Z]?[a-z]+|[A-Z]+|[0-9]+)([-_/+]([A-Z]?[a-z]+|[A-Z]+|[0-9]+))+$", "-_/+"),
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef"),
    ("hex_upper", r"^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)

#: Levels at which a token may pass, and upper ends of the length classes.
LEVELS = (0.01, 0.02, 0.05, 0.1, 0.2)
LENGTHS = (17, 19, 21, 24, 28, 32, 40, 48, 64, 128)


def _let(name: str, value: str, body: str) -> str:
    """SQL that binds a value to a name, so that it is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _sums_before(lengths: str, chunk: int = 256) -> str:
    """SQL: for each element of an int array the sum of those before it.  Sums
    are put together in chunks, as appending copies what is there."""
    inner = (f"aggregate(slice({lengths}, k + 1, {chunk}), struct(a.pos AS pos, "
             "cast(array() AS array<int>) AS out), (b, x) -> struct(b.pos + x AS pos, "
             "array_append(b.out, b.pos) AS out))")
    step = _let("r", inner, "struct(r.pos AS pos, concat(a.out, r.out) AS out)")
    return (f"CASE WHEN size({lengths}) = 0 THEN cast(array() AS array<int>) ELSE "
            f"aggregate(sequence(0, size({lengths}) - 1, {chunk}), struct(0 AS pos, "
            f"cast(array() AS array<int>) AS out), (a, k) -> {step}, a -> a.out) END")


def _found(text: str, pattern: str, group: int = 0) -> str:
    """SQL: array<struct<start, stop, body>> of the leftmost non-overlapping
    matches; places from the lengths of the pieces between them."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    none = "cast(array() AS array<struct<start: int, stop: int, body: string>>)"
    lengths = ("transform(m, (x, i) -> length(get(s, i)) + length(x))")
    spans = ("transform(m, (x, i) -> struct(get(o, i) + length(get(s, i)) AS start, "
             "get(o, i) + length(get(s, i)) + length(x) AS stop, get(g, i) AS body))")
    body = _let("n", lengths, _let("o", _sums_before("n"), spans))
    bodies = "m" if group == 0 else f"regexp_extract_all({text}, '{quoted}', {group})"
    body = _let("s", f"split({text}, '{quoted}', -1)", _let("g", bodies, body))
    return _let("m", f"regexp_extract_all({text}, '{quoted}', 0)",
                f"CASE WHEN size(m) = 0 THEN {none} ELSE {body} END")


def _tail(z: str) -> str:
    """SQL: upper tail of the normal law, floored at 1e-7 (error below 2e-7)."""
    y = f"abs({z}) / sqrt(2D)"
    t = _let("t", f"1D / (1D + 0.3275911D * {y})", (
        "t * (0.254829592D + t * (-0.284496736D + t * (1.421413741D + t * (-1.453152027D + "
        f"t * 1.061405429D)))) * exp(-({y}) * ({y})) / 2D"))
    return f"greatest(1e-7D, CASE WHEN {z} >= 0 THEN {t} ELSE 1D - {t} END)"


def encoding_of(token: str) -> str:
    """SQL: name of the inferred encoding."""
    cases = " ".join(f"WHEN {token} RLIKE '{p}' THEN '{n}'" for n, p, _ in ENCODINGS if p)
    return f"CASE {cases} ELSE '{ENCODINGS[-1][0]}' END"


def randomness(token: str, encoding: str) -> str:
    """SQL: p-value of the battery for the hypothesis that a token (without
    padding) is uniform over the alphabet of its encoding."""
    alphabet = " ".join(f"WHEN '{n}' THEN '{a}'" for n, _, a in ENCODINGS)
    text = (f"CASE {encoding} WHEN 'word' THEN lower({token}) WHEN 'base64' THEN "
            f"translate({token}, '-_', '+/') ELSE {token} END")
    chars = f"transform(filter(split({text}, ''), c -> c != ''), c -> locate(c, al))"
    square = "aggregate(array_distinct(x), 0D, (a, d) -> a + power(size(filter(x, y -> y = d)), 2))"
    chi = f"(k / n * {square} - n) / (k - 1D)"
    z_chi = (f"(power(greatest(0D, {chi}), 1D / 3D) - (1D - 2D / (9D * (k - 1D)))) / "
             "sqrt(2D / (9D * (k - 1D)))")
    high = "cast(size(filter(x, v -> v > k / 2D)) AS double)"
    runs = "1D + size(filter(x, (v, i) -> i > 0 AND (v > k / 2D) != (get(x, i - 1) > k / 2D)))"
    mu = "1D + 2D * h * (n - h) / n"
    z_runs = _let("h", high, _let("u", mu, (
        f"CASE WHEN u <= 2D OR n < 3D THEN -6D ELSE ({runs} - u) / sqrt((u - 1D) * (u - 2D) / "
        "(n - 1D)) END")))
    mean = "aggregate(x, 0D, (a, v) -> a + v) / n"
    spread = "aggregate(x, 0D, (a, v) -> a + (v - e) * (v - e))"
    pairs = ("aggregate(transform(slice(x, 1, size(x) - 1), (v, i) -> (v - e) * "
             "(get(x, i + 1) - e)), 0D, (a, v) -> a + v)")
    z_serial = _let("e", mean, _let("w", spread, (
        f"CASE WHEN w = 0D THEN 6D ELSE ({pairs} / w + 1D / n) * sqrt(n) END")))
    z = (f"struct({z_chi} AS chi, {z_runs} AS runs, {z_serial} AS serial)")
    p = (f"ln({_tail('z.chi')}) + ln(least(1D, 2D * {_tail('abs(z.runs)')})) + "
         f"ln(least(1D, 2D * {_tail('abs(z.serial)')}))")
    fisher = _let("f", f"-({p})", "exp(-f) * (1D + f + f * f / 2D)")
    body = _let("z", z, fisher)
    body = _let("n", "cast(size(x) AS double)", body)
    body = _let("x", chars, body)
    body = _let("k", "cast(length(al) AS double)", body)
    return _let("al", f"CASE {encoding} {alphabet} END", body)


def scan(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the arrays assign, access, hex (struct<start, stop, ..>) and
    tokens (struct<start, stop, enc, len, p>), written once."""
    body = "scan_body"
    got = docs.select(*keep, text_or_empty(F.col(text)).alias(body)).withColumns({
        "assign": F.filter(F.expr(_found(body, ASSIGN, 2)),
                           lambda x: F.length(x["body"]) >= MIN_ASSIGN),
        "access": F.expr(_found(body, ACCESS)),
        "hex": F.expr(_found(body, HEX)),
        "tokens": F.expr(_found(body, TOKEN)),
    }).drop(body)
    plain = "rtrim('=', v.body)"
    tested = _let("q", plain, _let("c", encoding_of("q"), (
        "struct(v.start AS start, v.stop AS stop, c AS enc, length(q) AS len, "
        f"CASE WHEN c IN ('number', 'joined') THEN 0D ELSE {randomness('q', 'c')} END AS p)")))
    got = got.withColumn("tokens", F.expr(f"transform(tokens, v -> {tested})"))
    spans = lambda c: f"transform({c}, v -> struct(v.start AS start, v.stop AS stop))"
    return stored(got.withColumns({c: F.expr(spans(c)) for c in ("assign", "access", "hex")}),
                  "secrets")


def _class_of(value: str, ends: tuple) -> str:
    """SQL: number of the first class whose end is not below the value."""
    cases = " ".join(f"WHEN {value} <= {e} THEN {i}" for i, e in enumerate(ends))
    return f"CASE {cases} ELSE {len(ends)} END"


def _passed(value: str) -> str:
    """SQL: number of levels at which a token passes."""
    return " + ".join(f"CASE WHEN {value} >= {a}D THEN 1 ELSE 0 END" for a in LEVELS)


def false_discovery_levels(counts: list[tuple[str, int, int, int]],
                           fdr: float = 0.05) -> dict[tuple[str, int], float]:
    """Level by (encoding, length class) from counts of (encoding, length class,
    levels passed, tokens).  Words of shorter classes stand in for a length
    class with fewer than 100 words: shorter ones pass more often."""
    classes = range(len(LENGTHS) + 1)
    words = {c: [sum(n for e, k, p, n in counts if e == "word" and k == c and p > i)
                 for i in range(len(LEVELS))] for c in classes}
    total = {c: sum(n for e, k, _, n in counts if e == "word" and k == c) for c in classes}
    out = {}
    for enc in {e for e, *_ in counts} - {"word", "number", "joined"}:
        for c in classes:
            mine = [(p, n) for e, k, p, n in counts if e == enc and k == c]
            if not mine:
                continue
            ref, low = [0] * len(LEVELS), 0
            for k in range(c, -1, -1):
                ref, low = [a + b for a, b in zip(ref, words[k])], low + total[k]
                if low >= 100:
                    break
            for i, level in enumerate(LEVELS):
                passing = (ref[i] + 1) / (low + 2)
                hits = sum(n for p, n in mine if p > i)
                fails = sum(n for p, n in mine if p <= i)
                if hits and fails * passing / max(1e-9, 1 - passing) <= fdr * hits:
                    out[enc, c] = level
                    break
    return out


def find_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 fdr: float = 0.05) -> DataFrame:
    """``keep`` and the spans by kind: assign, access, hex, random (those that
    the battery adds; none overlaps a span of the other kinds)."""
    rows = scan(docs, text, list(keep))
    cells = (rows.select(F.explode("tokens").alias("v"))
             .selectExpr("v.enc AS enc", f"{_class_of('v.len', LENGTHS)} AS len_class",
                         f"{_passed('v.p')} AS passed")
             .groupBy("enc", "len_class", "passed").agg(F.count(F.lit(1)).alias("n")))
    levels = false_discovery_levels([tuple(r) for r in cells.collect()], fdr)
    cases = " ".join(f"WHEN v.enc = '{e}' AND {_class_of('v.len', LENGTHS)} = {c} "
                     f"THEN v.p >= {level}D" for (e, c), level in sorted(levels.items()))
    chosen = f"CASE {cases} ELSE false END" if cases else "false"
    free = "NOT exists(base, b -> b.start < v.stop AND v.start < b.stop)"
    random = _let("base", "concat(assign, access, hex)", (
        f"transform(filter(tokens, v -> {chosen} AND {free}), "
        "v -> struct(v.start AS start, v.stop AS stop))"))
    return rows.withColumn("random", F.expr(random)).drop("tokens")


def _listed(*kinds: str) -> str:
    """SQL: all spans as kind:start:end by start, then kind as listed."""
    parts = [f"transform({k}, v -> struct(v.start AS start, {i} AS o, v.stop AS stop, '{k}' AS kind))"
             for i, k in enumerate(kinds)]
    return (f"array_join(transform(sort_array(concat({', '.join(parts)})), "
            "v -> concat(v.kind, ':', v.start, ':', v.stop)), ',')")


def report(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans."""
    kinds = ("assign", "access", "hex")
    return found.withColumns(
        {f"n_{k}": F.size(k).cast("long") for k in kinds}
        | {"n_random": F.size("random").cast("long"),
           "base_sha256": F.sha2(F.expr(_listed(*kinds)).cast("binary"), 256),
           "spans": F.expr(_listed(*kinds, "random"))}).drop(*kinds, "random")


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """SQL: the text with each span, or chain of overlapping spans, replaced."""
    spans = "sort_array(concat(assign, access, hex, random))"
    step = (f"struct(greatest(a.pos, v.stop) AS pos, concat(a.out, CASE WHEN v.start >= a.pos THEN "
            f"concat(substring({text}, a.pos + 1, v.start - a.pos), '{mark}') ELSE '' END) AS out)")
    return (f"aggregate({spans}, struct(0 AS pos, '' AS out), (a, v) -> {step}, "
            f"a -> concat(a.out, substring({text}, a.pos + 1)))")


def redact(docs: DataFrame, text: str = "text", fdr: float = 0.05) -> DataFrame:
    """``docs`` with every found secret replaced by a mark, and ``n_chars``, if
    there, following the text.  Rows without secrets stay as they are."""
    row = F.struct(*[column(c).alias(c) for c in docs.columns])
    found = find_secrets(docs.select(row.alias("scan_row"), column(text).alias("scan_text")),
                         "scan_text", ("scan_row",), fdr)
    some = F.expr("size(assign) + size(access) + size(hex) + size(random) > 0")
    quoted = text.replace("`", "``")
    out = found.select("scan_row", some.alias("some"), F.when(some, F.expr(
        redacted(f"scan_row.`{quoted}`"))).alias("new"))
    old = {c: F.col("scan_row").getField(c) for c in docs.columns}
    changed = {text: F.when(F.col("some"), F.col("new")).otherwise(old[text])}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("some"), F.length("new").cast(
            docs.schema["n_chars"].dataType)).otherwise(old["n_chars"])
    return out.select(*[changed.get(c, old[c]).alias(c) for c in docs.columns])

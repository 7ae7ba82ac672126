"""Repair of conversation structure by Viterbi paths that converge in rank.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials.
Rows may be kept (K, 0), given the role user or assistant (R, 2) or deleted
(D, 3, required for blank and duplicate rows), and empty user or assistant rows
may be inserted anywhere (I, 2); a row that stays although it is truncated
costs 1 more.  The cheapest edits are found backwards: the cost to the end from
each of four states (nothing yet, after a system, user or assistant row).

A conversation is cut into chunks of rows, all chunks at the same time:

1. Every chunk runs from the vector of the end of a conversation, a guess for
   all but the last.  The vector of its first row is the one that the chunk
   before should have begun with.  Fix-up passes run the chunks whose guess
   differs from it by more than a constant, until none does; min-plus products
   soon have rank one, so a few passes do (as many as chunks at worst).
2. A chunk is walked from each of the four states to the state it ends in;
   these short maps, one after the other, give every chunk its first state.
3. Every chunk traces its edits from its first state along the stitched
   vectors, taking the least letter among the cheapest edits.

Rows are sorted once by a range partitioning.  A conversation that lies within
one partition and one chunk is repaired there; the others (long ones, and at
most two for each partition border) go through the passes.  Only the maps of
step 2 and running digests pass through one task per conversation.

Defined cases: a null role or text is one space; a null conversation id is a
conversation of its own; rows are ordered by turn (nulls first), then role, then
the MD5 of the text; roles count by their first character, and one that begins
otherwise than with s, u or a can be kept nowhere; a conversation whose rows are
all ignored has zeros and no parts of text; an empty table gives no rows;
columns other than those named are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import column, stored

#: Rows and bytes of text in a chunk.
CHUNK_ROWS = 4096
CHUNK_BYTES = 1 << 20

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
CLASSES = {"s": 0, "u": 1, "a": 2}

#: States: nothing yet, after system, after user, after assistant.
NEXT_USER = {0: 2, 1: 2, 3: 2}
NEXT_ASSISTANT = {2: 3}
#: By the class of a kept row.
KEEP = ({0: 1}, NEXT_USER, NEXT_ASSISTANT, {})
INSERT = NEXT_USER | NEXT_ASSISTANT
ROLE = {2: "user", 3: "assistant"}
#: Cost to the end behind the last row.
END = (0, 4, 2, 0)

DELETED = 0


def row_code(must_go: bool, role: str, truncated: bool) -> int:
    """0 for a row that has to be deleted, else its class and truncation."""
    return DELETED if must_go else 1 + 2 * CLASSES.get(role[:1], 3) + truncated


class Paths:
    """Steps over one row, remembered: vectors that differ by a constant are one,
    so there are few of them."""

    def __init__(self):
        self._back: dict[tuple, tuple] = {}
        self._edit: dict[tuple, tuple] = {}

    @staticmethod
    def _row_options(code: int, state: int, after: tuple) -> list[tuple]:
        """(letter, cost to the end, next state) of the edits of a row."""
        found = [("D", 3 + after[state], state)]
        if code != DELETED:
            kind, extra = divmod(code - 1, 2)
            if state in KEEP[kind]:
                to = KEEP[kind][state]
                found.append(("K", extra + after[to], to))
            to = INSERT[state]
            found.append(("R", 2 + extra + after[to], to))
        return found

    def back(self, code: int, after: tuple) -> tuple[tuple, int]:
        """Vector before a row, lowest entry 0, and what was taken off."""
        key = (code, after)
        if key not in self._back:
            direct = [min(c for _, c, _ in self._row_options(code, q, after)) for q in range(4)]
            # one insertion reaches any state that two would reach cheaper
            v = list(direct)
            v[2], v[3] = min(direct[2], 2 + direct[3]), min(direct[3], 2 + direct[2])
            v[0], v[1] = min(direct[0], 2 + v[2]), min(direct[1], 2 + v[2])
            low = min(v)
            self._back[key] = (tuple(x - low for x in v), low)
        return self._back[key]

    def edits(self, code: int, after: tuple, state: int) -> tuple[str, int]:
        """Letters of the least cheapest edits up to and with a row, and the state
        behind it."""
        key = (code, after, state)
        if key not in self._edit:
            before, low = self.back(code, after)
            letters, now = "", state
            while True:
                options = self._row_options(code, now, after)
                options.append(("I", low + 2 + before[INSERT[now]], INSERT[now]))
                letter, _, to = min(o for o in options if o[1] == low + before[now])
                letters, now = letters + letter, to
                if letter != "I":
                    break
            self._edit[key] = (letters, now)
        return self._edit[key]

    def vectors(self, codes: bytes, end: tuple) -> tuple[list[tuple], tuple, int]:
        """The vectors behind every row, the one before the first, and its cost
        over that of ``end``."""
        behind, v, total = [], end, 0
        for code in reversed(codes):
            behind.append(v)
            v, low = self.back(code, v)
            total += low
        behind.reverse()
        return behind, v, total

    def leave(self, codes: bytes, behind: list[tuple], state: int) -> int:
        for code, after in zip(codes, behind):
            state = self.edits(code, after, state)[1]
        return state

    def trace(self, codes: bytes, behind: list[tuple], state: int, last: bool,
              rows: list[tuple[str, str]]) -> tuple[str, list[str], list[str]]:
        """(audit, roles, texts) of a chunk."""
        audit, roles, texts = [], [], []

        def insert(now):
            roles.append(ROLE[INSERT[now]])
            texts.append("")
            return INSERT[now]

        for code, after, (role, text) in zip(codes, behind, rows):
            letters, to = self.edits(code, after, state)
            audit.append(letters)
            for _ in letters[:-1]:
                state = insert(state)
            if letters[-1] != "D":
                roles.append(role if letters[-1] == "K" else ROLE[to])
                texts.append(text)
            state = to
        while last and END[state]:
            audit.append("I")
            state = insert(state)
        return "".join(audit), roles, texts


class Faults:
    """Counts of the rows of a chunk and their codes."""

    def __init__(self, rows: list[tuple[str, str]], seen: set[bytes]):
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        codes = bytearray()
        seen = set(seen)
        for i, (role, text) in enumerate(rows):
            solid = text.rstrip(BLANKS)
            digest = digest_of(role, text)
            cut = False
            if not solid:
                self.blank += 1
            elif digest in seen:
                self.duplicate += 1
            elif solid[-1] not in ENDS:
                self.truncated += 1
                cut = True
            codes.append(row_code(not solid or digest in seen, role, cut))
            seen.add(digest)
            if i and not legal(rows[i - 1][0], role):
                self.illegal += 1
        self.codes = bytes(codes)


def legal(role: str, following: str) -> bool:
    return role[:1] + following[:1] in ("su", "ua", "au")


def digest_of(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


# ------------------------------------------------------------- Spark side

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "cost")

#: Chunks that are repaired where they were sorted (``done``), and the others.
_CHUNK = pa.schema([
    ("key", pa.string()), ("part", pa.int64()), ("done", pa.bool_()),
    *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()),
    ("turn_list", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())), ("digests", pa.list_(pa.binary()))])
_CHUNK_SQL = ("key string, part long, done boolean, " + ", ".join(f"{c} long" for c in _COUNTS)
              + ", audit string, turn_list array<long>, roles array<string>, texts array<string>, "
              "digests array<binary>")


def _batches(rows: Iterator[dict], schema: pa.Schema, weigh, limit: int = 4 << 20):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row) + 200
        if size >= limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _weight(row: dict) -> int:
    return sum(map(len, row["texts"])) + 64 * len(row["texts"])


def _turn_counts(turns: list[int | None]) -> dict:
    known = [t for t in turns if t is not None]
    return {"turns": len(set(known)), "low": min(known, default=None),
            "high": max(known, default=None)}


def _finished(key: str, part: int, rows: list[tuple], paths: Paths) -> dict:
    pairs = [(r, t) for _, r, t in rows]
    faults = Faults(pairs, set())
    behind, start, cost = paths.vectors(faults.codes, END)
    audit, roles, texts = paths.trace(faults.codes, behind, 0, True, pairs)
    return {"key": key, "part": part, "done": True, "blank": faults.blank,
            "duplicate": faults.duplicate, "truncated": faults.truncated,
            "illegal": faults.illegal, "cost": cost + start[0], "audit": audit,
            "turn_list": None, "roles": roles, "texts": texts, "digests": None,
            **_turn_counts([t for t, _, _ in rows])}


def _open(key: str, part: int, rows: list[tuple]) -> dict:
    return {"key": key, "part": part, "done": False, "turn_list": [t for t, _, _ in rows],
            "roles": [r for _, r, _ in rows], "texts": [t for _, _, t in rows],
            "digests": [digest_of(r, t) for _, r, t in rows]}


def _sorted_chunks(rows: DataFrame, chunk_rows: int, chunk_bytes: int) -> DataFrame:
    """Chunks of the rows (key, turn, role, text, ignored), written once."""
    order = ("key", "turn", "role", "text_md5", "copy")
    spread = rows.withColumn("text_md5", F.md5("text")).withColumn(
        "copy", F.monotonically_increasing_id())
    ranged = (spread.repartitionByRange(*order).sortWithinPartitions(*order)
              .select(F.spark_partition_id().alias("pid"), "key", "turn", "role", "text", "ignored"))

    def chunks(incoming):
        paths, at, first, opened = Paths(), None, True, False
        held, size, part = [], 0, 0
        for pid, key, turn, role, text, ignored in incoming:
            if key != at:
                if at is not None:
                    # the first one may have begun in the partition before
                    yield (_open(at, part, held) if first or opened
                           else _finished(at, part, held, paths))
                    first = False
                    part += 1
                else:
                    part = pid << 32
                at, held, size, opened = key, [], 0, False
            if ignored:
                continue
            if held and (len(held) >= chunk_rows or size + len(text) > chunk_bytes):
                yield _open(at, part, held)
                held, size, opened, part = [], 0, True, part + 1
            held.append((turn, role, text))
            size += len(text)
        if at is not None:  # the last one may go on in the next partition
            yield _open(at, part, held)

    def run(batches):
        return _batches(chunks(_rows(batches)), _CHUNK, _weight)

    return stored(ranged.mapInArrow(run, _CHUNK_SQL), "conv-chunks")


def _seen_before(chunks: DataFrame) -> DataFrame:
    """key, part, seen: digests of rows that an earlier chunk of the conversation
    holds.  A chunk names each digest once, so a frequent row counts by
    chunks."""
    named = chunks.select("key", "part", F.explode(F.array_distinct("digests")).alias("digest"))
    first = named.groupBy("key", "digest").agg(
        F.min("part").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    return (named.join(first.drop("times"), ["key", "digest"]).filter("part > first")
            .groupBy("key", "part").agg(F.collect_list("digest").alias("seen")))


_CODED = pa.schema([("key", pa.string()), ("part", pa.int64()), ("codes", pa.binary()),
                    *[(c, pa.int64()) for c in _COUNTS if c != "cost"],
                    ("turn_first", pa.int64()), ("turn_last", pa.int64()),
                    ("role_first", pa.string()), ("role_last", pa.string())])
_CODED_SQL = ("key string, part long, codes binary, "
              + ", ".join(f"{c} long" for c in _COUNTS if c != "cost")
              + ", turn_first long, turn_last long, role_first string, role_last string")


def _coded(chunks: DataFrame) -> DataFrame:
    def codes(rows):
        for key, part, turns, roles, texts, seen in rows:
            faults = Faults(list(zip(roles, texts)), set(seen or ()))
            yield {"key": key, "part": part, "codes": faults.codes, "blank": faults.blank,
                   "duplicate": faults.duplicate, "truncated": faults.truncated,
                   "illegal": faults.illegal, "turn_first": turns[0] if turns else None,
                   "turn_last": turns[-1] if turns else None,
                   "role_first": roles[0] if roles else None,
                   "role_last": roles[-1] if roles else None, **_turn_counts(turns)}

    def run(batches):
        return _batches(codes(_rows(batches)), _CODED, lambda r: len(r["codes"]))

    both = chunks.join(_seen_before(chunks), ["key", "part"], "left").select(
        "key", "part", "turn_list", "roles", "texts", "seen")
    return stored(both.mapInArrow(run, _CODED_SQL), "conv-codes")


def _key_window():
    return Window.partitionBy("key").orderBy("part")


_RUN = pa.schema([("key", pa.string()), ("part", pa.int64()), ("last", pa.bool_()),
                  ("codes", pa.binary()), ("end", pa.list_(pa.int32())),
                  ("start", pa.list_(pa.int32())), ("cost", pa.int64()),
                  ("leaves", pa.list_(pa.int32()))])
_RUN_SQL = ("key string, part long, last boolean, codes binary, end array<int>, "
            "start array<int>, cost long, leaves array<int>")


def _run_chunks(df: DataFrame) -> DataFrame:
    """Start vector, cost and the four states left in, of rows (key, part, last,
    codes, end)."""
    def passes(rows):
        paths = Paths()
        for key, part, last, codes, end in rows:
            behind, start, cost = paths.vectors(codes, tuple(end))
            yield {"key": key, "part": part, "last": last, "codes": codes, "end": end,
                   "start": list(start), "cost": cost,
                   "leaves": [paths.leave(codes, behind, q) for q in range(4)]}

    def run(batches):
        return _batches(passes(_rows(batches)), _RUN, lambda r: len(r["codes"]))

    return df.select("key", "part", "last", "codes", "end").mapInArrow(run, _RUN_SQL)


def converge(coded: DataFrame) -> tuple[DataFrame, int]:
    """Chunks with the vector of their end as the next chunk begins with it, and
    the passes that it took."""
    guess = F.array(*[F.lit(x) for x in END])
    todo = coded.select("key", "part", F.lead("part").over(_key_window()).isNull().alias("last"),
                        "codes", guess.alias("end"))
    state, passes = stored(_run_chunks(todo), "conv-pass"), 1
    while True:
        ahead = F.lead("start").over(_key_window())
        judged = stored(state.withColumn("should", F.coalesce(ahead, F.col("end"))), "conv-judged")
        wrong = judged.filter(F.col("should") != F.col("end"))
        if wrong.isEmpty():
            return state, passes
        again = _run_chunks(wrong.drop("end").withColumnRenamed("should", "end"))
        right = judged.filter(F.col("should") == F.col("end")).drop("should")
        state, passes = stored(right.unionByName(again), "conv-pass"), passes + 1


def _entered(state: DataFrame) -> DataFrame:
    """key, part, enters: the state each chunk begins in.  Only four numbers per
    chunk pass through the task of a conversation."""
    schema = pa.schema([("key", pa.string()), ("part", pa.int64()), ("enters", pa.int32())])

    def walk(rows):
        at, now = None, 0
        for key, part, leaves in rows:
            if key != at:
                at, now = key, 0
            yield {"key": key, "part": part, "enters": now}
            now = leaves[now]

    def run(batches):
        return _batches(walk(_rows(batches)), schema, lambda r: 0)

    narrow = (state.select("key", "part", "leaves").repartition("key")
              .sortWithinPartitions("key", "part"))
    return narrow.mapInArrow(run, "key string, part long, enters int")


_TEXT = pa.schema([("key", pa.string()), ("part", pa.int64()), ("audit", pa.string()),
                   ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _traced(chunks: DataFrame, state: DataFrame) -> DataFrame:
    def trace(rows):
        paths = Paths()
        for key, part, last, codes, end, enters, roles, texts in rows:
            behind = paths.vectors(codes, tuple(end))[0]
            audit, roles, texts = paths.trace(codes, behind, enters, last, list(zip(roles, texts)))
            yield {"key": key, "part": part, "audit": audit, "roles": roles, "texts": texts}

    def run(batches):
        return _batches(trace(_rows(batches)), _TEXT, _weight)

    both = (chunks.select("key", "part", "roles", "texts").join(state, ["key", "part"])
            .join(_entered(state), ["key", "part"])
            .select("key", "part", "last", "codes", "end", "enters", "roles", "texts"))
    return both.mapInArrow(
        run, "key string, part long, audit string, roles array<string>, texts array<string>")


def _totals(coded: DataFrame, state: DataFrame) -> DataFrame:
    """Counts of the conversations of ``coded`` chunks, borders included."""
    before = _key_window().rowsBetween(Window.unboundedPreceding, -1)
    c = (coded.withColumn("turn_ahead", F.last("turn_last", True).over(before))
         .withColumn("role_ahead", F.last("role_last", True).over(before)))
    pair = F.concat(F.substring("role_ahead", 1, 1), F.substring("role_first", 1, 1))
    c = (c.withColumn("again", F.when(F.col("turn_ahead") == F.col("turn_first"), 1).otherwise(0))
         .withColumn("breach", F.when(pair.isNotNull() & ~pair.isin("su", "ua", "au"), 1)
                     .otherwise(0)))
    counts = c.groupBy("key").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"),
        F.sum("truncated").alias("truncated"),
        (F.sum("illegal") + F.sum("breach")).alias("illegal"),
        (F.sum("turns") - F.sum("again")).alias("turns"), F.min("low").alias("low"),
        F.max("high").alias("high"))
    costs = state.groupBy("key").agg(
        (F.sum("cost") + F.min_by(F.element_at("start", 1), F.col("part"))).alias("cost"))
    return counts.join(costs, "key")


def repair(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", ignored: Column | None = None, chunk_rows: int = CHUNK_ROWS,
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The repaired conversations in parts: conv_id, part (their order), whole
    (the conversation has this part only), gaps, blank, duplicate, truncated,
    illegal, cost (of the conversation), and of the part audit, roles, texts.
    Rows for which ``ignored`` is true are left out, but their conversation is
    reported."""
    name = column(conv_id).cast("string")
    rows = convs.select(
        F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), name)).alias("key"),
        column(turn).cast("long").alias("turn"),
        F.coalesce(column(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(column(text), F.lit(" ")).alias("text"),
        (ignored if ignored is not None else F.lit(False)).alias("ignored"))
    made = _sorted_chunks(rows, chunk_rows, chunk_bytes)
    done = made.filter("done").withColumn("whole", F.lit(True))
    chunks = made.filter("not done")
    coded = _coded(chunks)
    state, _ = converge(coded)
    numbers = ["turns", "low", "high", "blank", "duplicate", "truncated", "illegal", "cost"]
    several = (_traced(chunks, state).join(_totals(coded, state), "key")
               .withColumn("whole", F.lit(False)))
    kept = ["key", "part", "whole", *numbers, "audit", "roles", "texts"]
    every = done.select(*kept).unionByName(several.select(*kept))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    kind = convs.select(column(conv_id)).schema[0].dataType
    return every.select(
        F.when(F.col("key") != "-", F.expr("substring(key, 2)").cast(kind)).alias("conv_id"),
        "part", "whole", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        "illegal", "cost", "audit", "roles", "texts")


def digests(parts: DataFrame) -> DataFrame:
    """One row per conversation: its numbers, the whole audit and the SHA-256 of
    ``role:text`` of its repaired rows, joined by line feeds.  The parts of a
    conversation pass through a running digest in their order."""
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    one = parts.filter("whole").select("conv_id", *numbers, "audit",
                                       F.sha2(lines, 256).alias("repaired_sha256"))
    kind = dict(parts.dtypes)["conv_id"]
    schema_sql = (f"conv_id {kind}, " + ", ".join(f"{c} long" for c in numbers)
                  + ", audit string, repaired_sha256 string")
    several = parts.filter("not whole").select("conv_id", "part", *numbers, "audit",
                                               (F.size("roles") > 0).alias("some"),
                                               lines.alias("lines"))

    def joined(rows):
        at, row, audits, digest, some = None, None, [], None, False
        for r in rows:
            name = (r[0],)
            if name != at:
                if at is not None:
                    yield (*row, "".join(audits), digest.hexdigest())
                at, row, audits, digest, some = name, (r[0], *r[2:8]), [], hashlib.sha256(), False
            audits.append(r[8])
            if r[9]:
                digest.update((("\n" if some else "") + r[10]).encode())
                some = True
        if at is not None:
            yield (*row, "".join(audits), digest.hexdigest())

    fields = ["conv_id", *numbers, "audit", "repaired_sha256"]

    def run(batches):
        held = []
        for row in joined(_rows(batches)):
            held.append(dict(zip(fields, row)))
            if len(held) >= 1000:
                yield pa.RecordBatch.from_pylist(held)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held)

    ordered = several.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return one.unionByName(ordered.mapInArrow(run, schema_sql))

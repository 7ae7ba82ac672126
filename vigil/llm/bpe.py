"""Byte-level BPE of whole texts in overlapping chunks, and back.

A text of more than ``chunk`` characters is cut into chunks that reach
``overlap`` characters into the next one.  Chunks are pre-tokenised on their
own, wherever they begin, so the first boundaries of a chunk may be wrong.
A pre-token depends only on what follows its start, so from the first boundary
that two neighbours both found in their overlap they agree for good: there the
texts are stitched.  Chunks without a common boundary (a pre-token longer than
the overlap) are joined with their neighbour and pre-tokenised again.  Every
chunk then encodes the pre-tokens between its two stitches by the ranks of the
vocabulary.  A text of one chunk has nothing to stitch.  Decoding
concatenates the bytes of the tokens.

A pre-token counts as found only if the chunk holds all that decides it: the
character behind it, and three characters from its start for the endings that
the pattern names.  The last chunk of a text holds its end.

The regular expressions of Python and of the tokenizer library may know
different versions of Unicode.  ``python_pattern`` asks the library about every
character on which two versions at hand disagree, and corrects the classes.

Defined cases: a null or empty text has one row without ids; a null id is
carried; repeated rows are encoded as often as they occur; an empty table gives
no rows; other columns, whatever their names, are ignored.  A text of any
length is read whole.  A run of chunks that holds one pre-token is joined in
one task, as the token ids of a pre-token need all of it.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import column, stored, text_or_empty

#: Characters of a chunk and of its overlap with the next.
CHUNK = 16_384
OVERLAP = 512

#: Characters from its start that decide a pre-token beside its own.
AHEAD = 3

#: Bytes of texts or ids handed on at a time.
BATCH_BYTES = 4 << 20

TOKENS = "doc_id long, row long, start long, ids binary"


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken
    return tiktoken.Encoding("texts", pat_str=pattern, mergeable_ranks=_ranks(path),
                             special_tokens={})


@lru_cache(maxsize=4)
def _bytes_of(path: str) -> dict[int, bytes]:
    return {r: t for t, r in _ranks(path).items()}


def _as_ids(encoding, text: str) -> bytes:
    ids = encoding.encode_to_numpy(text, disallowed_special=())
    return ids.astype("<u4").tobytes()


# ------------------------------------------------------------ pre-tokens

def _in_one_piece(pattern: str, chars: list[str], mate: str) -> set[str]:
    """Those of ``chars`` that the library's own regular expressions put into
    one pre-token with ``mate``: only there can its probe vocabulary join the
    last byte of the character with it."""
    import tiktoken
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {bytes([b]) + mate.encode(): 128 + b for b in range(128, 192)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return {c for c in chars if max(probe.encode_ordinary(c + mate)) > 255}


def _ranges(chars: set[str]) -> str:
    points, out = sorted(map(ord, chars)), []
    for p in points:
        if out and p == out[-1][1] + 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@lru_cache(maxsize=4)
def python_pattern(pattern: str) -> str:
    """``pattern`` with the letters and numbers that the library knows."""
    every = "".join(chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000)
    for name, mate in (("L", "a"), ("N", "1")):
        mine = set(regex.findall(rf"\p{{{name}}}", every))
        other = {c for c in every if unicodedata.category(c)[0] == name}
        doubtful = mine ^ other
        theirs = _in_one_piece(pattern, sorted(doubtful), mate)
        less, more = _ranges((doubtful & mine) - theirs), _ranges(theirs - mine)
        fixed = rf"\p{{{name}}}"
        if less:
            fixed = f"[{fixed}--[{less}]]"
        if more:
            fixed = f"[{fixed}||[{more}]]"
        pattern = pattern.replace(rf"\p{{{name}}}", fixed)
    return f"(?V1){pattern}"


@lru_cache(maxsize=4)
def _compiled(pattern: str):
    return regex.compile(pattern)


def _boundaries(pattern, body: str, last: bool, lo: int, hi: int) -> list[int]:
    """Ends (and 0) of the pre-tokens of ``body`` between lo and hi that are
    sure to be those of a longer text that goes on behind it."""
    size, found = len(body), [0] if lo == 0 else []
    for m in pattern.finditer(body):
        s, e = m.span()
        if e > hi or not last and (e >= size or s + AHEAD > size):
            break
        if e >= lo:
            found.append(e)
    return found


# ---------------------------------------------------------------- chunks

def _batches(rows, kinds, names, weigh) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size >= BATCH_BYTES:
            yield _batch(held, kinds, names)
            held, size = [], 0
    if held:
        yield _batch(held, kinds, names)


def _batch(rows, kinds, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def cut_chunks(long_texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """row, doc_id, chunk, last, body of ``long_texts`` (doc_id, body), written
    once: this fixes the row numbers."""
    numbered = long_texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "body")
    names = ["row", "doc_id", "chunk", "last", "body"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def cut(rows):
        for row, doc, body in rows:
            for i in range(0, len(body), chunk):
                yield row, doc, i // chunk, i + chunk >= len(body), body[i:i + chunk + overlap]

    def run(batches):
        return _batches(cut(_rows(batches)), kinds, names, lambda r: 4 * len(r[4]))

    made = numbered.mapInArrow(run, "row long, doc_id long, chunk long, last boolean, body string")
    return stored(made, "bpe-chunks")


def stitch(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """For every chunk: row, chunk, run (the first chunk of the run that it is
    encoded with), alone, and p0, p1: the places in its text between which it is
    encoded (a run from the p0 of its first to the p1 of its last chunk; p1 is
    null at the end of a text)."""
    names = ["row", "chunk", "last", "head", "tail"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def ends(rows):
        own = _compiled(pattern)
        for row, i, last, body in rows:
            found = _boundaries(own, body, last, 0, chunk + overlap)
            yield (row, i, last, [i * chunk + e for e in found if e <= overlap],
                   [i * chunk + e for e in found if e >= chunk])

    def run(batches):
        return _batches(ends(_rows(batches)), kinds, names, lambda r: 16 * len(r[3]) + 64)

    # a long text must not keep its chunks in the task that cut them
    spread = chunks.select("row", "chunk", "last", "body").repartition("row", "chunk")
    made = spread.mapInArrow(
        run, "row long, chunk long, last boolean, head array<long>, tail array<long>")
    made = stored(made, "bpe-boundaries")  # no texts
    order = Window.partitionBy("row").orderBy("chunk")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = (made.withColumn("p1", F.array_min(F.array_intersect("tail", F.lead("head").over(order))))
              .withColumn("p0", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(
                  F.lag("p1").over(order)))
              .withColumn("run", F.max(F.when(F.col("p0").isNotNull(), F.col("chunk"))).over(upto)))
    linked = linked.withColumn("alone", F.col("p0").isNotNull() & (F.col("p1").isNotNull() | F.col("last")))
    return linked.select("row", "chunk", "run", "alone", "p0", "p1")


def _encode_between(pattern, encoding, body: str, begin: int, end: int | None,
                    known: dict[str, bytes]) -> bytes:
    """Ids of the pre-tokens of ``body`` from ``begin`` to ``end``."""
    out = []
    for m in pattern.finditer(body, begin):
        if end is not None and m.end() > end:
            break
        piece = m.group()
        ids = known.get(piece)
        if ids is None:
            ids = _as_ids(encoding, piece)
            if len(piece) <= 64 and len(known) < 200_000:
                known[piece] = ids
        out.append(ids)
    return b"".join(out)


def _encode_stitched(chunks: DataFrame, links: DataFrame, path: str, pattern: str,
                     chunk: int) -> DataFrame:
    both = chunks.join(links, ["row", "chunk"])
    names = ["doc_id", "row", "start", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = ["row", "run", "chunk", "doc_id", "body", "p0", "p1"]

    def joined(rows):
        """(row, run, doc_id, text, p0, p1) of every run of chunks."""
        key, bodies, doc, begin, end = None, [], None, 0, None
        for row, run, _, name, body, p0, p1 in rows:
            if key != (row, run):
                if key is not None:
                    yield *key, doc, "".join(bodies), begin, end
                key, bodies, doc, begin = (row, run), [], name, p0
            if bodies:
                bodies[-1] = bodies[-1][:chunk]
            bodies.append(body)
            end = p1
        if key is not None:
            yield *key, doc, "".join(bodies), begin, end

    def ids(rows):
        # a pre-token is one piece here, whatever it holds
        own, encoding, known = _compiled(pattern), _encoding(path, r"[\s\S]+"), {}
        for row, run, doc, body, begin, end in joined(rows):
            base = run * chunk
            yield doc, row, begin, _encode_between(
                own, encoding, body, begin - base, None if end is None else end - base, known)

    def run(batches):
        return _batches(ids(_rows(batches)), kinds, names, lambda r: len(r[3]) + 64)

    alone = both.filter("alone").select(*columns)
    runs = (both.filter("not alone").select(*columns).repartition("row", "run")
            .sortWithinPartitions("row", "run", "chunk"))
    return alone.mapInArrow(run, TOKENS).unionByName(runs.mapInArrow(run, TOKENS))


def encode_texts(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK,
                 overlap: int = OVERLAP, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Token ids of every text: doc_id, row, start, ids (little-endian unsigned
    32-bit), whole.  A text of one chunk has one row (``whole``, ``row`` null);
    the rows of a longer one share ``row`` and follow each other by ``start``."""
    body = docs.select(column(doc_id).cast("long").alias("doc_id"),
                       text_or_empty(column(text)).alias("body"))
    names = ["doc_id", "row", "start", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def whole(batches):
        encoding = _encoding(path, pattern)
        rows = ((doc, None, 0, _as_ids(encoding, t)) for doc, t in _rows(batches))
        return _batches(rows, kinds, names, lambda r: len(r[3]) + 64)

    short = body.filter(F.length("body") <= chunk).mapInArrow(whole, TOKENS)
    chunks = cut_chunks(body.filter(F.length("body") > chunk), chunk, overlap)
    own = python_pattern(pattern)
    links = stitch(chunks, own, chunk, overlap)
    stitched = _encode_stitched(chunks, links, path, own, chunk)
    # a literal, so that a filter on it leaves one branch out of the plan
    return short.withColumn("whole", F.lit(True)).unionByName(
        stitched.withColumn("whole", F.lit(False)))


def decode_ids(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` and ``bytes``: the bytes of their ids in a row."""
    names = ["doc_id", "row", "start", "ids", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        table = _bytes_of(path)
        rows = ((doc, row, start, ids, b"".join(map(
            table.__getitem__, np.frombuffer(ids, "<u4").tolist())))
            for doc, row, start, ids in _rows(batches))
        return _batches(rows, kinds, names, lambda r: len(r[3]) + len(r[4]) + 64)

    return tokens.select("doc_id", "row", "start", "ids").mapInArrow(run, TOKENS + ", bytes binary")


def digests(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text, from its ids
    and the bytes that they decode to.  The rows of a long text are sorted and
    pass through running digests."""
    one = decode_ids(tokens.filter("whole"), path).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def texts(rows):
        key, doc, count, of_ids, of_bytes = None, None, 0, None, None
        for name, row, _, ids, raw in rows:
            if row != key:
                if key is not None:
                    yield doc, count, of_ids.hexdigest(), of_bytes.hexdigest()
                key, doc, count = row, name, 0
                of_ids, of_bytes = hashlib.sha256(), hashlib.sha256()
            count += len(ids) // 4
            of_ids.update(ids)
            of_bytes.update(raw)
        if key is not None:
            yield doc, count, of_ids.hexdigest(), of_bytes.hexdigest()

    def run(batches):
        return _batches(texts(_rows(batches)), kinds, names, lambda r: 200)

    many = (decode_ids(tokens.filter("not whole"), path).repartition("row")
            .sortWithinPartitions("row", "start").select("doc_id", "row", "start", "ids", "bytes"))
    return one.unionByName(many.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))

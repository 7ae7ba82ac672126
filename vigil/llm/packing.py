"""Packing: first-fit decreasing with a tournament tree of bin capacities.

A document is its token ids and an end id.  It is cut at multiples of the
sequence capacity, so that every piece but the last fills a sequence.  Pieces
go to random groups of about ``group_pieces``; in each group, on its own, the
pieces are placed from long to short into the first sequence with room.  The
tree holds the free room of every sequence in its leaves and the larger of two
children in every node, so the first fit is a walk from the root.

Token ids: white space is dropped by the tokenizer and nothing in it reaches
across white space, so a text's ids are those of its words in a row.  Each
worker keeps the ids of the words it has met (a bounded number, those met
lately) and hands only new words to the tokenizer.

Defined cases: a null, empty or blank text is the end id alone, one piece; a
null id is carried; repeated rows are packed as often as they occur; an empty
table gives no rows; texts of any length are cut, never dropped.
"""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import stored, text_or_empty

#: Words whose ids a worker keeps, and the longest word (in characters) that it
#: keeps.
CACHE_WORDS = 1_000_000
CACHE_CHARS = 64

#: Words handed to the tokenizer at a time.
CALL_WORDS = 20_000

#: UTF-8 bytes of text that a worker encodes at a time.
CHUNK_BYTES = 6 << 20

_ENDED = re.compile(r"(.*[a-z])([.,;:!?]+)", re.S)

_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of whole texts through a cache of words.  ASCII letters are lowered
    first, as the tokenizer lowers all letters (unless a text may hold one of
    its special tokens, which are matched as they are written), and signs that
    end a word are looked up by themselves, as they are tokens of their own."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task is one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # columns take a seventh of the room of a dict
        self.words = pa.array([], pa.string())
        self.lists = pa.array([], pa.list_(pa.uint32()))
        self.again = np.zeros(0, bool)

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """A call for many words; those that may hold a special token, which
        belongs to no word, are encoded one by one."""
        plain = [w for w in words if "<|" not in w]
        out = {}
        for first in range(0, len(plain), CALL_WORDS):
            part = plain[first:first + CALL_WORDS]
            found = self.tokenizer.encode_batch([part], is_pretokenized=True,
                                                add_special_tokens=False)[0]
            raw = np.array(found.ids, "<u4").tobytes()
            counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(part))
            ends = (4 * np.cumsum(counts)).tolist()
            out |= zip(part, (raw[i:j] for i, j in zip([0, *ends], ends)))
        if len(plain) < len(words):
            for w in words:
                if "<|" in w:
                    found = self.tokenizer.encode(w, add_special_tokens=False)
                    out[w] = np.array(found.ids, "<u4").tobytes()
        return out

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of distinct words that are not kept; signs that end a word are split
        off first."""
        ended = {w: m.groups() for w in new if (m := _ENDED.fullmatch(w))}
        parts = {x for pair in ended.values() for x in pair}
        kept = parts and pc.index_in(pa.array(list(parts), pa.string()), value_set=self.words)
        made, offsets, values = {}, self.lists.offsets.to_numpy(), self.lists.values.to_numpy()
        for w, i in zip(parts, kept.to_pylist() if parts else ()):
            if i is not None:
                made[w] = values[offsets[i]:offsets[i + 1]].tobytes()
        fresh = (set(new) - ended.keys() | parts) - made.keys()
        made |= self._encode(list(fresh))
        made |= {w: made[stem] + made[signs] for w, (stem, signs) in ended.items()}
        short = [w for w in (*fresh, *ended) if len(w) <= CACHE_CHARS]
        self.words = pa.concat_arrays([self.words, pa.array(short, pa.string())])
        self.lists = pa.concat_arrays([self.lists, _id_lists([made[w] for w in short])])
        self.again = np.concatenate([self.again, np.zeros(len(short), bool)])
        return made

    def _forget(self) -> None:
        """Beyond the bound only words stay that were met again since the last time."""
        if len(self.words) > CACHE_WORDS:
            stay = pa.array(self.again)
            self.words, self.lists = self.words.filter(stay), self.lists.filter(stay)
            self.again = np.zeros(len(self.words), bool)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many each text has).  Words are split,
        numbered and looked up by the column; only words not kept are handled
        one by one."""
        special = pc.match_substring(texts, "<|")
        split = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        words = split.flatten()
        some = pc.greater(pc.binary_length(words), 0)
        # words of each text, blanks at its ends aside
        upto = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
        bounds = upto[split.offsets.to_numpy() - split.offsets[0].as_py()]
        coded = pc.dictionary_encode(words.filter(some))
        each, places = coded.dictionary, coded.indices.to_numpy()
        self._forget()
        at = pc.index_in(each, value_set=self.words)
        new = at.is_null().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy()
        self.again[at[~new]] = True
        lists = self.lists
        missing = each.filter(pa.array(new)).to_pylist()
        if missing:
            made = self._learn(missing)
            at = np.where(new, len(lists) + np.cumsum(new) - 1, at)
            lists = pa.concat_arrays([lists, _id_lists([made[w] for w in missing])])
        ids = lists.take(pa.array(at[places])).flatten().to_numpy()
        counts = lists.value_lengths().to_numpy()[at][places]
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)[bounds]
        return ids, np.diff(ends)


def _id_lists(raw: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) // 4)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(np.frombuffer(b"".join(raw), "<u4")))


def _give_back() -> None:
    """Freed memory goes back to the machine: workers live on beside other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about CHUNK_BYTES."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        done = sizes[first - 1] if first else 0
        last = int(np.searchsorted(sizes, done + CHUNK_BYTES)) + 1
        yield texts.slice(first, min(last, len(texts)) - first)
        first = last


PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, and ``ids`` (little
    endian unsigned 32-bit)."""
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       text_or_empty(F.col(text)).alias("body"))
    fields = ("doc_id", "start", "length", "doc_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            names = iter(batch.column(0).to_pylist())
            for part in _chunks(batch.column(1)):
                ids, counts = enc.ids(part)
                # every text ends with the end id
                stops = np.cumsum(counts)
                ids, stops = np.insert(ids, stops, end_id), stops + np.arange(1, len(part) + 1)
                rows, begin = [], 0
                for stop in stops.tolist():
                    name, n = next(names), stop - begin
                    for start in range(0, n, capacity):
                        cut = ids[begin + start:min(begin + start + capacity, stop)]
                        rows.append((name, start, len(cut), n, cut.tobytes()))
                    begin = stop
                columns = zip(*rows)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], fields)
        _give_back()

    return body.mapInArrow(run, PIECES)


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each length, in the order given; lengths are at most
    ``capacity``.  Ties go by position."""
    n = len(lengths)
    size = 1
    while size < n:
        size *= 2
    room = [capacity] * (2 * size)
    placed: list[tuple[int, int]] = [(0, 0)] * n
    for i in sorted(range(n), key=lambda k: -lengths[k]):
        need, node = lengths[i], 1
        while node < size:
            node *= 2
            if room[node] < need:
                node += 1
        placed[i] = (node - size, capacity - room[node])
        room[node] -= need
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return placed


def pack_pieces(pieces: DataFrame, capacity: int = 4096, group_pieces: int = 8192,
                seed: int = 0) -> DataFrame:
    """``pieces`` (with doc_id, start, length) and sequence_id, offset.  The
    groups are drawn once and written, so that reruns of a task see the same."""
    drawn = stored(pieces.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "start",
                                                        F.monotonically_increasing_id())), "pieces")
    groups = max(1, -(-drawn.count() // group_pieces))
    grouped = drawn.withColumn("draw", F.pmod(F.col("draw"), F.lit(groups)))
    fields = [f for f in grouped.schema if f.name != "draw"]

    def fit(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("start", "ascending")])
        placed = first_fit_decreasing(group.column("length").to_pylist(), capacity)
        base = key[0].as_py() << 32
        out = group.select([f.name for f in fields])
        out = out.append_column("sequence_id", pa.array([base + b for b, _ in placed], pa.int64()))
        return out.append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    schema = drawn.select(*[f.name for f in fields]).schema
    return grouped.groupBy("draw").applyInArrow(
        fit, schema.add("sequence_id", "long").add("offset", "long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096,
                   group_pieces: int = 8192, end_id: int = 2, text: str = "text",
                   doc_id: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Pieces with their sequence and offset, a CRC-32 of their ids, and on
    demand the ids."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, text, doc_id)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    return pack_pieces(pieces if keep_ids else pieces.drop("ids"), capacity, group_pieces)

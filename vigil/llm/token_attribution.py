"""Token counts of sections, from one encoding of the whole document.

A document is encoded once by a byte-level BPE, whose tokens join to exactly
the bytes of the text: the running sum of token lengths is the offset map.
Sections are character spans; they are turned into byte spans, and tokens meet
sections in an interval join by binary search.  A token that crosses a boundary
goes by one of three rules:

``majority``  to the section with most of its bytes, the earlier one on a tie;
``first``     to the section of its first byte that lies in a section;
``share``     to all of them, by the share of its bytes in each.

Bytes between sections count for no section; a token wholly outside counts
for none.  The default sections are lines, each with the line feed that ends
it, so that every token belongs to one.

Defined cases: a null text is empty; an empty text has one empty section with
no tokens; a null id is carried; repeated rows are counted alike; texts of any
length are encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import text_or_empty

RULES = ("majority", "first", "share")

#: Sections that a worker gathers before it hands them on.
BATCH_ROWS = 50_000

_ENCODINGS: dict[tuple[str, str], tuple] = {}


def encoding(path: str, pattern: str):
    """The encoding of a rank file and the byte length of each token."""
    if (path, pattern) not in _ENCODINGS:
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        _ENCODINGS[path, pattern] = (tiktoken.Encoding(
            "public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths)
    return _ENCODINGS[path, pattern]


def lines(text: str) -> list[tuple[str, int, int]]:
    """(name, start, end) of each line, line feed included."""
    out, at = [], 0
    for i, part in enumerate(text.split("\n")):
        end = min(at + len(part) + 1, len(text))
        out.append(("head" if i == 0 else "line", at, end))
        at = end
    return out


def byte_places(text: str) -> np.ndarray | None:
    """Byte offset of each character and of the end; None if they are equal."""
    if text.isascii():
        return None
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))


def counts_by_section(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray,
                      rule: str) -> np.ndarray:
    """Tokens of each section.  ``ends``: running sum of token lengths; the
    sections are byte spans in order that do not overlap."""
    begins = ends - np.diff(ends, prepend=0)
    # sections that a token may touch: those that end after its begin and start before its end
    low = np.searchsorted(stops, begins, side="right")
    high = np.searchsorted(starts, ends, side="left")
    one = high - low == 1
    out = np.zeros(len(starts))
    if rule == "share":
        inside = np.minimum(ends[one], stops[low[one]]) - np.maximum(begins[one], starts[low[one]])
        np.add.at(out, low[one], inside / (ends[one] - begins[one]))
    else:
        np.add.at(out, low[one], 1.0)
    for t in np.flatnonzero(high - low > 1):
        touched = np.arange(low[t], high[t])
        inside = np.minimum(ends[t], stops[touched]) - np.maximum(begins[t], starts[touched])
        touched, inside = touched[inside > 0], inside[inside > 0]
        if rule == "share":
            out[touched] += inside / (ends[t] - begins[t])
        elif len(touched):
            out[touched[0] if rule == "first" else touched[int(np.argmax(inside))]] += 1.0
    return out


SCHEMA = ("doc_id long, section_no long, section string, start long, stop long, n_tokens double, "
          "doc_tokens long")


def attribute_tokens(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "majority",
                     sections: Callable[[str], list[tuple[str, int, int]]] = lines,
                     text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per section: doc_id, section_no, section, start, stop
    (characters), n_tokens by the rule, and the tokens of the document."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, lengths = encoding(ranks_path, pattern)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.asarray(enc.encode_ordinary(body), np.int64)
                parts = sections(body)
                starts = np.array([s for _, s, _ in parts], np.int64)
                stops = np.array([e for _, _, e in parts], np.int64)
                places = byte_places(body)
                spans = (starts, stops) if places is None else (places[starts], places[stops])
                counts = counts_by_section(np.cumsum(lengths[ids]), *spans, rule)
                n = len(parts)
                for column, values in zip(rows, (
                        [name] * n, range(n), [x for x, _, _ in parts], starts.tolist(),
                        stops.tolist(), counts.tolist(), [len(ids)] * n)):
                    column.extend(values)
                if len(rows[0]) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                                     names)
                    rows = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    return docs.select(F.col(doc_id).cast("long"), text_or_empty(F.col(text))).mapInArrow(run, SCHEMA)

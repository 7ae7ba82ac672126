"""Main text of pages by a recurrent block labeller.

A page is a sequence of blocks (texts between block-level tags).  Each block
gives a vector: hashed names of its tag path (tags, class and id words), its
hashed words, and a few shares.  A bidirectional LSTM in numpy reads the
whole sequence, so that a block is labelled in the context of all others.
The model is trained on made-up pages with known labels (``TRAIN_PAGES`` of
them, from a fixed seed), on the driver, once per process; its weights go to
the tasks with the function.

Defined cases: a null or empty page, or one without text, gives an empty text;
very long pages are read whole, one at a time; repeated rows give equal texts;
an empty table gives no rows.  Columns of the input are carried by name.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import new_name
from vigil.llm.html_blocks import Block, blocks_of
from vigil.llm.html_pages import labelled_page

PATH_SIZE, WORD_SIZE, SHARES = 256, 32, 6
INPUT = PATH_SIZE + WORD_SIZE + SHARES
HIDDEN = 16

#: Made-up pages that the model is trained on, and rounds over them.
TRAIN_PAGES, ROUNDS, BATCH = 1200, 12, 60

#: Most blocks in a batch at prediction; a longer page is a batch of its own.
BATCH_BLOCKS = 20_000


@lru_cache(maxsize=4096)
def _path_slots(path: tuple[str, ...]) -> tuple[int, ...]:
    """Slots of the names on a path, and one more for the tag at its end."""
    names = {crc32(w.encode()) % PATH_SIZE for label in path for w in label.split()}
    end = (crc32(("leaf " + path[-1].split()[0]).encode()) % PATH_SIZE,) if path else ()
    return (*sorted(names), *end)


def features(blocks: list[Block]) -> np.ndarray:
    """(blocks, INPUT) vectors."""
    x = np.zeros((len(blocks), INPUT), np.float32)
    for i, b in enumerate(blocks):
        for k in _path_slots(b.path):
            x[i, k] += 1.0
        words = b.text.lower().encode().split()
        slots = np.fromiter(map(crc32, words), np.uint32, len(words)) % WORD_SIZE
        count = np.bincount(slots, minlength=WORD_SIZE)
        x[i, PATH_SIZE:PATH_SIZE + WORD_SIZE] = count / math.sqrt(float(count @ count))
        n = len(b.text)
        x[i, PATH_SIZE + WORD_SIZE:] = (
            math.log1p(n) / 6, math.log1p(len(words)) / 4, min(1.0, b.linked / n),
            sum(map(b.text.count, ".,;:!?")) / (1 + len(words)), (i + 1) / len(blocks), 1.0)
    return x


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Direction:
    """One LSTM layer over padded sequences (time, batch, input)."""

    def __init__(self, rng: np.random.Generator, backward: bool):
        self.wx = rng.normal(0, 1 / math.sqrt(INPUT), (INPUT, 4 * HIDDEN)).astype(np.float32)
        self.wh = rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1.0  # forget gate
        self.backward = backward

    def weights(self):
        return [self.wx, self.wh, self.b]

    def steps(self, n: int):
        return range(n - 1, -1, -1) if self.backward else range(n)

    def run(self, x, mask, keep=False):
        n, batch, _ = x.shape
        z_in = x @ self.wx + self.b
        h = np.zeros((batch, HIDDEN), np.float32)
        c = np.zeros((batch, HIDDEN), np.float32)
        out = np.zeros((n, batch, HIDDEN), np.float32)
        memory = {}
        for t in self.steps(n):
            z = z_in[t] + h @ self.wh
            i, f = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN:2 * HIDDEN])
            g, o = np.tanh(z[:, 2 * HIDDEN:3 * HIDDEN]), _sigmoid(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            if keep:
                memory[t] = (h, c, i, f, g, o, tc)
            h, c = m * (o * tc) + (1 - m) * h, m * c_new + (1 - m) * c
            out[t] = h
        return out, memory

    def grads(self, x, mask, memory, d_out):
        n, batch, _ = x.shape
        dz_all = np.zeros((n, batch, 4 * HIDDEN), np.float32)
        d_wh = np.zeros_like(self.wh)
        dh = np.zeros((batch, HIDDEN), np.float32)
        dc = np.zeros((batch, HIDDEN), np.float32)
        for t in reversed(self.steps(n)):
            h, c, i, f, g, o, tc = memory[t]
            m = mask[t][:, None]
            dh_all = dh + d_out[t]
            dh_new, dh_skip = m * dh_all, (1 - m) * dh_all
            dc_new = m * dc + dh_new * o * (1 - tc * tc)
            dz = np.concatenate([dc_new * g * i * (1 - i), dc_new * c * f * (1 - f),
                                 dc_new * i * (1 - g * g), dh_new * tc * o * (1 - o)], axis=1)
            dz_all[t] = dz
            d_wh += h.T @ dz
            dh = dz @ self.wh.T + dh_skip
            dc = dc_new * f + (1 - m) * dc
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        return [x.reshape(-1, INPUT).T @ flat, d_wh, flat.sum(axis=0)]


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = max(len(p) for p in pages)
    x = np.zeros((n, len(pages), INPUT), np.float32)
    mask = np.zeros((n, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, 1.0
    return x, mask


class Labeller:
    """Bidirectional LSTM and a logistic output per block."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.layers = [Direction(rng, False), Direction(rng, True)]
        self.w = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def weights(self):
        return [w for layer in self.layers for w in layer.weights()] + [self.w, self.bias]

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of main text for each block of each page."""
        x, mask = padded(pages)
        h = np.concatenate([layer.run(x, mask)[0] for layer in self.layers], axis=2)
        p = _sigmoid(h @ self.w + self.bias[0])
        return [p[:len(page), k] for k, page in enumerate(pages)]

    def loss_grads(self, pages: list[np.ndarray], labels: list[np.ndarray]):
        x, mask = padded(pages)
        y = np.zeros_like(mask)
        for k, v in enumerate(labels):
            y[:len(v), k] = v
        runs = [layer.run(x, mask, keep=True) for layer in self.layers]
        h = np.concatenate([out for out, _ in runs], axis=2)
        p = _sigmoid(h @ self.w + self.bias[0])
        d = (p - y) * mask / mask.sum()
        loss = -np.sum(mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))) / mask.sum()
        dh = d[:, :, None] * self.w
        grads = []
        for k, (layer, (_, memory)) in enumerate(zip(self.layers, runs)):
            grads += layer.grads(x, mask, memory, dh[:, :, k * HIDDEN:(k + 1) * HIDDEN])
        grads += [np.tensordot(d, h, ([0, 1], [0, 1])), np.array([d.sum()], np.float32)]
        return loss, grads

    def fit(self, pages, labels, rounds: int = ROUNDS, batch: int = BATCH, rate: float = 0.02,
            seed: int = 7):
        """Adam; pages of like length share a batch."""
        rng = random.Random(seed)
        first = [np.zeros_like(w) for w in self.weights()]
        second = [np.zeros_like(w) for w in self.weights()]
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        batches = [order[k:k + batch] for k in range(0, len(order), batch)]
        step = 0
        for r in range(rounds):
            rng.shuffle(batches)
            now = rate * (1 - r / rounds)
            for b in batches:
                _, grads = self.loss_grads([pages[k] for k in b], [labels[k] for k in b])
                step += 1
                scale = min(1.0, 1.0 / (1e-9 + math.sqrt(sum(float((g * g).sum()) for g in grads))))
                for w, g, m, v in zip(self.weights(), grads, first, second):
                    g = g * scale
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return self


def labelled_sample(n: int, seed: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors and labels of ``n`` made-up pages; cut-off texts count as main
    text only inside an article."""
    rng = random.Random(seed)
    pages, labels = [], []
    while len(pages) < n:
        html, known = labelled_page(rng)
        blocks = blocks_of(html)
        got = [known.get(b.text) for b in blocks]
        if not blocks or any(v is None for v in got[:-1]):
            continue
        if got[-1] is None:  # cut off: as the text that begins so
            begun = [v for t, v in known.items() if t.startswith(blocks[-1].text[:-6] or " ")]
            got[-1] = begun[0] if begun else 0
        pages.append(features(blocks))
        labels.append(np.array(got, np.float32))
    return pages, labels


_TRAINED: dict[tuple, Labeller] = {}


def trained(pages: int = TRAIN_PAGES, rounds: int = ROUNDS, seed: int = 7) -> Labeller:
    key = (pages, rounds, seed)
    if key not in _TRAINED:
        _TRAINED[key] = Labeller(seed).fit(*labelled_sample(pages, seed), rounds=rounds, seed=seed)
    return _TRAINED[key]


def main_texts(htmls: list[str], model: Labeller, level: float = 0.5) -> list[str]:
    """Main text of each page."""
    parsed = [blocks_of(h) for h in htmls]
    texts = [""] * len(htmls)
    order = sorted((k for k, b in enumerate(parsed) if b), key=lambda k: len(parsed[k]))
    while order:
        # the longest that are left, as many as fit in a batch
        longest = len(parsed[order[-1]])
        batch = [order.pop() for _ in range(min(len(order), max(1, BATCH_BLOCKS // longest)))]
        for k, p in zip(batch, model.predict([features(parsed[k]) for k in batch])):
            texts[k] = " ".join(b.text for b, keep in zip(parsed[k], p >= level) if keep)
    return texts


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
            model: Labeller | None = None, name: str = "text") -> DataFrame:
    """The columns of ``keep`` and the main text of each row."""
    model = model or trained()
    body = new_name(pages, "body")
    narrow = pages.select(*keep, F.coalesce(F.col(html), F.lit("")).alias(body))
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = 512
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                texts = main_texts(part.column(n).to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(texts, pa.string())], [*keep, name])

    return narrow.mapInArrow(run, narrow.select(*keep).schema.add(name, "string"))

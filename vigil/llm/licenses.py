"""Licence scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a run of non-blank lines, so that a notice may be wrapped.  Every
paragraph is read in windows of ``SIZES`` words that start at each of its words.
A window is a sparse vector of word n-grams up to three words; a multinomial
logistic regression in numpy gives the probability of each licence family and of
an ``unknown`` class.  No text is passed over: prefix sums of the n-gram weights
score all windows of a text.

The temperature and the level above which a family is predicted are fitted on
sentences worded otherwise than the templates that the model is trained on; every
other one of those sentences is kept for ``reliability``.

Where windows predict a family, templates of that family are compared: a notice
is confirmed where ``CONFIRM`` of the word pairs of a template stand within twice
its length, else within ``WINDOW`` words, and no negation stands before it in the
sentence.  Of confirmed notices of different families that share words the best
confirmed one counts; all others are notices of their own.  What is predicted and
not confirmed stays ``unknown``.

The model is trained on the driver, once per process, on ``EXAMPLES`` variations
of each template, as many sentences without a licence for each, and pieces of
templates that are too short to say what they belong to.

Defined cases: a null or empty text has no paragraph, the licence ``unknown`` and
probability 1; without a notice the probability is that of ``unknown`` in the
window that is least so; ``n_paragraphs`` counts non-blank lines; a blank line ends
a notice; ties between families go to the more probable, then by name; repeated
rows are judged alike; long texts are read whole; an empty table gives no rows;
other columns of the input do no harm.
"""

from __future__ import annotations

import math
import random
import re
from array import array
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import text_or_empty

#: Short notices by family, as they are usually worded.
TEMPLATES = {
    "mit": ("released under the mit license", "licensed under the mit license",
            "the mit license mit", "spdx license identifier mit",
            "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files",
            "the software is provided as is without warranty of any kind express or implied"),
    "apache": ("licensed under the apache license version 2.0",
               "you may not use this file except in compliance with the license",
               "distributed under the apache license 2.0", "spdx license identifier apache 2.0"),
    "gpl": ("this work is licensed under the gnu general public license version 3",
            "this program is free software you can redistribute it and or modify it under the terms "
            "of the gnu general public license",
            "under the terms of the gnu general public license",
            "licensed under the gnu general public license",
            "released under the gnu gpl license", "licensed under the gplv3", "licensed under the gplv2",
            "spdx license identifier gpl 2.0", "spdx license identifier gpl 3.0"),
    "agpl": ("under the terms of the gnu affero general public license",
             "licensed under the gnu affero general public license version 3",
             "spdx license identifier agpl 3.0"),
    "lgpl": ("licensed under the gnu lesser general public license version 2.1",
             "under the terms of the gnu lesser general public license",
             "spdx license identifier lgpl 2.1", "spdx license identifier lgpl 3.0"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met copyright",
            "neither the name of the copyright holder nor the names of its contributors may be used "
            "to endorse or promote products derived from this software",
            "released under the bsd license", "licensed under the 3 clause bsd license",
            "spdx license identifier bsd 2 clause", "spdx license identifier bsd 3 clause"),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted", "licensed under the isc license",
            "spdx license identifier isc"),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2.0",
            "licensed under the mozilla public license 2.0", "spdx license identifier mpl 2.0"),
    "cc_by": ("cc by 4.0", "licensed under cc by 4.0",
              "this work is licensed under a creative commons attribution 4.0 international license"),
    "cc_by_sa": ("cc by sa 4.0", "licensed under cc by sa 4.0",
                 "this work is licensed under a creative commons attribution sharealike 4.0 "
                 "international license"),
    "cc_by_nc": ("cc by nc 4.0", "licensed under cc by nc 4.0",
                 "this work is licensed under a creative commons attribution noncommercial 4.0 "
                 "international license"),
    "cc_by_nd": ("cc by nd 4.0", "licensed under cc by nd 4.0",
                 "this work is licensed under a creative commons attribution noderivatives 4.0 "
                 "international license"),
    "cc_by_nc_sa": ("cc by nc sa 4.0", "licensed under cc by nc sa 4.0",
                    "this work is licensed under a creative commons attribution noncommercial "
                    "sharealike 4.0 international license"),
    "cc_by_nc_nd": ("cc by nc nd 4.0", "licensed under cc by nc nd 4.0",
                    "this work is licensed under a creative commons attribution noncommercial "
                    "noderivatives 4.0 international license"),
    "public_domain": ("cc0 1.0", "this work is dedicated to the public domain cc0 1.0 universal license",
                      "the author has waived all copyright and placed this work in the public domain"),
    "all_rights": ("all rights reserved", "copyright all rights reserved",
                   "no part of this work may be copied without written permission all rights reserved"),
}
UNKNOWN = "unknown"
FAMILIES = (*sorted(TEMPLATES), UNKNOWN)

#: Sentences without a licence: frames and words to fill them with.
_FRAMES = (
    "the driver lost a license after the test", "she asked for permission to leave early",
    "a license to sell food is issued by the town", "he holds a fishing license and a permit",
    "the public library opens at nine", "the warranty of the washing machine ends next year",
    "they were granted a hearing in public", "students of mit built a small robot",
    "an apache helicopter flew over the valley", "the license plate was hard to read",
    "general information for the public", "copyright law was the subject of the lecture",
    "version 3 of the report came out in may", "the work was finished without any help",
    "creative people make common things new", "terms and conditions of the lottery apply")
_FILLERS = ("and then the people went to the old house by the river and it was cold in that winter of "
            "long roads with many small stones for all who came from the north at night on foot").split()

#: Sentences that calibrate: families in other words than the templates', and texts
#: about licences, permission and rights that grant nothing.
WORDED = (
    ("mit", "you can use this code under the terms of the mit license"),
    ("mit", "this library is available under an mit license"),
    ("mit", "see the license file for the full text of the mit license"),
    ("mit", "code is mit licensed and the mit license applies to all files"),
    ("apache", "the project uses the apache license version 2.0 for all of its code"),
    ("apache", "contributions are accepted under the apache license version 2.0"),
    ("apache", "available under apache license 2.0"),
    ("apache", "this file falls under the apache license 2.0 of the foundation"),
    ("gpl", "distributed under the gnu general public license as published by the foundation"),
    ("gpl", "covered by version 2 of the gnu general public license"),
    ("gpl", "you may copy it under the gnu general public license"),
    ("gpl", "this package is free software under the gnu gpl license"),
    ("lgpl", "this library falls under the gnu lesser general public license"),
    ("lgpl", "link with it as the gnu lesser general public license version 2.1 allows"),
    ("agpl", "the server is published under the gnu affero general public license"),
    ("agpl", "see the gnu affero general public license version 3 for details"),
    ("bsd", "use is governed by the 3 clause bsd license"),
    ("bsd", "available under the bsd license of the university"),
    ("isc", "this tool comes with the isc license"),
    ("isc", "you can copy it under the isc license"),
    ("mpl", "files are covered by the mozilla public license 2.0"),
    ("mpl", "subject to the mozilla public license v 2.0"),
    ("cc_by", "text of this page is under cc by 4.0"),
    ("cc_by", "shared as creative commons attribution 4.0 international"),
    ("cc_by_sa", "text of this page is under cc by sa 4.0"),
    ("cc_by_sa", "shared as creative commons attribution sharealike 4.0 international"),
    ("cc_by_nc", "text of this page is under cc by nc 4.0"),
    ("cc_by_nc", "shared as creative commons attribution noncommercial 4.0 international"),
    ("public_domain", "the author placed this text in the public domain with cc0 1.0"),
    ("public_domain", "dedicated to the public domain as cc0 1.0 universal says"),
    ("all_rights", "all rights reserved by the publisher"),
    ("all_rights", "copyright of the company with all rights reserved"),
    *(("unknown", text) for text in (
        "the driver showed his license to the officer", "a license to fish costs ten dollars",
        "public records are kept in the town hall", "the terms of the contract were hard to read",
        "the general asked the public for help", "software helps people to write letters",
        "permission to enter the building was granted by the owner",
        "the bus company reserved all seats for the children", "rights of workers were discussed",
        "the apache people lived in the south west", "students at mit wrote a paper about birds",
        "version 2 of the game will be released in june", "the work is done and the source is clear",
        "this work was published by a small house in the city", "the library has a copy of the book",
        "international trade grew by 4.0 percent", "use the door at the back of the house",
        "the mozilla browser is fast", "the warranty covers any person who bought the car",
        "he was free to go under the bridge", "creative people have things in common",
        "domain names are sold by the year", "the author has a house by the sea",
        "conditions on the road were bad", "a copyright claim was made in court",
        "attribution of the painting is under dispute", "the software industry in the city grew",
        "in compliance with the rules of the club", "no part of the town was left without light",
        "the clause in the contract was removed", "the universal church stands in the old square",
        "see the file for the list of members", "all people reserved a table for the night",
        "the foundation gave money to the public school")))

#: Examples of each template, the longest notice, the needed share of pairs, and the
#: windows; words read at once, and words around a prediction that are compared.
EXAMPLES, WINDOW, CONFIRM = 40, 80, 0.7
SIZES = (4, 8, 16, 32, 64)
READ, AROUND = 1 << 13, 16

#: Words that deny what follows them, and how many words before a notice are read.
_DENIES, _BEFORE = {"not", "never", "no", "nor", "cannot", "isn", "wasn", "aren"}, 4
_PAUSE = re.compile(r"[.,;:!?()]")

_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: What closes a notice, and runs of non-blank lines.
_CLOSING = re.compile(r"[^\w\s]*")
_BLOCK = re.compile(r"\S[^\n]*(?:\n[^\S\n]*+\S[^\n]*)*+")


def lowered(text: str) -> str:
    """Lower case of the same length: only one letter has a longer one."""
    return text.replace("\u0130", "I").lower()


def words_in(text: str) -> list[str]:
    return _WORD.findall(lowered(text))


def grams(words: list[str]) -> list[str]:
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def pairs(words: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:])} or set(words)


def needed(template: str) -> int:
    """Pairs of a template that confirm it."""
    return math.ceil(CONFIRM * len(pairs(template.split())) - 1e-9)


def examples(n: int = EXAMPLES, seed: int = 3) -> list[tuple[list[str], int]]:
    """(words, class): templates with words around or left out, as far as they
    are still confirmed best by their own family; frames with fillers and single words
    of templates; and short pieces of templates, which are unknown."""
    rng = random.Random(seed)
    noise = lambda k: [rng.choice(_FILLERS) for _ in range(rng.randint(0, k))]
    every = [(f, pairs(t.split()), t.split()) for f, ts in TEMPLATES.items() for t in ts]
    out = []
    for k, family in enumerate(FAMILIES[:-1] if FAMILIES[-1] == UNKNOWN else FAMILIES):
        for template in TEMPLATES[family]:
            plain = template.split()
            for _ in range(n):
                kept = [w for w in plain if rng.random() > 0.05]
                had = pairs(kept)
                share = len(had & pairs(plain)) / len(pairs(plain))
                if share < CONFIRM or any(f != family and len(had & t) >= share * len(t)
                                          for f, t, _ in every):
                    kept = plain  # what is left may be another family's notice
                out.append((noise(8) + kept + noise(8), k))
    words = sorted({w for ts in TEMPLATES.values() for t in ts for w in t.split()})
    for _ in range(len(out)):
        frame = rng.choice(_FRAMES).split()
        for _ in range(rng.randint(0, 4)):
            frame.insert(rng.randint(0, len(frame)), rng.choice(words))
        out.append((noise(10) + frame + noise(20), len(FAMILIES) - 1))
    for _ in range(len(out) // 2):
        # pieces too short to be a notice
        plain = rng.choice(every)[2]
        size = rng.randint(1, max(1, int(0.4 * len(plain))))
        a = rng.randint(0, len(plain) - size)
        out.append((noise(6) + plain[a:a + size] + noise(6), len(FAMILIES) - 1))
    rng.shuffle(out)
    return out


def worded(part: int, n: int = 12, seed: int = 5) -> list[tuple[list[str], int]]:
    """(words, class) of every other sentence of ``WORDED``, with words around."""
    rng = random.Random(seed + part)
    noise = lambda k: [rng.choice(_FILLERS) for _ in range(rng.randint(0, k))]
    return [(noise(6) + text.split() + noise(6), FAMILIES.index(family))
            for family, text in WORDED[part::2] for _ in range(n)]


class LicenseModel:
    """Sparse n-gram weights, a temperature and a level for predictions."""

    def __init__(self, seed: int = 3, rounds: int = 200, precision: float = 0.995):
        data = examples(seed=seed)
        cut = len(data) * 4 // 5
        train, held = data[:cut], data[cut:]
        seen = Counter(g for words, _ in train for g in set(grams(words)))
        self.slots = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n >= 4), 1)}
        self._number_grams()
        # row 0 is that of n-grams without a slot, the last one the intercept
        self.w = np.zeros((len(self.slots) + 2, len(FAMILIES)), np.float32)
        rows, starts, norm = self._sparse([w for w, _ in train])
        truth = np.eye(len(FAMILIES), dtype=np.float32)[[k for _, k in train]]
        example = np.repeat(np.arange(len(train)), np.diff([*starts, len(rows)]))
        by_row = np.argsort(rows, kind="stable")
        first = np.flatnonzero(np.diff(rows[by_row], prepend=-1))
        m, v = np.zeros_like(self.w), np.zeros_like(self.w)
        for t in range(1, rounds + 1):
            p = self._softmax(np.add.reduceat(self.w[rows], starts) / norm)
            error = ((p - truth) / norm / len(train))[example[by_row]]
            g = 1e-4 * self.w
            g[rows[by_row][first]] += np.add.reduceat(error, first)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        self.temperature = 1.0
        p, right = self._judged(held)
        self.held_out_accuracy = float((p.argmax(axis=1) == right).mean())
        scores, right = self._judged(worded(0), raw=True)
        nll = lambda s: -np.log(self._softmax(scores / s)[np.arange(len(right)), right]
                                + 1e-9).mean()
        self.temperature = min((2.0 ** (k / 4) for k in range(-12, 13)), key=nll)
        p = self._softmax(scores / self.temperature)
        best, sure = p[:, :-1].argmax(axis=1), p[:, :-1].max(axis=1)
        self.level = 0.99
        for level in (0.5, 0.6, 0.7, 0.8, 0.9, 0.95):
            taken = sure >= level
            if taken.any() and (best[taken] == right[taken]).mean() >= precision:
                self.level = level
                break
        self.measures = {t: (f, len(pairs(t.split())), len(t.split()))
                         for f, ts in TEMPLATES.items() for t in ts}
        self.by_pair: dict[tuple, list[str]] = {}
        for t in self.measures:
            for pair in pairs(t.split()):
                self.by_pair.setdefault(tuple(pair.split()), []).append(t)

    def _number_grams(self):
        """Words as numbers, and n-grams as sorted codes with their slots."""
        self.words = {w: i for i, w in enumerate(sorted({w for g in self.slots for w in g.split()}), 1)}
        base = len(self.words) + 1
        self.base, self.codes = base, []
        for n in (1, 2, 3):
            coded = sorted((sum(self.words[w] * base ** i for i, w in enumerate(reversed(g.split()))), k)
                           for g, k in self.slots.items() if g.count(" ") == n - 1)
            self.codes.append((np.array([c for c, _ in coded], np.int64),
                               np.array([k for _, k in coded], np.int64)))

    def _sparse(self, texts: list[list[str]]):
        """Rows of all texts' n-grams and the intercept, where each text starts, and
        the length that its vector is divided by."""
        lists = [[*(self.slots[g] for g in grams(w) if g in self.slots), len(self.slots) + 1]
                 for w in texts]
        sizes = np.array([len(x) for x in lists])
        return (np.concatenate([np.array(x) for x in lists]), np.cumsum(sizes) - sizes,
                np.sqrt(sizes)[:, None].astype(np.float32))

    def _judged(self, data, raw: bool = False):
        rows, starts, norm = self._sparse([w for w, _ in data])
        z = np.add.reduceat(self.w[rows], starts) / norm
        return z if raw else self._softmax(z / self.temperature), np.array([k for _, k in data])

    @staticmethod
    def _softmax(z):
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def predict(self, words: list[str]) -> tuple[str, float]:
        """Family (or unknown) and its probability."""
        p = self._judged([(words, 0)])[0][0]
        k = int(p[:-1].argmax())
        return (FAMILIES[k], float(p[k])) if p[k] >= self.level else (UNKNOWN, float(p[-1]))

    def reliability(self) -> list[tuple[float, float, int, float, float]]:
        """(from, to, sentences, mean probability, share right) of the most probable
        class, on the sentences that took no part in the calibration."""
        p, right = self._judged(worded(1))
        best, sure = p.argmax(axis=1), p.max(axis=1)
        bins = [(a, b, (sure >= a) & (sure < b)) for a, b in
                ((0.0, 0.5), (0.5, 0.7), (0.7, 0.9), (0.9, 0.97), (0.97, 1.01))]
        return [(a, b, int(x.sum()), float(sure[x].mean()), float((best[x] == right[x]).mean()))
                for a, b, x in bins if x.any()]

    def _gram_rows(self, ids: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Row of the n-gram that starts at each word, for n = 1, 2, 3."""
        out, code, at = [], np.zeros(len(ids), np.int64), np.arange(len(ids))
        whole = np.ones(len(ids), bool)
        for n, (codes, slots) in enumerate(self.codes):
            word = np.zeros(len(ids), np.int64)
            word[:len(ids) - n] = ids[n:]
            whole = whole & (word > 0) & (at + n < ends)
            code = code * self.base + word
            rows = np.zeros(len(ids), np.int64)
            if len(codes):
                some = np.flatnonzero(whole)
                place = np.minimum(np.searchsorted(codes, code[some]), len(codes) - 1)
                rows[some] = np.where(codes[place] == code[some], slots[place], 0)
            out.append(rows)
        return out

    def windows(self, ids: np.ndarray, ends: np.ndarray):
        """Score the windows of all sizes from every word.  ``ends`` holds for each
        word where its paragraph ends.  Yields (starts, ends, families, probabilities)
        of the windows that predict a family, and for every word the least probability
        of ``unknown`` as (first word, array)."""
        turned = np.ascontiguousarray(self.w.T)
        for a in range(0, len(ids), READ):
            n = min(READ, len(ids) - a)
            b = min(len(ids), a + n + max(SIZES))
            stop = np.minimum(ends[a:b] - a, b - a)
            one, two, three = self._gram_rows(ids[a:b], stop)
            # sums (classes by words) of the n-grams that start before a word, and of
            # those of them that end before it, which a window up to there holds
            begun = np.zeros((len(FAMILIES), len(one) + 1))
            np.cumsum(turned[:, one] + turned[:, two] + turned[:, three], axis=1, out=begun[:, 1:])
            ended = begun.copy()
            ended[:, 1:] -= turned[:, two] + turned[:, three]
            ended[:, 2:] -= turned[:, three[:-1]]
            many = np.concatenate([[0], np.cumsum((one > 0) * 1 + (two > 0) + (three > 0))])
            whole = many.copy()
            whole[1:] -= (two > 0) * 1 + (three > 0)
            whole[2:] -= three[:-1] > 0
            before = begun[:, :n] - turned[:, -1:]
            start = np.arange(n)
            least = np.ones(n, np.float32)
            found = []
            for size in SIZES:
                end = np.minimum(start + size, stop[:n])
                z = (ended[:, end] - before).astype(np.float32)
                z /= (np.sqrt(whole[end] - many[:n] + 1) * self.temperature).astype(np.float32)
                z -= z.max(axis=0)
                np.exp(z, out=z)
                z /= z.sum(axis=0)
                np.minimum(least, z[-1], out=least)
                # a predicted family has at least the level, so unknown at most the rest
                maybe = np.flatnonzero(z[-1] < 1 - self.level + 1e-6)
                some = z[:-1, maybe]
                best, sure = some.argmax(axis=0), some.max(axis=0)
                said = sure >= self.level
                at = maybe[said]
                found.append((a + at, a + end[at], best[said], sure[said]))
            yield tuple(np.concatenate(x) for x in zip(*found)), (a, least)

    def aligned(self, words: list[str], said: str) -> list[tuple]:
        """(loose, -share, -pairs, family, from, to) of the windows that a template
        of the family ``said`` confirms; those of one template do not overlap."""
        at: dict[str, list[int]] = {}
        for i, pair in enumerate(zip(words, words[1:])):
            for template in self.by_pair.get(pair, ()):
                if self.measures[template][0] == said:
                    at.setdefault(template, []).append(i)
        out = []
        for template, hits in at.items():
            family, every, length = self.measures[template]
            if len({(words[i], words[i + 1]) for i in hits}) < needed(template):
                continue
            taken = bytearray(len(words))
            for loose, limit in enumerate((2 * length, WINDOW)):
                for want in range(every, needed(template) - 1, -1):
                    held: deque = deque()
                    seen: Counter = Counter()
                    for i in hits:
                        if taken[i] or taken[i + 1]:
                            held.clear()
                            seen.clear()
                            continue
                        held.append(i)
                        seen[words[i], words[i + 1]] += 1
                        while held[-1] - held[0] + 2 > limit or (
                                seen[words[held[0]], words[held[0] + 1]] > 1):
                            first = words[held[0]], words[held[0] + 1]
                            seen[first] -= 1
                            if not seen[first]:
                                del seen[first]
                            held.popleft()
                        if len(seen) >= want:
                            a, b = held[0], i + 2
                            out.append((loose, -want / every, -want, family, a, b))
                            taken[a:b] = b"\1" * (b - a)
                            held.clear()
                            seen.clear()
        return out

    def read(self, texts: list[str]) -> list[tuple[list[tuple], float]]:
        """Per text its notices (family, probability, similarity, start, end) in order,
        and the least probability of ``unknown``; a notice ends with the signs that
        follow its last word.  The windows of all texts are scored together."""
        lows = [lowered(t) for t in texts]
        ids, ends, paragraphs, first = array("i"), array("q"), [], []
        for k, low in enumerate(lows):
            first.append(len(ids))
            for block in _BLOCK.finditer(low):
                words = _WORD.findall(low, block.start(), block.end())
                if words:
                    paragraphs.append((len(ids), k, block.start(), block.end()))
                    ids.extend(self.words.get(w, 0) for w in words)
                    ends.extend([len(ids)] * len(words))
        out = [([], 1.0) for _ in texts]
        if not ids:
            return out
        starts = np.array([p[0] for p in paragraphs])
        least = np.ones(len(ids))
        said: dict[int, list[tuple]] = {}
        for (a, b, family, p), (at, some) in self.windows(np.frombuffer(ids, np.int32),
                                                          np.frombuffer(ends, np.int64)):
            least[at:at + len(some)] = some
            where = np.searchsorted(starts, a, side="right") - 1
            for w, *window in zip(where.tolist(), (a - starts[where]).tolist(),
                                  (b - starts[where]).tolist(), family.tolist(), p.tolist()):
                said.setdefault(w, []).append(tuple(window))
        for w, windows in sorted(said.items()):
            _, k, a, b = paragraphs[w]
            out[k][0].extend(self._confirmed(lows[k], a, b, windows))
        cuts = np.array(first)
        for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)])):
            if b > a:
                out[k] = (sorted(out[k][0], key=lambda f: (f[3], f[4])), float(least[a:b].min()))
        return out

    def _confirmed(self, low: str, start: int, end: int, windows: list[tuple]) -> list[tuple]:
        """Notices of one paragraph where templates agree with its predictions."""
        places = list(_WORD.finditer(low, start, end))
        words = [w[0] for w in places]
        found = []
        for family in {w[2] for w in windows}:
            mine = sorted(w for w in windows if w[2] == family)
            regions: list[list] = []
            for a, b, _, p in mine:
                a, b = max(0, a - AROUND), min(len(words), b + AROUND)
                if regions and a <= regions[-1][1]:
                    regions[-1][1] = max(regions[-1][1], b)
                    regions[-1][2] = max(regions[-1][2], p)
                else:
                    regions.append([a, b, p])
            for a, b, p in regions:
                found += [(*x[:4], a + x[4], a + x[5], p)
                          for x in self.aligned(words[a:b], FAMILIES[family])]
        owned = bytearray(len(words))
        out = []
        for _, share, _, family, a, b, p in sorted(found):
            if any(owned[a:b]) or self._denied(low, places, a):
                continue
            owned[a:b] = b"\1" * (b - a)
            stop = _CLOSING.match(low, places[b - 1].end(), end).end()
            out.append((family, p, -share, places[a].start(), stop))
        return out

    @staticmethod
    def _denied(low: str, places: list, a: int) -> bool:
        return any(w[0] in _DENIES and not _PAUSE.search(low, w.end(), places[a].start())
                   for w in places[max(0, a - _BEFORE):a])

    def notices(self, text: str) -> list[tuple[str, float, float, int, int]]:
        return self.read([text])[0][0]

    def judge(self, text: str) -> tuple[str, float, float] | None:
        """Family, probability and similarity of the most probable notice."""
        return max((f[:3] for f in self.notices(text)), key=lambda f: (f[1], f[0]), default=None)


_TRAINED: list[LicenseModel] = []


def trained() -> LicenseModel:
    if not _TRAINED:
        _TRAINED.append(LicenseModel())
    return _TRAINED[0]


SCHEMA = ("doc_id long, n_paragraphs long, n_licensed long, license string, probability double, "
          "similarity double, families string, spans string")


def scan_licenses(docs: DataFrame, model: LicenseModel | None = None, text: str = "text",
                  doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its paragraphs, the confirmed notices, the most
    probable licence, all families found, and family:start:end (code points) of
    each notice found."""
    model = model or trained()
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(),
             pa.string(), pa.string()]

    def row(text: str, found: list[tuple], unknown: float) -> tuple:
        n = sum(1 for line in text.split("\n") if line and not line.isspace())
        best = max(found, key=lambda f: (f[1], f[0]), default=(UNKNOWN, unknown, None))
        return (n, len(found), *best[:3], ",".join(sorted({f[0] for f in found})),
                ",".join(f"{f[0]}:{f[3]}:{f[4]}" for f in found))

    def parts(texts: list[str]) -> Iterator[list[str]]:
        """Texts read together: about a million characters, or one longer text."""
        some, size = [], 0
        for text in texts:
            if some and size + len(text) > 1_000_000:
                yield some
                some, size = [], 0
            some.append(text)
            size += len(text)
        if some:
            yield some

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(t, *got) for part in parts(batch.column(1).to_pylist())
                    for t, got in zip(part, model.read(part))]
            columns = list(zip(*rows)) or [()] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds[1:])]], names)

    return docs.select(F.col(doc_id).cast("long"), text_or_empty(F.col(text))).mapInArrow(run, SCHEMA)

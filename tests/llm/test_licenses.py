import numpy as np

from vigil.llm import licenses


def test_held_out_accuracy():
    assert licenses.trained().held_out_accuracy >= 0.97


def test_paragraphs():
    model = licenses.trained()
    for text, family in (("Licensed under CC BY-NC 4.0.", "cc_by_nc"),
                         ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
                         ("Licensed under the Apache License, Version 2.0.", "apache"),
                         ("Released under the MIT License.", "mit"),
                         ("RELEASED  under the mit license", "mit")):
        assert model.judge(text)[0] == family
    for text in ("He lost his driver's license in the town.", "Copyright law is old.", "",
                 "She studied at MIT and asked for permission.", "The license", "plain words"):
        assert model.judge(text) is None


def test_long_paragraph_is_read_in_windows():
    filler = "the people went by the river on foot " * 60
    got = licenses.trained().judge(filler + "Released under the MIT License. " + filler)
    assert got and got[0] == "mit"


def test_scan(docs_of, odd_rows):
    rows = odd_rows + [(50, "é line\n\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.", "", ""),
                       (51, "Released under the MIT License.", "", "")]
    got = licenses.scan_licenses(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    r = by[50]
    assert (r.n_paragraphs, r.n_licensed, r.families) == (3, 2, "cc_by_nc,mit")
    assert "mit:8:39" in r.spans.split(",")
    assert (by[51].license, by[51].n_licensed) == ("mit", 1)
    assert all(x.license == "unknown" and x.n_licensed == 0 and x.spans == ""
               for x in got if x.doc_id not in (50, 51))
    assert by[1].n_paragraphs == by[2].n_paragraphs == 0
    assert licenses.scan_licenses(docs_of([])).count() == 0


def test_notices_without_the_word_license():
    model = licenses.trained()
    for text, family in (("All rights reserved.", "all_rights"),
                         ("Copyright (c) 2024 X. All rights reserved.", "all_rights"),
                         ("CC BY-SA 4.0", "cc_by_sa"), ("CC BY 4.0", "cc_by"),
                         ("CC BY-NC 4.0", "cc_by_nc"), ("CC0 1.0", "public_domain")):
        got = model.judge(text)
        assert got and got[0] == family, text


def test_windows_score_as_the_model_does():
    model = licenses.trained()
    words = licenses.words_in("the town hall is old and this code is released under the mit license for "
                              "all who came cc by 4.0 in the winter of long roads " * 3)
    ids = np.array([model.words.get(w, 0) for w in words], np.int32)
    ends = np.where(np.arange(len(words)) < 30, 30, len(words))
    got = {}
    for (a, b, family, p), _ in model.windows(ids, ends):
        got.update(zip(zip(a.tolist(), b.tolist()), zip(family.tolist(), p.tolist())))
    want = {}
    for i in range(len(words)):
        for size in licenses.SIZES:
            e = min(i + size, int(ends[i]))
            family, p = model.predict(words[i:e])
            if family != licenses.UNKNOWN:
                want[i, e] = licenses.FAMILIES.index(family), p
    assert got.keys() == want.keys() and got
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-4 for k in want)


def test_pieces_of_a_long_text_and_texts_read_together(monkeypatch):
    model = licenses.trained()
    filler = "the people went by the river on foot " * 9
    texts = [filler + "Released under the MIT License. " + filler, "", "CC BY-SA 4.0\n\nplain",
             (filler + "Licensed under the Apache License, Version 2.0. ") * 5]
    whole = [model.read([t])[0] for t in texts]
    for read in (7, 64, 1 << 15):
        monkeypatch.setattr(licenses, "READ", read)
        for (a, p), (b, q) in zip(model.read(texts), whole):
            assert a == b and abs(p - q) < 1e-6
    assert [len(n) for n, _ in whole] == [1, 0, 1, 5]


def test_more_families_and_what_is_denied():
    model = licenses.trained()
    for text, family in (("SPDX-License-Identifier: MIT", "mit"), ("The MIT License (MIT)", "mit"),
                         ("// SPDX-License-Identifier: Apache-2.0", "apache"),
                         ("Licensed under the GPLv3.", "gpl"), ("CC BY-ND 4.0", "cc_by_nd"),
                         ("CC BY-NC-SA 4.0", "cc_by_nc_sa"),
                         ("under the terms of the GNU Affero General Public License", "agpl"),
                         ("Permission to use, copy, modify, and/or distribute this software for any\n"
                          "purpose with or without fee is hereby granted", "isc")):
        assert {n[0] for n in model.notices(text)} == {family}, text
    for text in ("This is not licensed under the MIT license.", "It was never released under the MIT License",
                 "no longer licensed under the Apache License, version 2.0"):
        assert not model.notices(text), text
    assert model.notices("It is not free. Released under the MIT License.")


def test_calibration():
    model = licenses.trained()
    table = model.reliability()
    assert sum(n for _, _, n, _, _ in table) == 12 * len(licenses.WORDED[1::2])
    gap = sum(n * abs(p - right) for _, _, n, p, right in table) / sum(t[2] for t in table)
    assert gap < 0.15
    p, unknown = model.read(["the people went by the river"])[0][1], model.read([""])[0][1]
    assert 0.5 < p <= 1 and unknown == 1.0


def test_templates_are_recognised():
    model = licenses.trained()
    for family, templates in licenses.TEMPLATES.items():
        for template in templates:
            assert model.judge(template)[0] == family, template


WRAPPED = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal",
    "gpl": " * This program is free software: you can redistribute it and/or modify\n"
           " * it under the terms of the GNU General Public License as published by",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the\n"
            "terms of the GNU Lesser General Public License as published by the Foundation",
    "bsd": "# Redistribution and use in source and binary forms, with or without\n"
           "# modification, are permitted provided that the following conditions are met:"}


def test_notices_wrapped_over_lines():
    model = licenses.trained()
    for family, text in WRAPPED.items():
        for body in (text, text.replace("\n", "\r\n"), "x y\n\n" + text + "\nmore words\n"):
            assert {n[0] for n in model.notices(body)} == {family}, (family, body)
    assert not model.notices(WRAPPED["mit"].replace("\n", "\n\n"))
    assert model.judge("under the terms of the GNU General Public License")[0] == "gpl"


def test_all_notices_of_one_line(docs_of):
    filler = "the people went by the river on foot " * 30
    text = f"\u0130 {WRAPPED['mit']} {filler}{WRAPPED['gpl']} {filler}".replace("\n", " ")
    near = "Copyright 2024 X. All rights reserved. Released under the MIT License. CC BY-SA 4.0"
    twice = "Released under the MIT License. Released under the MIT License."
    got = {r.doc_id: r for r in licenses.scan_licenses(docs_of(
        [(1, text, "", ""), (2, near, "", ""), (3, twice, "", "")])).collect()}
    assert (got[1].n_paragraphs, got[1].n_licensed, got[1].families) == (1, 2, "gpl,mit")
    (_, a, b), (_, c, d) = (x.split(":") for x in got[1].spans.split(","))
    assert text[int(a):int(b)].startswith("Permission") and text[int(b) - 5:int(b)] == "files"
    assert text[int(c):int(d)].endswith("General Public License")
    assert (got[2].n_licensed, got[2].families) == (3, "all_rights,cc_by_sa,mit")
    assert (got[3].n_licensed, got[3].families) == (2, "mit")


def test_lowered_keeps_places():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    assert len(licenses.lowered(every)) == len(every)

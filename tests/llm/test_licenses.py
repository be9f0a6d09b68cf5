from littoral.llm import licenses

from .helpers import docs, prose

GPL = "This work is licensed under the GNU General Public License, version 3."


def brute(text):
    w = licenses.strip_words(text or "")
    at = {(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()}
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_matches_brute_force(spark):
    rows = [(1, GPL), (1, GPL), (2, None), (3, ""), (4, "MIT"), (5, "mit license MIT-License, apache\tlicense general public; general public license"), (None, "The MIT License"), (6, "K mit license É license"), (7, "...!")]
    rows += [(10, "Licensed under CC BY-NC 4.0."), (11, prose(1, 50) + " Licensed under the very own Apache License, Version 2.0 " + prose(2, 20)), (12, prose(3, 20_000)), (13, "license mit"), (14, "general public public license general public license " * 50)]
    got = licenses.scan(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted([(d, *brute(t)) for d, t in rows], key=str)
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=str) == want
    by = {r.doc_id: r for r in got}
    assert by[1].labels == "gpl,gpl-3.0" and by[1].score == 1.0
    assert by[10].labels == "cc-by-nc"
    assert by[11].labels == "apache,apache-2.0"
    assert by[12].labels == "" and by[12].score == 0
    assert all(0 <= r.score <= 1 for r in got)


def test_empty(spark):
    assert licenses.scan(docs(spark, [])).collect() == []


def test_spans_are_verified(spark):
    near_misses = [
        "Licensed under the Apache License, Version 1.1",
        "Licensed under the Apache License, Version 2.1",
        "Licensed under the Apache License, Version 1.1. It needs Python version 2.0",
        "licensed under the " * 200,
        "Licensed under the. Version 2.0. Licensed under the Apache",
        "This work is licensed under the GNU General Public License version 2",
        "This work is licensed under the GNU Lesser General Public License version 3",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1",
        "Licensed under CC BY-NC-SA 4.0",
        "Licensed under CC BY-SA 3.0",
        "Licensed under CC BY 4.1",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "This work is licensed under a Creative Commons Attribution 3.0 International License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of the Font Software",
        "Redistribution and use in source and binary forms, with or without modification, are not permitted provided that the following conditions are met",
        "Released under the MIT-0 license",
    ]
    right = {
        "Licensed under the Apache License, Version 2.0": "apache-2.0",
        "Licensed under the Apache License, Version 2 (see NOTICE)": "apache-2.0",
        "Licensed under the licensed under the Apache License, Version 2.0": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 3, 29 June 2007": "gpl-3.0",
        "This work is licensed under the GNU General Public License (GPL) v3.0": "gpl-3.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2.0",
        "Licensed under CC BY 4.0": "cc-by",
        "Licensed under CC BY-SA, with thanks": "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-text",
        "Released under the MIT license": "mit-notice",
    }
    for name, text in licenses.TEMPLATES.items():
        right[text] = name
    texts = [*near_misses, *right]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        found = [s.name for s in got[i].spans]
        assert found == ([right[text]] if text in right else []), text
    assert licenses.scan(docs(spark, [(1, "Licensed under the Apache License, Version 2.0. " * 3)])).first().spans[1].start == 8

"""License scans against a plain search in Python."""

import re
from collections import Counter

from helpers import LONG, ODD, frame
from weftable.llm.license import AGREE, ANCHORS, BASE, NEED, anchors, document_frequencies, patterns, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at"
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files"
ROWS = [
    *ODD,
    (30, APACHE),
    (31, "x " * 3000 + MIT + " y" * 3000),
    (32, "The GNU General Public License; gnu GENERAL public license, mit-license CC\n\nBY"),
    (33, "gnu general publik license, mité license, mİt license, apache licenſe, Kcc by"),
    (34, "is hereby granted, free of charge, to any person obtaining a copy of this software"),  # begins before the file
    (35, "Permission was hereby granted free of charge to any person who obtains a copy of that software"),  # no key phrase
    (36, "cc by " * 2000),
    (37, "this work is licensed under the GNU General Public License, version 3."),
    (38, "license license apache apache license"),
    (None, "released under the MIT License"),
    *[(40 + i, "the free software of any person may be without a license") for i in range(5)],
]


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain_scan(rows):
    frequencies = Counter(w for _, t in rows for w in set(words(t)))
    out = []
    for key, text in rows:
        here = words(text)
        base, labels, share, notices = [], set(), None, []
        for label, is_base, expected, keys in patterns():
            rare = sorted(set(expected), key=lambda w: (frequencies[w], w))[: 1 if is_base else ANCHORS]
            for start in range(-len(expected), len(here)):
                cut = [here[start + j] if 0 <= start + j < len(here) else None for j in range(len(expected))]
                agree = {w for w, e in zip(cut, expected) if w == e and w in rare}
                matched = sum(w == e for w, e in zip(cut, expected))
                joined = " " + " ".join(w for w in cut if w is not None) + " "
                if is_base and matched == len(expected):
                    base.append((label, start))
                elif not is_base and len(agree) >= AGREE and 100 * matched >= NEED * len(expected) and all(f" {k} " in joined for k in keys):
                    notices.append((label, start, matched))
                    share = max(share or 0, matched / len(expected))
        labels = {b[0] for b in base} | {n[0] for n in notices}
        score = share if share is not None else 0.5 if base else 0.0
        out.append((key, len(here), sorted(base), sorted(notices), ",".join(sorted({b[0] for b in base})), ",".join(sorted(labels)), score))
    return out


def test_against_plain(spark):
    rows = [r for r in ROWS if r[1] != LONG] + [(50, " ".join(LONG.split()[:2000]) + " cc by")]
    found = [
        (r.doc_id, r.n_words, sorted((b.label, b.start) for b in r.base), sorted((n.label, n.start, n.matched) for n in r.notices), r.base_labels, r.labels, r.score)
        for r in scan_licenses(frame(spark, rows)).collect()
    ]
    assert sorted(map(str, found)) == sorted(map(str, plain_scan(rows)))
    by_id = {r[0]: r for r in found}
    assert by_id[30][5] == "apache,apache-2.0" and by_id[31][5] == "mit" and by_id[31][4] == "" and by_id[34][5] == "mit"
    assert by_id[32][4] == "cc-by,gpl,mit" and len(by_id[32][2]) == 4
    assert by_id[33][4:] == ("", "", 0.0) and by_id[35][5] == "" and len(by_id[36][2]) == 2000


def test_index_holds_the_rarest_words():
    index = anchors({"license": 9, "gnu": 1, "general": 5, "public": 5, "apache": 2, "mit": 3, "cc": 4, "by": 50})
    for number, (_, base, expected, _) in enumerate(patterns()):
        held = {w for w, postings in index.items() if any(p == number for p, _ in postings)}
        assert len(held) == (1 if base else min(ANCHORS, len(set(expected))))
        for word, postings in index.items():
            assert all(patterns()[p][2][j] == word for p, j in postings)
    assert [w for w, postings in index.items() if (0, 0) in postings] == ["gnu"] and len(BASE) == 4


def test_frequencies_count_documents(spark):
    counts = document_frequencies(spark.createDataFrame([("MIT mit mit",), ("a MIT",), (None,), ("license",)], "text string"))
    assert (counts["mit"], counts["license"]) == (2, 1) and "gnu" not in counts


def test_no_python_workers(spark):
    plan = scan_licenses(frame(spark, ROWS), frequencies={})._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan

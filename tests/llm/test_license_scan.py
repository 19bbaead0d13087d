import random
import re

from siftlode.llm.license_scan import PHRASES, scan_licenses

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places_match_brute_force(spark):
    rng = random.Random(6)
    parts = "under the mit license apache version 2 cc by nc x-y 2.0 ÉTÉ straße K".split()
    texts = [" ".join(rng.choice([*parts, "Under the MIT License", "Apache License, Version 2", "CC BY-NC"]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += [None, "", "  ", "a", "a b", "cc by nc", "cc by nc " * 3000, "mit", "cc by nc", "cc by nc"]
    rows = [(i if i else None, t) for i, t in enumerate(texts)] + [(5, texts[5])]
    got = scan_licenses(spark.createDataFrame([(k, t, "z") for k, t in rows], "doc_id long, text string, label string")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(((k, *brute(t)) for k, t in rows), key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in got)


def test_longer_templates_by_merged_diagonals(spark):
    rows = [
        (1, "This work is licensed under the GNU General Public License, version 3."),
        (2, "this work now is licensed under the gnu old general public license version 3"),
        (3, "the gnu general public opinion"),
        (4, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated docs"),
    ]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "gpl-3" and got[1].score == 1 and got[1].n_base == 0
    assert got[3].labels == "" and got[3].score == 0
    assert got[4].labels == "mit" and 0.6 <= got[4].score < 1
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_capitals_beyond_ascii_are_no_letters_of_templates(spark):
    text = "this wor\u212a is licensed under the mit l\u0130cense and under the MIT License"
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (13, 1, 9, 9)

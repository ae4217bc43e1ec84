import random
import re

from mercato.llm import license_scan as L

MIT = next(t for label, t in L.TEMPLATES if label == "mit" and len(t) > 100)


def labels(docs_of, rows):
    return {r["doc_id"]: r for r in L.license_labels(docs_of(rows)).collect()}


def test_base_places(docs_of):
    got = labels(docs_of, [(1, "It is UNDER the MIT License. Again under-the-mit license!"), (2, "apache license version 2 cc by nc"),
                           (3, "under the mit"), (4, None), (5, "")])
    assert [got[1][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")] == [11, 2, 2, 7, "mit"]
    assert [got[2][c] for c in ("n_base", "first_word", "last_word", "base_labels")] == [2, 0, 4, "apache-2,cc-by-nc"]
    for i in (3, 4, 5):
        assert [got[i][c] for c in ("n_base", "first_word", "last_word", "base_labels", "score")] == [0, None, None, "", 0.0]
    assert got[4]["n_words"] == 0


def test_changed_notices_are_found(docs_of):
    w = MIT.split()
    changed = w[:10] + ["extra", "words"] + w[10:30] + w[31:]
    got = labels(docs_of, [(1, "x y z " + " ".join(changed) + " more"), (2, " ".join(w[:12])), (3, " ".join(reversed(w))),
                           (4, "This work is licensed under the GNU General Public License, version 3.")])
    assert got[1]["labels"] == "mit" and got[1]["base_labels"] == "" and 0.9 < got[1]["score"] < 1
    assert got[2]["labels"] == "" and got[3]["labels"] == "" and got[2]["score"] == 0
    assert got[4]["labels"] == "gpl-3" and got[4]["score"] == 1


def test_odd_rows(docs_of, odd_rows):
    rows = odd_rows + [(70, odd_rows[7][1] + " under the mit license " + odd_rows[7][1])]
    got = L.license_labels(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert [(r["labels"], r["first_word"]) for r in got if r["doc_id"] == 70] == [("mit", 60_000)]
    assert L.license_labels(docs_of([])).collect() == []


CC = {"cc-by": "", "cc-by-nc": "-NonCommercial", "cc-by-sa": "-ShareAlike", "cc-by-nd": "-NoDerivatives",
      "cc-by-nc-sa": "-NonCommercial-ShareAlike", "cc-by-nc-nd": "-NonCommercial-NoDerivatives"}


def test_each_notice_gets_its_own_label_alone(docs_of):
    cases = [*L.TEMPLATES]
    cases += [(label, f"This work is licensed under a Creative Commons Attribution{more} 3.0 Unported License.") for label, more in CC.items()]
    cases += [("lgpl-2.1", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                           "Public License as published by the Free Software Foundation; either version 2.1 of the License, or later"),
              ("gpl-2", "the whole work is licensed under the GNU General Public License version 2"),
              ("", "Released under the BSD License."), ("", "Licensed under the Eclipse License, Version 2.0."),
              ("", "This work is licensed under the GNU General Public License, version 1.")]
    got = labels(docs_of, [(i, f"start of it {text} then ends") for i, (_, text) in enumerate(cases)])
    # The fixed base phrase "cc by nc" stands in the short notices of these too.
    base = lambda text: {"cc-by-nc"} if "CC BY-NC-" in text else set()
    assert [(t, set(got[i]["labels"].split(","))) for i, (_, t) in enumerate(cases)] == [(t, {n} | base(t)) for n, t in cases]


def test_two_licenses_of_one_text_stay(docs_of):
    text = "Licensed under the MIT License and the Apache License, Version 2.0. Manual: licensed under CC BY-SA 4.0."
    got = labels(docs_of, [(1, text), (2, L.TEMPLATES[4][1] + " " + L.TEMPLATES[9][1])])
    assert got[1]["labels"] == "apache-2,cc-by-sa,mit" and got[2]["labels"] == "cc-by,gpl-3"


def plain_base(text):
    """Words, places of the fixed phrases, first and last of them, labels: one word after the other."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for label, phrase in (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def test_base_columns_equal_a_plain_count(spark, docs_of, odd_rows):
    rng = random.Random(11)
    parts = ["under the MIT license", "Apache License, Version 2.0", "apache license version 2", "CC BY-NC", "cc by nc cc by nc", "under the", "mit",
             "license version", "\u00e9t\u00e9", "x1", "\n", "under the mit", "apache", "cc-by", "nc.", "the word"]
    rows = odd_rows + [(100 + i, " ".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 4, 30])))) for i in range(150)]
    got = sorted(((r["doc_id"], (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))
                  for r in L.license_labels(docs_of(rows)).collect()), key=str)
    assert got == sorted(((i, plain_base(t)) for i, t in rows), key=str)

import random
import re

import numpy as np
import pytest

from mercato.llm import pii_crf as P

#: The contract's patterns, as they stand.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


@pytest.fixture(scope="module")
def model():
    return P.train()


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                    "card": 16 <= len(digits) <= 19 and P.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_equals_the_patterns():
    rng = random.Random(0)
    for _ in range(20_000):
        letters = rng.choice(["a1.@-+ 2(3)9%é.0\n", "1234 .-@", "4539148803436467 -", "0123456789. "])
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(45)))
        assert P.base_spans(text) == plain(text), text


def test_base_is_linear_in_hostile_texts():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 150_000, "+1" + " " * 300_000, "1 " * 100_000):
        P.base_spans(text)


def test_viterbi_equals_all_paths(model):
    rng = np.random.default_rng(0)
    batch = [rng.normal(size=(n, 5)) * 4 for n in (1, 2, 4, 3)]
    for scores, tags in zip(batch, model.viterbi(batch), strict=True):
        best, way = -1e9, None
        for path in np.ndindex(*[5] * len(scores)):
            total = model.first[path[0]] + sum(scores[i][t] for i, t in enumerate(path)) + sum(
                model.move[a, b] for a, b in zip(path, path[1:]))
            if total > best:
                best, way = total, path
        assert tuple(tags) == way


def test_field_adds_and_leaves_alone(model):
    texts = ["call (415) 555-2671 or kim(at)site.example.org now", "in 1998 we had 12,500 of 3.5 % in version 2.0",
             "text +1 (314) 555-6532 4539148803436467 after"]
    base = [P.base_spans(t) for t in texts]
    more = P.field_spans(texts, base, model)
    assert [k for k, _, _ in more[0]] == ["phone", "email"]
    assert texts[0][more[0][0][1]:more[0][0][2]] == "(415) 555-2671"
    assert more[1] == []
    assert not base[2] and sorted(k for k, _, _ in more[2]) == ["card", "phone"]


def test_rows(docs_of, odd_rows, model):
    long = next(t for i, t in odd_rows if i == 5)
    rows = odd_rows + [(70, long + " ann@mail.example.com " + long), (71, "ip 1.2.3.4, é 1.2.3.4")]
    got = P.pii_spans(docs_of(rows), masked=True, model=model).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    at = len(long) + 1
    assert f"email:{at}:{at + 20}" in by_id[70]["spans"].split(",") and by_id[70]["n_email"] == 1
    assert by_id[71]["spans"] == "ip:3:10,ip:14:21" and by_id[71]["_masked"] == "ip <ip>, é <ip>"
    assert by_id[1]["_masked"] is None and by_id[2]["spans"] == ""
    assert P.pii_spans(docs_of([]), model=model).collect() == []


@pytest.mark.parametrize("text", ["1." + "0" * 5000 + ".2.3", "0" * 5000 + "1.2.3.4", "1.2.3." + "9" * 5000])
def test_long_parts_of_an_address(text, model):
    good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))
    assert [s for s in P.base_spans(text) if s[0] == "ip"] == ([("ip", 0, len(text))] if good else [])


def test_features_see_whole_words():
    long = "a1" * 200
    assert P.shape(long) == "ad1" * 200
    assert P.word_features(long + "@b") != P.word_features(long)
    assert P.shape("x" * 70 + "9") == "ad1"

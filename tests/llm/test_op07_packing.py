import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mercato.llm import packing as K

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    return lambda s: tok.encode(s or "", add_special_tokens=False).ids


def test_cached_ids_equal_the_tokenizers(plain):
    rng = random.Random(1)
    encode = K.Encoder(PATH)
    parts = ["a", "B", "É", "ß", "'", "s", "'t", "'re", " ", "\n", "1", "2", "_", "-", ".", "…", "Σ", "İ", "×", "ſ", "<|endoftext|>",
             "é", "\x1c", "\xa0", "中", "!", "ll", "Ð", "\t", "\r", "word"]
    for _ in range(5000):
        s = "".join(rng.choice(parts) for _ in range(rng.randrange(16)))
        assert np.frombuffer(encode(s), "<u4").tolist() == plain(s), s


def test_small_caches(plain, monkeypatch):
    monkeypatch.setattr(K, "CACHE_WORDS", 5)
    encode = K.Encoder(PATH)
    for s in ("one two three four five six seven", "eight nine ten, one two", "one one"):
        assert np.frombuffer(encode(s), "<u4").tolist() == plain(s)


def test_nnls():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((6, 9)), rng.random(6)
        x = K.nnls(a, b)
        grad = a.T @ (a @ x - b)
        assert (x >= 0).all() and (grad > -1e-6).all() and abs(grad[x > 0]).max(initial=0) < 1e-5


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece(seed):
    rng = np.random.default_rng(seed)
    sizes = np.clip(rng.lognormal(6, 1.3, 3000).astype(int), 1, 2048) if seed else np.full(50, 2048)
    hist = np.bincount(sizes, minlength=2049)
    plan = K.plan(hist)
    used = np.zeros(2049, int)
    for parts, count in plan:
        assert sum(parts) <= 2048 and count > 0
        for p in parts:
            used[p] += count
    assert (used == hist).all()
    assert sum(c for _, c in plan) <= 1.01 * -(-sizes.sum() // 2048) + 1
    if seed:
        assert K.fit(hist.copy(), 2048, K.BUCKET, K.FILLER)
    key, seq, off = K.places(plan)
    assert (np.diff(key) > 0).all() and len(key) == len(seq) == len(off)


def test_rows(docs_of, odd_rows, plain):
    rng = random.Random(4)
    rows = odd_rows + [(100 + i, " ".join(rng.choice("abcdef") * rng.randrange(1, 9) for _ in range(rng.randrange(900)))) for i in range(60)]
    got = K.pack(docs_of(rows), PATH, with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = np.array(plain(t) + [0], "<u4")
        want += [(str(i), k // 2048, k, len(p), zlib.crc32(p.tobytes())) for k in range(0, len(ids), 2048) for p in [ids[k:k + 2048]]]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in got)
    spans = {}
    for r in got:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in spans.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 2048
    assert K.pack(docs_of([]), PATH).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_never_more_sequences_than_best_fit_alone(seed):
    rng = np.random.default_rng(seed)
    hist = np.zeros(2049, np.int64)
    sizes = np.clip(rng.lognormal(5.8, 0.9, 4000).astype(int), 1, 2048)
    np.add.at(hist, sizes, rng.integers(1, 30, len(sizes)))
    made = K.plan(hist)
    used = np.zeros(2049, np.int64)
    for parts, count in made:
        assert sum(parts) <= 2048
        np.add.at(used, list(parts), count)
    assert (used == hist).all()
    assert sum(c for _, c in made) <= sum(c for _, c in K.best_fit(hist.copy(), 2048, []))

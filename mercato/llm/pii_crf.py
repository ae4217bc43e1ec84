"""Personal data: exact base patterns plus a linear-chain conditional random
field over word-shape features (operator 6).

Base spans come from four fixed patterns with their checks.  The random field
labels the words of a text with O or one of the four kinds.  It is trained
here, by gradient ascent on the exact log-likelihood (forward-backward in
numpy), from the small labelled table LABELLED; and decoded by Viterbi in numpy
batches.  Its spans are added where they touch no base span.

A word can only belong to a span if a word with a digit or "@" is at most
CONTEXT words away on its line, so the sequences that are decoded are the runs of
such words; all other words are O by definition.  Nothing is cut off.

Defined results.  Null or empty text: no spans.  Repeated rows are treated one
by one.  A very long text is searched whole (each pattern is written to run in
linear time).  Null ids are kept.  An empty table gives an empty result.  Other
columns are ignored, clashing names do no harm.  Offsets are code points, end
exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm import vectext as V

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *KINDS)
CONTEXT = 2

#: The labelled table: one line a sequence, {kind:words} around personal data.
LABELLED = """
write to {email:ann.lee@mail.example.com} for help
contact {email:bob_77@corp-site.org} or call {phone:+1 (415) 555-2671} today
mail: {email:x.y+z@sub.domain.co.uk}, thanks
send it to {email:ann(at)example.com} please
send it to {email:jo.doe[at]mail.example.org} now
my address is {email:kim(at)site(dot)net} there
reach me under {email:sam.r[at]firm[dot]com} or later
phone {phone:(415) 555-2671} after nine
phone {phone:(212) 555-0187}, ask for Ann
call {phone:415-555-2671} at noon
call {phone:212-555-0142} or write
fax {phone:030 555-7713-20} in the office
dial {phone:+49 30 1234567} from abroad
dial {phone:+33 1 42 68 53 00} from abroad
the number {phone:(974) 555-3436} is free
the server {ip:10.24.3.118} was down
from {ip:97.51.17.173} and {ip:161.17.88.162} we saw it
host {ip:192.168.0.1:8080} answers
ping {ip:8.8.8.8/32} twice
paid by card {card:4539 1488 0343 6467} yesterday
paid by card {card:4539148803436467} yesterday
the card {card:4111-1111-1111-1111} expires soon
Licensed under the Apache License, Version 2.0.
Licensed under CC BY-NC 4.0.
licensed under the GNU General Public License, version 3.
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" was set
key = "a81f3c9d2b7744e0" and more
in 1998 there were 12,500 people and 3.5 % more
on 2021-03-04 at 10:45 we met
on 04.03.2021 at 10.45 we met
chapter 3.2.1 says so
version 1.2.3 of the tool
version 10.4.2.1-beta of the tool
order 4845168114407329 was sent
number 9807915762804490 again
id 7536784127813050 here
it costs $19.99 or 20 EUR
call 911 in an emergency
pages 120-134 of volume 12
the years 1990-1999 and 2000-2010
see section 4 and table 5
a ratio of 16:9 or 4:3
room 415-B on floor 2
ISBN 978-3-16-148410-0 is a book
the score was 3-2 after 90 minutes
follow @ann_lee on the site
meet @ noon by the gate
3 + 4 = 7 and 5 * 6 = 30
from 10 to 20 of 30
row 1 | row 2 | row 3
H2O and CO2 and B12
100 200 300 400 500
1 2 3 4 5 6 7 8
12 June 2019
12345 67890
2,000 words
A1 B2 C3
x1y2z3
""".strip().split("\n")

_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind as listed, then start."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        # The leftmost start for this "@" is where its run of local characters begins.
        start = at
        while start > done and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        m = _EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---------------------------------------------------------------- features

def shape(word: str) -> str:
    """Letters become a, A; digits keep their run length (up to 5) as d; others stay."""
    out, n = [], 0
    for c in word + "\0":
        if "0" <= c <= "9":
            n += 1
            continue
        if n:
            out.append(f"d{min(n, 5)}")
            n = 0
        k = "a" if c.islower() else "A" if c.isupper() else "u" if c.isalnum() else c
        if k != "\0" and (not out or out[-1] != k or not k.isalpha()):
            out.append(k)
    return "".join(out)


def _kind_of_number(word: str) -> str:
    d = _digits(word)
    if len(d) < 7:
        return f"n{len(d)}"
    return "luhn" if 13 <= len(d) <= 19 and luhn(d) else "long" if len(d) > 15 else "mid"


@lru_cache(maxsize=50_000)
def word_features(word: str) -> tuple[str, ...]:
    """Features of one word, trailing punctuation aside."""
    core = word.strip(",;:!?\"'")
    s = shape(core)
    marks = "".join(sorted({c for c in core if not c.isalnum()}))
    mail = "@" in core[1:-1] or "(at)" in core or "[at]" in core
    dots = core.count(".")
    quad = bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}([:/][0-9]+)?", core))
    out = [f"s={s}", f"m={marks}", f"k={_kind_of_number(core)}", f"h={s[:3]}", f"t={s[-3:]}", f"dots={min(dots, 4)}"]
    if mail:
        out.append("mail")
    if quad:
        out.append("quad")
    if not any("0" <= c <= "9" for c in core):
        out.append("nodigit")
    return tuple(out)


def sequence_features(words: list[str]) -> list[tuple[str, ...]]:
    own = [word_features(w) if len(w) <= 200 else word_features.__wrapped__(w) for w in words]     # no long words in the cache
    pad = ("edge",)
    out = []
    for i, f in enumerate(own):
        left, right = own[i - 1] if i else pad, own[i + 1] if i + 1 < len(own) else pad
        out.append(f + ("<" + left[0], ">" + right[0], "<" + left[-1], ">" + right[-1],
                        f[0] + "<" + left[0], f[0] + ">" + right[0]))
    return out


def parse_labelled(lines: list[str]) -> list[tuple[list[str], list[int]]]:
    out = []
    for line in lines:
        words, tags, pos = [], [], 0
        for m in re.finditer(r"\{(\w+):([^{}]*)\}(\S*)", line):
            for w in line[pos:m.start()].split():
                words.append(w)
                tags.append(0)
            inside = m.group(2).split()
            inside[-1] += m.group(3)
            words += inside
            tags += [TAGS.index(m.group(1))] * len(inside)
            pos = m.end()
        for w in line[pos:].split():
            words.append(w)
            tags.append(0)
        out.append((words, tags))
    return out


# ---------------------------------------------------------------- the model

def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Crf:
    """Weights: feature x tag, tag x tag, and the first word's tag."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray, first: np.ndarray):
        self.names, self.emit, self.move, self.first = names, emit, move, first

    def scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(TAGS)))
        for i, fs in enumerate(sequence_features(words)):
            at = [self.names[f] for f in fs if f in self.names]
            if at:
                out[i] = self.emit[at].sum(axis=0)
        return out

    def viterbi(self, batch: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags of sequences of emission scores, all in step."""
        size = np.array([len(s) for s in batch])
        longest = int(size.max())
        e = np.zeros((len(batch), longest, len(TAGS)))
        for i, s in enumerate(batch):
            e[i, :len(s)] = s
        best, back = e[:, 0] + self.first, []
        for t in range(1, longest):
            step = best[:, :, None] + self.move
            arg = step.argmax(axis=1)
            new = np.take_along_axis(step, arg[:, None], 1)[:, 0] + e[:, t]
            live = (t < size)[:, None]
            best = np.where(live, new, best)
            back.append(np.where(live, arg, np.arange(len(TAGS))))
        tag = best.argmax(axis=1)
        path = [tag]
        for arg in reversed(back):
            tag = arg[np.arange(len(batch)), tag]
            path.append(tag)
        path = np.stack(path[::-1], axis=1)
        return [path[i, :n] for i, n in enumerate(size)]


def train(lines: list[str] = LABELLED, steps: int = 300, l2: float = 0.02, rate: float = 0.1) -> Crf:
    """Maximum-likelihood weights by full-batch Adam; the same each time."""
    data = parse_labelled(lines)
    feats = [sequence_features(w) for w, _ in data]
    names = {f: i for i, f in enumerate(sorted({f for s in feats for fs in s for f in fs}))}
    n, k = len(data), len(TAGS)
    size = np.array([len(t) for _, t in data])
    longest = int(size.max())
    x = np.zeros((n, longest, len(names)), np.float32)
    y = np.zeros((n, longest, k))
    live = np.arange(longest) < size[:, None]
    for i, (s, (_, tags)) in enumerate(zip(feats, data, strict=True)):
        for t, fs in enumerate(s):
            x[i, t, [names[f] for f in fs]] = 1
            y[i, t, tags[t]] = 1
    pairs = live[:, 1:]
    want_move = np.einsum("ntj,ntk,nt->jk", y[:, :-1], y[:, 1:], pairs)
    want_emit = np.einsum("ntf,ntk->fk", x, y)
    p = [np.zeros((len(names), k)), np.zeros((k, k)), np.zeros(k)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        e = x @ p[0]
        f = np.zeros((n, longest, k))
        b = np.zeros((n, longest, k))
        f[:, 0] = e[:, 0] + p[2]
        for t in range(1, longest):
            new = _log_sum(f[:, t - 1, :, None] + p[1], 1) + e[:, t]
            f[:, t] = np.where(live[:, t, None], new, f[:, t - 1])
        z = _log_sum(f[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            new = _log_sum(p[1] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
            b[:, t] = np.where(live[:, t + 1, None], new, 0)
        prob = np.exp(f + b - z[:, None, None]) * live[:, :, None]
        joint = np.exp(f[:, :-1, :, None] + p[1] + (e + b)[:, 1:, None, :] - z[:, None, None, None]) * pairs[:, :, None, None]
        grad = [want_emit - np.einsum("ntf,ntk->fk", x, prob), want_move - joint.sum(axis=(0, 1)), y[:, 0].sum(axis=0) - prob[:, 0].sum(axis=0)]
        for i in range(3):
            g = grad[i] - l2 * p[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] + rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Crf(names, *p)


# ---------------------------------------------------------------- decoding

def _sequences(text: str) -> Iterator[list[tuple[int, int]]]:
    """Word spans of each run of words near a digit or "@", line by line."""
    at = 0
    for line in text.split("\n"):
        if re.search(r"[0-9@]|[\[(]at[\])]", line):
            spans = [(m.start() + at, m.end() + at) for m in _WORD.finditer(line)]
            near = np.zeros(len(spans), bool)
            for i, (a, b) in enumerate(spans):
                if re.search(r"[0-9@]|[\[(]at[\])]", text[a:b]):
                    near[max(0, i - CONTEXT):i + CONTEXT + 1] = True
            run: list[tuple[int, int]] = []
            for i, s in enumerate(spans):
                if near[i]:
                    run.append(s)
                elif run:
                    yield run
                    run = []
            if run:
                yield run
        at += len(line) + 1


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in ",;:!?\"'<>{}|*#$%&":
        a += 1
    while b > a and text[b - 1] in ",;:!?\"'<>{}|*#$%&.":
        b -= 1
    return a, b


def field_spans(texts: list[str], base: list[list[tuple[str, int, int]]], model: Crf) -> list[list[tuple[str, int, int]]]:
    """Spans of the random field that touch no base span."""
    owner, runs = [], []
    for i, text in enumerate(texts):
        for run in _sequences(text):
            owner.append(i)
            runs.append(run)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    order = sorted(range(len(runs)), key=lambda j: len(runs[j]))
    lo = 0
    while lo < len(order):
        # Batches of like length, of bounded size.
        hi = lo + 1
        while hi < len(order) and hi - lo < 512 and (hi - lo) * len(runs[order[hi]]) < 20_000:
            hi += 1
        part = order[lo:hi]
        lo = hi
        tags = model.viterbi([model.scores([texts[owner[j]][a:b] for a, b in runs[j]]) for j in part])
        for j, tag in zip(part, tags, strict=True):
            text, run, t = texts[owner[j]], runs[j], 0
            while t < len(run):
                u = t
                while u + 1 < len(run) and tag[u + 1] == tag[t]:
                    u += 1
                if tag[t]:
                    a, b = _trim(text, run[t][0], run[u][1])
                    if b > a and not any(a < e and s < b for _, s, e in base[owner[j]]):
                        out[owner[j]].append((TAGS[tag[t]], a, b))
                t = u + 1
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


_trigger = np.zeros(256, bool)
_trigger[list(b"0123456789@")] = True
_opening = np.zeros(256, bool)
_opening[list(b"([")] = True


def _may_hold(block: V.Block) -> np.ndarray:
    """Rows with a digit, an "@", or a bracket before "at"."""
    d = block.data
    hit = _trigger[d]
    hit[:-3] |= _opening[d[:-3]] & (d[1:-2] == 97) & (d[2:-1] == 116) if len(d) > 3 else False
    return V.per_row(hit, block.offsets) > 0


SPAN_FIELDS = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [
    T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType())]


def pii_spans(docs: DataFrame, text_col: str = "text", passed: tuple[str, ...] = ("doc_id",), model: Crf | None = None,
              masked: bool = False) -> DataFrame:
    """One row per input row: the columns in ``passed``, base counts by kind, the
    base spans and all spans as kind:start:end lists.  With ``masked`` also the
    text with every span replaced by <kind> (a null text stays null)."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train())
    fields = [docs.schema[c] for c in passed] + SPAN_FIELDS + ([T.StructField("_masked", T.StringType())] if masked else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for b in batches:
            column = b.column("_text")
            for block in V.blocks(column):
                at = np.flatnonzero(_may_hold(block))
                texts = [x or "" for x in column.slice(block.first, block.rows).take(pa.array(at)).to_pylist()]
                base = [base_spans(x) for x in texts]
                more = field_spans(texts, base, crf)
                counts = np.zeros((len(KINDS), block.rows), np.int64)
                base_list, all_list = [""] * block.rows, [""] * block.rows
                for i, r in enumerate(at):
                    for k, _, _ in base[i]:
                        counts[KINDS.index(k), r] += 1
                    base_list[r], all_list[r] = _joined(base[i]), _joined(base[i] + more[i])
                arrays = [b.column(c).slice(block.first, block.rows) for c in passed]
                arrays += [pa.array(c) for c in counts] + [pa.array(base_list), pa.array(all_list)]
                if masked:
                    out = column.slice(block.first, block.rows)
                    if any(all_list[r] for r in at):
                        out = out.to_pylist()
                        for i, r in enumerate(at):
                            if all_list[r]:
                                out[r] = mask(texts[i], base[i] + more[i])
                        out = pa.array(out, pa.string())
                    arrays.append(out)
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    rows = docs.select(*passed, F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, T.StructType(fields))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with its spans replaced by <kind>; overlapping spans become one."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()

"""Operator 3: personal data by patterns and a linear-chain conditional random field.

Patterns give the base spans, with scans that stay linear in the text whatever it holds. The field labels every token of
every line: its features are the word shapes of the token and of its neighbours, two on each side, so a token's scores
are five rows of small tables. It is trained on a small labelled table by gradient ascent on the likelihood (forward and
backward in numpy), and decoded by Viterbi, all lines of a batch step by step at once. Spans that it adds must be well
formed for their kind and keep off the base spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, slices, table, whole_text
from .pii_table import LINES

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]
#: Gradient steps, step size and strength of the Gaussian prior of the training.
STEPS, RATE, RIDGE = 250, 0.1, 0.05
#: Words that have a shape of their own.
CUES = ("at", "dot", "call", "tel", "phone", "fax", "mobile", "ring", "dial", "mail", "email", "card", "visa", "ip", "host", "server", "version", "release", "build", "chapter", "section")
SYMBOLS = ".,-+()[]@:/_=\"'|#$%"
SPACE, LOWER, UPPER, DIGIT, OTHER = range(5)

DIGITS = re.compile(r"[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits, and never gives back what it has taken
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start, then kind as listed."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            end = m.end()
        else:
            end = at + 1  # a local part never holds an @
        at = text.find("@", end)
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p := part.lstrip("0")) < 3 or (len(p) == 3 and p <= "255") for part in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if 12 <= len(digits := _only_digits(m[0])) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_only_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _letters(lower: str) -> int:
    return sum(ord(c) << 8 * i for i, c in enumerate(lower))


CUE_CODES = np.array(sorted(_letters(c) for c in CUES))
DIGIT_STEPS = np.array([1, 2, 3, 4, 5, 7, 10, 12, 20])
LETTER_STEPS = np.array([1, 2, 3, 5, 9])
N_LETTER, N_DIGIT, N_SYMBOL = 4 * len(LETTER_STEPS) + len(CUES), len(DIGIT_STEPS), len(SYMBOLS) + 1
#: Shapes without and with white space before them, and one for the outside of a line.
SHAPES = 2 * (N_LETTER + N_DIGIT + N_SYMBOL) + 1


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, lower case and symbol number of the first code points; letters beyond them count as lower-case letters."""
    n = 0x530
    kind, lower, symbol = np.full(n, OTHER, np.uint8), np.arange(n), np.full(n, len(SYMBOLS), np.uint8)
    for c in map(chr, range(n)):
        i = ord(c)
        kind[i] = SPACE if c.isspace() else DIGIT if "0" <= c <= "9" else UPPER if c.isupper() else LOWER if c.isalpha() else OTHER
        if len(c.lower()) == 1:
            lower[i] = min(ord(c.lower()), n - 1)
        if c in SYMBOLS:
            symbol[i] = SYMBOLS.index(c)
    return kind, lower, symbol


def tokens(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points -> (start, end, shape, line) of every token: a run of letters, a run of digits, or one other sign."""
    kinds, lower, symbols = _tables()
    low = np.minimum(points, len(kinds) - 1)
    kind = np.where(points < len(kinds), kinds[low], np.where((points >= 0x2000) & (points < 0x2070) | (points == 0x3000), OTHER, LOWER)).astype(np.uint8)
    run = np.where(kind == UPPER, LOWER, kind)
    first = run != SPACE
    first[1:] &= (run[1:] != run[:-1]) | (run[1:] == OTHER)
    start = np.flatnonzero(first)
    if not len(start):
        return start, start, start, start
    edge = np.flatnonzero(first | (run == SPACE))
    edge = np.r_[edge, len(points)]
    end = edge[np.searchsorted(edge, start, "right")]
    size = end - start
    head = run[start]
    shape = np.zeros(len(start), np.int64)
    letters = np.flatnonzero(head == LOWER)
    caps = np.add.reduceat((kind == UPPER).astype(np.int32), start)[letters]
    n = size[letters]
    case = np.where(caps == 0, 0, np.where(caps == n, 1, np.where((caps == 1) & (kind[start[letters]] == UPPER), 2, 3)))
    shape[letters] = case * len(LETTER_STEPS) + np.searchsorted(LETTER_STEPS, n, "right") - 1
    short = letters[(n <= 7) & (n >= 2)]
    if len(short):
        code = np.zeros(len(short), np.int64)
        for i in range(7):
            has = size[short] > i
            p = points[np.minimum(start[short] + i, len(points) - 1)]
            code += np.where(has, np.where(p < 128, lower[np.minimum(p, 127)], 255), 0).astype(np.int64) << 8 * i
        at = np.minimum(np.searchsorted(CUE_CODES, code), len(CUE_CODES) - 1)
        cue = CUE_CODES[at] == code
        shape[short[cue]] = 4 * len(LETTER_STEPS) + at[cue]
    numbers = np.flatnonzero(head == DIGIT)
    shape[numbers] = N_LETTER + np.searchsorted(DIGIT_STEPS, size[numbers], "right") - 1
    signs = np.flatnonzero(head == OTHER)
    own = points[start[signs]]
    shape[signs] = N_LETTER + N_DIGIT + np.where(own < len(symbols), symbols[np.minimum(own, len(symbols) - 1)], len(SYMBOLS))
    spaced = np.r_[True, run[np.maximum(start[1:] - 1, 0)] == SPACE]
    shape = 2 * shape + spaced
    line = np.cumsum(points == 10)[start]
    return start, end, shape, line


def neighbours(shape: np.ndarray, line: np.ndarray) -> list[np.ndarray]:
    """The shapes two before to two after each token; outside its line the last shape."""
    out = []
    for k in (-2, -1, 0, 1, 2):
        own = np.full(len(shape), SHAPES - 1)
        if k < 0:
            own[-k:] = np.where(line[-k:] == line[:k], shape[:k], SHAPES - 1)
        elif k > 0:
            own[:-k] = np.where(line[:-k] == line[k:], shape[k:], SHAPES - 1)
        else:
            own = shape
        out.append(own)
    return out


def _allowed() -> np.ndarray:
    """Which label may follow which: inside a span comes only after its own kind."""
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for j, b in enumerate(LABELS):
        if b[0] == "I":
            ok[:, j] = [a[1:] == b[1:] for a in LABELS]
    return ok


NEVER = -1e4


class Field:
    """weights: (5, SHAPES, labels); step: (labels, labels). No span can be entered in its middle."""

    def __init__(self, weights: np.ndarray, step: np.ndarray):
        self.weights = weights.astype(np.float32)
        self.step = np.where(_allowed(), step, NEVER).astype(np.float32)
        self.enter = np.array([NEVER if x[0] == "I" else 0 for x in LABELS], np.float32)

    def scores(self, shape: np.ndarray, line: np.ndarray) -> np.ndarray:
        out = np.zeros((len(shape), len(LABELS)), np.float32)
        for w, s in zip(self.weights, neighbours(shape, line), strict=True):
            out += w[s]
        return out

    def decode(self, shape: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Best labels of all lines at once: step t treats the t-th token of every line that has one."""
        score = self.scores(shape, line)
        first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        size = np.diff(np.r_[first, len(line)])
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        back = np.zeros((len(shape), len(LABELS)), np.int8)
        best = score[first] + self.enter
        label = np.zeros(len(shape), np.int8)
        live = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # lines with at least so many tokens
        step = np.ascontiguousarray(self.step.T)  # to, from
        last = np.empty((len(first), len(LABELS)), np.float32)
        for t in range(1, size[0]):
            n = live[t]
            if n < len(best):
                last[n : len(best)] = best[n:]
                best = best[:n]
            way = best[:, None, :] + step
            chosen = way.argmax(axis=2)
            at = first[:n] + t
            back[at] = chosen
            best = np.take_along_axis(way, chosen[:, :, None], axis=2)[:, :, 0] + score[at]
        last[: len(best)] = best
        now = last.argmax(axis=1)
        label[first + size - 1] = now
        state = now.copy()
        for t in range(size[0] - 1, 0, -1):
            n = live[t]
            at = first[:n] + t
            state[:n] = back[at, label[at]]
            label[at - 1] = state[:n]
        return label


def labelled(lines: str) -> tuple[str, list[tuple[int, int, int]]]:
    """The table's text without its marks, and its spans (start, kind, end)."""
    out, spans, at = [], [], 0
    mark = re.compile(r"\[(" + "|".join(KINDS) + r") ")
    for line in lines.splitlines():
        pos = 0
        while m := mark.search(line, pos):
            depth, end = 1, m.end()
            while depth:
                depth += {"[": 1, "]": -1}.get(line[end], 0)
                end += 1
            out += [line[pos : m.start()], line[m.end() : end - 1]]
            at += m.start() - pos
            spans.append((at, KINDS.index(m[1]), at + end - 1 - m.end()))
            at += end - 1 - m.end()
            pos = end
        out += [line[pos:], "\n"]
        at += len(line) - pos + 1
    return "".join(out), spans


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=2)
def trained(lines: str = LINES, steps: int = STEPS) -> Field:
    """The field that the labelled table makes most likely, under a Gaussian prior. The same table gives the same field."""
    text, spans = labelled(lines)
    start, end, shape, line = tokens(_points(text))
    gold = np.zeros(len(start), np.int64)
    for a, k, b in spans:
        inside = np.flatnonzero((start >= a) & (end <= b))
        gold[inside] = 2 + 2 * k
        gold[inside[0]] = 1 + 2 * k
    near, L = neighbours(shape, line), len(LABELS)
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    size = np.diff(np.r_[first, len(line)])
    longest, rows = size.max(), len(first)
    at = np.minimum(first[:, None] + np.arange(longest), len(start) - 1)
    real = np.arange(longest) < size[:, None]
    ban = np.where(_allowed(), 0.0, NEVER)
    enter = np.array([NEVER if x[0] == "I" else 0 for x in LABELS])
    w, s = np.zeros((5, SHAPES, L)), np.zeros((L, L))
    moments = [np.zeros_like(x) for x in (w, s, w, s)]
    pairs = np.flatnonzero(line[1:] == line[:-1])
    want_s = np.zeros((L, L))
    np.add.at(want_s, (gold[pairs], gold[pairs + 1]), 1)

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for it in range(1, steps + 1):
        emit = sum(w[k][near[k]] for k in range(5))[at]
        step = s + ban
        a = np.zeros((rows, longest, L))
        a[:, 0] = emit[:, 0] + enter
        for t in range(1, longest):
            a[:, t] = np.where(real[:, t, None], lse(a[:, t - 1, :, None] + step, 1) + emit[:, t], a[:, t - 1])
        z = lse(a[:, -1], 1)
        b = np.zeros((rows, longest, L))
        ahead = np.zeros((L, L))
        for t in range(longest - 2, -1, -1):
            following = emit[:, t + 1] + b[:, t + 1]
            b[:, t] = np.where(real[:, t + 1, None], lse(step + following[:, None, :], 2), 0)
            both = np.exp(a[:, t, :, None] + step + following[:, None, :] - z[:, None, None])
            ahead += both[real[:, t + 1]].sum(axis=0)
        p = np.exp(a + b - z[:, None, None])
        share = np.zeros((len(start), L))
        share[at[real]] = p[real]
        off = -share
        off[np.arange(len(gold)), gold] += 1
        grad_w = np.zeros_like(w)
        for k in range(5):
            np.add.at(grad_w[k], near[k], off)
        grads = (grad_w - RIDGE * w, np.where(_allowed(), want_s - ahead, 0) - RIDGE * s)
        for i, (x, g) in enumerate(zip((w, s), grads, strict=True)):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[i + 2] = 0.99 * moments[i + 2] + 0.01 * g * g
            x += RATE * (moments[i] / (1 - 0.9**it)) / (np.sqrt(moments[i + 2] / (1 - 0.99**it)) + 1e-8)
    return Field(w, s)


WELL_FORMED = (
    re.compile(r"[\w.%+-]+(?:\s*@\s*[\w.-]+|(?:\s+at\s+|\s*[(\[]\s*at\s*[)\]]\s*)[\w-]+(?:(?:\.|\s+dot\s+|\s*[(\[]\s*dot\s*[)\]]\s*)[\w-]+)+)", re.I),
    re.compile(r"[0-9]{1,3}(?:\s*[.,-]\s*[0-9]{1,3}){3}"),
    re.compile(r"[0-9][0-9 ./-]*[0-9]"),
    re.compile(r"[+(]?[0-9][0-9 ().+/-]*[0-9]"),
)


def _well_formed(text: str, start: int, end: int, kind: int) -> bool:
    body = text[start:end]
    if not WELL_FORMED[kind].fullmatch(body) or (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    digits = _only_digits(body)
    return (
        kind == 0
        or (kind == 1 and all(int(x) <= 255 for x in re.findall("[0-9]+", body)))
        or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits))
        or (kind == 3 and 7 <= len(digits) <= 15)
    )


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], field: Field) -> list[list[tuple[int, int, int]]]:
    """What the field finds beyond the base spans, for each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size + 1) - (size + 1)
    start, end, shape, line = tokens(_points("\n".join(texts)))
    if not len(start):
        return out
    label = field.decode(shape, line)
    heads = np.flatnonzero(label % 2 == 1)
    for h in heads.tolist():
        kind, last = (int(label[h]) - 1) // 2, h
        while last + 1 < len(label) and label[last + 1] == label[h] + 1:
            last += 1
        doc = int(np.searchsorted(begin, start[h], "right")) - 1
        a, b = int(start[h] - begin[doc]), int(end[last] - begin[doc])
        if all(b <= s or e <= a for s, _, e in base[doc]) and _well_formed(texts[doc], a, b, kind):
            out[doc].append((a, kind, b))
    return out


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, field: Field | None = None) -> DataFrame:
    """One row per row of docs: id_col, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added.

    Spans are kind:start:end in code points, end exclusive. A null text counts as empty and has no spans. Very long texts
    are read whole, one at a time; lines are what the field sees together. Ties between labels go to the first. Repeated rows
    get the same result; null ids stay null. Other columns are neither read nor returned. An empty table gives an empty
    result.
    """
    model = field or trained()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            texts = batch.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, model)
            counts = [pa.array([sum(s[1] == k for s in own) for own in base], pa.int64()) for k in range(len(KINDS))]
            yield pa.record_batch(
                [batch.column(0), *counts, pa.array([hashlib.sha256(_said(b).encode()).hexdigest() for b in base]), pa.array([_said(sorted(b + m)) for b, m in zip(base, more, strict=True)]), pa.array(list(map(len, more)), pa.int64())],
                names=[id_col, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    schema = f"`{id_col}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    return in_batches(docs.select(F.col(id_col), whole_text(text_col).alias("text")), run, schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))

"""Personal data: base patterns, and spans that a semi-Markov conditional random field adds.

The base patterns mark e-mail addresses, IP addresses, card and phone numbers. The field
scores whole candidate spans (their shape, digits, separators, check digit, and the words
next to them) and chooses boundaries and kinds jointly by dynamic programming over spans of
at most MAX_TOKENS tokens. It learns from the base spans of a bounded sample of texts, with
the plus sign, the grouping and the neighbouring words varied, and adds what the patterns
miss: a phone number without its plus sign, an address written with "at" and "dot".

Only stretches around a digit or an at sign are scored. A span without either has a fixed
score of minus infinity, so cutting the text there leaves the best labelling as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.shared import filled, tune

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the base kinds.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
MAX_TOKENS = 12
#: Texts with base spans that the field learns from, chosen by a hash of the id.
SAMPLE_TEXTS = 400
EPOCHS = 5
#: What a span must score above the empty labelling to be added.
MARGIN = 2.0

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]|\s+")
_HINT = re.compile(r"[0-9@]|\b(?:at|dot)\b", re.I)
_DIGIT = re.compile(r"[0-9]")
_CUES = {"mail": "email", "email": "email", "contact": "email", "tel": "phone", "phone": "phone", "call": "phone", "fax": "phone", "mobile": "phone", "card": "card", "visa": "card", "ip": "ip", "host": "ip", "server": "ip"}

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _holds(kind: str, text: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(p.isdigit() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))
    digits = "".join(_DIGIT.findall(text))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind; offsets are code points."""
    found = []
    for kind in KINDS:
        if kind == "email":
            found += _emails(text)
        else:
            found += [(m.start(), m.end(), kind) for m in PATTERNS[kind].finditer(text) if _holds(kind, m.group())]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> list[Span]:
    """The e-mail pattern's leftmost matches, found from each at sign, so a long run without one costs nothing."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append((start, domain.end(), "email"))
                end = domain.end()
        at = text.find("@", max(at + 1, end))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


# The field: features of a span, the best labelling, learning.


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]


def _shape(text: str) -> str:
    """Digits as runs of 9 by length class, letters as a, the rest as they are, repeats once."""
    out = re.sub(r"[A-Za-z]+", "a", text)
    out = re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 6)}", out)
    return re.sub(r"\s+", " ", out)


def features(text: str, start: int, end: int, kind: str) -> list[str]:
    """Features of a whole span under a kind."""
    span = text[start:end]
    digits = "".join(_DIGIT.findall(span))
    before = re.findall(r"[A-Za-z]+|\S", text[max(0, start - 24) : start])[-2:]
    cue = next((_CUES[w.lower()] for w in reversed(before) if w.lower() in _CUES), "")
    edge = (start == 0 or not (text[start - 1].isalnum() or text[start - 1] in "+@.")) and (end == len(text) or not (text[end].isalnum() or text[end] == "@"))
    names = [f"shape={_shape(span)}", f"digits={len(digits)}", f"edge={edge}", f"letters={any(c.isalpha() for c in span)}", f"at={'@' in span or ' at ' in span.lower()}", f"dots={min(span.count('.') + span.lower().count(' dot '), 4)}", f"separators={len(set(re.findall(r'[^A-Za-z0-9]', span)))}"]
    if 14 <= len(digits) <= 19:
        names.append(f"luhn={luhn(digits)}")
    if cue:
        names.append(f"cue={cue == kind}")
    plain = _plain(span, kind)
    if PATTERNS[kind].fullmatch(plain) and _holds(kind, plain):
        names.append("pattern")
    return [f"{kind}|{x}" for x in names]


def _plain(span: str, kind: str) -> str:
    """A varied writing brought back to the plain one."""
    if kind == "email":
        return re.sub(r"\s*[\[(]?\s*\bdot\b\s*[\])]?\s*", ".", re.sub(r"\s*[\[(]?\s*\bat\b\s*[\])]?\s*", "@", span, flags=re.I), flags=re.I)
    if kind == "phone":
        return span if span.startswith("+") else f"+{span.lstrip('(')}"
    return span


def _windows(text: str, taken: list[Span]) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """Token runs around hints, cut at base spans."""
    free, at = [], 0
    for s, e, _ in sorted(taken):
        if s > at:
            free.append((at, s))
        at = max(at, e)
    free.append((at, len(text)))
    for low, high in free:
        hints = [m.start() for m in _HINT.finditer(text, low, high)]
        k = 0
        while k < len(hints):
            first = last = hints[k]
            while k + 1 < len(hints) and hints[k + 1] - last <= 40:
                k += 1
                last = hints[k]
            k += 1
            a, b = max(low, first - 40), min(high, last + 40)
            tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, a, b)]
            # One unbroken stretch of hints may be as long as the text: work on it in overlapping parts.
            yield tokens, 0


def candidates(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """Spans by token numbers (end exclusive) that can be of some kind at all."""
    for i, (s, _) in enumerate(tokens):
        head = text[s]
        if not (head.isdigit() or head.isalpha() or head in "(+"):
            continue
        for j in range(i + 1, min(i + MAX_TOKENS, len(tokens)) + 1):
            e = tokens[j - 1][1]
            tail = text[e - 1]
            if not (tail.isdigit() or tail.isalpha()):
                continue
            span = text[s:e]
            digits = sum(c.isdigit() for c in span)
            if digits == len(re.sub(r"[^A-Za-z0-9]", "", span)):
                if 10 <= digits <= 15:
                    yield i, j, "phone"
                if 14 <= digits <= 19:
                    yield i, j, "card"
                if span.count(".") == 3 and 4 <= digits <= 12:
                    yield i, j, "ip"
            elif re.search(r"@|\bat\b", span, re.I) and re.search(r"\.|\bdot\b", span, re.I) and head.isalnum():
                yield i, j, "email"


def best(text: str, tokens: list[tuple[int, int]], weights: dict[str, float]) -> list[Span]:
    """The labelling of a token run with the highest score: bounded spans, everything else empty at score 0."""
    scores: dict[int, list[tuple[int, str, float]]] = {}
    for i, j, kind in candidates(text, tokens):
        value = sum(weights.get(f, 0.0) for f in features(text, tokens[i][0], tokens[j - 1][1], kind)) - MARGIN
        if value > 0:
            scores.setdefault(j, []).append((i, kind, value))
    top, back = np.zeros(len(tokens) + 1), [None] * (len(tokens) + 1)
    for j in range(1, len(tokens) + 1):
        top[j], back[j] = top[j - 1], None
        for i, kind, value in scores.get(j, ()):
            if top[i] + value > top[j]:
                top[j], back[j] = top[i] + value, (i, kind)
    out, j = [], len(tokens)
    while j > 0:
        if back[j]:
            i, kind = back[j]
            out.append((tokens[i][0], tokens[j - 1][1], kind))
            j = i
        else:
            j -= 1
    return out[::-1]


def _gradient(text: str, tokens: list[tuple[int, int]], truth: set[Span], weights: dict[str, float]) -> dict[str, float]:
    """Gradient of the log likelihood of one token run: observed less expected features, by forward and backward sums."""
    spans = [(i, j, kind, features(text, tokens[i][0], tokens[j - 1][1], kind)) for i, j, kind in candidates(text, tokens)]
    if not spans:
        return {}
    score = [sum(weights.get(f, 0.0) for f in x[3]) for x in spans]
    n = len(tokens)
    ending, starting = {}, {}
    for k, (i, j, _, _) in enumerate(spans):
        ending.setdefault(j, []).append(k)
        starting.setdefault(i, []).append(k)
    ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1], *[ahead[spans[k][0]] + score[k] for k in ending.get(j, ())]])
    for i in range(n - 1, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1], *[behind[spans[k][1]] + score[k] for k in starting.get(i, ())]])
    out: dict[str, float] = {}
    for k, (i, j, kind, names) in enumerate(spans):
        seen = (tokens[i][0], tokens[j - 1][1], kind) in truth
        move = seen - float(np.exp(ahead[i] + score[k] + behind[j] - ahead[n]))
        if abs(move) > 1e-4:
            for f in names:
                out[f] = out.get(f, 0.0) + move
    return out


def _varied(text: str, span: Span) -> Iterator[tuple[str, Span]]:
    """A labelled stretch as it stands, and in another writing."""
    s, e, kind = span
    left, value, right = text[max(0, s - 60) : s], text[s:e], text[e : e + 60]
    writings = [value]
    if kind == "phone":
        writings.append(value.lstrip("+"))
    if kind == "email":
        writings.append(value.replace("@", " at ").replace(".", " dot "))
    for w in writings:
        yield left + w + right, (len(left), len(left) + len(w), kind)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_texts: int = SAMPLE_TEXTS) -> Model:
    """Learn from at most `sample_texts` texts with base spans; the examples are a few hundred bytes around each span.

    The sample is bounded, so its stretches are learned from in one place by stochastic gradient steps.
    """
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stretches, spans = [], []
            for text in batch.column("text").to_pylist():
                for span in base_spans(text)[:4]:
                    for stretch, at in _varied(text, span):
                        stretches.append(stretch)
                        spans.append(joined([at]))
            yield pa.RecordBatch.from_arrays([pa.array(stretches, pa.string()), pa.array(spans, pa.string())], names=["stretch", "span"])

    hinted = docs.where(F.col(text_col).rlike(r"@[A-Za-z0-9-]+\.|[0-9]{1,3}\.[0-9]{1,3}\.[0-9]|\+[0-9][\x20().0-9-]{8}|[0-9]{14}"))
    chosen = hinted.select(F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h")).orderBy("h").limit(sample_texts)
    rows = chosen.select("text").mapInArrow(run, "stretch string, span string").collect()
    examples = sorted({(r["stretch"], r["span"]) for r in rows})
    weights: dict[str, float] = {}
    for epoch in range(EPOCHS):
        for stretch, span in examples:
            kind, s, e = span.split(":")
            truth = {(int(s), int(e), kind)}
            tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(stretch)]
            for f, g in _gradient(stretch, tokens, truth, weights).items():
                weights[f] = weights.get(f, 0.0) + g * 0.5 / (1 + epoch) - 1e-3 * weights.get(f, 0.0)
    return Model({f: w for f, w in weights.items() if abs(w) > 1e-6})


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Spans of the field outside the base spans."""
    found = []
    for tokens, _ in _windows(text, base):
        found += best(text, tokens, model.weights)
    return found


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the union is replaced, under the first one's kind."""
    out, at = [], 0
    for s, e, kind in sorted(spans):
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_private(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", replace: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added; with replace also the redacted text.

    Null texts count as empty, and stay null when redacted. Rows with a null or repeated id
    are treated like any other. Base spans of different kinds may overlap; added spans
    overlap nothing.
    """
    spark = tune(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, added, texts = [], [], [], [], []
            for value in batch.column(1):
                raw = value.as_py()
                text = raw or ""
                base = base_spans(text) if _HINT.search(text) else []
                more = added_spans(text, base, shared.value) if _HINT.search(text) else []
                both = sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))
                counts.append([sum(s[2] == k for s in base) for k in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(both))
                added.append(len(more))
                if replace:
                    texts.append(raw if raw is None else redacted(text, both))
            columns = [batch.column(0), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(4)], pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]
            if replace:
                columns += [pa.array(texts, pa.string()), *[batch.column(c) for c in range(2, batch.num_columns)]]
                names += ["text", *batch.schema.names[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind_of = dict(docs.dtypes)
    schema = f"doc_id {kind_of[id_col]}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    if not replace:
        return docs.select(F.col(id_col).alias("doc_id"), filled(text_col).alias("text")).mapInArrow(run, schema)
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"other_{k}") for k, c in enumerate(others)])
    schema += ", text string" + "".join(f", other_{k} {kind_of[c]}" for k, c in enumerate(others))
    found = rows.mapInArrow(run, schema)
    return found.select(F.col("doc_id").alias(id_col), F.col("text").alias(text_col), *[F.col(f"other_{k}").alias(c) for k, c in enumerate(others)])

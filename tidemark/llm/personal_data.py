"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans (email, ip, card, phone) are exact patterns with checks and always stay. Wider
patterns give further candidates: written-out addresses, local phone numbers, national ids,
account numbers and secrets. Regular-expression, checksum, gazetteer, context and shape
labelers vote for, against or not at all on every candidate, base ones included.
Expectation-maximisation over the counts of all vote patterns of all documents estimates
each labeler's reliability and each pattern's probability, held to seeds on both sides: spans
named as personal data and spans named as something else; a logistic span classifier is
then trained on these probabilities and on coarse features of the spans. A candidate is a
function of a few small features here, so the counts, the training and the decisions need
one row for each distinct combination, a number that does not grow with the corpus.

Defined cases: a null text is empty; rows without an id are returned; repeated rows are
returned each; without candidates nothing is added; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, stored

BASE = ("email", "ip", "card", "phone")
ADDED = ("address", "local_phone", "national_id", "account", "secret")
KINDS = (*BASE, *ADDED)

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
#: A match begins at the first digit of a run: where that fails, later digits of the run fail too.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_WIDE = {
    "address": re.compile(r"[A-Za-z0-9._%+-]+\s?[\[(]at[\])]\s?[A-Za-z0-9-]+(?:\s?(?:[\[(]dot[\])]|\.)\s?[A-Za-z0-9-]+)+"),
    "local_phone": re.compile(r"(?<![0-9+.-])\(?0[0-9]{1,4}\)?[ /.-][0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9.-])"),
    "national_id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "secret": re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_/+-])"),
}
_AT = re.compile(r"\s?[\[(]at[\])]")
_LONG = re.compile(r"[A-Za-z0-9_-]{20}")
_ACCOUNT_START = re.compile(r"[A-Z]{2}[0-9]{2}")

#: Gazetteers: words right before a span that name it, and words that name something else.
NAMED = {
    "email": {"email", "e-mail", "mail", "mailto", "from", "to", "contact"},
    "ip": {"ip", "host", "address", "server", "client", "from"},
    "card": {"card", "visa", "mastercard", "credit", "amex", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "whatsapp"},
    "address": {"email", "e-mail", "mail", "write", "contact", "reach"},
    "local_phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "whatsapp"},
    "national_id": {"ssn", "social", "security", "id", "number"},
    "account": {"iban", "account", "konto", "bank"},
    "secret": {"token", "secret", "password", "passwd", "key", "api_key", "apikey", "access_key", "bearer", "auth"},
}
OTHER = {"version", "isbn", "issn", "order", "invoice", "page", "pages", "sha", "commit", "rev", "doi", "figure", "chapter"}
#: Context words anywhere in the characters before a span.
CONTEXT = re.compile(r"(?i)\b(call|phone|tel|mail|contact|reach|write|pay|account|bank|login|password|secret|token|key|id)\b")
CONTEXT_CHARS = 48
#: Probability that a seed is what it is taken for.
SEED = 0.98
LABELERS = ("pattern", "checksum", "gazetteer", "context", "shape")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str):
    """Leftmost matches of the address pattern, looked for around each sign only."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _EMAIL.match(text, start) if start < at else None
        if found:
            yield found.start(), found.end()
            done = found.end()
        at = text.find("@", max(done, at + 1))


def _written_addresses(text: str):
    """Leftmost matches of the pattern of written-out addresses, looked for around each marker only."""
    done = 0
    for marker in _AT.finditer(text):
        start = at = marker.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _WIDE["address"].match(text, start) if start < at else None
        if found:
            yield found.start(), found.end()
        done = found.end() if found else marker.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, in order."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def wide_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that overlap neither base spans nor an earlier candidate."""
    out = []
    if "at]" in text or "at)" in text:
        out += [(a, 4, b) for a, b in _written_addresses(text)]
    if _DIGIT.search(text):
        names = ["local_phone", "national_id"]
        names += ["account"] if _ACCOUNT_START.search(text) else []
        names += ["secret"] if _LONG.search(text) else []
        for name in names:
            out += [(m.start(), KINDS.index(name), m.end()) for m in _WIDE[name].finditer(text)]
    taken, kept = sorted((a, b) for a, _, b in base), []
    if out:
        out.sort()
        i, end = 0, -1
        for a, kind, b in out:
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if a >= end and (i == len(taken) or taken[i][0] >= b):
                kept.append((a, kind, b))
                end = b
    return kept


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def votes(text: str, kind: int, a: int, b: int) -> tuple[list[int], int]:
    """Votes of the labelers on a span (1 for, -1 against, 0 none) and its coarse feature number."""
    span, name = text[a:b], KINDS[kind]
    digits = _NOT_DIGIT.sub("", span)
    before = text[max(0, a - CONTEXT_CHARS) : a]
    words = re.findall(r"[\w-]+", before.lower())[-2:]
    strict = {
        "email": lambda: 1 if re.fullmatch(r"[^@]{1,64}@[^@]+\.[A-Za-z]{2,}", span) else -1,
        "ip": lambda: -1 if digits == "0" * len(digits) else 1,
        "card": lambda: 1 if re.fullmatch(r"[2-6][0-9]{12,15}|[2-6][0-9]{3}(?:[ -][0-9]{4}){3}", span) else -1,
        "phone": lambda: -1 if digits[0] == "0" else 1,
        "address": lambda: 1 if re.search(r"[A-Za-z]{2,}\Z", span) else -1,
        "local_phone": lambda: 1 if 9 <= len(digits) <= 12 else -1,
        "national_id": lambda: -1 if span[:3] in ("000", "666") or span[4:6] == "00" or span[0] == "9" else 1,
        "account": lambda: 1 if 15 <= len(span.replace(" ", "")) <= 34 else -1,
        "secret": lambda: 1 if re.fullmatch(r"[0-9a-f]{32,64}|[A-Za-z0-9_-]{24,}", span) else -1,
    }[name]()
    checksum = 0  # cards have passed theirs already, so it tells nothing about them
    if name == "account":
        checksum = 1 if _mod97(span.replace(" ", "")) else -1
    gazetteer = 1 if any(w in NAMED[name] for w in words) else -1 if any(w in OTHER for w in words) else 0
    context = 1 if CONTEXT.search(before) else 0
    rich = _entropy(digits if kind in (1, 2, 3, 5, 6) else span) if span else 0.0
    shape = -1 if rich < 1.5 else 1 if rich > 2.5 else 0
    feature = min(len(span) // 8, 5) * 16 + min(int(4 * len(digits) / max(1, len(span))), 3) * 4 + min(int(rich), 3)
    return [strict, checksum, gazetteer, context, shape], feature


SPANS = (
    "doc_id bigint, base array<struct<a:int,kind:int,b:int>>, "
    "wide array<struct<a:int,kind:int,b:int,pattern:int,feature:int>>, seen array<struct<kind:int,pattern:int,feature:int>>"
)


def _pattern(vote: list[int]) -> int:
    return sum((v + 1) * 3**i for i, v in enumerate(vote))


def _finder(batches):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("base", pa.list_(pa.struct([("a", pa.int32()), ("kind", pa.int32()), ("b", pa.int32())]))),
            ("wide", pa.list_(pa.struct([(c, pa.int32()) for c in ("a", "kind", "b", "pattern", "feature")]))),
            ("seen", pa.list_(pa.struct([(c, pa.int32()) for c in ("kind", "pattern", "feature")]))),
        ]
    )
    for block in blocks(batches, "text"):
        base, wide, seen = [], [], []
        for value in block.column("text"):
            text = value.as_py() or ""
            own = base_spans(text)
            more = wide_spans(text, own)
            base.append([{"a": a, "kind": k, "b": b} for a, k, b in own])
            marks, found = [], []
            for a, kind, b in own + more:
                vote, feature = votes(text, kind, a, b)
                marks.append({"kind": kind, "pattern": _pattern(vote), "feature": feature})
                if kind >= len(BASE):
                    found.append({"a": a, "b": b, **marks[-1]})
            wide.append(found)
            seen.append(marks)
        arrays = [block.column("doc_id").cast(pa.int64())]
        arrays += [pa.array(v, schema.field(i + 1).type) for i, v in enumerate((base, wide, seen))]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def seeds(patterns: np.ndarray) -> np.ndarray:
    """Probability of the vote patterns whose truth is taken as known, nan for all others.

    Personal data: named as such right before the span, with no vote against. Something else: named
    as something else (a version, an order, a commit), without a checksum that holds.
    """
    pattern, checksum, gazetteer, _, shape = patterns.T
    out = np.full(len(patterns), np.nan)
    out[(gazetteer == 1) & (pattern >= 0) & (checksum >= 0) & (shape >= 0)] = SEED
    out[(gazetteer == -1) & (checksum < 1)] = 1 - SEED
    return out


def reliabilities(
    patterns: np.ndarray, counts: np.ndarray, known: np.ndarray | None = None, rounds: int = 50
) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns (rows of -1, 0, 1): accuracy of each labeler and probability of each pattern.

    A labeler that votes is right with its accuracy, whatever the truth; not voting says nothing. An
    accuracy below one half turns a labeler's votes round. ``known`` holds the probabilities of seeds.
    """
    known = np.full(len(patterns), np.nan) if known is None else known
    accuracy, prior = np.full(patterns.shape[1], 0.7), 0.5
    p = np.full(len(patterns), 0.5)
    for _ in range(rounds):
        weight = np.log(accuracy / (1 - accuracy))
        p = 1 / (1 + np.exp(-(patterns @ weight + np.log(prior / (1 - prior)))))
        p = np.where(np.isnan(known), p, known)
        right = (counts[:, None] * np.where(patterns == 1, p[:, None], np.where(patterns == -1, 1 - p[:, None], 0))).sum(axis=0)
        voted = (counts[:, None] * (patterns != 0)).sum(axis=0)
        accuracy = np.clip((right + 7) / (voted + 10), 0.05, 0.99)  # a prior of ten votes
        prior = float(np.clip((counts @ p + 5) / (counts.sum() + 10), 0.05, 0.95))
    return accuracy, p


def _design(kinds: np.ndarray, patterns: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Columns of the span classifier: votes, kind, and bins of length, digit share and entropy."""
    one = lambda v, n: np.eye(n)[v]
    parts = [patterns, one(kinds, len(KINDS)), one(features // 16, 6), one(features // 4 % 4, 4), one(features % 4, 4)]
    return np.column_stack([*parts, np.ones(len(kinds))])


def classify(rows: list[tuple[int, int, int, int]]) -> set[tuple[int, int, int]]:
    """(kind, pattern, feature, count) of all candidates -> the combinations that are personal data."""
    if not rows:
        return set()
    kinds, codes, features, counts = (np.array(c, np.int64) for c in zip(*rows, strict=True))
    patterns = codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3 - 1
    _, p = reliabilities(patterns, counts.astype(float), seeds(patterns))
    x, w = _design(kinds, patterns, features), counts / counts.sum()
    beta = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a small ridge
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (q - p)) + 1e-4 * beta
        hess = (x * (w * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(len(beta))
        beta -= np.linalg.solve(hess, grad)
    q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
    return {(int(k), int(c), int(f)) for k, c, f, y in zip(kinds, codes, features, q, strict=True) if y >= 0.5}


FOUND = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
)


def _joiner(good: set[tuple[int, int, int]]):
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                base = [(s["a"], s["kind"], s["b"]) for s in row["base"]]
                more = [(s["a"], s["kind"], s["b"]) for s in row["wide"] if (s["kind"], s["pattern"], s["feature"]) in good]
                text = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
                n = Counter(k for _, k, _ in base)
                digest = hashlib.sha256(text(base).encode()).hexdigest()
                out.append((row["doc_id"], *(n[k] for k in range(4)), digest, text(base + more), len(more)))
            names = [c.split()[0] for c in FOUND.split(", ")]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def find(docs: DataFrame) -> DataFrame:
    """Personal data of each document (doc_id, text): base counts and digest, and all spans."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    spans = stored(rows.mapInArrow(_finder, SPANS), "pii-spans")
    seen = spans.select(F.explode("seen").alias("s")).groupBy("s.kind", "s.pattern", "s.feature").count()
    good = classify([tuple(r) for r in seen.orderBy("kind", "pattern", "feature").collect()])
    return spans.select("doc_id", "base", "wide").mapInArrow(_joiner(good), FOUND)

"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans (email, ip, card, phone) follow fixed patterns and always stay. Candidates for two
more kinds, ``secret`` (keys, tokens, passwords) and ``name``, come from wide patterns. Labelers
vote on each candidate for, against, or not at all: shape patterns, a gazetteer, words
before the span, licence wording. Votes of all documents are counted by pattern (a bounded
table), expectation-maximisation estimates how reliable each labeler is, and a logistic
classifier over coarse span features is trained on the counts weighted by those estimates. A
candidate is a span if the classifier says so; one that overlaps a base span is dropped.

Null and empty texts have no spans. Repeated rows are searched each on its own. Positions are
code points, ends exclusive. Matching is linear in the length of a text, however long; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm._shared import tidy

Span = tuple[str, int, int]
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "name", "secret")

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# A run of digits is tried from its first digit only: from a later one it fails alike.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Given names, words that announce a name or a secret, licence words.
GIVEN_NAMES = frozenset(
    "Anna Ben Carlos Charlotte Claire Daniel David Elena Emily Emma Felix Hans Jack James Jan Jean John Jose Juan "
    "Julia Karl Laura Lena Lucas Luis Maria Marie Mary Max Michael Paul Peter Pierre Robert Sarah Sofia Thomas".split()
)
TITLES = frozenset("mr mrs ms dr herr frau señor señora madame monsieur dear name contact author".split())
NAME_CUES = re.compile(r"(?i)\b(?:mr|mrs|ms|dr|herr|frau|señor|señora|madame|monsieur|name|contact|dear|author)\b[.:]?\s*$")
SECRET_CUES = re.compile(r"(?i)(?:password|passwort|passwd|pwd|token|secret|api[_-]?key|key|contraseña)\s*[=:]\s*[\"']?$")
LICENCE = re.compile(r"(?i)licen[sc]e|copyright|version|revision|checksum|commit")
_NAMES = re.compile(r"\b[A-ZÀ-Ý][a-zà-ÿ]+(?: [A-ZÀ-Ý][a-zà-ÿ]+)+\b")
_SECRET = re.compile(r"(?<![0-9A-Za-z_])[0-9A-Za-z_+/-]{12,}(?![0-9A-Za-z_])")
_KEY_SHAPE = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,}")
_HEX = re.compile(r"[0-9a-f]{16,}")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches found from their '@': the local part is the whole run before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and not _NOT_LOCAL.match(text, begin - 1):
            begin -= 1
        if begin < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield "email", begin, done
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Base spans by kind as listed, then by start."""
    found = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.groups()):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() <= 2 * 19 else ""
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# --- candidates, labelers, features ---------------------------------------------------------

LABELERS = ("shape", "gazetteer", "cue", "licence", "plain")
FOR, AGAINST, SILENT = 1, 0, -1


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def candidates(text: str) -> Iterator[tuple[Span, tuple[int, ...], str]]:
    """(span, votes, features) of each candidate."""
    digits = bool(_DIGIT.search(text))
    for m in _SECRET.finditer(text) if digits else ():
        value = m.group()
        if not _DIGIT.search(value) or not any(c.isalpha() for c in value):
            continue
        before = text[max(0, m.start() - 40) : m.start()]
        key, hexa, cue = bool(_KEY_SHAPE.fullmatch(value)), bool(_HEX.fullmatch(value)), bool(SECRET_CUES.search(before))
        entropy = _entropy(value)
        votes = (
            FOR if key or hexa else SILENT,
            SILENT,
            FOR if cue else SILENT,
            AGAINST if LICENCE.search(before) else SILENT,
            AGAINST if entropy < 3 else SILENT,
        )
        features = f"key={key} hex={hexa} cue={cue} length={min(len(value) // 8, 8)} entropy={int(entropy)}"
        yield ("secret", *m.span()), votes, features
    for m in _NAMES.finditer(text):
        for first, start, end, n, cue in names_in(m.group().split(" "), m.start(), bool(NAME_CUES.search(text[max(0, m.start() - 20) : m.start()]))):
            known = first in GIVEN_NAMES
            votes = (SILENT, FOR if known else AGAINST, FOR if cue else SILENT, SILENT, AGAINST if len(first) < 3 else SILENT)
            yield ("name", start, end), votes, f"known={known} cue={cue} length={min((end - start) // 8, 4)} words={min(n, 4)}"


def names_in(words: list[str], start: int, cue: bool) -> Iterator[tuple[str, int, int, int, bool]]:
    """(first word, start, end, words, announced) of the names in a run of capitalised words that starts at ``start``.

    A name begins after a title, at the run's beginning where the words before announce one, or at a given name; it goes on
    to the next such place or the run's end. Given names in a row are of one name. Words before the first such place are no name.
    """
    at, begun = start, None  # begun: first word, start, end so far, words, announced, only given names so far
    for word in words:
        end = at + len(word)
        if word.lower() in TITLES:
            if begun:
                yield begun[:5]
            begun, cue = None, True
        elif begun and not (word in GIVEN_NAMES and not begun[5]):
            begun = (begun[0], begun[1], end, begun[3] + 1, begun[4], begun[5] and word in GIVEN_NAMES)
        elif cue or word in GIVEN_NAMES:
            if begun:
                yield begun[:5]
            begun, cue = (word, at, end, 1, cue, word in GIVEN_NAMES), False
        at = end + 1
    if begun:
        yield begun[:5]


# --- label model and classifier -------------------------------------------------------------


def label_model(votes: np.ndarray, counts: np.ndarray, steps: int = 50) -> np.ndarray:
    """Probability that each vote pattern is a span: EM over labeler reliabilities (one truth, two classes)."""
    said = votes != SILENT
    yes = votes == FOR
    belief = np.where(said.any(1), (yes.sum(1) + 0.5) / (said.sum(1) + 1), 0.2)
    for _ in range(steps):
        weight = np.stack([counts * (1 - belief), counts * belief])  # class x pattern
        prior = (weight.sum(1) + 1) / (counts.sum() + 2)
        # P(vote for | class, votes at all), and P(votes at all | class); a labeler is better than chance a priori.
        hint = np.array([[1.0], [4.0]])
        right = (weight @ yes + hint) / (weight @ said + 5)
        speaks = (weight @ said + 1) / (weight.sum(1, keepdims=True) + 2)
        log = np.log(prior)[:, None] + np.where(
            said[None], np.log(speaks)[:, None] + np.where(yes[None], np.log(right)[:, None], np.log(1 - right)[:, None]),
            np.log(1 - speaks)[:, None],
        ).sum(2)
        belief = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return belief


def span_classifier(features: list[str], target: np.ndarray, counts: np.ndarray, steps: int = 300) -> dict[str, float]:
    """Weights by feature of a logistic classifier trained on soft targets."""
    names = {name: k for k, name in enumerate(sorted({n for f in features for n in f.split()}))}
    x = np.zeros((len(features), len(names) + 1))
    x[:, -1] = 1
    for row, f in enumerate(features):
        x[row, [names[n] for n in f.split()]] = 1
    w, share = np.zeros(x.shape[1]), counts / counts.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 2.0 * (x.T @ (share * (p - target)) + 1e-4 * w)
    return {name: float(w[k]) for name, k in names.items()} | {"": float(w[-1])}


def train(docs: DataFrame) -> dict[str, dict[str, float]]:
    """Classifier weights by kind. What reaches the driver is one row for each vote and feature pattern."""

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for (kind, _, _), votes, features in candidates(text or ""):
                    seen[kind, ",".join(map(str, votes)), features] += 1
        rows = list(seen)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([r[k] for r in rows], pa.string()) for k in range(3)), pa.array([seen[r] for r in rows], pa.int64())],
            ["kind", "votes", "features", "n"],
        )

    counted = (
        docs.select("text")
        .mapInArrow(tidy(patterns), "kind string, votes string, features string, n long")
        .groupBy("kind", "votes", "features")
        .agg(F.sum("n").alias("n"))
        .orderBy("kind", "votes", "features")
        .collect()
    )
    model = {}
    for kind in sorted({r["kind"] for r in counted}):
        rows = [r for r in counted if r["kind"] == kind]
        counts = np.array([r["n"] for r in rows], float)
        belief = label_model(np.array([[int(v) for v in r["votes"].split(",")] for r in rows]), counts)
        model[kind] = span_classifier([r["features"] for r in rows], belief, counts)
    return model


def all_spans(text: str, model: dict[str, dict[str, float]]) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans, by kind as listed and start."""
    base = base_spans(text)
    added = []
    for span, _, features in candidates(text):
        weights = model.get(span[0], {})
        if weights.get("", 0) + sum(weights.get(n, 0) for n in features.split()) > 0:
            if not any(start < span[2] and span[1] < end for _, start, end in base):
                added.append(span)
    return base, base + sorted(added)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    model = train(docs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, spans = all_spans(text or "", model)
                n = Counter(kind for kind, _, _ in base)
                rows.append((*(n[k] for k in BASE_KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            columns = [pa.array([r[k] for r in rows], kinds[k]) for k in range(6)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        search, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first and longest is named."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame) -> DataFrame:
    """All documents and columns, personal data in the text replaced, n_chars counted anew. Null stays null."""
    model = train(docs)
    names = docs.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            texts = [t and masked(t, all_spans(t, model)[1]) for t in batch.column(at).to_pylist()]
            columns = dict(zip(names, batch.columns, strict=True)) | {"text": pa.array(texts, pa.string())}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.withColumn("n_chars", F.col("n_chars").cast("long")).mapInArrow(tidy(rewrite), docs.schema) if "n_chars" in names else docs.mapInArrow(tidy(rewrite), docs.schema)

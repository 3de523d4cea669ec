"""Personal data: e-mail and IP addresses, card and phone numbers.

The base patterns give spans that always count.  Beside them, generators with high recall
propose spans in other spellings (``name at host dot com``, a phone number without ``+``,
a card number with dots); proposals may overlap.  Boosted trees judge each proposal by its
format (digits, groups, separators, check digits) and context (neighbouring characters,
words like "call" or "card" in front).  Proposals above the calibrated threshold of their
kind are taken, best first, where they overlap no span taken before.

Every kind has trees of its own, which learn from all documents.  Base spans, and the same data
respelled, are positive; base spans broken on purpose, and proposals that cannot be data of
their kind (``impossible``), are negative.  Other proposals in real texts may be genuine and
teach nothing.  The examples of a third of the documents, told by a hash of their ids (of their
texts, without an id), set the thresholds, for a precision of ``PRECISION``; those of the others
grow the trees.  A kind without positive examples on both sides, or without negative ones for
its trees, gets no spans beyond the base.  Examples stay in Spark, equal ones as one row with a
count; the driver sees sums of them: by node, feature and bin for the trees, by kind and step of
the score for the thresholds.

NULL and empty texts have no spans; whole texts are read, however long; repeated rows give
repeated results, and an empty table none.  Positions count code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.llm.arrow import slices
from alertfold.llm.boosting import Boosted, binned_rows, by_kind, fit_table, unpacked
from alertfold.llm.common import cut

SAMPLE = None  # nothing is sampled; the name stays for a test that sets it
STEPS = 1 << 14  # of the score, for the thresholds
EXAMPLE_ROWS = 5000  # a task hands over at once, however many a text gives
PRECISION = 0.98
CONTEXT = 40

# The base patterns
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The generators: other spellings, wide on purpose (those of e-mail addresses start from ``AT``)
WIDE = {
    "ip": re.compile(r"[0-9]{1,3}(?: ?(?:[.,]|\[\.\]|\(\.\)| dot ) ?[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[ ._/-]{0,2}[0-9]){12,18}"),
    "phone": re.compile(r"(?:\+|00)?[0-9(][0-9() ./-]{5,20}[0-9]"),
}
CUES = {
    "email": re.compile(r"mail|contact|write|reach", re.I),
    "ip": re.compile(r"\bip\b|address|server|host|login", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|pay", re.I),
    "phone": re.compile(r"phone|call|tel|mobile|fax|cell|whatsapp", re.I),
}
# Frequent last labels of hosts
SUFFIXES = frozenset("com org net edu gov mil int info biz io co ai dev app eu us uk ca au de fr es it nl at ch be pl pt "
                     "se no dk fi ie cz jp cn kr in br mx ar ru test local example invalid".split())
LABEL = re.compile(r"[\w-]*")
WORDS = re.compile(r"[^\W\d_]{2,12}")
DIGIT_RUN = re.compile(r"[0-9]+")
HAS_DIGIT = re.compile(r"[0-9]")
DOT_WORD = re.compile(r"[ (\[{]dot[ )\]}]", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGIT_RUN.findall(text))


def _emails(text: str):
    """Matches of local@domain, found from each ``@``: the local part is the run in front of
    it, since ``@`` is not of the run's characters."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (text[start - 1] in _LOCAL_CHARS):
            start -= 1
        right = DOMAIN.match(text, at + 1) if start < at else None
        if right:
            end = right.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not HAS_DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        d = _digits(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def propose(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Wide matches in the stretches between base spans."""
    kinds = []
    if "@" in text or DOT_WORD.search(text):
        kinds.append("email")
    if HAS_DIGIT.search(text):
        kinds += ["ip", "card", "phone"]
    if not kinds:
        return []
    stretches, lo = [], 0
    for a, b in sorted((a, b) for _, a, b in base):
        if lo < a:
            stretches.append((lo, a))
        lo = max(lo, b)
    if lo < len(text):
        stretches.append((lo, len(text)))
    out = []
    for kind in kinds:
        for lo, hi in stretches:
            found = (_spelled_emails(text, lo, hi) if kind == "email"
                     else (m.span() for m in WIDE[kind].finditer(text, lo, hi)))
            out.extend((kind, a, b) for a, b in found)
    return out


#: The at of an address, and what follows it.  Possessive: a run is read once, however long.
AT = re.compile(r" ?(?:@|\(at\)|\[at\]|\{at\}| at ) ?", re.I)
HOST = re.compile(r"[\w-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot ) ?[\w-]++)++", re.I)
NAME_BACKWARDS = re.compile(r"[\w.%+-]+")


def _name_start(text: str, lo: int, end: int) -> int:
    """Where the run of name characters that ends at ``end`` starts, ``lo`` at the earliest."""
    width = 64
    while True:
        at = max(lo, end - width)
        m = NAME_BACKWARDS.match(text[at:end][::-1])
        start = end - (m.end() if m else 0)
        if start > at or at == lo:
            return start
        width *= 2


def _spelled_emails(text: str, start: int, stop: int):
    """Wide e-mail matches in a stretch: for each at, the whole name in front of it and the whole
    host behind it.  Every character is read a bounded number of times."""
    done, at = start, AT.search(text, start, stop)
    while at:
        host = HOST.match(text, at.end(), stop)
        a = _name_start(text, done, at.start()) if host else at.start()
        if a < at.start():
            done = host.end()
            yield a, done
        at = AT.search(text, max(at.start() + 1, done), stop)


def features(text: str, kind: str, a: int, b: int) -> list[float]:
    span, before, after = text[a:b], text[max(0, a - CONTEXT):a], text[b:b + 1]
    groups = DIGIT_RUN.findall(span)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    letters = sum(c.isalpha() for c in span)
    left = before[-1:]
    return [
        *(float(kind == k) for k in KINDS), len(span), len(digits), letters, len(groups), max(sizes), min(sizes),
        sizes[-1], span.count(" "), span.count("-"), span.count("."), float("(" in span), float("+" in span),
        float("@" in span), float(bool(DOT_WORD.search(span))), float(len(digits) >= 2 and luhn(digits)),
        float(bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        float(left.isalnum()), float(left in set("._-/#@$€£") and left != ""), float(after.isalnum()),
        float(after in set("-/%@") and after != ""), float(bool(CUES[kind].search(before))),
        float(any(c.search(before) for c in CUES.values())), float(digits.startswith("0")),
        float(kind == "email" and LABEL.match(span[::-1]).group()[::-1].lower() in SUFFIXES),
    ]


def respell(kind: str, span: str, rng: random.Random) -> str:
    """The same data in another spelling."""
    if kind == "email":
        at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), ("(at)", "."), (" (at) ", " (dot) "), (" @ ", ".")])
        name, domain = span.split("@")
        return name + at + domain.replace(".", dot)
    if kind == "ip":
        return span.replace(".", rng.choice(["[.]", " . ", "(.)", " dot "]))
    digits = _digits(span)
    if kind == "card":
        sep = rng.choice([".", "/", "_", " - ", "  "])
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    tail = f"{digits[-10:-7]}{{0}}{digits[-7:-4]}{{1}}{digits[-4:]}"
    seps = rng.choice([("-", "-"), (" ", " "), (".", "."), (") ", "-")])
    return rng.choice(["00" + digits[:-10] + " ", "", ""]) + ("(" if seps[0] == ") " else "") + tail.format(*seps)


def break_up(kind: str, span: str, words: list[str], rng: random.Random) -> str:
    """Something that looks alike and is no personal data; ``words`` are of the text around."""
    if kind == "email":
        if words and rng.random() < 0.5:
            a, b, c = (rng.choice(words) for _ in range(3))
            return rng.choice([f"{a} at {b} dot {c}", f"{a} at the dot {b}", f"{a} at the {b} dot {c} dot", f"{a} at {b}. {c}"])
        return span.replace("@", rng.choice([" ", ".", "/"]))
    if kind == "ip":
        return ".".join(str(rng.randint(256, 999)) for _ in range(4))
    digits = _digits(span)
    if kind == "card":
        return digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
    return rng.choice([f"{rng.randint(1900, 2100)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
                       f"{rng.randint(1, 99)}.{rng.randint(100, 999)}.{rng.randint(100, 999)}", digits[:6],
                       f"{rng.randint(10 ** 6, 10 ** 9)}"])


def impossible(kind: str, span: str) -> bool:
    """Whether no spelling of the kind's data reads like that."""
    groups = DIGIT_RUN.findall(span)
    digits = "".join(groups)
    if kind == "email":
        return not any(c.isalpha() for c in span)
    if kind == "ip":
        return any(int(g) > 255 for g in groups)
    if kind == "card":
        return not (16 <= len(digits) <= 19 and luhn(digits))
    return not 7 <= len(digits) <= 15


def examples(key: str, text: str) -> Iterator[tuple[str, float, list[float]]]:
    """(kind, label, features) rows of one document."""
    base = base_spans(text)
    for k, a, b in propose(text, base):
        if impossible(k, text[a:b]):
            yield k, 0.0, features(text, k, a, b)
    rng = random.Random(f"{key}")
    for kind, a, b in base:
        yield kind, 1.0, features(text, kind, a, b)
        lead = rng.choice(["", "", "call ", "mail ", "card ", "ip "]) if rng.random() < 0.5 else ""
        around = WORDS.findall(text, max(0, a - 10 * CONTEXT), b + 10 * CONTEXT) if kind == "email" else []
        for label, changed in ((1.0, respell(kind, text[a:b], rng)), (0.0, break_up(kind, text[a:b], around, rng))):
            new = text[max(0, a - CONTEXT):a] + lead + changed + text[b:b + CONTEXT]
            for k, x, y in propose(new, base_spans(new)):
                inside = x >= min(a, CONTEXT) - 1 and y <= len(new) - len(text[b:b + CONTEXT]) + 1
                if inside:
                    yield k, label * (k == kind), features(new, k, x, y)


def _example_rows(batches):
    def all_of(batch):
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            key = str(i) if i is not None else hashlib.sha256((text or "").encode()).hexdigest()
            held = zlib.crc32(key.encode()) % 3 == 0
            for kind, label, x in examples(key, text or ""):
                yield kind, held, float(label), x

    types = [pa.string(), pa.bool_(), pa.float64(), pa.list_(pa.float64())]
    for batch in batches:
        for part in slices(batch, 1):
            found = all_of(part)
            while rows := list(islice(found, EXAMPLE_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)],
                                                 names=["kind", "held", "label", "x"])


class Judges:
    """The trees of every kind; a row of ``features`` begins with its kind."""

    def __init__(self, trees: dict[str, Boosted]):
        self.trees = trees

    def probability(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for j, kind in enumerate(KINDS):
            of_kind = x[:, j] == 1
            if kind in self.trees and of_kind.any():
                out[of_kind] = self.trees[kind].probability(x[of_kind])
        return out


def fit(docs: DataFrame):
    """Trees and a threshold per kind, or None where no kind has examples of both labels."""
    docs = docs.select("doc_id", "text")
    rows = cut(docs.mapInArrow(_example_rows, "kind string, held boolean, label double, x array<double>")
               .groupBy("kind", "held", "label", "x").agg(F.count("*").alias("n")))
    trees = fit_table(rows.filter("NOT held"))
    if not trees:
        return None
    held = binned_rows(rows.filter("held"), trees)

    def scores(batches):
        for batch in batches:
            for kind, part in by_kind(batch, trees):
                x, label, n = unpacked(part)
                step = np.floor(trees[kind].binned_probability(x) * STEPS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("kind"), pa.array(step), part.column("n"), pa.array(n * label)],
                                                 names=["kind", "step", "n", "yes"])

    steps = (held.mapInArrow(scores, "kind string, step int, n bigint, yes double")
             .groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("yes").alias("yes")).toPandas())
    limits = {}
    for kind in KINDS:
        own = steps[steps["kind"] == kind].sort_values("step", ascending=False)
        limits[kind] = _threshold(own["step"].to_numpy() / STEPS, own["n"].to_numpy(), own["yes"].to_numpy())
    return Judges(trees), limits


def _threshold(p: np.ndarray, n: np.ndarray, yes: np.ndarray) -> float:
    """The lowest of the falling scores from which on up at least ``PRECISION`` are positive;
    above 1 if none is.  ``n`` examples, ``yes`` of them positive, have each score."""
    if not yes.any():
        return 2.0
    good = np.flatnonzero(np.cumsum(yes) / np.cumsum(n) >= PRECISION)
    return max(0.5, float(p[good[-1]])) if len(good) else 2.0


def find_spans(texts: list[str], model) -> list[tuple[list, list]]:
    """(base spans, added spans) per text."""
    bases = [base_spans(t) for t in texts]
    added: list[list] = [[] for _ in texts]
    if model is None:
        return list(zip(bases, added))
    trees, limits = model
    asked = [(i, s) for i, t in enumerate(texts) for s in propose(t, bases[i]) if limits[s[0]] <= 1]
    if asked:
        p = trees.probability(np.array([features(texts[i], *s) for i, s in asked]))
        taken: list[list[tuple[int, int]]] = [[] for _ in texts]  # apart from each other, in order
        for k in np.lexsort(([s[1] for _, s in asked], -p)):
            i, (kind, a, b) = asked[k]
            at = bisect(taken[i], (a, a))
            free = (at == 0 or taken[i][at - 1][1] <= a) and (at == len(taken[i]) or taken[i][at][0] >= b)
            if p[k] >= limits[kind] and free:
                taken[i].insert(at, (a, b))
                added[i].append((kind, a, b))
    return list(zip(bases, added))


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256``, ``spans``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches):
        for batch in batches:
            found = find_spans([t or "" for t in batch.column(1).to_pylist()], shared.value)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            digest = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found]
            spans = [_joined(base + more) for base, more in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digest, pa.string()), pa.array(spans, pa.string())], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS)
                           + ", base_sha256 string, spans string")


def redact(text: str | None, spans: str) -> str | None:
    """The text with every span of ``detect``'s ``spans`` replaced by its kind."""
    if not text or not spans:
        return text
    cuts = sorted(((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(","))), reverse=True)
    edge = len(text)
    for a, b, k in cuts:
        b = min(b, edge)  # base spans of two kinds may overlap
        if a < b:
            text = f"{text[:a]}[{k}]{text[b:]}"
        edge = min(edge, a)
    return text

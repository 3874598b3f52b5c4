"""Personal data: proposed spans, boosted trees and a calibrated threshold.

Generators propose overlapping spans with high recall: the four strict formats, and looser forms of
each. Boosted trees judge a loose proposal by its format and its surroundings. They learn what such data
looks like from strict matches rewritten in place to loose forms, without the markers (+, @) that make
them strict, and what it does not look like from strict-free look-alikes: ids, enumerations, numbers
that fail a check. Loose forms that could be either teach nothing. A loose span is added where its
probability reaches a threshold, which is calibrated on examples that the trees have not seen. Strict
matches always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import boosting
from tidemark.llm.common import numbered, stored, take

# The kinds in their order and the formats of strict matches.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Looser forms. Each starts at a digit or a marker, and none can run on: lengths are bounded.
LOOSE = (
    ("email", re.compile(r"[\w.%+-]{1,64}[ ]?(?:\(at\)|\[at\]|\{at\}|＠)[ ]?[\w-]{1,63}(?:[ ]?(?:\.|\(dot\)|\[dot\])[ ]?[\w-]{1,63}){1,5}", re.IGNORECASE)),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[ ]?[.,][ ]?[0-9]{1,3}){3}(?![0-9.])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])")),
)
MARKER = re.compile(r"\(at\)|\[at\]|\{at\}|＠", re.IGNORECASE)
DIGITS = re.compile(r"[0-9][0-9 .,()-]{5}")
CUES = tuple(re.compile(c) for c in (r"mail|e-mail|contact", r"\bip\b|addr|host|server", r"card|visa|credit|karte|carte|tarjeta", r"tel|phone|call|mobil|fax"))
PRECISION, CERTAIN = 0.999, 0.98
# Different rows of bins that are added up on the driver (24 bytes each and some doubles), and steps of the threshold.
HELD, STEPS = 2**18, 2**20
Span = tuple[int, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match holds exactly one @: look left and right of each, not from every start."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def strict_spans(text: str) -> list[Span]:
    """(kind, start, end) of the strict matches by kind, then start."""
    out: list[Span] = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def proposals(text: str) -> list[Span]:
    """Strict matches and loose forms, each once."""
    found = strict_spans(text)
    known = set(found)
    digits, marked = DIGITS.search(text) is not None, MARKER.search(text) is not None
    for name, pattern in LOOSE:
        if marked if name == "email" else digits:
            for m in pattern.finditer(text):
                span = (KINDS.index(name), *m.span())
                if span not in known:
                    known.add(span)
                    found.append(span)
    return found


def loosened(kind: int, body: str) -> list[str]:
    """A strict match in the loose forms of its kind."""
    if kind == 0:
        name, host = body.split("@")
        out = [f"{name} (at) {host}", f"{name}[at]{host}", f"{name}＠{host}", f"{name} (at) {host.replace('.', ' (dot) ')}", f"{name} [at] {host.replace('.', '[dot]')}"]
    elif kind == 1:
        out = [body.replace(".", " . "), body.replace(".", ". "), body.replace(".", " .")]
    elif kind == 2:
        digits = re.sub("[^0-9]", "", body)
        out = [".".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    else:
        groups = re.findall(r"[0-9]+", body)
        # Without the country's code, and with 00 for +.
        local = re.sub(r"^\+[0-9]+[ .-]?", "", body) if len(groups) > 1 else ""
        out = [local, " ".join(groups[1:]), "-".join(groups[1:]), ".".join(groups[1:]), "00" + body[1:], "00" + " ".join(groups), "00" + "-".join(groups)]
    pattern = LOOSE[kind][1]
    return [x for x in dict.fromkeys(out) if pattern.fullmatch(x)]


def imitated(kind: int, body: str) -> list[str]:
    """Look-alikes of a strict match's form: an id of its digits, an enumeration, a number that fails the check."""
    digits = re.sub("[^0-9]", "", body)
    if kind == 0:
        return []
    if kind == 1:
        first, rest = body.split(".", 1)
        out = [f"{int(first) % 256 + 300}.{rest}", body.replace(".", ","), body.replace(".", ", ")]
    elif kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        out = [wrong, *(c.join(wrong[i : i + 4] for i in range(0, len(wrong), 4)) for c in " -.")]
    else:
        out = [digits[-10:], digits[-9:], f"20{digits[-2:]} {digits[-4:]} {digits[-5:-1]}", f"{digits[:5]} {digits[-4:]}"]
    pattern = LOOSE[kind][1]
    return [x for x in dict.fromkeys(out) if pattern.fullmatch(x) and not (kind == 3 and x.startswith("00"))]


def look_alike(text: str, span: Span) -> bool:
    """A loose form that is no personal data, whatever surrounds it; False where it could be."""
    kind, start, end = span
    groups = re.findall(r"[0-9]+", text[start:end])
    if kind == 1:
        return "," in text[start:end] or any(len(g) > 3 or int(g) > 255 for g in groups) or max(map(len, groups)) == 1
    if kind == 2:
        return not _luhn("".join(groups))
    if kind == 3:
        longer = re.search(r"[0-9][.,-]?$", text[max(0, start - 2) : start]) or re.match(r"[.,-]?[0-9]", text[end : end + 2])
        plain = len(groups) == 1 or len(groups[0]) > 4 or len(groups[0]) == 4 and groups[0][0] != "0"
        return bool(longer) or plain and not groups[0].startswith("00")
    return False


def examples(text: str) -> Iterator[tuple[str, Span, bool, str]]:
    """(text, span, is personal data, what it was made from) to learn from."""
    strict = strict_spans(text)
    for kind, start, end in strict:
        before, after = text[max(0, start - 24) : start], text[end : end + 2]
        source = before + text[start:end] + after
        for label, forms in ((True, loosened(kind, text[start:end])), (False, imitated(kind, text[start:end]))):
            for form in forms:
                yield before + form + after, (kind, len(before), len(before) + len(form)), label, source
    for span in proposals(text):
        if all(span[2] <= s[1] or s[2] <= span[1] for s in strict) and look_alike(text, span):
            yield text, span, False, text[max(0, span[1] - 24) : span[2] + 2]


def _digest(body: str) -> int:
    return int.from_bytes(hashlib.blake2b(body.encode("utf-8", "replace"), digest_size=7).digest())


def _sort_of(char: str) -> float:
    return 0.0 if not char else 1.0 if char.isspace() else 2.0 if char.isalpha() else 3.0 if char.isdigit() else 4.0


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    body, before, after = text[start:end], text[max(0, start - 24) : start].lower(), text[end : end + 2]
    digits, letters = sum(c.isdigit() for c in body), sum(c.isalpha() for c in body)
    groups = [len(g) for g in re.findall(r"[0-9]+", body)]
    return [
        float(kind), float(len(body)), digits / len(body), letters / len(body),
        float(body.count(" ")), float(body.count("-")), float(body.count(".")), float(body.count("(")), float(body.count("@")),
        float(body[0] == "+"), float(text[max(0, start - 1) : start] == "+"), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(groups[0] if groups else 0), float(groups[-1] if groups else 0), len(set(body)) / len(body),
        _sort_of(before[-1:]), _sort_of(after[:1]), float(before.endswith(("=", '"', ":"))),
        *[float(c.search(before) is not None) for c in CUES],
    ]


@dataclass
class Detector:
    trees: boosting.Trees | None
    threshold: float

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """Strict spans, and strict with added ones, each by kind, then start."""
        text = text or ""
        strict = strict_spans(text)
        more = [s for s in proposals(text) if s not in set(strict)] if self.trees else []
        if not more:
            return strict, strict
        p = self.trees.probability(np.array([features(text, s) for s in more]))
        kept: list[Span] = []
        for i in np.lexsort(([s[1] for s in more], -p)):
            span = more[i]
            if p[i] >= self.threshold and all(span[2] <= s[1] or s[2] <= span[1] for s in [*strict, *kept]):
                kept.append(span)
        return strict, sorted([*strict, *kept])


def learned(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """All different examples of all texts: features x, label y, and whether they belong to the half that fits the trees.

    Copies of a document propose the same, so that one of each is enough. All forms of one match are in the same half.
    """
    picked = take(docs, *columns).toDF("doc_id", "text").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = (example for text in batch["text"] for example in examples(text.as_py() or ""))
            while part := list(islice(every, 4096)):
                marks = [_digest(told[max(0, span[1] - 24) : span[2] + 2] + KINDS[span[0]]) for told, span, _, _ in part]
                yield pa.RecordBatch.from_pydict(
                    {
                        "x": pa.array([features(told, span) for told, span, _, _ in part], pa.list_(pa.float64())),
                        "y": pa.array([label for _, _, label, _ in part], pa.bool_()),
                        "mark": pa.array(marks, pa.int64()),
                        "fits": pa.array([_digest(source) % 2 == 0 for _, _, _, source in part], pa.bool_()),
                    }
                )

    return picked.mapInArrow(run, "x array<double>, y boolean, mark long, fits boolean").distinct()


def fit(docs: DataFrame, precision: float = PRECISION, columns: Sequence[str] = ("doc_id", "text"), held: int = HELD) -> Detector:
    """Train on all different examples of all documents.

    Half of them fit the trees; the other half give the threshold, the smallest probability (in steps of 1 / ``STEPS``), no
    less than ``CERTAIN``, from which on at least ``precision`` of the examples are personal data. Without both labels
    nothing is added. Examples whose features fall into the same bins are counted; up to ``held`` different ones are
    added up on the driver, more of them by Spark for every level of every tree, which gives the same trees.
    """
    rows = stored(learned(docs, columns), "pii-examples")
    counts = {(r["fits"], r["y"]): r["n"] for r in rows.groupBy("fits", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    yes, no = counts.get((True, True), 0), counts.get((True, False), 0)
    if not yes or not no or yes + no == sum(counts.values()):
        return Detector(None, 1.0)
    width = len(features("0", (0, 0, 1)))
    at = F.array(*[F.lit(i / boosting.BINS) for i in range(1, boosting.BINS)])
    # Lengths and counts of a loose form are bounded, so a feature has a bounded number of values, and these are counted.
    cuts = rows.filter("fits").agg(*[F.percentile(F.col("x")[f], at).alias(f"f{f}") for f in range(width)]).first()
    cuts = [np.unique(c) for c in cuts]

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch["x"].flatten().to_numpy().reshape(-1, width)
                packed = [b.tobytes() for b in boosting.binned(x, cuts)]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch["y"], batch["fits"]], ["bins", "y", "fits"])

    alike = rows.select("x", "y", "fits").mapInArrow(bins, "bins binary, y boolean, fits boolean").groupBy("bins", "fits")
    alike = stored(alike.agg(F.count_if("y").alias("yes"), F.count_if(~F.col("y")).alias("no")), "pii-counted")
    fits, tests = alike.filter("fits"), alike.filter("not fits").select("bins", "yes", "no")
    few = fits.count() <= held
    sums = boosting.Held(*boosting.unpacked(fits.select("bins", "yes", "no").toArrow().combine_chunks().to_batches()[0])) if few else boosting.Spread(fits, width)
    trees = boosting.fit(sums, cuts, yes / (yes + no))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                step = np.floor(trees.probability(boosting.unpacked(batch)[0], binned=True) * STEPS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(step), batch["yes"], batch["no"]], ["step", "yes", "no"])

    certain = tests.mapInArrow(steps, "step long, yes long, no long").filter(F.col("step") >= int(np.ceil(CERTAIN * STEPS)))
    by_step = certain.groupBy("step").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).toPandas().sort_values("step", ascending=False)
    right, wrong = by_step["yes"].cumsum().to_numpy(), by_step["no"].cumsum().to_numpy()
    enough = np.flatnonzero(right >= precision * (right + wrong))
    return Detector(trees, float(by_step["step"].iloc[enough[-1]] / STEPS) if len(enough) else 2.0)


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, detector: Detector | None = None, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """Per row: doc_id, counts of strict matches by kind, SHA-256 of the strict spans, all spans.

    NULL and empty texts have no spans. Positions are code points, ends exclusive. Repeated rows and
    NULL ids each get their row; an empty table gives none. Further columns are ignored.
    """
    detector = detector or fit(docs, columns=columns)
    picked = take(docs, *columns).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [detector.spans(x.as_py()) for x in batch["text"]]
            counts = [pa.array([sum(s[0] == k for s in strict) for strict, _ in found], pa.int64()) for k in range(len(KINDS))]
            digests = [hashlib.sha256(joined(strict).encode()).hexdigest() for strict, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *counts, pa.array(digests, pa.string()), pa.array([joined(s) for _, s in found], pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return picked.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str | None, spans: Sequence[Span]) -> str | None:
    """Each span gives way to its kind in brackets; of overlapping spans the first decides the name."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """The documents, all columns in place, with the spans of their texts redacted and n_chars renewed.

    NULL and empty texts stay as they are; n_chars changes only with its text. Of overlapping spans the first names the
    redaction. Repeated rows and NULL ids each keep their row; an empty table gives none. Further columns stay, whatever
    their names.
    """
    detector = detector or fit(docs)
    wide, of = numbered(docs)
    text = int(of("text")[1:])
    chars = int(of("n_chars")[1:]) if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(text).to_pylist()
            new = [redacted(t, detector.spans(t)[1]) for t in old]
            columns = list(batch.columns)
            columns[text] = pa.array(new, batch.schema.field(text).type)
            if chars is not None:
                counted = [n if a == b else len(b) for n, a, b in zip(batch.column(chars).to_pylist(), old, new, strict=True)]
                columns[chars] = pa.array(counted, batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return wide.mapInArrow(run, wide.schema).toDF(*docs.columns)

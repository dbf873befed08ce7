"""Personal data by fixed patterns and a semi-Markov conditional random field.

Patterns find the base spans: email, ip, card and phone. The field adds spans
that the patterns miss (written-out or bracketed "at" and "dot", cards cut by
dots or slashes, phones without plus sign). Around every sign that can belong
to an entity (a digit, an at sign, a bracketed or spelled "dot") a window of
tokens is cut out; candidate segments are runs of up to ``LONGEST`` tokens, and
whole-span features (shape, digits, checksum, separators, rewritten form) score
each of them as one of the kinds or, one token at a time, as other text.
Dynamic programming over segment ends picks boundaries and kinds together.
Weights maximise the exact conditional likelihood (forward and backward sums
over segmentations) on windows of a bounded sample of documents, in which the
base spans are the truth and are also rewritten into the forms to be learned. A
decoded segment is added if it meets no base span and its kind's form is whole
after rewriting, so that text without personal data stays without spans.

Offsets are code points, ends exclusive. Defined results: null texts are empty
texts without spans; several kinds may share a place; repeated rows repeat
their results; windows keep a task's work linear in the length of a text; other
columns are kept by ``detect``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import drawn, table

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 1500
#: Characters of each document of the sample that the fit reads at most; detection reads all.
SAMPLE_CHARS = 20_000
#: Training windows taken from the sample.
WINDOWS = 400
LONGEST = 9
CONTEXT = 3
EPOCHS = 6
#: Features are hashed to so many weights per kind.
WEIGHTS = 4096
#: Number of features that every candidate segment has.
ALWAYS = 8

Span = tuple[int, int, str]

# Each pattern starts only where no earlier start could have matched, so a text is read once.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|[\[({<]\s?(?:at|dot)\s?[\])}>]|\bdot\b", re.IGNORECASE)
TOKEN = re.compile(r"\S+")
GOES_ON = re.compile(r"[\[({<]?\s?(?:at|dot|\.)(?:\W|$)", re.IGNORECASE)
EDGES = "\"'“”‘’«»,;:!?|*_`"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind."""
    out: list[Span] = []
    last = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > last and LOCAL.match(text[begin - 1]):
            begin -= 1
        match = DOMAIN.match(text, at) if begin < at else None
        if match:
            out.append((begin, match.end(), "email"))
            last = match.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = only_digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= len(only_digits(m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def rewritten(text: str) -> str:
    """The usual form of a written-out address."""
    text = re.sub(r"\s*[\[({]\s*\.\s*[\])}]\s*", ".", text)
    text = re.sub(r"\s*[\[({<]\s*at\s*[\])}>]\s*|\s+at\s+", "@", text, flags=re.IGNORECASE)
    return re.sub(r"\s*[\[({<]\s*dot\s*[\])}>]\s*|\s+dot\s+", ".", text, flags=re.IGNORECASE)


def whole(kind: str, text: str) -> bool:
    """Whether a segment has the full form of its kind."""
    digits = only_digits(text)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", rewritten(text)))
    if kind == "ip":
        parts = re.split(r"\.", re.sub(r"\s+", "", rewritten(text)))
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return bool(re.fullmatch(r"[0-9]{4}(?:[ ./-]{1,3}[0-9]{2,7}){2,4}", text)) and 12 <= len(digits) <= 19 and luhn(digits)
    return bool(re.fullmatch(r"(?:\(?00\)?[ ./-]?[0-9]{1,3}[ ./-]?)?(?:1[ ./-])?\(?[0-9]{3}\)?[ ./-]{1,2}[0-9]{3}[ ./-]{1,2}[0-9]{4}", text))


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of token offsets around triggers, in order and apart."""
    lines: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        begin = end = m.start()
        for _ in range(CONTEXT + 1):  # to the left, over whole tokens
            while begin > 0 and text[begin - 1].isspace():
                begin -= 1
            while begin > 0 and not text[begin - 1].isspace():
                begin -= 1
        for _ in range(CONTEXT + 1):
            while end < len(text) and text[end].isspace():
                end += 1
            while end < len(text) and not text[end].isspace():
                end += 1
        if lines and begin <= lines[-1][1]:
            lines[-1] = (lines[-1][0], max(end, lines[-1][1]))
        else:
            lines.append((begin, end))
    for begin, end in lines:
        tokens = [t.span() for t in TOKEN.finditer(text, begin, end)]
        if tokens:
            yield tokens


def trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    """Without quotes, commas and unpaired brackets or a final full stop."""
    while begin < end and (text[begin] in EDGES or text[begin] in "([{<" and not set(")]}>") & set(text[begin:end])):
        begin += 1
    while end > begin and (text[end - 1] in EDGES + "." or text[end - 1] in ")]}>" and not set("([{<") & set(text[begin:end])):
        end -= 1
    return begin, end


def shape(text: str) -> str:
    text = re.sub(r"[^\W\d_]+", "a", text)
    return re.sub(r"\s+", " ", re.sub(r"[0-9]+", lambda m: "9" if len(m[0]) < 3 else "999" if len(m[0]) < 5 else "9999", text))


def stable(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest()) % WEIGHTS


def features(text: str, tokens: int, before: str, after: str) -> list[int]:
    """Whole-span features of a candidate segment."""
    digits, form = only_digits(text), rewritten(text)
    names = [
        f"s {shape(text)[:40]}",
        f"n {tokens}",
        f"d {sum(len(digits) > x for x in (0, 8, 11, 15, 19))}",
        f"f {shape(form)[:40]}",
        f"b {shape(before)[:8]}",
        f"first {shape(text[:2])}",
        f"last {shape(text[-2:])}",
        "bias",
    ]
    goes_on = bool(GOES_ON.match(after))
    names += [f"whole {kind} {goes_on}" for kind in KINDS if whole(kind, text)]
    base = base_spans(text)
    names += [f"is {kind}" for b, e, kind in base if b == 0 and e == len(text)]
    names += [f"has {kind}" for b, e, kind in base if e - b < len(text)]
    if 12 <= len(digits) <= 19:
        names.append(f"luhn {luhn(digits)}")
    return [stable(n) for n in names]


class Lattice:
    """Candidate segments of one window with their features."""

    def __init__(self, text: str, tokens: list[tuple[int, int]]) -> None:
        self.tokens = tokens
        self.segments: list[tuple[int, int, int, int]] = []  # first, last token, begin, end
        self.features: list[list[int]] = []
        n = len(tokens)
        for i in range(n):
            before = text[tokens[i - 1][0] : tokens[i - 1][1]][-12:] if i else ""
            for j in range(i, min(n, i + LONGEST)):
                begin, end = trimmed(text, tokens[i][0], tokens[j][1])
                inside = text[begin:end]
                # Entities hold a digit or an at sign, or spell one.
                if end > begin and end - begin <= 120 and TRIGGER.search(inside):
                    self.segments.append((i, j, begin, end))
                    after = text[tokens[j + 1][0] : tokens[j + 1][1]][:12] if j + 1 < n else ""
                    self.features.append(features(inside, j - i + 1, before, after))
        # Every segment has the first ALWAYS features; some have more.
        self.kept = np.array([f[:ALWAYS] for f in self.features], np.int64).reshape(-1, ALWAYS)
        self.more = [f[ALWAYS:] for f in self.features]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """(segments, kinds) scores; other text scores 0."""
        out = weights[:, self.kept].sum(2).T if len(self.kept) else np.zeros((0, len(KINDS)))
        for row, extra in enumerate(self.more):
            if extra:
                out[row] += weights[:, extra].sum(1)
        return out

    def best(self, weights: np.ndarray) -> list[Span]:
        scores = self.scores(weights)
        n = len(self.tokens)
        value, back = [0.0] * (n + 1), [None] * (n + 1)
        ending: dict[int, list[int]] = {}
        for s, (_, j, _, _) in enumerate(self.segments):
            ending.setdefault(j + 1, []).append(s)
        for t in range(1, n + 1):
            value[t] = value[t - 1]
            for s in ending.get(t, ()):
                kind = int(scores[s].argmax())
                v = value[self.segments[s][0]] + scores[s, kind]
                if v > value[t]:
                    value[t], back[t] = v, (s, kind)
        out, t = [], n
        while t > 0:
            if back[t] is None:
                t -= 1
            else:
                s, kind = back[t]
                out.append((self.segments[s][2], self.segments[s][3], KINDS[kind]))
                t = self.segments[s][0]
        return out[::-1]

    def step(self, weights: np.ndarray, truth: set[Span], rate: float) -> None:
        """One ascent step on the conditional log-likelihood of this window."""
        scores = self.scores(weights)
        n = len(self.tokens)
        starts, ends = {}, {}
        for s, (i, j, _, _) in enumerate(self.segments):
            starts.setdefault(i, []).append(s)
            ends.setdefault(j + 1, []).append(s)
        total = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
        forward, backward = np.zeros(n + 1), np.zeros(n + 1)
        for t in range(1, n + 1):
            forward[t] = np.logaddexp.reduce(
                [forward[t - 1], *(forward[self.segments[s][0]] + total[s] for s in ends.get(t, ()))]
            )
        for t in range(n - 1, -1, -1):
            backward[t] = np.logaddexp.reduce(
                [backward[t + 1], *(backward[self.segments[s][1] + 1] + total[s] for s in starts.get(t, ()))]
            )
        for s, (i, j, b, e) in enumerate(self.segments):
            chance = np.exp(forward[i] + scores[s] + backward[j + 1] - forward[n])
            gold = np.array([(b, e, kind) in truth for kind in KINDS], float)
            move = rate * (gold - chance)
            if np.abs(move).max() > 1e-4:
                for f in self.features[s]:
                    weights[:, f] += move


def altered(text: str, kind: str, way: int) -> str:
    """A base span in one of the forms that the patterns miss."""
    if kind == "email":
        text = text if "." in text.partition("@")[2] else text + ".org"
        at, dot = ((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."))[way % 4]
        name, _, domain = text.partition("@")
        if way % 3:  # names and hosts without digits or with fewer labels are addresses too
            name = re.sub(r"[._]?[0-9]+", "", name) or name
            domain = re.sub(r"[0-9]+", "", domain) if way % 3 == 1 else domain[domain.find(".") + 1 :]
        return name + at + domain.replace(".", dot)
    if kind == "ip":
        return text.replace(".", ("[.]", " . ", " dot ", "[dot]")[way % 4])
    digits = only_digits(text)
    if kind == "card":
        return (".", "/", " - ", " / ")[way % 4].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    d = digits[-10:]
    return (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"1-{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}")[way % 4]


def fit(texts: list[str]) -> np.ndarray:
    """Weights (kinds, features) from the windows of a bounded sample of texts."""
    weights = np.zeros((len(KINDS), WEIGHTS))
    weights[:, stable("bias")] = -2.0
    cases: list[tuple[Lattice, set[Span]]] = []
    for text in texts:
        spans = base_spans(text)
        for number, tokens in enumerate(windows(text)):
            begin, end = tokens[0][0], tokens[-1][1]
            part = text[begin:end]
            inside = [(b - begin, e - begin, k) for b, e, k in spans if begin <= b and e <= end]
            variants = [(part, set(inside))]
            if len(inside) == 1:
                (b, e, kind) = inside[0]
                for way in (number, number + len(part)):
                    new = altered(part[b:e], kind, way)
                    variants.append((part[:b] + new + part[e:], {(b, b + len(new), kind)}))
            for words, truth in variants:
                cases.append((Lattice(words, [t.span() for t in TOKEN.finditer(words)]), truth))
        if len(cases) >= 3 * WINDOWS:
            break
    for epoch in range(EPOCHS):
        for lattice, truth in cases:
            lattice.step(weights, truth, 1.0 / (1 + epoch))
    return weights


def all_spans(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """(base spans, spans that the field adds)."""
    base = base_spans(text)
    added: list[Span] = []
    for tokens in windows(text):
        begin, end = tokens[0][0], tokens[-1][1]
        near = [s for s in base if s[0] < end and s[1] > begin]
        for b, e, kind in Lattice(text, tokens).best(weights):
            if whole(kind, text[b:e]) and not any(s[0] < e and b < s[1] for s in near):
                added.append((b, e, kind))
    return base, added


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{b}:{e}" for b, e, kind in ordered)


FOUND = "struct<n_email:long,n_ip:long,n_card:long,n_phone:long,n_added:long,base_sha256:string,spans:string>"


def detect(text: Column, weights: np.ndarray) -> Column:
    """Counts of base spans per kind, the digest of the base spans, and all spans."""

    @F.pandas_udf(FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                base, added = all_spans(value or "", weights)
                counts = [sum(s[2] == kind for s in base) for kind in KINDS]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*counts, len(added), digest, joined(base + added)))
            names = ["n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"]
            yield pd.DataFrame(rows, columns=names)

    return found(text)


def trained(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Fit on at most ``sample`` documents that hold a digit or an at sign."""
    some = docs.filter(F.col("text").rlike("[0-9@]")).select(F.substring("text", 1, SAMPLE_CHARS).alias("text"), "doc_id")
    chosen = drawn(some, sample).collect()
    return fit([row.text for row in chosen])


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", detect(F.col("text"), trained(docs)).alias("found")).select("doc_id", "found.*")

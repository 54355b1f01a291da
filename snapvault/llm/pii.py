"""Personal data: fixed patterns, and spans that a semi-Markov conditional random field adds.

The base patterns take the leftmost match and drop it when its check fails, so a
telephone number next to a card number is lost with it: their digits run into
one match that fails both checks.  The random field chooses boundaries and types
together.  A region is a run of words that hold a digit or an at sign, cut at
the base spans; it is split into tokens (digits, letters, single other
characters).  Every run of at most ``MOST_TOKENS`` tokens that looks like a kind
is a candidate segment, scored by features of the whole span: its checksum,
number of digits, separators, groups, and the characters around it.  Dynamic
programming over the tokens (segments have a bounded length, so it is linear in
the region) takes the segmentation of greatest score, in which tokens outside
segments score nothing.

The weights are learned here by maximum likelihood (forward and backward sums
over segmentations).  Labels come from the base patterns themselves, on regions
of at most ``MAX_TEXTS`` distinct texts drawn by their hash, ``MAX_REGIONS``
regions of them; regions in which a match was dropped teach nothing.  Of each
region's spans altered copies are added: a changed digit, a part beyond 255, a
number without its plus sign (none of them personal data), and pairs of spans
side by side (both are).  Base spans stay as they are; a span is added where no
base span lies.

Cases: null text is empty; a text without digits and at signs has no spans;
longer spans than ``MOST_TOKENS`` tokens are left to the base patterns; without
any labelled region nothing is added; repeated rows and ids each give their
row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits

KINDS = ("email", "ip", "card", "phone")
MAX_TEXTS, MAX_REGIONS, LONGEST_REGION = 3000, 4000, 400
MOST_TOKENS = 24
PENALTY, ROUNDS, STEP = 0.02, 60, 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match begins where a run of digits does: no later start of a run matches if the first doesn't, and none ends inside
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_REST = re.compile(r"\S*")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)
_EMAIL_SHAPE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_SHAPE = re.compile(r"[0-9]{1,4}(?:\.[0-9]{1,4}){3}")
_CARD_SHAPE = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE_SHAPE = re.compile(r"[+(]*[0-9][\x20().0-9-]+[0-9]")


def digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from the at signs so that long runs without one cost nothing more."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(kind, start, end) by kind and start, and the matches that failed their check."""
    kept, dropped = [("email", s, e) for s, e in emails(text)] if "@" in text else [], []
    if not _HINT.search(text):
        return kept, dropped
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(text):
            span = m.group()
            if kind == "ip":
                fine = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in span.split("."))
            else:
                number = digits(span)
                fine = 13 <= len(number) <= 19 and luhn(number) if kind == "card" else 9 <= len(number) <= 15
            if fine:
                kept.append((kind, *m.span()))
            elif kind != "card" or len(number) >= 13:
                dropped.append(m.span())
    return kept, dropped


def regions(text: str, taken: list[tuple[int, int]] = ()):
    """(start, end) of runs of words with a digit or an at sign, one space apart, cut at the spans ``taken``."""
    at, borders = 0, sorted(taken)
    while True:
        hint = _HINT.search(text, at)
        if not hint:
            return
        start = hint.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _REST.match(text, hint.start()).end()
        while end + 1 < len(text) and text[end] == " ":
            following = _REST.match(text, end + 1).end()
            if not _HINT.search(text, end + 1, following):
                break
            end = following
        cut = start
        for s, e in borders:
            if e > cut and s < end:
                if s > cut:
                    yield cut, s
                cut = max(cut, e)
        if cut < end:
            yield cut, end
        borders = [b for b in borders if b[1] > end]
        at = end


# ---------------------------------------------------------------- segments and their features

def _around(c: str | None) -> str:
    if c is None or c.isspace():
        return "space"
    return "word" if c.isalnum() else "sign"


def features(kind: str, span: str, before: str | None, after: str | None) -> list[str]:
    """Names of the whole span's features; none if it can't be of this kind."""
    number = digits(span)
    if kind == "email":
        if not _EMAIL_SHAPE.fullmatch(span):
            return []
        labels = span.split("@")[1].split(".")
        own = [f"labels{min(len(labels), 4)}", "top letters" if labels[-1].isalpha() and len(labels[-1]) > 1 else "top other"]
    elif kind == "ip":
        if not _IP_SHAPE.fullmatch(span):
            return []
        own = ["parts fit" if all(int(p) <= 255 for p in span.split(".")) else "part beyond"]
    elif kind == "card":
        if not 13 <= len(number) <= 19 or not _CARD_SHAPE.fullmatch(span):
            return []
        signs = {c for c in span if c in " -"}
        groups = [len(g) for g in re.split(r"[ -]", span)]
        own = ["checksum" if luhn(number) else "no checksum", "mixed signs" if len(signs) > 1 else "one sign",
               "even groups" if len(set(groups[:-1])) <= 1 and groups[-1] <= groups[0] else "uneven groups"]
    else:
        if not 7 <= len(number) <= 18 or not _PHONE_SHAPE.fullmatch(span):
            return []
        shut = span.count("(") == span.count(")") and ")(" not in span
        own = ["plus" if span[0] == "+" else "no plus", "brackets shut" if shut else "brackets open",
               "length fits" if 9 <= len(number) <= 15 else "length off", f"digits{min(len(number), 16)}",
               f"last{min(len(re.split(r'[^0-9]+', span)[-1]), 6)}", f"groups{min(len(re.findall(r'[0-9]+', span)), 6)}"]
    return [f"{kind} {f}" for f in ["any", *own, f"after {_around(before)}", f"before {_around(after)}"]]


def segments(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int, str, list[str]]]]:
    """Token borders of a region, and its candidate segments (first token, token after, kind, features)."""
    borders = [start] + [m.end() for m in _TOKEN.finditer(text, start, end)]
    out = []
    for i in range(len(borders) - 1):
        first = text[borders[i]]
        if not (first.isascii() and (first.isalnum() or first in "+(._%-")):
            continue
        for j in range(i + 1, min(i + MOST_TOKENS, len(borders) - 1) + 1):
            last = text[borders[j] - 1]
            if last.isspace() and not ("0" <= first <= "9" or first in "+("):
                break
            if not (last.isascii() and last.isalnum()):
                continue
            span = text[borders[i]:borders[j]]
            before = text[borders[i] - 1] if borders[i] else None
            after = text[borders[j]] if borders[j] < len(text) else None
            for kind in (("email",) if "@" in span else KINDS[1:] if not (first.isalpha() or last.isalpha()) else ()):
                found = features(kind, span, before, after)
                if found:
                    out.append((i, j, kind, found))
    return borders, out


class SegmentModel:
    """Weights by feature name; the best segmentation of a region."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def decode(self, text: str, start: int, end: int) -> list[tuple[str, int, int]]:
        borders, found = segments(text, start, end)
        by_end: dict[int, list] = {}
        for i, j, kind, names in found:
            score = sum(self.weights.get(f, 0.0) for f in names)
            if score > 0:
                by_end.setdefault(j, []).append((i, score, kind))
        if not by_end:
            return []
        best, back = [0.0] * len(borders), [None] * len(borders)
        for j in range(1, len(borders)):
            best[j] = best[j - 1]
            for i, score, kind in by_end.get(j, ()):
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind)
        out, j = [], len(borders) - 1
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((kind, borders[i], borders[j]))
                j = i
        return out[::-1]

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        taken = [(s, e) for _, s, e in base]
        return [span for start, end in regions(text, taken) for span in self.decode(text, start, end)]


# ---------------------------------------------------------------- learning

def altered(region: str, gold: list[tuple[str, int, int]]) -> list[tuple[str, list]]:
    """Copies of a region with one span changed so that it is no personal data."""
    out = []
    for kind, s, e in gold:
        span = region[s:e]
        if kind == "card":
            other = span[:-1] + str((int(span[-1]) + 5) % 10)
        elif kind == "ip":
            other = "3" + span.split(".")[0].rjust(2, "9")[-2:] + span[span.index("."):]
        elif kind == "phone":
            other = span[1:]
        else:
            continue
        shift = len(other) - len(span)
        rest = [(k, a + shift if a >= e else a, b + shift if a >= e else b) for k, a, b in gold if (k, a, b) != (kind, s, e)]
        out.append((region[:s] + other + region[e:], rest))
    return out


def joined(spans: list[tuple[str, str]]) -> list[tuple[str, list]]:
    """Neighbouring sampled spans side by side, one space between."""
    out = []
    for (k1, a), (k2, b) in zip(spans, spans[1:]):
        if "email" not in (k1, k2):
            out.append((f"{a} {b}", [(k1, 0, len(a)), (k2, len(a) + 1, len(a) + 1 + len(b))]))
    return out


def apart(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of which none overlaps an earlier or, at one start, a longer one."""
    out, end = [], 0
    for span in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if span[1] >= end:
            out.append(span)
            end = span[2]
    return out


def learn(labelled: list[tuple[str, list[tuple[str, int, int]]]]) -> SegmentModel:
    """Maximum likelihood with a quadratic penalty; ``labelled``: (region, spans of it)."""
    names: dict[str, int] = {}
    held = []
    for region, gold in labelled:
        borders, found = segments(region, 0, len(region))
        at = {b: k for k, b in enumerate(borders)}
        wanted = {(at.get(s), at.get(e), kind) for kind, s, e in gold}
        if not found or not wanted <= {(i, j, kind) for i, j, kind, _ in found}:
            continue  # nothing to choose, or a span longer than any segment
        held.append((len(borders), [(i, j, np.array([names.setdefault(f, len(names)) for f in fs]), (i, j, kind) in wanted)
                                    for i, j, kind, fs in found]))
    if not held:
        return SegmentModel({})
    w, squares = np.zeros(len(names)), np.full(len(names), 1e-6)
    for _ in range(ROUNDS):
        gradient = -PENALTY * w
        for n, found in held:
            scores = [float(w[f].sum()) for _, _, f, _ in found]
            by_end: dict[int, list] = {}
            by_start: dict[int, list] = {}
            for c, (i, j, _, _) in enumerate(found):
                by_end.setdefault(j, []).append((i, scores[c]))
                by_start.setdefault(i, []).append((j, scores[c]))
            forward, backward = [0.0] * n, [0.0] * n
            for j in range(1, n):
                forward[j] = forward[j - 1]
                for i, s in by_end.get(j, ()):
                    forward[j] = _add(forward[j], forward[i] + s)
            for i in range(n - 2, -1, -1):
                backward[i] = backward[i + 1]
                for j, s in by_start.get(i, ()):
                    backward[i] = _add(backward[i], backward[j] + s)
            for (i, j, f, gold), s in zip(found, scores):
                gradient[f] += gold - math.exp(min(forward[i] + s + backward[j] - forward[-1], 0.0))
        gradient /= len(held)
        squares += gradient ** 2
        w += STEP * gradient / np.sqrt(squares)
    return SegmentModel({f: float(w[k]) for f, k in names.items()})


def _add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def _sampled_regions(batches):
    """Regions of sampled texts with their base spans; none in which a match was dropped."""
    for b in batches:
        found, gold = [], []
        for text in b.column("text").to_pylist():
            base, dropped = base_spans(text)
            for s, e in regions(text):
                if e - s <= LONGEST_REGION and not any(x < e and y > s for x, y in dropped):
                    found.append(text[s:e])
                    gold.append([f"{k}:{x - s}:{y - s}" for k, x, y in apart([q for q in base if s <= q[1] and q[2] <= e])])
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(gold, pa.list_(pa.string()))], names=["region", "gold"])


def fit(docs: DataFrame, text_col: str = "text", max_texts: int = MAX_TEXTS, max_regions: int = MAX_REGIONS) -> SegmentModel:
    """Learn from a bounded sample of texts, drawn by their hash whatever the table's size."""
    arrow_limits(docs.sparkSession)
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    texts = texts.withColumn("h", F.xxhash64("text"))
    # the greatest of the max_texts least hashes; copies count once
    last = texts.select("h").distinct().orderBy("h").limit(max_texts).agg(F.max("h")).first()[0]
    if last is None:
        return SegmentModel({})
    sample = texts.where(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text"))
    found = sample.mapInArrow(_sampled_regions, "region string, gold array<string>").distinct()
    # at most max_regions regions of LONGEST_REGION characters
    rows = found.orderBy(F.xxhash64("region"), "region").limit(max_regions).collect()
    labelled, spans = [], []
    for r in rows:
        gold = [(k, int(s), int(e)) for k, s, e in (g.split(":") for g in r["gold"])]
        labelled.append((r["region"], gold))
        labelled.extend(altered(r["region"], gold))
        spans.extend((k, r["region"][s:e]) for k, s, e in gold)
    return learn(labelled + joined(spans))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def find_personal_data(docs: DataFrame, model: SegmentModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans (base and added), n_added, and the text with its spans masked."""
    arrow_limits(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches):
        for b in batches:
            rows = {k: [] for k in ("base_sha256", "spans", "n_added", "masked")}
            counts = {k: [] for k in KINDS}
            for text in b.column("text").to_pylist():
                text = text or ""
                base, _ = base_spans(text)
                more = model.added(text, base) if _HINT.search(text) else []
                for k in KINDS:
                    counts[k].append(sum(x == k for x, _, _ in base))
                rows["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                rows["spans"].append(written(base + more))
                rows["n_added"].append(len(more))
                rows["masked"].append(mask(text, base + more))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(rows["base_sha256"], pa.string()),
                 pa.array(rows["spans"], pa.string()), pa.array(rows["n_added"], pa.int64()), pa.array(rows["masked"], pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "masked_text"])

    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return own.mapInArrow(judge, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
                          + ", base_sha256 string, spans string, n_added long, masked_text string")


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with a mark of its kind in place of each span (the longer one of overlapping spans)."""
    out, end = [], 0
    for kind, s, e in apart(spans):
        out += [text[end:s], f"[{kind}]"]
        end = e
    return "".join(out) + text[end:] if out else text

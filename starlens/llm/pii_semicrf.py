"""Personal data by base patterns and a semi-Markov conditional random field.

Base spans follow fixed patterns, matched leftmost and without overlap for each
kind, by linear scans from digits and at-signs (no backtracking, so no text is
too long). Around digits, at-signs and written-out at-signs lie regions; a
region is cut into tokens and a semi-Markov CRF scores every candidate segment
of at most ``MOST_TOKENS`` tokens by features of the whole span: its shape, its
number of digits, checksum, octets, separators and neighbours. Bounded-entity
dynamic programming picks the best segmentation, boundaries and kinds together.
Base spans are held fixed in it; other segments of the best segmentation whose
marginal probability is at least ``SURE`` are added. The programme runs over a
whole region, or over pieces of it that no candidate crosses, in linear time
and with a few numbers a token.

The weights are trained on a bounded number of regions of each kind, drawn from
all documents and labelled by the base patterns, and on copies of them altered by rule: forms the patterns
miss (a phone number without its plus, a written-out at-sign, a card number with
dots) keep their label, damaged ones (a wrong check digit, an octet above
255, a phone number cut short) lose it.

Defined results: a null text counts as empty; an empty text has no spans;
repeated rows get a row each; a null id is passed through; an empty table gives
an empty result, and a sample without regions a model that adds nothing; other
columns are ignored (``redacted`` carries them). Positions are code points.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import values, written

KINDS = ("email", "ip", "card", "phone")
#: Training regions of each base kind, how many times as many without any, and the most characters of one.
SAMPLE_REGIONS = 200
SAMPLE_NONE = 3
SAMPLE_CHARACTERS = 400
MOST_TOKENS = 24
#: A region is cut after a line end or tab, which no candidate holds, once it has so many tokens.
REGION_TOKENS = 96
REACH = 24
SURE = 0.9
EPOCHS = 6

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_PHONE = re.compile(r"[\x20().0-9-]*")
_WRITTEN_AT = re.compile(r"[\[(] ?at ?[\])]", re.IGNORECASE)
_WRITTEN_DOMAIN = re.compile(r" ?[\w.-]+")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.DOTALL)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        hit = _DOMAIN.match(text, at + 1) if start < at else None
        if hit:
            found.append((start, hit.end()))
            done = hit.end()
        # characters up to here belong to no local part any more only if matched
        at = text.find("@", max(at + 1, done))
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, by start and kind."""
    spans = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    runs = [m.span() for m in _DIGITS.finditer(text)]
    if runs:
        i = 0
        while i + 3 < len(runs):
            if all(runs[j][1] + 1 == runs[j + 1][0] and text[runs[j][1]] == "." for j in range(i, i + 3)):
                if all(_small(text[a:b]) for a, b in runs[i : i + 4]):
                    spans.append((runs[i][0], runs[i + 3][1], 1))
                i += 4
            else:
                i += 1
        i = 0
        while i < len(runs):
            j, count = i, runs[i][1] - runs[i][0]
            while j + 1 < len(runs) and runs[j][1] + 1 == runs[j + 1][0] and text[runs[j][1]] in " -":
                j += 1
                count += runs[j][1] - runs[j][0]
            if 12 <= count <= 19 and luhn("".join(text[a:b] for a, b in runs[i : j + 1])):
                spans.append((runs[i][0], runs[j][1], 2))
            i = j + 1
        plus = text.find("+")
        while plus >= 0:
            nxt = plus + 1
            if nxt < len(text) and text[nxt] in "0123456789":
                end = _PHONE.match(text, nxt + 1).end()
                while end > nxt + 2 and text[end - 1] not in "0123456789":
                    end -= 1
                if end > nxt + 2 and text[end - 1] in "0123456789":
                    if 9 <= sum(c in "0123456789" for c in text[plus:end]) <= 15:
                        spans.append((plus, end, 3))
                    nxt = end
            plus = text.find("+", nxt)
    spans.sort(key=lambda s: (s[0], s[2]))
    return spans


def _written(text: str) -> Iterator[tuple[int, int]]:
    """Written-out addresses: word characters on both sides of ``(at)``, of any length, by linear scans from the brackets."""
    done = 0
    for m in _WRITTEN_AT.finditer(text):
        stop = m.start() - (text[m.start() - 1 : m.start()] == " ")
        start = stop
        while start > done and (text[start - 1].isalnum() or text[start - 1] in "_.%+-"):
            start -= 1
        domain = _WRITTEN_DOMAIN.match(text, m.end())
        if start < stop and domain:
            done = domain.end()
            yield start, done


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and (written-out) at-signs, up to blanks on both sides."""
    anchors = [m.span() for m in _DIGITS.finditer(text)]
    at = text.find("@")
    while at >= 0:
        anchors.append((at, at + 1))
        at = text.find("@", at + 1)
    anchors += _written(text)
    anchors.sort()
    merged: list[list[int]] = []
    for a, b in anchors:
        if merged and a - merged[-1][1] <= 4:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    out: list[tuple[int, int]] = []
    for a, b in merged:
        low = max(a - REACH, out[-1][1] if out else 0)
        while a > low and not text[a - 1].isspace():
            a -= 1
        if a > low + 1 and text[a - 1] == " " and text[a - 2] in "+)":
            a -= 2
        high = min(len(text), b + REACH)
        while b < high and not text[b].isspace():
            b += 1
        out.append((a, max(a, b)))
    return [r for r in out if r[0] < r[1]]


def tokens(text: str, start: int, end: int) -> list[list[tuple[int, int]]]:
    """The region's tokens, in pieces of at least ``REGION_TOKENS`` cut where no candidate crosses."""
    pieces, piece = [], []
    for m in _TOKEN.finditer(text, start, end):
        piece.append(m.span())
        if len(piece) >= REGION_TOKENS and text[m.start()] in "\n\r\t":
            pieces.append(piece)
            piece = []
    return [*pieces, piece] if piece else pieces


def _side(c: str) -> str:
    """Class of a neighbour; the edge of a text is like a blank."""
    return "_" if not c or c.isspace() else "9" if c.isdigit() else "a" if c.isalpha() else c


def span_features(span: str, left: str, right: str) -> tuple[str, ...]:
    """Features of a whole candidate span between two neighbouring characters."""
    digits = [m.group() for m in _DIGITS.finditer(span)]
    number = "".join(digits)
    shape = re.sub(r"[^\W\d_]+", "a", _DIGITS.sub(lambda m: "d%d" % min(len(m.group()), 5), span))
    shape = re.sub(r"(?:(?:a|d\d)[._%+-])+(?=(?:a|d\d))", "w.", shape) if "@" in span or "at" in span.lower() else shape
    groups = len(digits) == 4 and re.fullmatch(r"[0-9]+(\.[0-9]+){3}", span) is not None
    n = len(number)
    check = "none" if not 12 <= n <= 19 else "ok" if luhn(number) else "bad"
    octets = "none" if not groups else "ok" if all(map(_small, digits)) else "bad"
    written = bool(_WRITTEN_AT.search(span))
    letters = any(c.isalpha() for c in span)
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    opened = span.count("(") - span.count(")")
    return (
        "bias",
        "shape=" + shape,
        f"digits={min(n, 20)}",
        f"check={check},{letters}",
        f"octets={octets}",
        f"at={span.count('@')},{written},{letters}",
        f"left={_side(left)}",
        f"right={_side(right)}",
        f"marks={marks},{letters}",
        f"first={_side(span[0])}",
        f"last={_side(span[-1])}",
        f"open={opened}",
    )


def candidate_ends(text: str, piece: list[tuple[int, int]], i: int) -> Iterator[int]:
    """The j of token ranges [i, j) that may be entities: they start and end visibly and hold a digit or an at-sign."""
    a = piece[i][0]
    if not (text[a].isalnum() or text[a] in "+("):
        return
    anchor = False
    for j in range(i, min(len(piece), i + MOST_TOKENS)):
        b, e = piece[j]
        c = text[b]
        if c in "\n\r\t":
            break
        anchor = anchor or c.isdigit() or c == "@" or text[b:e].lower() == "at"
        if anchor and (c.isalnum()) and e - a >= 5:
            yield j + 1


def candidates(text: str, piece: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The candidates [i, j) of every token."""
    for i in range(len(piece)):
        for j in candidate_ends(text, piece, i):
            yield i, j


class Fixed:
    """Spans by start, with the farthest end of each and all before it."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.spans = spans
        self.starts = [s for s, _, _ in spans]
        self.reach = list(accumulate((e for _, e, _ in spans), max))

    def before(self, a: int) -> int | None:
        """How many spans start before ``a``; None if one of them goes on beyond it."""
        n = bisect_left(self.starts, a)
        return None if n and self.reach[n - 1] > a else n


def _log_add(x: float, y: float) -> float:
    return max(x, y) + math.log1p(math.exp(-abs(x - y)))


def _log_sum(scores: list[float]) -> float:
    top = max(scores)
    return top + math.log(sum(math.exp(s - top) for s in scores))


class SemiMarkov:
    """Weights by feature, one number a kind; the score of leaving a token out of every entity is 0."""

    def __init__(self):
        self.weights: dict[str, list[float]] = {}
        self.cache: dict = {}

    def scores(self, features: tuple[str, ...]) -> list[float]:
        found = self.cache.get(features)
        if found is None:
            found = [0.0] * len(KINDS)
            for f in features:
                for k, w in enumerate(self.weights.get(f, ())):
                    found[k] += w
            if len(self.cache) >= 50_000:
                self.cache.clear()
            self.cache[features] = found
        return found

    def starting(self, text: str, piece, i: int, fixed: Fixed):
        """(j, features, scores) of the candidates from token ``i`` that don't cut across a fixed span."""
        a = piece[i][0]
        n = fixed.before(a)
        if n is None:
            return
        for j in candidate_ends(text, piece, i):
            b = piece[j - 1][1]
            inside = fixed.spans[n : bisect_left(fixed.starts, b, n)]
            if any((s, e) != (a, b) for s, e, _ in inside):
                continue
            features = span_features(text[a:b], text[a - 1 : a], text[b : b + 1])
            scores = self.scores(features)
            if inside:  # a base span keeps its kind
                kinds = {k for _, _, k in inside}
                scores = [x + (1e3 if k in kinds else -1e3) for k, x in enumerate(scores)]
            yield j, features, scores

    def segments(self, text: str, piece, fixed: list[tuple[int, int, int]]):
        """(i, j, features, scores) of the candidates that don't cut across a fixed span."""
        held = Fixed(fixed)
        return [(i, *rest) for i in range(len(piece)) for rest in self.starting(text, piece, i, held)]

    def best(self, n: int, segments) -> list[tuple[int, int, int]]:
        """Viterbi over segmentations: (i, j, kind) of the chosen entities."""
        by_end = defaultdict(list)
        for i, j, _, scores in segments:
            k = max(range(len(KINDS)), key=scores.__getitem__)
            by_end[j].append((i, k, scores[k]))
        value, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for i, k, score in by_end[j]:
                if value[i] + score > value[j]:
                    value[j], back[j] = value[i] + score, (i, j, k)
        chosen, j = [], n
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                chosen.append(back[j])
                j = back[j][0]
        return chosen[::-1]

    def marginals(self, n: int, segments) -> dict[tuple[int, int, int], float]:
        """Forward-backward: the probability of each (i, j, kind)."""
        by_end, by_start = defaultdict(list), defaultdict(list)
        for i, j, _, scores in segments:
            by_end[j].append((i, scores))
            by_start[i].append((j, scores))
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = ahead[j - 1]
            for i, scores in by_end[j]:
                for s in scores:
                    ahead[j] = _log_add(ahead[j], ahead[i] + s)
        for i in range(n - 1, -1, -1):
            behind[i] = behind[i + 1]
            for j, scores in by_start[i]:
                for s in scores:
                    behind[i] = _log_add(behind[i], behind[j] + s)
        return {
            (i, j, k): math.exp(min(0.0, ahead[i] + s + behind[j] - ahead[n]))
            for i, j, _, scores in segments
            for k, s in enumerate(scores)
        }

    def added(self, text: str, piece, fixed: Fixed) -> list[tuple[int, int, int]]:
        """(start, end, kind) of the best segmentation besides the fixed spans, if its marginal is at least ``SURE``.

        The same as by ``best`` and ``marginals``, without holding the segments of a long piece.
        """
        n = len(piece)
        value, ahead = array("d", [-math.inf]) * (n + 1), array("d", [-math.inf]) * (n + 1)
        value[0] = ahead[0] = 0.0
        back: dict[int, tuple[int, int, float]] = {}
        for i in range(n):
            if value[i] >= value[i + 1]:
                value[i + 1] = value[i]
                back.pop(i + 1, None)
            ahead[i + 1] = _log_add(ahead[i + 1], ahead[i])
            for j, _, scores in self.starting(text, piece, i, fixed):
                k = max(range(len(KINDS)), key=scores.__getitem__)
                if value[i] + scores[k] > value[j]:
                    value[j], back[j] = value[i] + scores[k], (i, k, scores[k])
                ahead[j] = _log_add(ahead[j], ahead[i] + _log_sum(scores))
        own = set(fixed.spans)
        chosen, j = [], n
        while j > 0:
            if j not in back:
                j -= 1
                continue
            i, k, score = back[j]
            a, b = piece[i][0], piece[j - 1][1]
            if not any((a, b, x) in own for x in range(len(KINDS))):
                chosen.append((i, j, k, score))
            j = i
        if not chosen:
            return []
        behind = array("d", bytes(8 * (n + 1)))
        for i in range(n - 1, chosen[-1][1] - 1, -1):
            total = behind[i + 1]
            for j, _, scores in self.starting(text, piece, i, fixed):
                total = _log_add(total, behind[j] + _log_sum(scores))
            behind[i] = total
        return [
            (piece[i][0], piece[j - 1][1], k)
            for i, j, k, score in reversed(chosen)
            if math.exp(min(0.0, ahead[i] + score + behind[j] - ahead[n])) >= SURE
        ]

    def train(self, examples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS) -> SemiMarkov:
        """AdaGrad on the log-likelihood of (text, spans) examples."""
        prepared = []
        for text, spans in examples:
            for piece in tokens(text, 0, len(text)):
                starts = {a: i for i, (a, _) in enumerate(piece)}
                ends = {b: i + 1 for i, (_, b) in enumerate(piece)}
                gold = {(starts[a], ends[b], k) for a, b, k in spans if a in starts and b in ends}
                segments = [
                    (i, j, span_features(text[piece[i][0] : piece[j - 1][1]], text[piece[i][0] - 1 : piece[i][0]] if i else "", text[piece[j - 1][1] : piece[j - 1][1] + 1]))
                    for i, j in candidates(text, piece)
                ]
                if segments:
                    prepared.append((len(piece), segments, gold))
        squares: dict[str, list[float]] = {}
        order = random.Random(11)
        for _ in range(epochs):
            order.shuffle(prepared)
            for n, segments, gold in prepared:
                self.cache.clear()
                scored = [(i, j, f, self.scores(f)) for i, j, f in segments]
                chance = self.marginals(n, scored)
                for i, j, f, _ in scored:
                    for k in range(len(KINDS)):
                        gradient = ((i, j, k) in gold) - chance[i, j, k]
                        if abs(gradient) < 1e-4:
                            continue
                        for name in f:
                            w = self.weights.setdefault(name, [0.0] * len(KINDS))
                            g = squares.setdefault(name, [1e-2] * len(KINDS))
                            step = gradient - 1e-4 * w[k]
                            g[k] += step * step
                            w[k] += 0.5 * step / math.sqrt(g[k])
        self.cache.clear()
        return self


def altered(text: str, spans: list[tuple[int, int, int]], seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Copies of a one-span example: forms the base patterns miss keep the label, damaged ones lose it."""
    if len(spans) != 1:
        return []
    (a, b, kind), rng = spans[0], random.Random(seed)
    span = text[a:b]

    def put(new: str, keep: bool = True):
        return text[:a] + new + text[b:], [(a, a + len(new), kind)] if keep else []

    at = rng.choice([m.start() for m in re.finditer("[0-9]", span)] or [0])
    if kind == 0:
        written = span.replace("@", rng.choice([" [at] ", " (at) ", "[at]"]))
        return [put(written), put(span.replace("@", ""), False)]
    if kind == 1:
        return [put(re.sub(r"^[0-9]+", str(rng.randint(256, 999)), span), False), put(span.rsplit(".", 1)[0], False)]
    if kind == 2:
        number = re.sub("[^0-9]", "", span)
        wrong = span[:at] + str((int(span[at]) + rng.randint(1, 9)) % 10) + span[at + 1 :]
        return [put(".".join(number[i : i + 4] for i in range(0, len(number), 4))), put(wrong, luhn(re.sub("[^0-9]", "", wrong)))]
    short = span[1:]
    return [put(short), put(re.sub(r"^[0-9]{1,3}[ .-]", "", short)), put(span[: rng.randint(2, min(6, len(span)))].rstrip(" (.-"), False)]


def _region_batches(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, mark, text, spans): a task's regions of each kind, and of none, with the least text hashes."""
    best: list[dict[str, tuple[int, str]]] = [{} for _ in (*KINDS, "none")]

    def trimmed(k: int) -> dict[str, tuple[int, str]]:
        return dict(sorted(best[k].items(), key=lambda x: (x[1][0], x[0]))[: _most(k, most)])

    for batch in batches:
        for text in values(batch.column(0)):
            if not text:
                continue
            spans = base_spans(text)
            for a, b in regions(text):
                if b - a > SAMPLE_CHARACTERS:
                    continue
                # spans are in order: those before the region end before those in it
                inside = [(s - a, e - a, k) for s, e, k in spans[_first_in(spans, a) : bisect_left(spans, (b,))]]
                if any(s < 0 or e > b - a for s, e, _ in inside):
                    continue
                region = text[a:b]
                mark = xxhash.xxh64_intdigest(region.encode(), 42) >> 1
                for k in {k for _, _, k in inside} or {len(KINDS)}:
                    best[k][region] = (mark, ",".join(f"{k}:{s}:{e}" for s, e, k in inside))
                    if len(best[k]) >= 8 * _most(k, most):
                        best[k] = trimmed(k)
    rows = [(k, mark, text, spans) for k in range(len(best)) for text, (mark, spans) in trimmed(k).items()]
    kinds = (pa.int32(), pa.int64(), pa.string(), pa.string())
    columns = zip(*rows, strict=True) if rows else [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["kind", "mark", "text", "spans"])


def _most(kind: int, most: int) -> int:
    """Training regions of a kind; number ``len(KINDS)`` stands for none."""
    return most if kind < len(KINDS) else SAMPLE_NONE * most


def _first_in(spans: list[tuple[int, int, int]], a: int) -> int:
    """The first span that may reach beyond ``a``; spans of several kinds may overlap, so some before it can end later."""
    i = bisect_left(spans, (a,))
    while i and spans[i - 1][1] > a:
        i -= 1
    return i


def fit(docs: DataFrame, most: int = SAMPLE_REGIONS) -> SemiMarkov:
    """Train on ``most`` regions of each base kind, and ``SAMPLE_NONE`` times as many without any, of all documents.

    Those with the least text hashes; a task gives at most that many of each. The driver gets at most
    ``(4 + SAMPLE_NONE) * most`` regions of at most ``SAMPLE_CHARACTERS`` characters (longer ones aren't
    trained on). Where a kind has fewer, all of them.
    """
    found = written(docs.select("text").mapInArrow(partial(_region_batches, most), "kind int, mark long, text string, spans string"), "pii-regions")
    chosen = {}
    for kind in range(len(KINDS) + 1):
        rows = found.where(F.col("kind") == kind).select("mark", "text", "spans").distinct().orderBy("mark", "text").limit(_most(kind, most))
        chosen |= {r.text: r.spans for r in rows.collect()}
    examples = []
    for n, (text, listed) in enumerate(sorted(chosen.items())):
        spans = [(int(s), int(e), int(k)) for k, s, e in (x.split(":") for x in listed.split(",") if x)]
        spans = [s for s in spans if not any(o != s and o[0] < s[1] and s[0] < o[1] for o in spans)]
        examples.append((text, spans))
        examples += altered(text, spans, n)
    return SemiMarkov().train(examples)


def all_spans(text: str, base: list[tuple[int, int, int]], model: SemiMarkov) -> list[tuple[int, int, int]]:
    """Base spans and those the model adds, by start and kind."""
    added = []
    covered = 0
    for a, b in regions(text):
        while covered < len(base) and base[covered][1] <= a:
            covered += 1
        last = covered
        while last < len(base) and base[last][0] < b:
            last += 1
        fixed = Fixed(base[covered:last])
        for piece in tokens(text, a, b):
            added += model.added(text, piece, fixed)
    return sorted([*base, *added], key=lambda s: (s[0], s[2])) if added else base


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _span_batches(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fitted = model.value
    for batch in batches:
        counts, digests, spans = [[] for _ in KINDS], [], []
        for text in values(batch.column(1)):
            text = text or ""
            base = base_spans(text)
            for k, column in enumerate(counts):
                column.append(sum(s[2] == k for s in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(all_spans(text, base, fitted)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
        )


def found_spans(docs: DataFrame, model: SemiMarkov) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(partial(_span_batches, shared), f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def redact(text: str, model: SemiMarkov) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first names the gap."""
    out, at = [], 0
    for a, b, k in all_spans(text, base_spans(text), model):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def _redact_batches(model, at: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fitted = model.value
    for batch in batches:
        texts = pa.array([redact(t, fitted) if t else t for t in values(batch.column(at))], pa.string())
        columns = [texts if i == at else c for i, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def redacted(docs: DataFrame, model: SemiMarkov) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; every other column as it was."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(partial(_redact_batches, shared, docs.columns.index("text")), fields)

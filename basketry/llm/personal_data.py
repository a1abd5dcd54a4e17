"""Personal data in whole texts: fixed patterns, and more spans from a semi-Markov conditional random field.

The patterns give the base spans, which always stay. They miss what runs together: two card numbers next to
each other, a phone number followed by a card, an address written with words. The field looks at the places
where such data can be (runs of digit groups, and addresses spelled out). A segmentation of a place is a
sequence of segments with a type, or nothing; its score is the sum of whole-segment feature weights (digit
count, checksum, separators, lengths, neighbours) and of a weight for every two segments that follow each other with
at most `NEAR` characters between, by their types and what parts them. Dynamic programming over segments of bounded
length chooses boundaries and types together; base spans are fixed segments in it.

The weights are trained here by conditional likelihood on at most `TRAIN_PLACES` places, those with the
smallest hash among all where the patterns are unambiguous (every match passed its check); the patterns'
spans are the labels. A place where a match failed its length check, or where an address is spelled out, is no
training case: the patterns say nothing about it, and that is where the field decides. Everything else sees all rows and whole texts.

Defined cases: a NULL or empty text has no spans. Without training places the field adds nothing. Repeated
rows each get a result, NULL ids are carried along; an empty table gives an empty result. Other columns do
not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

KINDS = ("email", "ip", "card", "phone")  # in the order in which ties are written
TRAIN_PLACES = 2048
EPOCHS, RATE, DECAY = 12, 0.2, 1e-3
LONGEST = 48  # characters of a segment
MOST_GROUPS = 8  # digit groups of a segment
NEAR = 3  # characters between segments that follow each other closely
_SURE = 1e6  # score of a fixed span

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_AROUND = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_GROUP = re.compile("[0-9]+")
_RUN = re.compile(r"[+(]{0,2}[0-9]+(?:[\x20().+-]{1,3}[0-9]+)*")
_AT = re.compile(r"\s?[\[({]\s?at\s?[\])}]\s?|\sat\s", re.I)
_SPELLED = re.compile(r"(?:[A-Za-z0-9-]{1,40}(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\.)){1,4}[A-Za-z]{2,10}(?![A-Za-z0-9])", re.I)

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Leftmost non-overlapping matches per kind that pass their check, and the places of those that fail it."""
    spans, failed = [], []
    if "@" in text:
        done = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                spans.append((start, m.end(), "email"))
                done = m.end()
    if not _DIGIT.search(text):
        return spans, failed
    for m in _IP.finditer(text):
        good = all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))
        spans.append((m.start(), m.end(), "ip")) if good else failed.append(m.span())
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), "card"))
        elif len(digits) > 19:
            failed.append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = len(_digits(m.group()))
            spans.append((m.start(), m.end(), "phone")) if 10 <= n <= 15 else failed.append(m.span())
    return spans, failed


def written(spans: list[Span]) -> str:
    ordered = sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def places(text: str) -> Iterator[tuple[int, int]]:
    """Where digit groups stand together, around every @, and where an address may be spelled out."""
    if "@" in text:
        done = 0
        for m in _AROUND.finditer(text):
            start = m.start()
            while start > done and m.start() - start < LONGEST and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                yield start, m.end()
                done = m.end()
    if _DIGIT.search(text):
        yield from (m.span() for m in _RUN.finditer(text) if sum(map(len, _GROUP.findall(m.group()))) >= 4)
    yield from spelled_places(text)


def spelled_places(text: str) -> Iterator[tuple[int, int]]:
    """Where an address may be spelled out, in whatever case and with whatever white space."""
    for m in _AT.finditer(text):
        start = m.start()
        while start > 0 and m.start() - start <= LONGEST and text[start - 1] in LOCAL:
            start -= 1
        if m.start() - start > LONGEST:
            continue  # no segment holds it, and a part of it is no address
        end = _SPELLED.match(text, m.end())
        if start < m.start() and end and re.search(r"dot", end.group(), re.I):
            yield start, end.end()


def segments(text: str, start: int, end: int) -> list[tuple[int, int, str, list[str]]]:
    """Candidate segments of a place with their features, in order of their ends."""
    place = text[start:end]
    found = []
    if "@" in place or _AT.search(place):
        parts = re.split(r"@|\bat\b", place, flags=re.I)
        labels = len(re.split(r"\bdot\b|\.", parts[-1], flags=re.I))
        return [(start, end, "email", ["email", f"email dotted={labels > 1}"])]
    groups = [m.span() for m in _GROUP.finditer(place)]
    for i, (first, _) in enumerate(groups):
        lead = first
        while lead > 0 and place[lead - 1] in "+(" and first - lead < 2:
            lead -= 1
        for j in range(i, min(len(groups), i + MOST_GROUPS)):
            last = groups[j][1]
            if last - lead > LONGEST:
                break
            own = groups[i : j + 1]
            between = [place[a[1] : b[0]] for a, b in zip(own, own[1:])]
            sizes = [b - a for a, b in own]
            n = sum(sizes)
            shape = "-".join(map(str, sizes)) if len(sizes) <= 5 else "many"
            apart = "".join(sorted(set("".join(between)) - set("()"))) or "none"
            alone = ["open" if i and lead > 0 and place[lead - 1] == "." else "closed", f"after={place[last : last + 1] == '.' and j + 1 < len(groups)}"]
            if n < 4:
                continue
            if len(own) == 4 and set(between) == {"."}:
                good = all(len(place[a:b].lstrip("0")) <= 3 and int(place[a:b]) <= 255 for a, b in own)
                found.append((start + first, start + last, "ip", ["ip", f"ip good={good}", *(f"ip {x}" for x in alone)]))
            if 13 <= n <= 19 and all(x in (" ", "-") for x in between):
                good = luhn("".join(place[a:b] for a, b in own))
                even = len(set(sizes[:-1])) <= 1
                found.append((start + first, start + last, "card", ["card", f"card luhn={good}", f"card n={n if good else 0}", f"card even={even}"]))
            if 7 <= n <= 15 and last - lead >= 8:
                plus = "plus" if place[lead] == "+" else "paren" if place[lead] == "(" else "bare"
                closed = place[lead:last].count("(") == place[lead:last].count(")")
                found.append((start + lead, start + last, "phone", ["phone", f"phone {plus}", f"phone {plus} n={n}", f"phone closed={closed}", f"phone apart={apart}", f"phone {plus} shape={shape}"]))
    found.sort(key=lambda s: (s[1], s[0], s[2]))
    return found


def _score(features: list[str], weights: dict[str, float]) -> float:
    return sum(weights.get(f, 0.0) for f in features)


def link(text: str, left: tuple, right: tuple) -> str:
    """The feature of two segments that follow each other closely."""
    between = text[left[1] : right[0]]
    return f"{left[2]}>{right[2]} by {'nothing' if not between else 'space' if between.isspace() else 'mark'}"


def _near(found: list) -> list[list[int]]:
    """For every segment those that end at most NEAR characters before it; `found` is in order of ends."""
    ends = [f[1] for f in found]
    return [list(range(bisect_left(ends, f[0] - NEAR), bisect_right(ends, f[0]))) for f in found]


def best_segments(text: str, found: list, weights: dict[str, float], fixed: list[Span]) -> list[Span]:
    """The segments, beside the fixed spans, of the segmentation with the highest score that keeps these; ties: the first found."""
    kept = sorted(s for s in fixed)
    usable = [f for f in found if not any(s < f[1] and f[0] < e for s, e, _ in kept)]
    usable = sorted([*usable, *((s, e, k, None) for s, e, k in kept)], key=lambda f: (f[1], f[0], f[2]))
    ends, near = [f[1] for f in usable], _near(usable)
    score, back = [], []  # of the best segmentation that ends with segment i, and the segment before it
    best = [(0.0, -1)]  # after the first i segments
    for i, f in enumerate(usable):
        own = _score(f[3], weights) if f[3] is not None else _SURE
        value, before = best[bisect_left(ends, f[0] - NEAR)]  # those that end farther away; the near ones follow
        for j in near[i]:
            if j < i and (linked := score[j] + weights.get(link(text, usable[j], f), 0.0)) > value:
                value, before = linked, j
        score.append(value + own)
        back.append(before)
        best.append((score[i], i) if score[i] > best[i][0] else best[i])
    spans, at = [], best[-1][1]
    while at >= 0:
        if usable[at][3] is not None:
            spans.append(usable[at][:3])
        at = back[at]
    return spans[::-1]


def train(cases: list[tuple[str, list[Span]]], epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY) -> dict[str, float]:
    """Weights by stochastic gradient ascent on the log-likelihood of the labelled segmentations."""
    weights: dict[str, float] = defaultdict(float)
    prepared = []
    for text, spans in cases:
        found = segments(text, 0, len(text))
        gold = {(s, e, k) for s, e, k in spans}
        if found and gold <= {f[:3] for f in found}:
            prepared.append((text, found, [f[:3] in gold for f in found]))
    for _ in range(epochs):
        for text, found, gold in prepared:
            shares, links = _marginals(text, found, weights)
            chosen = [i for i, x in enumerate(gold) if x]
            true = Counter((i, j) for i, j in zip(chosen, chosen[1:]) if found[j][0] - found[i][1] <= NEAR)
            for (_, _, _, features), share, is_gold in zip(found, shares, gold):
                step = rate * (is_gold - share)
                if step:
                    for f in features:
                        weights[f] += step - rate * decay * weights[f]
            for (i, j), share in links.items():
                step, f = rate * (true[i, j] - share), link(text, found[i], found[j])
                weights[f] += step - rate * decay * weights[f]
    return dict(weights)


def _sum(logs: list[float]) -> float:
    most = max(logs)
    return most + math.log(sum(math.exp(x - most) for x in logs))


def _marginals(text: str, found: list, weights: dict[str, float]) -> tuple[list[float], dict[tuple[int, int], float]]:
    """Probability under the field of every segment, and of every two that follow each other closely.

    Forward sums go over segments in order of their ends, backward sums the other way; places in training are short.
    """
    own, ends, near = [_score(f[3], weights) for f in found], [f[1] for f in found], _near(found)
    ahead: list[float] = []  # of segmentations that end with a segment
    upto = [0.0]  # of those that use the first i segments at most
    bonus = {(j, i): weights.get(link(text, found[j], found[i]), 0.0) for i, before in enumerate(near) for j in before if j < i}
    for i, f in enumerate(found):
        far = upto[bisect_left(ends, f[0] - NEAR)]
        ahead.append(own[i] + _sum([far, *(ahead[j] + bonus[j, i] for j in near[i] if j < i)]))
        upto.append(_sum([upto[i], ahead[i]]))
    behind = [0.0] * len(found)  # of what may follow a segment
    for i in sorted(range(len(found)), key=lambda i: -found[i][1]):
        after = [k for k, f in enumerate(found) if f[0] >= found[i][1] and k != i]
        behind[i] = _sum([0.0, *(bonus.get((i, k), 0.0) + own[k] + behind[k] for k in after)])
    shares = [math.exp(min(0.0, a + b - upto[-1])) for a, b in zip(ahead, behind)]
    links = {(j, i): math.exp(min(0.0, ahead[j] + w + own[i] + behind[i] - upto[-1])) for (j, i), w in bonus.items()}
    return shares, links


def training_cases(rows: DataFrame, most: int = TRAIN_PLACES) -> list[tuple[str, list[Span]]]:
    """At most `most` places with unambiguous labels, those with the smallest hash of place and labels."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: dict[tuple[str, str], str] = {}
            for text in batch.column(0):
                text = text.as_py()
                if not text or not (_DIGIT.search(text) or "@" in text):
                    continue
                spans, failed = base_spans(text)
                unlabelled = set(spelled_places(text))
                for start, end in places(text):
                    if (start, end) in unlabelled or any(s < end and start < e for s, e in failed) or end - start > 4 * LONGEST:
                        continue
                    inside = [(max(s, start) - start, e - start, k) for s, e, k in spans if s >= start and e <= end]
                    if any(s < end and start < e and not (start <= s and e <= end) for s, e, _ in spans):
                        continue
                    case = (text[start:end], written(inside))
                    kept[case] = hashlib.md5("\n".join(case).encode()).hexdigest()
            smallest = sorted(kept.items(), key=lambda x: x[1])[:most]
            columns = [pa.array([c[0][0] for c in smallest], pa.string()), pa.array([c[0][1] for c in smallest], pa.string()), pa.array([c[1] for c in smallest], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "spans", "h"])

    found = rows.select("text").mapInArrow(of_batches, "place string, spans string, h string").distinct()
    cases = []
    for r in found.orderBy("h").limit(most).collect():
        parts = [x.split(":") for x in r["spans"].split(",") if x]
        cases.append((r["place"], [(int(s), int(e), k) for k, s, e in parts]))
    return cases


def tag(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that the field adds."""
    base, _ = base_spans(text)
    added = []
    for start, end in places(text):
        fixed = [s for s in base if s[0] < end and start < s[1]]
        added += best_segments(text, segments(text, start, end), weights, fixed)
    return base, [s for s in added if not any(b[0] < s[1] and s[0] < b[1] for b in base)]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: dict[str, float] | None = None) -> DataFrame:
    """Per row: doc_id, the number of base spans per kind, base_spans and spans, both as kind:start:end joined by commas."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    learned = train(training_cases(rows)) if weights is None else weights

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, bases, every = [], [], []
            for text in batch.column(1):
                base, added = tag(text.as_py() or "", learned)
                counts.append([sum(s[2] == kind for s in base) for kind in KINDS])
                bases.append(written(base))
                every.append(written(base + added))
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, pa.array(bases, pa.string()), pa.array(every, pa.string())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_spans", "spans"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(of_batches, f"doc_id {kind}, {numbers}, base_spans string, spans string")


def op6_personal_data(spark: SparkSession, d: str) -> DataFrame:
    found = find_personal_data(spark.read.parquet(f"{d}/documents.parquet"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")

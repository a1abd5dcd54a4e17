"""The semi-Markov field against enumeration of all segmentations; base patterns against plain regular expressions; shards of rows without ids."""

from __future__ import annotations

import math
import random
import re
from itertools import combinations

import pytest

from basketry.llm import personal_data as field, sharding


def segmentations(found):
    for n in range(len(found) + 1):
        for chosen in combinations(range(len(found)), n):
            if all(found[a][1] <= found[b][0] for a, b in zip(chosen, chosen[1:])):
                yield chosen


def score(text, found, chosen, weights):
    own = sum(field._score(found[i][3], weights) for i in chosen)
    near = [(a, b) for a, b in zip(chosen, chosen[1:]) if found[b][0] - found[a][1] <= field.NEAR]
    return own + sum(weights.get(field.link(text, found[a], found[b]), 0.0) for a, b in near)


PLACES = ["+49 30 1234567 4111 1111 1111 1111", "10.0.0.1 555-123-4567", "4111-1111-1111-1111 5500 0000 0000 0004", "(030) 123 456 78 90 12", "1.2.3.4.5.6 12345678"]


@pytest.mark.parametrize("text", PLACES)
def test_field_against_enumeration(text):
    draw = random.Random(text)
    found = field.segments(text, 0, len(text))[:16]
    names = {f for _, _, _, fs in found for f in fs} | {field.link(text, a, b) for a in found for b in found if a[1] <= b[0]}
    for _ in range(5):
        weights = {n: draw.uniform(-2, 2) for n in names}
        scored = [(score(text, found, c, weights), c) for c in segmentations(found)]
        best = max(s for s, _ in scored)
        chosen = field.best_segments(text, found, weights, [])
        mine = [next(i for i, f in enumerate(found) if f[:3] == s) for s in chosen]
        assert score(text, found, mine, weights) == pytest.approx(best)
        whole = math.log(sum(math.exp(s) for s, _ in scored))
        shares, links = field._marginals(text, found, weights)
        for i, share in enumerate(shares):
            assert share == pytest.approx(sum(math.exp(s - whole) for s, c in scored if i in c), abs=1e-9)
        for (j, i), share in links.items():
            assert share == pytest.approx(sum(math.exp(s - whole) for s, c in scored if (j, i) in zip(c, c[1:])), abs=1e-9)


def test_fixed_spans_stay_and_link():
    text = "4111 1111 1111 1111 12345678"
    found = [(20, 28, "phone", ["phone"])]
    fixed = [(0, 19, "card")]
    assert field.best_segments(text, found, {"phone": -1.0, "card>phone by space": 2.0}, fixed) == [(20, 28, "phone")]
    assert field.best_segments(text, found, {"phone": -1.0}, fixed) == []
    assert field.best_segments(text, found, {"phone": -1.0, "card>phone by space": 2.0}, []) == []


def test_neighbours_are_learned():
    cases = [(f"4111 1111 1111 1111 1234567{i}", [(0, 19, "card"), (20, 28, "phone")]) for i in range(10)]
    weights = field.train(cases)
    assert weights["card>phone by space"] > 0
    text = cases[0][0]
    assert field.best_segments(text, field.segments(text, 0, len(text)), weights, []) == cases[0][1]


def test_base_patterns_against_plain_ones():
    draw = random.Random(9)
    pieces = ["1", "23", "456", "7890", "255", "256", "0", ".", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "10.0.0.1", "a", "x@y.z", "@", "é"]

    def plain(text):
        spans = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            if all(int(x) <= 255 for x in m[0].split(".")):
                spans.append((*m.span(), "ip"))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
            if 14 <= len(digits) <= 19 and total % 10 == 0:
                spans.append((*m.span(), "card"))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                spans.append((*m.span(), "phone"))
        return sorted(spans)

    for _ in range(4000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 25)))
        assert sorted(field.base_spans(text)[0]) == plain(text), text


def test_a_long_local_part_is_no_half_address():
    name = "a" * 60
    assert list(field.spelled_places(f"{name} at example dot com")) == []
    assert list(field.spelled_places(f"{'b' * 48} at example dot com")) == [(0, 48 + len(" at example dot com"))]


@pytest.mark.parametrize("doc_id", [None, 5])
def test_rows_without_ids_are_spread(spark, doc_id):
    rows = [(doc_id, "the same text on every row", "en", "s", 26) for _ in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = sharding.shard_documents(docs).groupBy("shard").count().collect()
    sizes = sorted(r["count"] for r in got)
    assert len(sizes) == 8 and sum(sizes) == 4000 and sizes[-1] <= 1.3 * sizes[0]

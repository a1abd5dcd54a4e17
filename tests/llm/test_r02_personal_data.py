"""Addresses spelled out count in any case and spacing, and do not train the field against themselves."""

from __future__ import annotations

import pytest

from basketry.llm import personal_data

SPELLED = ["bob AT example DOT com", "bob [AT] example [DOT] com", "bob (at ) x (dot) org", "bob\tat\texample dot com", "bob\nAt\nexample dot com"]


@pytest.mark.parametrize("text", SPELLED)
def test_spelled_out_places_in_any_case_and_spacing(text):
    assert list(personal_data.places(text)) == [(0, len(text))]


def test_spelled_out_addresses_are_found_where_they_prevail(spark):
    literal = [(i, f"write to a{i}@b.example.org") for i in range(5)]
    spelled = [(100 + i, f"{i} u{i} at host{i} dot example dot com") for i in range(200)]
    rows = literal + spelled + [(1000 + i, t) for i, t in enumerate(SPELLED)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in personal_data.find_personal_data(df).collect()}
    assert all(got[i] == f"email:9:{len(t)}" for i, t in literal)
    assert all(got[100 + i] == f"email:{len(str(i)) + 1}:{len(t)}" for i, (_, t) in enumerate(spelled))
    assert all(got[1000 + i] == f"email:0:{len(t)}" for i, t in enumerate(SPELLED))

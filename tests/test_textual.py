"""Textual routing finds what one pattern per name finds, whatever the names and texts look like."""

import random
import re

import pytest
from pyspark.sql import functions as F

from logweir.operators import routing
from logweir.operators.routing import alternation, is_plain, prefix_tree, text_events

PLAIN = ["a", "ab", "abc", "b", "event", "event_1", "event_11", "it's", "a-b", "ÄÖ", "x y", ":", ","]
ODD = ["a.b", "b$", "(a|b)", "a+"]


def texts_with(pick, names):
    parts = ['"event":"', '"', "event", ":", "{", " ", "\n", *names]
    return ["".join(pick.choices(parts, k=pick.randint(0, 14))) for _ in range(400)]


@pytest.mark.parametrize("names", [PLAIN, PLAIN + ODD, ["a"], ODD[:1], []])
def test_every_name_is_found_where_its_own_pattern_is(texts, names):
    values = [None, "", *texts_with(random.Random(len(names)), names), '"event":"event":"a"', '"event":"a""event":"b"']
    want = [(v, {n for n in names if v is not None and re.search(f'"event":"{n}"', v)}) for v in values]
    rows = texts(*values).select("value", text_events(names).alias("found")).collect()
    assert [(r.value, set(r.found)) for r in rows] == want
    assert all(len(r.found) == len(set(r.found)) for r in rows)


@pytest.mark.parametrize("names", [PLAIN, PLAIN + ODD, PLAIN[3:], ["a"], ["a", "b"], ["b$", "a"]])
def test_the_folded_alternation_matches_like_the_flat_one(texts, names):
    values = ["", *texts_with(random.Random(7), names)]
    flat = re.compile('"event":"{}"'.format("|".join(names)))
    want = sorted(v for v in values if flat.search(v))
    assert sorted(r.value for r in routing.route(texts(*values), names, "regex").collect()) == want
    assert want


def test_prefix_tree():
    pick = random.Random(3)
    for _ in range(200):
        words = ["".join(pick.choices("ab.", k=pick.randint(1, 5))) for _ in range(pick.randint(1, 8))]
        tree = re.compile(prefix_tree(words))
        for _ in range(30):
            text = "".join(pick.choices("ab.", k=pick.randint(0, 8)))
            assert bool(tree.search(text)) == any(w in text for w in words)


def test_a_long_list_of_names_is_a_short_plan(texts):
    names = [f"name{i:05d}" for i in range(5000)]
    plan = texts("x").select(F.explode(text_events(names)))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan and "RLIKE" not in plan
    assert len(alternation(tuple(names))) < 40_000
    assert is_plain("event_1") and not is_plain("a.b") and not is_plain('a"b')


def test_repeated_names_and_records_of_no_name(texts):
    found = texts('{"event":"a","event":"a"}', '{"event":"c"}').select(text_events(["a", "b", "a"]).alias("f")).collect()
    assert [r.f for r in found] == [["a"], []]

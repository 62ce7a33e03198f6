import random

import numpy as np
from brute import component_of
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import hashing
from ledgerloom.llm.components import components
from ledgerloom.llm.suffixes import merged


def test_components_in_one_and_many_tasks(llm):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(7, 7), (900, 901), (901, 900)] + [(0, k) for k in range(400, 460)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = component_of(nodes, links)
    table = llm.createDataFrame([*links, (None, 3), (5, None)], "a long, b long")
    for per_task in (10_000, 25):
        got = {r["node"]: r["component"] for r in components(table, per_task).collect()}
        assert got == want


def test_components_of_a_long_chain(llm):
    table = llm.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long")
    assert {r["component"] for r in components(table, 20).collect()} == {0}


def test_components_of_nothing(llm):
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té", max_size=30), max_size=8), st.integers(1, 4))
def test_shingles_are_those_of_each_text(texts, words):
    from brute import shingles

    sets = [s.copy() for s in hashing.shingle_sets(hashing.lower_bytes(texts), words)]
    assert [len(s) for s in sets] == [len(shingles(t, words)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(np.intersect1d(sets[i], sets[j])) == len(shingles(a, words) & shingles(b, words))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=209, max_size=209).map(lambda b: bytes(x % 2 for x in b[:4]) + bytes(205)), max_size=12), min_size=1, max_size=6))
def test_loser_tree_merges_and_knows_common_prefixes(runs):
    runs = [sorted(r) for r in runs]
    common = lambda a, b: next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    shared = [[0] + [common(a, b) for a, b in zip(r, r[1:])] for r in runs]
    out = list(merged(runs, shared))
    keys = [runs[r][i] for r, i, _ in out]
    assert keys == sorted(k for r in runs for k in r)
    assert [p for *_, p in out][1:] == [common(a, b) for a, b in zip(keys, keys[1:])]

import random

import pytest
from brute import UNIT, fim as plain, sha
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import fim

TEXTS = st.text(alphabet="ab é日𝒳 \t\n\x0b\x1c\x85<PSM>", max_size=400)


def check(rows, docs):
    """``docs``: (doc_id, text) pairs; ids may repeat."""
    whole = lambda v: None if v is None or v != v else int(v)
    want = [(i, *plain(i, t)[:4], sha(plain(i, t)[4]), sha(t or "")) for i, t in docs]
    got = [(whole(r["doc_id"]), r["n"], r["form"], whole(r["prefix_chars"]), whole(r["middle_chars"]), r["output_sha256"], r["restored_sha256"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=8), max_size=6))
def test_summaries_add_up(parts):
    total = fim.EMPTY
    for part in parts:
        total = total + fim.summary(part)
    assert total == fim.summary(b"".join(parts))


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(0, 400), st.integers(0, 400))
def test_places(text, a, b):
    units, data = UNIT.findall(text * 3), (text * 3).encode()
    wanted = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    n, found = fim.Counter().places(data, lambda n: wanted)
    assert n == len(units)
    assert found == [(len("".join(units[:k]).encode()), len("".join(units[:k]))) for k in wanted]


def test_every_place_of_a_long_text():
    rng = random.Random(3)
    passages = ["".join(rng.choice("abcé \n  ") for _ in range(rng.randrange(3000))) + rng.choice(["", " ", "x" * 40_000]) for _ in range(12)]
    text = "".join(rng.choice(passages) for _ in range(40))
    units, counter = UNIT.findall(text), fim.Counter()
    n, found = counter.places(text.encode(), lambda n: range(n + 1))
    ends = [0]
    for u in units:
        ends.append(ends[-1] + len(u))
    assert n == len(units) and [c for _, c in found] == ends
    assert counter.hits > 0


def test_chunks_follow_content():
    rng = random.Random(4)
    shared = bytes(rng.randrange(97, 123) for _ in range(30_000))
    cut = lambda d: {d[a:b] for a, b in zip([0, *fim.chunk_ends(d)], fim.chunk_ends(d))}
    a, b = cut(b"one " + shared), cut(b"another beginning " + shared)
    assert len(a & b) > 0.9 * len(a)
    for data in (shared, b"a" * 100_000, b"", b"x"):
        ends = fim.chunk_ends(data)
        assert (ends[-1] if ends else 0) == len(data)
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert all(0 < s <= fim.MOST_CHUNK for s in sizes) and all(s >= fim.LEAST_CHUNK for s in sizes[:-1])


def test_full_cache_is_emptied():
    counter = fim.Counter(most=1000)
    for i in range(100):
        counter.places(str(i).encode() * 200, lambda n: [])
    assert counter.size <= 1000 + fim.MOST_CHUNK


def test_documents(make, odd_texts, empty):
    rows = [(i, t, s) for i, t, s in odd_texts] + [(100 + i, t, None) for i, t in enumerate(["<P>", "a<S>b", "< P> <", "x<", "  lead", "trail  ", " wide space ", "𝒳 é"])]
    got = fim.report(make(rows)).collect()
    check(got, [(i, t) for i, t, _ in rows])
    assert {r["form"] for r in got} >= {"plain", "spm"}
    assert fim.report(empty).collect() == []


def test_other_rules(make):
    rows = [(i, f"some text number {i} of many", None) for i in range(200)]
    forms = [r["form"] for r in fim.report(make(rows), fim.Rule(seed=7, rate=100, spm=0)).collect()]
    assert set(forms) == {"psm"}
    assert {r["form"] for r in fim.report(make(rows), fim.Rule(rate=0)).collect()} == {"plain"}


def test_columns_stay(make):
    docs = make([(1, "a b c", "s")])
    row = fim.fill_in_middle(docs).select("row.*").collect()
    assert row == docs.collect()


@pytest.mark.parametrize("name", ["op12_fill_in_middle"])
def test_query(ask, documents, name):
    check(ask(name).to_dict("records"), list(zip(documents.doc_id, documents.text)))

import functools
import random

import pytest
from brute import aligned as plain, sha
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import alignment as op
from ledgerloom.llm.queries import BYTE_LEVEL, PIECES

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["<|endoftext|> <s> </s> <unk>", "a▁b", " lead", "trail ", "  two  spaces ", "a \n b", "\n", "\x00 nul", "﻿mark", "日本語 テキスト", "𝒳 é ñ", "a\xa0b 　 c", "x\x1c y", "don't we'll", "\r\n\r\n} {", "tab\t tab", "</s>", "<0x41> A", "z" * 3000, "é" * 500 + " end"]


@pytest.fixture(scope="module")
def aligner():
    return op.Aligner(op.Sides(BYTE_LEVEL, PIECES))


def check(rows, docs):
    want = [(i, *r[:6], sha(r[6]) if r[6] is not None else "") for (i, *_), r in zip(docs, plain([t for _, t, *_ in docs], BYTE_LEVEL, PIECES))]
    got = [tuple(r) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(0, 120), max_size=5))
def test_any_ranges_compose(a, b, cuts):
    """Whatever byte ranges the tokens of a text are cut into, and whatever pair is composed first."""
    ends = lambda sizes: [sum(sizes[: i + 1]) for i in range(len(sizes))]
    a_ends, b_ends = ends(a), ends(b)
    whole = op.fragment(list(range(len(a))), a_ends, list(range(100, 100 + len(b))), b_ends)
    bounds = [0, *sorted(cuts), 1000]

    def of(lo, hi):
        i, j = [k for k, e in enumerate(a_ends) if lo < e <= hi], [k for k, e in enumerate(b_ends) if lo < e <= hi]
        return op.fragment(i, [a_ends[k] for k in i], [100 + k for k in j], [b_ends[k] for k in j])

    parts = [of(lo, hi) for lo, hi in zip(bounds, bounds[1:])]
    assert functools.reduce(op.compose, parts) == whole
    while len(parts) > 1:
        k = sum(cuts) % (len(parts) - 1)
        parts[k : k + 2] = [op.compose(parts[k], parts[k + 1])]
    assert parts[0] == whole == op.compose(op.Fragment(), whole) == op.compose(whole, op.Fragment())


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet="ab ,.\n\t'1日é▁　\x1c<>s/", min_size=1, max_size=60), size=st.integers(1, 20))
def test_texts_and_chunks(aligner, text, size):
    n_a, n_b, n, _, _, _, groups = plain([text], BYTE_LEVEL, PIECES)[0]
    parts = op.chunks(text, size)
    assert " ".join(parts) == text
    for f in (aligner.fragments([text])[0], functools.reduce(op.compose, aligner.fragments(parts))):
        assert op._finished(f)[:3] == (n_a, n_b, groups) and len(op._finished(f)[3]) == 4 * n


def test_full_cache_and_long_words(aligner):
    small = op.Aligner(aligner.sides, most=3)
    texts = ["one two three four five", "two " + "x" * 100, "one two"]
    for _ in range(3):
        assert small.fragments(texts) == aligner.fragments(texts)
    assert len(small.words) <= 8 and len(small.older) <= 8 and all(len(w) <= op.CACHED_CHARS for w in aligner.words)


def test_white_space_at_an_end_is_never_kept(aligner):
    """A first word with white space before it must not make that space a place to cut later on."""
    for texts in (["\nfoo bar", " foo", "foo\n"], ["a \nfoo bar", "a  foo", "foo\n b"]):
        for text, f in zip(texts, aligner.fragments(texts)):
            assert op._finished(f)[2] == plain([text], BYTE_LEVEL, PIECES)[0][6]


def test_words_that_are_not_spelled_stand_alone(aligner):
    words = [f"w{i}" for i in range(50)] + ["a▁b"] + [f"v{i}" for i in range(50)]
    found = aligner.sides.known(words)
    assert [w for w, k in zip(words, found) if k is None] == ["a▁b"]
    assert found == [aligner.sides.known([w])[0] for w in words]


def test_table_of_links_is_bounded(aligner):
    assert aligner.sides.pairs < 1_000_000


@pytest.mark.parametrize("size", [op.CHUNK_CHARS, 40])
def test_documents(make, odd_texts, size):
    rng = random.Random(2)
    docs = [(i, t, s) for i, t, s in odd_texts] + [(100 + k, t, None) for k, t in enumerate(ODD)]
    docs += [(300 + k, " ".join(rng.choice(["the", "of,", "naïve", "x\ny", "", "日本"]) for _ in range(rng.randrange(200))), "a") for k in range(30)]
    check(op.report(make(docs), BYTE_LEVEL, PIECES, chunk_chars=size).collect(), docs)


def test_groups_of_long_texts_are_digested_before_they_meet_their_rows(llm, make, odd_texts):
    docs = make(odd_texts)
    found = op.align(docs, BYTE_LEVEL, PIECES, chunk_chars=40, keep=["doc_id"], digest=True)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    long = op.align_long(docs.filter("text IS NOT NULL").selectExpr("unhex(sha2(text, 256)) AS key", "text"), (BYTE_LEVEL, PIECES), 40, digest=True)
    assert all(len(r["groups"]) in (0, 64) for r in long.collect())
    whole = op.align(docs, BYTE_LEVEL, PIECES, chunk_chars=40, keep=["doc_id"])
    want = [(r["row"], r["n_a"], r["n_b"], "" if r["groups"] is None else sha(r["groups"]), r["links"]) for r in whole.collect()]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_empty_table_and_columns(make, empty):
    assert op.report(empty, BYTE_LEVEL, PIECES).columns == COLUMNS and op.report(empty, BYTE_LEVEL, PIECES).collect() == []
    docs = make([(1, "a b", "s"), (2, None, None)])
    assert sorted(op.align(docs, BYTE_LEVEL, PIECES).select("row.*").collect()) == sorted(docs.collect())


def test_other_kinds_are_refused():
    from ledgerloom.llm.queries import TOKENIZER

    with pytest.raises(ValueError):
        op.Sides(TOKENIZER, PIECES)


def test_query(ask, documents):
    got = ask("op13_token_alignment")[COLUMNS]
    check(got.itertuples(index=False), list(zip(documents.doc_id, documents.text)))

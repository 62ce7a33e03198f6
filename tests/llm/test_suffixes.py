import random

import numpy as np
import pytest
from brute import repeat_report

from ledgerloom.llm import filters, suffixes


def check(rows, got):
    want = repeat_report([(t or "").encode() for _, t in rows])
    key = lambda r: str(r)
    have = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got]
    assert sorted(have, key=key) == sorted([(i, *w) for (i, _), w in zip(rows, want)], key=key)


def report(docs, **options):
    return [r.asDict() for r in suffixes.repeat_report(docs, **options).collect()]


@pytest.fixture(scope="module")
def passages():
    """Passages from under to far over the length, in changed surroundings, near and exact copies, periodic texts."""
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefghijé \n") for _ in range(n))
    shared = [text(n) for n in (150, 199, 200, 201, 230, 300, 700)]
    out = []
    for _ in range(60):
        out.append("".join(text(rng.randrange(80)) + (p if rng.random() < 0.3 else p[rng.randrange(20) : len(p) - rng.randrange(20)]) for p in rng.sample(shared, 2)))
    whole = text(900)
    out += [whole, whole, whole[:450] + "#" + whole[451:], text(5) + whole, whole + text(5), whole[100:], "ab" * 300, "a" * 201, "a" * 200, "b" * 199]
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("hot", [suffixes.HOT_SUFFIXES, 5, 0])
def test_passages(make, passages, hot):
    check(passages, report(make([(i, t, None) for i, t in passages]), hot_suffixes=hot))


def test_small_runs_and_segments(make, passages, monkeypatch):
    rows = [(0, "".join(t for _, t in passages[:20])), *passages[20:40]]
    found = [np.concatenate(x) for x in zip(*suffixes.anchors([t.encode() for _, t in rows]))]
    monkeypatch.setattr(suffixes, "SEGMENT", 1000)
    again = [np.concatenate(x) for x in zip(*suffixes.anchors([t.encode() for _, t in rows]))]
    assert all(np.array_equal(a, b) for a, b in zip(found, again))


def test_odd_documents(make, odd_texts):
    rows = [(i, t if t is None or len(t) < 5000 else t[:5000]) for i, t, _ in odd_texts]
    check(rows, report(make([(i, t, None) for i, t in rows])))


def test_very_long_text(make):
    rng = random.Random(7)
    long = "".join(rng.choice("abcdefgh") for _ in range(300_000))
    got = report(make([(1, long + "|" + long[1000:1300], None), (2, long[5000:5400], None)]))
    assert {(r["doc_id"], r["n_removed"], r["n_spans"]) for r in got} == {(1, 300 + 300 + 400, 3), (2, 400, 1)}


def test_empty_table(empty):
    assert report(empty) == [] and suffixes.drop_repeats(empty).count() == 0


def test_drop_repeats(make, passages):
    docs = make([(i, t, None) for i, t in passages[:30]] + [(None, None, None)])
    kept = suffixes.drop_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == 31
    want = repeat_report([t.encode() for _, t in passages[:30]])
    for r in kept.collect():
        if r["doc_id"] is not None and not want[r["doc_id"]][1]:
            assert r["text"] == passages[r["doc_id"]][1]


def test_runs_round_trip():
    rng = random.Random(8)
    keys = sorted({bytes(rng.choice(b"ab") for _ in range(209)) for _ in range(40)} | {b"a" * 209})
    classes = [(k, k[: rng.randrange(50)], [(rng.randrange(9), -5, 7, 3, 2)] * rng.randrange(1, 4)) for k in keys]
    run = suffixes.Run(*suffixes.front_coded(classes).values())
    assert run.keys == keys and run.before == [b for _, b, _ in classes] and [[tuple(x) for x in m.tolist()] for m in run.members] == [m for *_, m in classes]


def test_filter_has_no_false_negative(llm):
    values = np.random.default_rng(9).integers(-(2**63), 2**63, 5000)
    table = llm.createDataFrame([(int(v),) for v in values], "h long")
    found = filters.Filter.of(table, 1 << 20)
    assert found.holds(values.view(np.uint64)).all() and found.holds(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)).mean() < 0.02
    assert not filters.Filter.of(table.limit(0), 1 << 10).holds(values.view(np.uint64)).any()


def test_query(ask, documents):
    check([(int(i), t) for i, t in zip(documents.doc_id, documents.text)], ask("op10_suffix_dedup").to_dict("records"))

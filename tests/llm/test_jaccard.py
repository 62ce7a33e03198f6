import random

import numpy as np
import pytest
from brute import jaccard_components

from ledgerloom.llm import jaccard


def check(rows, got):
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, t)
    texts.pop(None, None)
    want, single = jaccard_components(texts), {i for i in texts if len({t for j, t, _ in rows if j == i}) == 1}
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]][1]
            assert r["doc_id"] not in single or r["n_shingles"] == want[r["doc_id"]][0]


def near_copies(rng, count, words=150, changes=6, vocabulary=5000):
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(count):
        own = base[:]
        for _ in range(rng.randrange(changes)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own[rng.randrange(2) : words - rng.randrange(2)]))
    return out


@pytest.fixture(scope="module")
def mixture():
    """Groups of copies of many sizes around the threshold, common passages, and short texts."""
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [t for n in (2, 3, 5, 9, 30, 300) for t in near_copies(rng, n)]
    texts += [f"{passage} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(6))) for _ in range(60)]
    rng.shuffle(texts)
    return [(k, t, None) for k, t in enumerate(texts)]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_odd_documents(make, odd_texts):
    got = rows_of(jaccard.join_documents(make(odd_texts)))
    check(odd_texts, got)
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None, None]


@pytest.mark.parametrize("rare", [1, 16, 10_000])
def test_groups_of_copies(make, mixture, rare, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    check(mixture, rows_of(jaccard.join_documents(make(mixture), rare=rare)))


def test_sets_around_one_passage_are_not_compared_with_each_other(make, monkeypatch):
    """A passage chains sets of which few are linked; what is compared follows the few."""
    rng = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(100))
    texts = [f"{passage} " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(20)) for _ in range(200)]
    texts += [f"{t} w{k}" for k, t in enumerate(texts[:10])] + near_copies(rng, 60)
    rng.shuffle(texts)
    rows, written = [(k, t, None) for k, t in enumerate(texts)], {}
    keep = jaccard.materialise

    def noted(df, label):
        written.setdefault(label, []).append(keep(df, label))
        return written[label][-1]

    monkeypatch.setattr(jaccard, "BLOCK", 20)
    monkeypatch.setattr(jaccard, "materialise", noted)
    check(rows, rows_of(jaccard.join_documents(make(rows))))
    assert written["members"][0].filter("size >= 200").count() >= 200  # the chain
    assert written["strays"][0].filter("label <> main").count() < 60


def test_texts_without_near_copies_are_not_exchanged(make, mixture):
    kept = jaccard.one_per_group(make(mixture), 80, 5)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_one_id_with_two_texts_joins_both(make):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(3, a, None), (4, a, None), (4, b, None), (9, b, None), (10, "z z z z", None)]
    got = {(r["doc_id"], r["component_id"]) for r in rows_of(jaccard.join_documents(make(rows)))}
    assert got == {(3, 3), (4, 3), (9, 3), (10, 10)}


def test_empty_table(empty):
    assert jaccard.join_documents(empty).count() == 0 and jaccard.one_per_group(empty).columns == empty.columns


def test_one_per_group(make, odd_texts):
    kept = jaccard.one_per_group(make(odd_texts), 80, 5)
    assert kept.columns == make(odd_texts).columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(None) == 2 and ids.count(30) == 2 and 31 not in ids


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_key(percent):
    """Sets at the threshold share a rare prefix shingle, or have enough frequent ones and share a combination."""
    rng = np.random.default_rng(percent)
    for _ in range(1500):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > rng.random() * 0.2], rng.integers(0, 2**64, int(rng.integers(0, 12)), dtype=np.uint64))))
        if not len(b) or not jaccard.linked(frozenset(a.tolist()), frozenset(b.tolist()), percent):
            continue
        prefix = [set(s[: jaccard.prefix_length(len(s), percent)].tolist()) for s in (a, b)]
        need = max(jaccard.enough_frequent(len(s), percent) for s in (a, b))
        assert len(prefix[0] & prefix[1]) >= need
        assert jaccard.combinations(a, percent) & jaccard.combinations(b, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_prefixes_of_linked_sets_leave_enough(llm, percent):
    rng, rows = np.random.default_rng(percent), []
    for _ in range(400):
        a = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 120)), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > rng.random() * 0.3], rng.integers(0, 2**64, int(rng.integers(1, 12)), dtype=np.uint64))))
        of_a, of_b = (s[: jaccard.prefix_length(len(s), percent)].view(np.int64).tolist() for s in (a, b))
        rows.append((of_a, of_b, len(a), len(b), len(set(of_a) & set(of_b)), jaccard.linked(frozenset(a.tolist()), frozenset(b.tolist()), percent)))
    pairs = llm.createDataFrame(rows, "of_a array<long>, of_b array<long>, n_a long, n_b long, shared int, linked boolean")
    found = {tuple(r) for r in pairs.select("linked", jaccard._may_link(percent)).distinct().collect()}
    assert (True, True) in found and (True, False) not in found and (False, False) in found


def test_words_made_to_collide(make):
    """A Thue-Morse word and its complement have one value under every odd base modulo a power of two."""
    from ledgerloom.llm.hashing import shingle_sets

    for power in (10, 12, 16):
        word = "a"
        for _ in range(power):
            word += word.translate(str.maketrans("ab", "ba"))
        other = word.translate(str.maketrans("ab", "ba"))
        one, two = shingle_sets([word.encode(), other.encode()], 3)
        assert one.tolist() != two.tolist()
        got = {r["doc_id"]: r["component_id"] for r in jaccard.join_documents(make([(1, word, None), (2, other, None), (3, word, None)])).collect()}
        assert got == {1: 1, 2: 2, 3: 1}

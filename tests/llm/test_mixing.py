from collections import Counter

import pytest
from brute import WORD, targets
from pyspark.sql import functions as F

from ledgerloom.llm import mixing


def check(rows, mixed):
    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    want, taken = targets(dict(sizes)), Counter()
    for r in mixed:
        assert r["size"] == size(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert (r["position"] is None) == (r["taken"] == 0) and (r["position"] is None or 0 <= r["position"] <= 1)
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.5 + 1e-6


def mix_rows(docs):
    return [r.asDict() for r in mixing.mix(docs).select("row.*", *(F.col(c).alias(c) for c in ("size", "source_size", "target", "taken", "position"))).collect()]


def slim(docs):
    return docs.select("doc_id", "text", "source")


def test_odd_documents(make, odd_texts):
    docs = slim(make(odd_texts))
    got = mix_rows(docs)
    assert len(got) == len(odd_texts)
    check(odd_texts, got)
    assert sorted(map(str, got)) == sorted(map(str, mix_rows(docs.repartition(7))))


def test_small_sources_are_full(make):
    rows = [(1, "a", "x"), (2, "b c", "y"), (3, " ".join("w" * 500), "z"), (4, "d e f", None)]
    check(rows, mix_rows(slim(make(rows))))


def test_empty_table(empty):
    assert mixing.mix(empty).count() == 0 and mixing.training_order(empty).columns == empty.columns


def test_no_words_at_all(make):
    rows = [(1, None, "x"), (2, "", None)]
    assert [(r["size"], r["taken"]) for r in mix_rows(slim(make(rows)))] == [(0, 0), (0, 0)]


def test_training_order_has_whole_texts_and_nearly_the_words_taken(make, odd_texts):
    docs = make(odd_texts)
    own = {(i, t) for i, t, _ in odd_texts}
    taken, size, short = Counter(), {}, Counter()
    for r in mixing.mix(docs).select("row.doc_id", "row.text", "row.source", "taken", "size").collect():
        taken[r["source"]] += r["taken"]
        size[r["source"]] = max(size.get(r["source"], 0), r["size"])
    ordered = mixing.training_order(docs)
    assert ordered.columns == docs.columns
    for r in ordered.select("doc_id", "text", "source").collect():
        assert (r["doc_id"], r["text"]) in own
        short[r["source"]] += len(WORD.findall(r["text"] or ""))
    assert all(2 * abs(taken[s] - short[s]) <= size[s] for s in size)


def test_other_documents_make_up_for_the_one_that_a_target_cuts(make):
    rows = [(k, " ".join(f"{k}-{i}" for i in range(k * 37 % 101 + 1)), "ab"[k % 2]) for k in range(60)] + [(100, " ".join(map(str, range(900))), "b")]
    docs, taken, used = make(rows), Counter(), Counter()
    for r in mixing.mix(docs).select("row.source", "taken").collect():
        taken[r["source"]] += r["taken"]
    for r in mixing.training_order(docs).select("text", "source").collect():
        used[r["source"]] += len(WORD.findall(r["text"]))
    assert used == taken


def test_demand_inverts_the_schedule(llm):
    row = llm.range(1).select(F.lit(2).alias("rank"))
    points = mixing.rising_and_falling(F.col("rank"))
    for share in (0.0, 0.2, 0.5, 0.9, 1.0):
        t = row.select(mixing.inverse_demand(points, F.lit(share))).first()[0]
        done = sum((min(t, b) - a) * (1.5 + (a * 1.0) + 1.5 + (min(t, b) * 1.0)) / 2 for a, b in ((0, 0.5), (0.5, 1)) if t > a)
        assert done / 2 == pytest.approx(share, abs=1e-9)


def test_query(ask, documents):
    got = ask("op1_mixing").merge(documents[["doc_id", "text", "source"]], on="doc_id")
    got["position"] = got["position"].astype(object).where(got["position"].notna(), None)
    assert len(got) == len(documents)
    check(list(documents[["doc_id", "text", "source"]].itertuples(index=False)), got.to_dict("records"))

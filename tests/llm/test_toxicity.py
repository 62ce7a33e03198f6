import random
import tracemalloc
import zlib

import pandas as pd
import pyarrow.parquet as pq
import pytest
from brute import DATA, auc

from ledgerloom.llm import toxicity


@pytest.fixture(scope="module")
def rows():
    """Toxic documents hold a few of ten words; a third of those hides them."""
    rng = random.Random(2)
    bad = ["idiot", "scum", "moron", "loser", "clown", "trash", "pathetic", "worthless", "stupid", "vermin"]
    hidden = {"i": "1", "o": "0", "e": "3", "a": "@", "s": "$"}
    out = []
    for i in range(900):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('klmnp')}{rng.choice('aeiou')}" for _ in range(rng.randrange(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                word = rng.choice(bad)
                word = "".join(hidden.get(c, c) for c in word) if i % 12 == 0 else word
                words[rng.randrange(len(words))] = rng.choice([word, word.upper(), word + "!!"])
        out.append((i, " ".join(words), int(toxic)))
    return out


@pytest.fixture(scope="module")
def tables(llm, make, rows):
    docs = make([(i, t, None) for i, t, _ in rows] + [(2000, None, None), (2001, "", None), (None, "idiot scum moron", None), (3, rows[3][1], None), (2002, "word " * 50_000, None)])
    labels = llm.createDataFrame([(i, 1, x, "e") for i, _, x in rows] + [(None, 1, 1, None), (5, 0, None, None), (99_999, 1, 1, None)], "doc_id long, quality int, toxic int, score string")
    return docs, labels


def test_held_out_rows_are_told_apart(tables, rows):
    report = toxicity.toxicity_report(*tables).collect()
    assert len(report) == len(rows) + 5
    label = {i: x for i, _, x in rows}
    known = [r for r in report if r["doc_id"] in label]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in known)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in report)
    held = [r for r in known if r["held_out"]]
    assert auc([r["score"] for r in held], [label[r["doc_id"]] for r in held]) > 0.97
    assert sum(r["predicted"] != label[r["doc_id"]] for r in held) < 0.05 * len(held)
    assert next(r for r in report if r["doc_id"] is None)["predicted"] == 1
    assert [r["predicted"] for r in report if r["doc_id"] in (2000, 2001, 2002)] == [0, 0, 0]


def test_labels_of_held_out_rows_change_nothing(tables, rows):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic", "score")
    one, two = (sorted((str(r["doc_id"]), r["score"]) for r in toxicity.toxicity_report(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_drop_toxic_keeps_the_others(tables, rows):
    docs, labels = tables
    kept = toxicity.drop_toxic(docs, docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    clean, toxic = {i for i, _, x in rows if not x}, {i for i, _, x in rows if x}
    assert len(ids & clean) >= 0.99 * len(clean) and len(ids & toxic) <= 0.05 * len(toxic) and {2000, 2001, 2002} <= ids


def test_few_labels_or_none(llm, make, empty):
    docs = make([(1, "good text", None), (2, "idiot", None), (4, "bad idiot", None), (None, None, None)])
    for labels in ([], [(1, 0, 0)], [(2, 1, 1)], [(1, 1, 0), (2, 0, 1), (3, 1, 1), (4, 1, 1)]):
        table = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert toxicity.toxicity_report(docs, table).count() == 4
    assert toxicity.toxicity_report(empty, table).count() == 0


def test_spelling_tricks():
    assert {toxicity.plain(w) for w in ("1d10t", "IDIOT!!", "i.d.i.o.t", "idiooooot", '"id!ot",')} == {"idiot"}
    assert toxicity.words_of("you i d i o t you") == ["you", "idiot", "you"]
    row = dict(zip(toxicity.FEATURES, toxicity.Features({"idiot": 3.0}).rows(["you are an 1d10t and an idiot !!"])[0]))
    assert row["hits"] == 2 and row["hidden_hits"] == 1 and row["near_second_person"] == 2
    assert len(toxicity.Features({}).rows([""])[0]) == len(toxicity.FEATURES)


def test_query(ask, documents):
    report = ask("op6_toxicity")
    assert len(report) == len(documents) and report.score.between(0, 1).all()
    assert (report.predicted == (report.score >= 0.5)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(report.doc_id, report.held_out))


def test_held_out_accuracy(llm):
    from ledgerloom.llm.queries import QUERIES

    folder = DATA.parent / "sf0.1"
    if not folder.exists():
        pytest.skip("no test data")
    labels = pq.read_table(folder / "labels.parquet").to_pandas()
    held = QUERIES["op6_toxicity"](llm, str(folder)).toPandas().query("held_out").merge(labels, on="doc_id")
    assert auc(held.score, held.toxic) > 0.97 and (held.predicted == held.toxic).mean() > 0.98


def test_words_without_a_chosen_form_take_little_memory():
    words = [f"w{'abcdefghij'[i % 10]}{i}" for i in range(20_000)]
    frames = [pd.DataFrame({"whole": [" ".join(words[a : a + 100])]}) for a in range(0, len(words), 100)]
    tracemalloc.start()
    assert sum(len(f) for f in toxicity._counted(frozenset({"idiot"}))(iter(frames))) == 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * len(words)

import random

from brute import line_report
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import lines


def check(rows, got):
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(t)
    single = {(-1 if i is None else i): t[0] for i, t in texts.items() if len(set(t)) == 1}
    want = line_report(single)
    for r in got:
        key = -1 if r["doc_id"] is None else r["doc_id"]
        if key in want:
            assert (r["n_lines"], r["n_dropped"], r["kept_sha256"]) == want[key], key
    assert len(got) == len(rows)


def report(docs):
    return [r.asDict() for r in lines.line_report(docs).collect()]


def shared_lines(seed=4, documents=300):
    """Lines of every frequency, one of them in a third of all documents, repeated lines, and ties of white space."""
    rng = random.Random(seed)
    common = [f"{'line number ' * 3}{k} is shared by some documents" for k in range(40)]
    rows = []
    for i in range(documents):
        own = [rng.choice(common[1:]) for _ in range(rng.randrange(6))] + ["short", "", f"{'own ' * 12}{i}"]
        if i % 3 == 0:
            own += [rng.choice(["", " ", "\t"]) + common[0].upper() + "\r"] * 2
        rng.shuffle(own)
        rows.append((i, "\n".join(own), None))
    return rows


def test_odd_documents(make, odd_texts):
    rows = [r for r in odd_texts if r[0] != 31]
    check(rows, report(make(rows)))


def test_shared_lines_over_many_partitions(llm, make):
    rows = shared_lines()
    llm.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = report(make(rows))
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", "4")
    check(rows, got)
    check(rows, report(make(rows)))


def test_rows_with_one_id_are_one_document(make):
    line = "a line that is long enough to count as a repeated one"
    rows = [(1, line, None), (1, f"{line}\nx", None), (2, line, None), (3, line, None), (4, line, None)]
    assert sum(r["n_dropped"] for r in report(make(rows))) == 0  # four documents
    got = report(make(rows + [(5, line, None), (5, line, None)]))
    assert [(r["doc_id"], r["n_dropped"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 0), (5, 0)]


def test_drop_lines_keeps_rows_and_columns(make):
    rows = shared_lines(9, 60) + [(None, None, "s")]
    docs = make(rows)
    kept = lines.drop_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    dropped = {r["doc_id"]: r["n_dropped"] for r in report(docs)}
    text = {i: t for i, t, _ in rows}
    for r in kept.collect():
        assert r["text"] == text[r["doc_id"]] if not dropped[r["doc_id"]] else len(r["text"]) < len(text[r["doc_id"]])
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


def test_empty_table(empty):
    assert lines.line_report(empty).count() == 0 and lines.keep_bitmaps(empty).count() == 0 and lines.drop_lines(empty).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 200), min_size=1))
def test_bitmaps_hold_what_was_dropped(places):
    import pandas as pd

    out = next(lines._pack(iter([pd.DataFrame({"doc": [1], "version": [2], "places": [list(places)]})])))
    assert lines.dropped_lines(out["bitmap"][0]) == places


def test_query(ask, documents):
    rows = [(int(i), t, None) for i, t in zip(documents.doc_id, documents.text)]
    check(rows, ask("op7_line_dedup").to_dict("records"))

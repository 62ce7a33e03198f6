import numpy as np
from brute import sha, shingles

from ledgerloom.llm import fingerprints
from ledgerloom.llm.fingerprints import Sketch, sketches


def check(rows, got):
    """rows: (doc_id, text) in descending order of id, then by text."""
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(None if r["doc_id"] is None or r["doc_id"] != r["doc_id"] else int(r["doc_id"]), []).append(r)
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        tail = len(text) // 3
        edited = text[: len(text) - tail] + after[:tail]
        found = [r for r in by[i] if r["edited_sha256"] == sha(edited) and r["n_chars"] == len(text)]
        assert found, (i, text[:40])
        a, b, c = (shingles(t, 5) for t in (text, edited, after))
        likeness = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert any(abs(r["near_edited"] - likeness(a, b)) < 0.2 and abs(r["near_next"] - likeness(a, c)) < 0.2 for r in found)
        if len(a | b) <= 100:
            assert any(abs(r["near_edited"] - likeness(a, b)) < 1e-9 for r in found)


def order(rows):
    return sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))


def test_odd_documents(make, odd_texts):
    got = [r.asDict() for r in fingerprints.edit_report(make(odd_texts)).collect()]
    check(order(odd_texts), got)
    same = [r["fingerprint"] for r in got if r["n_chars"] == len(odd_texts[13][1])]
    assert len(set(same)) == 1 and len(same) > 1


def test_one_row_and_none(make, empty):
    got = [r.asDict() for r in fingerprints.edit_report(make([(5, "a b c d e f g h i", None)])).collect()]
    check([(5, "a b c d e f g h i")], got)
    assert fingerprints.edit_report(empty).count() == 0 and fingerprints.fingerprint(empty).count() == 0


def test_sketches_merge_and_estimate():
    words = [f"w{i}" for i in range(3000)]
    whole, first, second = sketches([" ".join(words), " ".join(words[:1804]), " ".join(words[1800:])])
    assert np.array_equal(first.merge(second).hashes, whole.hashes)
    assert abs(whole.distinct() - 2996) < 800 and abs(first.resemblance(whole) - 0.6) < 0.15
    assert first.containment(whole) > 0.8 and abs(whole.containment(first) - 0.6) < 0.2
    assert np.array_equal(Sketch.parse(whole.text()).hashes, whole.hashes)
    none = Sketch(np.zeros(0, dtype=np.uint64))
    assert none.resemblance(none) == 1 and none.resemblance(whole) == 0 and none.distinct() == 0 and none.text() == ""


def test_fingerprint_table(make, odd_texts):
    rows = fingerprints.fingerprint(make(odd_texts)).collect()
    counts = {r["doc_id"]: r["distinct_shingles"] for r in rows}
    assert counts[1] == counts[2] == counts[3] == 0 and counts[4] == counts[5] == 1 and counts[6] > 20_000


def test_query(ask, documents):
    rows = order([(int(i), t, None) for i, t in zip(documents.doc_id, documents.text)])
    check(rows, ask("op3_fingerprints").to_dict("records"))

import pytest
from brute import base_spans, sha
from hypothesis import HealthCheck, given, settings, strategies as st

from ledgerloom.llm import pii


def listed(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def check(texts, rows):
    for r in rows:
        want = base_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == sha(listed(want)), (texts[r["doc_id"]], listed(want), r["spans"])
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[3] == k for s in want) for k in pii.BASE]
        assert {s for s in listed(want).split(",") if s} <= set(r["spans"].split(","))


CASES = [
    None, "", "no data", "mail a.b+c@x-y.co.uk, a@b.c_d@e.f and x@y or @z.com", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.02.003.0004 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111 5 4111111111111111", "+49 (30) 123-4567 +1 2 +12345678901234567 ++4930 1234567.", "é日本 a@b.cd 𝒳 10.0.0.1",
    "9" * 30 + " " + "4111111111111111", "a" * 20_000 + "@" + "b" * 20_000, "1-" * 20_000 + "1", "+1" + "()" * 20_000 + "1",
    "IBAN DE89 3704 0044 0532 0130 00 bank, not DE88 3704 0044 0532 0130 00", "ssn 123-45-6789", "123-45-6789", "a@b.c\nd@e.f\r\n1.1.1.1\n.2.2.2.2",
]


def test_cases(make):
    texts = dict(enumerate(CASES))
    rows = pii.span_report(make([(i, t, None) for i, t in texts.items()])).collect()
    assert len(rows) == len(CASES)
    check(texts, rows)
    spans = {r["doc_id"]: r["spans"] for r in rows}
    assert spans[12].count("iban") == 1 and "iban:5:32" in spans[12]
    assert spans[13] == "ssn:4:15" and spans[14] == ""


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a1234567890.-+@ ()_é\n", max_size=60), min_size=20, max_size=40))
def test_random_texts(make, texts):
    check(dict(enumerate(texts)), pii.span_report(make([(i, t, None) for i, t in enumerate(texts)])).collect())


def test_very_many_matches(make):
    """The work grows with the text, not with its square; context comes from the neighbours of a match."""
    import time

    took = {}
    for n in (2_000, 16_000, 160_000):
        text = " ".join(f"a{i}@b.cd" for i in range(n)) + " call +49301234567"
        docs, start = make([(1, text, None)]), time.time()
        row = pii.span_report(docs).collect()[0]
        took[n] = time.time() - start
        assert (row["n_email"], row["n_phone"], row["n_ip"]) == (n, 1, 0)
        assert row["base_sha256"] == sha(listed(base_spans(text)))
    assert took[160_000] < 10 * took[16_000] + 10


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["ssn ", "123-45-6789", " ", "tel", "030 1234 567", "+12345678", "x" * 30, "a@b.c", "\n", "social security", "é"]), max_size=14).map("".join), min_size=20, max_size=30))
def test_context_is_what_stands_around(llm, texts):
    from pyspark.sql import functions as F

    frame = llm.createDataFrame(list(enumerate(texts)), "id long, text string")
    for kind in pii.KINDS:
        items = pii.proposals(F.col("text"), kind)
        seen = frame.select("id", pii.bound(items, lambda x: F.transform(F.sequence(F.lit(0), F.size(x) - 1), lambda i: pii.around(x, i))).alias("c"), pii.bound(items, lambda x: x["match"]).alias("m"))
        ends = frame.select("id", pii.running(F.transform(items, lambda x: x["gap"] + x["size"])).alias("e"))
        for (i, contexts, matches), (_, e) in zip(seen.orderBy("id").collect(), ends.orderBy("id").collect()):
            for context, match, end in zip(contexts, matches, e):
                if match is not None:
                    start = end - len(match)
                    assert texts[i][start:end] == match
                    assert context == texts[i][max(start - pii.NEAR, 0) : start] + " " + texts[i][end : end + pii.NEAR]


def test_checksums(llm):
    from pyspark.sql import functions as F

    row = llm.range(1)
    assert row.select(pii.luhn(F.lit("79927398713"))).first()[0] and not row.select(pii.luhn(F.lit("79927398710"))).first()[0]
    assert row.select(pii.mod97(F.lit("GB82WEST12345698765432"))).first()[0] and not row.select(pii.mod97(F.lit("GB82WEST12345698765433"))).first()[0]


def test_repeated_rows_and_empty_table(make, empty, odd_texts):
    assert pii.span_report(make(odd_texts)).count() == len(odd_texts)
    assert pii.span_report(empty).count() == 0


def test_mask(make):
    masked = pii.mask(make([(1, "é write to a@b.cd or 10.0.0.1!", None), (2, None, None)]))
    assert [r["text"] for r in masked.orderBy("doc_id").collect()] == ["é write to [EMAIL] or [IP]!", None]


def test_no_python_in_the_plan(make, capsys):
    pii.span_report(make([(1, "x", None)])).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Exchange" not in plan


@pytest.mark.parametrize("name", ["op2_pii"])
def test_query(ask, documents, name):
    check(dict(zip(documents.doc_id, documents.text)), ask(name).to_dict("records"))

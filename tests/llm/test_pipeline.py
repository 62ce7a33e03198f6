import pytest
from brute import DATA, WORD

import corpus_pipeline
from ledgerloom.session import materialise


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "mixing", "packing"]


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_run_by_stages(llm):
    docs = llm.read.parquet(f"{DATA}/documents.parquet")
    columns, sizes = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(llm, docs, str(DATA)), name)
        sizes[name] = docs.count()
        if name != "packing":
            assert docs.columns == columns and docs.schema.simpleString() == before.schema.simpleString()
        if name in ("toxicity", "jaccard_join"):
            assert docs.exceptAll(before).count() == 0  # rows go, none changes
        if name == "line_dedup":
            assert docs.count() == before.count()
        if name == "mixing":
            words = lambda df: sum(len(WORD.findall(r[0] or "")) for r in df.select("text").collect())
            assert abs(words(docs) - words(before)) <= 20
    assert sizes["packing"] >= sizes["mixing"]


def test_stages_take_odd_tables(llm, make, empty, odd_texts):
    for table in (empty, make(odd_texts)):
        docs = table.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(llm, docs, str(DATA)), name)
        assert (docs.count() == 0) == (table.count() == 0)


def test_run_is_the_registered_query(llm):
    import __spark_entry__ as contract

    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(llm, str(DATA)).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

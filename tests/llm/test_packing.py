import random
from collections import Counter

import numpy as np
import pytest
from brute import crc
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import packing
from ledgerloom.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def check(texts, rows, tokenizer, sequence=2048):
    """Every document's ids in exactly one chain of pieces, sequences without gaps and overlaps."""
    want = Counter()
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[(doc, len(ids))] += 1
    by, sequences = {}, {}
    for r in rows:
        doc = None if r["doc_id"] is None or r["doc_id"] != r["doc_id"] else int(r["doc_id"])
        by.setdefault((doc, r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert by.keys() == want.keys()
    chosen = {}
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        chosen.setdefault((doc, len(ids)), []).append(ids)
    for key, pieces in by.items():
        covered = Counter(p for r in pieces for p in range(r["start"], r["start"] + r["length"]))
        assert covered == Counter({p: want[key] for p in range(key[1])})
        for r in pieces:
            assert r["ids_crc32"] in {crc(ids[r["start"] : r["start"] + r["length"]]) for ids in chosen[key]}
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= sequence
    return sequences


def test_odd_documents(make, odd_texts, tokenizer):
    rows = [r.asDict() for r in packing.pack(make(odd_texts), TOKENIZER).collect()]
    check([(i, t) for i, t, _ in odd_texts], rows, tokenizer)


def test_little_padding_and_even_cost(make, tokenizer):
    rng = random.Random(8)
    texts = [(i, " ".join(rng.choice(["the", "Größe", "xqzt7", "don't", "日本"]) for _ in range(int(rng.lognormvariate(5, 1.2)) + 1))) for i in range(400)]
    rows = [r.asDict() for r in packing.pack(make([(i, t, None) for i, t in texts]), TOKENIZER, documents_per_group=100).collect()]
    sequences = check(texts, rows, tokenizer)
    assert sum(r["length"] for r in rows) / (2048 * len(sequences)) > 0.95
    again = [r.asDict() for r in packing.pack(make([(i, t, None) for i, t in texts]), TOKENIZER, documents_per_group=100).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_empty_table(empty):
    assert packing.pack(empty, TOKENIZER).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_place_fills_sequences(lengths):
    lengths = sorted(lengths, reverse=True)
    placed = packing.place(lengths, 64)
    used = Counter()
    for piece, start, length, s, offset in placed:
        assert offset == used[s] and used[s] + length <= 64
        used[s] += length
    assert len(used) <= -(-sum(lengths) // 64)
    for piece, n in enumerate(lengths):
        parts = sorted((start, length) for p, start, length, *_ in placed if p == piece)
        assert sum(length for _, length in parts) == n and [a for a, _ in parts] == np.cumsum([0] + [b for _, b in parts])[:-1].tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aBé ü.,'!\n\t7́ 日𝒳ΣςİSs<|endoftext|>"), max_size=6))
def test_chunks_have_the_ids_of_the_whole(texts):
    from tokenizers import Tokenizer

    encoder, whole = packing.ChunkEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, dtype="<u2").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_every_letter_before_and_after_marks(tokenizer):
    """Letters that normalisation takes apart or puts together among them."""
    letters = [chr(c) for c in range(0x21, 0x3000)] + [chr(c) for c in range(0xF900, 0xFB50)]
    encoder = packing.ChunkEncoder(TOKENIZER)
    for form in ("{}", "{},", "a{}.", "{}b!", "{}'s", "({})", "{}{},", "9{},", "\u0917\u0922\u093c{}:", "{}\u0301;"):
        texts = [form.replace("{}", c) for c in letters]
        for text, ids, one in zip(texts, encoder.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False)):
            assert np.frombuffer(ids, dtype="<u2").tolist() == one.ids, ascii(text)


def test_random_texts_of_many_scripts(tokenizer):
    rng = random.Random(1)
    pool = [chr(c) for lo, hi in ((0x20, 0x180), (0x300, 0x340), (0x370, 0x400), (0x900, 0xC00), (0xE00, 0x1000), (0x1E00, 0x2060)) for c in range(lo, hi)] + list(" ,.!()" * 60)
    texts = ["".join(rng.choices(pool, k=rng.randrange(1, 12))) for _ in range(60_000)]
    encoder = packing.ChunkEncoder(TOKENIZER)
    for text, ids, one in zip(texts, encoder.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, dtype="<u2").tolist() == one.ids, ascii(text)


def test_other_tokenizers_are_refused():
    from ledgerloom.llm.queries import BYTE_LEVEL

    with pytest.raises(ValueError):
        packing.ChunkEncoder(BYTE_LEVEL)


def test_query(ask, documents, tokenizer):
    texts = [(int(i), t) for i, t in zip(documents.doc_id, documents.text)]
    sequences = check(texts, ask("op8_packing").to_dict("records"), tokenizer)
    assert sum(r["length"] for s in sequences.values() for r in s) / (2048 * len(sequences)) > 0.98


def test_the_cache_of_a_worker_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_CHUNKS", 100)
    encoder, held = packing.ChunkEncoder(TOKENIZER), 0
    for k in range(40):
        texts = [f"the The, Größe... w{k}x{i} " + "".join(chr(97 + (k * 50 + i) // 26**j % 26) for j in range(4)) + "!" for i in range(50)]
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        held = max(held, sum(len(v) for v in vars(encoder).values() if isinstance(v, dict)))
    assert held <= 2 * (100 + 50 * 4)  # a full cache and the one before, each with one batch more

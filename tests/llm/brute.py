"""Plain versions of the operators' contracts, over small inputs."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np

DATA = Path("/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def component_of(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def targets(sizes: dict) -> dict:
    """Targets of sources by the rule of three times the size, reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight, total, full = {s: i % 3 + 1 for i, s in enumerate(order)}, sum(sizes.values()), set()
    while True:
        rest, open_weight = total - sum(3 * sizes[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def luhn(number: str) -> bool:
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(number))) % 10 == 0


def base_spans(text: str) -> list[tuple]:
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m[0])]
    return sorted(found)


def shingles(text: str | None, words: int) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def jaccard_components(texts: dict, percent: int = 90, words: int = 3) -> dict:
    sets, links, ids = {i: shingles(t, words) for i, t in texts.items()}, [], sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                links.append((i, j))
    found = component_of(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def line_report(texts: dict) -> dict:
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for i, text in texts.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = {}
    for i, text in texts.items():
        lines = (text or "").split("\n")
        gone = lambda line: len(holders[key(line)]) >= 5 and max(holders[key(line)]) != i
        kept = [x for x in lines if not gone(x)]
        out[i] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def repeat_report(texts: list[bytes], length: int = 200) -> list[tuple]:
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]) if len(t) else 0
        out.append((len(t), int(gone.sum()), runs, sha(bytes(np.frombuffer(t, dtype=np.uint8)[~gone]))))
    return out


def article(page: str) -> str:
    """Text of pages whose article holds nothing but h1, p, b and br."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def cosine_links(vectors: dict, least: float = 0.9) -> tuple[dict, dict]:
    fine = {i: np.array(v, dtype=float) for i, v in vectors.items() if v is not None and None not in v}
    fine = {i: v / np.linalg.norm(v) for i, v in fine.items() if np.isfinite(v).all() and v.any()}
    links = [(i, j) for i in fine for j in fine if i < j and len(fine[i]) == len(fine[j]) and fine[i] @ fine[j] >= least]
    degree = Counter(x for pair in links for x in pair)
    return {i: degree[i] for i in vectors}, component_of(vectors, links)


def auc(scores, labels) -> float:
    scores, labels = np.asarray(scores), np.asarray(labels)
    better = [(s > scores[labels == 0]).mean() + (s == scores[labels == 0]).mean() / 2 for s in scores[labels == 1]]
    return float(np.mean(better)) if better else math.nan


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


LATIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(texts: list, items: list[tuple], length: int = 10) -> list[tuple]:
    """(n_words, n_hit, item ids) of each text; ``items``: (id, text)."""
    words_of = lambda t: LATIN_WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - length + 1) if w else 0):
            windows[tuple(w[i : i + length])].add("" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, own = words_of(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    own |= windows[tuple(w[i : i + size])]
        out.append((len(w), len(hit), sorted(own)))
    return out


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fim(doc_id, text) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    text = text or ""
    units, digest = UNIT.findall(text), sha(f"42:{'' if doc_id is None else doc_id}")
    n, h = len(units), [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), output


def aligned(texts: list, path_a: str, path_b: str) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text, whole texts encoded at once."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
    rows, count, best = [], Counter(), defaultdict(int)
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a, bytes_b = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a], [piece(i) for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            rows.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        at_b, groups, links, i0, j0 = {e: j for j, e in enumerate(ends_b)}, [], [], 0, 0
        for i, e in enumerate(ends_a):
            if e in at_b:
                j = at_b[e]
                groups.append((ids_a[i0 : i + 1], ids_b[j0 : j + 1]))
                links.append((ids_a[i], ids_b[j]))
                i0, j0 = i + 1, j + 1
        count.update(links)
        rows.append((len(ids_a), len(ids_b), groups, links))
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    listed = lambda ids: ",".join(map(str, ids))
    return [
        (0, 0, 0, 0, 0, 0, None) if r is None
        else (r[0], r[1], len(r[2]), len(r[3]), sum(count[p] == best[p[1]] for p in r[3]), sum(count[p] for p in r[3]), ";".join(f"{listed(x)}|{listed(y)}" for x, y in r[2]))
        for r in rows
    ]

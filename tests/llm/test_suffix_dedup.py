import random

import numpy as np
import pytest

from quarry.llm import suffix_dedup
from tests.llm.helpers import clashing, docs, edge_rows


def brute(rows):
    """Every window in order of origin, byte by byte."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - suffix_dedup.LENGTH + 1):
            w = raw[p:p + suffix_dedup.LENGTH]
            if w in seen:
                gone[p:p + suffix_dedup.LENGTH] = [True] * suffix_dedup.LENGTH
            seen.add(w)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def test_suffix_array_and_prefixes():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 40))).encode() for _ in range(60)] + [b"aaaa" * 10] * 3
    lens = np.array([len(t) for t in texts])
    symbols, ends = np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.cumsum(lens), lens)
    whole = symbols.tobytes()
    order = suffix_dedup.suffix_array(symbols, ends, int(lens.max()))
    suffixes = [whole[i:ends[i]] for i in range(len(whole))]
    assert order.tolist() == sorted(range(len(whole)), key=lambda i: (suffixes[i], i))
    got = suffix_dedup.common_prefixes(symbols, ends, order, 30)
    for k in range(1, len(order)):
        a, b = suffixes[order[k - 1]], suffixes[order[k]]
        n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert got[k] == min(n, 30)


@pytest.mark.parametrize("shard_bytes, most_bits", [(2 << 20, 28), (700, 7)])  # shards that hand on windows, bitmaps that let all through
def test_equal_to_all_windows(spark, shard_bytes, most_bits, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_bits", lambda entries, most: min(16, most))
    rnd = random.Random(9)
    alphabet = "abcdefgh é\n"
    text = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    passages = [text(n) for n in (99, 100, 101, 140, 400)]
    rows = []
    for i in range(60):
        parts = [text(rnd.randrange(150)) if rnd.random() < 0.6 else rnd.choice(passages) for _ in range(4)]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 400), (101, "x" * 350), (102, "x" * 350), (103, rows[3][1]), (104, None), (105, ""), (106, "\u0000" * 230), (50_000, rows[7][1][50:])]
    rows += [(200 + i, f"{i}head" + passages[4] + f"tail{i}") for i in range(40)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup.dedup(docs(spark, rows), shard_bytes=shard_bytes, most_bits=most_bits).collect()}
    assert got == brute(rows)


def test_edges(spark):
    got = suffix_dedup.dedup(clashing(docs(spark, edge_rows()))).collect()
    assert len(got) == len(edge_rows())
    by_id = {r.doc_id: r for r in got}
    assert by_id[10].n_removed == by_id[10].n_bytes > 0 and bytes(by_id[10].kept) == b""
    assert by_id[2].n_bytes == by_id[3].n_bytes == 0
    assert bytes(by_id[6].kept).decode() == "Plain text of a few words here."
    assert suffix_dedup.dedup(docs(spark, [(1, "a")]).limit(0)).collect() == []


def test_rows_of_one_id_are_one_document(spark):
    long = " ".join(f"{i * i}" for i in range(90))
    got = suffix_dedup.dedup(docs(spark, [(1, long + "abc"), (1, long + "abc"), (2, long)])).collect()
    assert sorted((r.doc_id, r.n_removed == 0) for r in got) == [(1, True), (1, True), (2, False)]


def test_cells_do_not_depend_on_the_texts_beside(monkeypatch):
    """Texts hashed together have the cells that each has alone, those too short for a window have none."""
    rnd = random.Random(3)
    raws = [bytes(rnd.choices(b"abc ", k=n)) for n in (0, 99, 100, 101, 5000, 0, 700, 99)] + [b"a" * 400, b"ab" * 200]
    together = suffix_dedup.cells_of(raws)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1)
    alone = suffix_dedup.cells_of(raws)
    assert all((a == b).all() for a, b in zip(together, alone)) and set(alone[0].tolist()) == {2, 3, 4, 6, 8, 9}
    assert [len(c) for c in suffix_dedup.cells_of([])] == [0] * 4
    for i, raw in enumerate(raws):  # every window is in one cell
        first, last = alone[2][alone[0] == i], alone[3][alone[0] == i]
        assert [p for a, b in zip(first, last) for p in range(a, b + 1)] == list(range(len(raw) - 99))

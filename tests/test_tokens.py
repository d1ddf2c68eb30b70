"""Byte tokens and BPE: goldens, properties, and a trainer over plain strings."""

import random
import re

from pyspark.sql import functions as F

from quarry.operators import tokens
from tests.conftest import docs_df

HELLO = "hello hello world"


def brute_train(texts, n_merges):
    """Each text as a string with one character per token: the most frequent
    two-character substring (overlapping; ties to the first one met) becomes
    one new character, by ``str.replace``."""
    strings = ["".join(map(chr, t.encode("utf-8"))) for t in texts]
    merges = []
    for new in range(256, 256 + n_merges):
        pairs = [p for s in strings for p in re.findall("(?s)(?=(..))", s)]
        if not pairs:
            break
        best = max(dict.fromkeys(pairs), key=pairs.count)
        merges.append(((ord(best[0]), ord(best[1])), new))
        strings = [s.replace(best, chr(new)) for s in strings]
    return merges, [list(map(ord, s)) for s in strings]


def test_byte_tokens_golden(spark):
    df = docs_df(spark, [HELLO])
    got = df.select(tokens.byte_tokens(F.col("text")).alias("t")).first()["t"]
    assert got == [104, 101, 108, 108, 111, 32, 104, 101, 108, 108, 111, 32, 119, 111, 114, 108, 100]


def test_bpe_train_golden(spark):
    df = docs_df(spark, [HELLO])
    merges = tokens.bpe_train(df, 3)
    assert [(m.left, m.right, m.new_id) for m in merges] == [(104, 101, 256), (256, 108, 257),
                                                            (257, 108, 258)]
    enc = df.select(tokens.bpe_encode(F.col("text"), merges).alias("e")).first()["e"]
    assert enc == [258, 111, 32, 258, 111, 32, 119, 111, 114, 108, 100]


def test_overlapping_pairs_merge_pairwise(spark):
    df = docs_df(spark, ["aaaa", "aaa"])
    counts = {(r.left_id, r.right_id): r.n for r in tokens.pair_counts(tokens.byte_chunks(df)).collect()}
    assert counts == {(97, 97): 5}
    merges = tokens.bpe_train(df, 1)
    enc = [r.e for r in df.orderBy("doc_id").select(
        tokens.bpe_encode(F.col("text"), merges).alias("e")).collect()]
    assert enc == [[256, 256], [256, 97]]


def test_bpe_matches_brute_force(spark):
    texts = ["the cat sat on the mat", "the the the", "", "zebra", "héllo wörld ünïcode",
             "abababab abab", "to be or not to be", "한국어 텍스트 🙂"]
    df = docs_df(spark, texts)
    merges = tokens.bpe_train(df, 12)
    want_merges, want_seqs = brute_train(texts, 12)
    assert [((m.left, m.right), m.new_id) for m in merges] == want_merges
    got = [r.e for r in df.orderBy("doc_id").select(
        tokens.bpe_encode(F.col("text"), merges).alias("e")).collect()]
    assert got == want_seqs


def test_decode_round_trip(spark):
    texts = ["hello hello world", "한국어 텍스트 🙂 emoji", "", "tab\tnew\nline", "aaaa"]
    df = docs_df(spark, texts)
    merges = tokens.bpe_train(df, 8)
    out = df.select("doc_id", "text", tokens.bpe_decode(
        tokens.bpe_encode(F.col("text"), merges), merges).alias("back")).collect()
    for r in out:
        assert r.back == (r.text or "")


def test_decode_truncated_utf8_does_not_raise(spark):
    df = spark.createDataFrame([([237, 149],)], "ids array<int>")
    back = df.select(tokens.bpe_decode(F.col("ids"), []).alias("t")).first()["t"]
    assert back == "�"


def test_special_tokens_are_atomic(spark):
    df = docs_df(spark, ["<|im_start|>user\nhi<|im_end|>\n"])
    specials = {"<|im_start|>": 300, "<|im_end|>": 301}
    ids = df.select(tokens.bpe_encode(F.col("text"), [], specials).alias("e")).first()["e"]
    assert ids[0] == 300 and ids.count(301) == 1
    back = df.select(tokens.bpe_decode(tokens.bpe_encode(F.col("text"), [], specials), [],
                                       specials).alias("t")).first()["t"]
    assert back == "<|im_start|>user\nhi<|im_end|>\n"


def test_truncate_pad_and_labels(spark):
    df = spark.createDataFrame([([1, 2, 3],), (list(range(10)),)], "ids array<int>")
    ids, mask = tokens.truncate_pad(F.col("ids"), 5, 99)
    rows = df.select(ids.alias("i"), mask.alias("m"),
                     tokens.lm_labels(ids, 99).alias("l")).collect()
    assert rows[0].i == [1, 2, 3, 99, 99] and rows[0].m == [1, 1, 1, 0, 0]
    assert rows[0].l == [1, 2, 3, -100, -100]
    assert rows[1].i == [0, 1, 2, 3, 4] and rows[1].m == [1] * 5


def test_word_chunking_keeps_pairs_inside_words(spark):
    df = docs_df(spark, ["ab ab", "ab"])
    merges = tokens.bpe_train(df, 2, chunking="word")
    assert (merges[0].left, merges[0].right) == (97, 98)
    # the space starts the second chunk: (32, 256) is the next pair
    assert (merges[1].left, merges[1].right) == (32, 256)


def test_five_thousand_merges(spark):
    """A table of the size of real vocabularies, against one replace per merge."""
    rnd = random.Random(11)
    merges, size = [], 256
    seen = set()
    while len(merges) < 5000:
        pair = (rnd.choice([rnd.randrange(97, 105), rnd.randrange(97, size) if size > 256 else 97]), rnd.randrange(97, 105))
        if pair in seen or 105 <= pair[0] < 256:
            continue
        seen.add(pair)
        merges.append(tokens.Merge(len(merges), *pair, size))
        size += 1
    texts = ["".join(rnd.choice("abcdefgh \u00e9") for _ in range(rnd.randrange(300))) for _ in range(40)] + ["", "a", "aaaaaaa", None]
    df = docs_df(spark, texts)
    rows = df.select("text", tokens.bpe_encode(F.col("text"), merges).alias("e")).withColumn(
        "back", tokens.bpe_decode(F.col("e"), merges)).collect()
    for r in rows:
        want = "".join(map(chr, (r.text or "").encode()))
        for m in merges:
            want = want.replace(chr(m.left) + chr(m.right), chr(m.new_id))
        assert r.e == list(map(ord, want)) and r.back == (r.text or "")


def test_non_ascii_specials(spark):
    df = docs_df(spark, ["\uff5cstart\uff5cna\u00efve\uff5cstart\uff5c", "plain"])
    specials = {"\uff5cstart\uff5c": 300}
    ids = tokens.bpe_encode(F.col("text"), [], specials)
    rows = df.select("text", ids.alias("e"), tokens.bpe_decode(ids, [], specials).alias("back")).collect()
    assert rows[0].e[0] == rows[0].e[-1] == 300 and rows[0].e.count(300) == 2
    assert all(r.back == r.text for r in rows)


def test_string_ids(spark):
    texts = ["ab ab cd", "cd cd", "", "xyz ab"]
    df = spark.createDataFrame([(f"<urn:uuid:{i}>", t) for i, t in enumerate(texts)], "doc_id string, text string")
    for chunking in ("document", "word"):
        got = [(m.left, m.right) for m in tokens.bpe_train(df, 3, chunking=chunking)]
        assert got == [(m.left, m.right) for m in tokens.bpe_train(docs_df(spark, texts), 3, chunking=chunking)]


def test_truncate_only(spark):
    df = docs_df(spark, ["h\u00e9llo", None, "abc"])
    rows = df.orderBy("doc_id").select(tokens.truncate(tokens.byte_tokens(F.col("text")), 2).alias("a"), tokens.first_byte_tokens(F.col("text"), 2).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] == [[104, 195], [], [97, 98]]


def test_a_task_passes_each_pair_on_once():
    import numpy as np
    import pyarrow as pa
    sym = pa.array(["ab ac " * 200_000, "cab " * 300_000, "", "b"])
    batch = pa.RecordBatch.from_arrays([pa.array([7, 3, 1, 2]), pa.array(np.zeros(4, np.int64)), pa.array([1, 1, 1, 5]), sym], ["doc_id", "chunk_pos", "weight", "sym"])
    got = [r for b in tokens._pair_count_kernel()([batch, batch]) for r in b.to_pylist()]
    assert len({(r["left_id"], r["right_id"]) for r in got}) == len(got)
    ab = next(r for r in got if (r["left_id"], r["right_id"]) == (97, 98))
    assert (ab["n"], ab["doc_id"], ab["pos"]) == (1_000_000, 3, 1)


def test_a_task_passes_each_word_on_once(spark):
    texts = [" the cat  sat", "the the", None, " ", "cat the"]
    df = docs_df(spark, texts).coalesce(1)
    rows = tokens.training_chunks(df, chunking="word")
    got = {r.sym: (r.doc_id, r.chunk_pos, r.weight) for r in rows.collect()}
    assert got == {" the": (0, 0, 3), " cat": (0, 1, 1), " ": (0, 2, 2), " sat": (0, 3, 1), "the": (1, 0, 1), "": (2, 0, 1), "cat": (4, 0, 1)}
    assert "MapInArrow" in rows._jdf.queryExecution().toString()


def test_words_of_rows_with_one_id(spark):
    df = spark.createDataFrame([(1, "a b c x"), (1, "q x c"), (None, "z x")], "doc_id long, text string").coalesce(1)
    got = {r.sym: (r.doc_id, r.chunk_pos, r.weight) for r in tokens.training_chunks(df, chunking="word").collect()}
    assert got[" c"] == (1, 2, 2) and got[" x"] == (None, 1, 3) and got[" b"] == (1, 1, 1)


def test_many_symbols_count_as_few_do(spark, monkeypatch):
    df = docs_df(spark, ["the cat sat", "aaaa", "", "héllo", None])
    few = sorted(map(str, tokens.pair_counts(tokens.byte_chunks(df)).collect()))
    monkeypatch.setattr(tokens, "DENSE_PAIRS", 0)
    assert sorted(map(str, tokens.pair_counts(tokens.byte_chunks(df)).collect())) == few


def test_encoding_passes_ids_on_before_the_next_slice():
    import types

    import numpy as np
    import pyarrow as pa
    shared = types.SimpleNamespace(value=(np.array([97]), np.array([98]), np.array([256])))
    out = list(tokens._encode_kernel(shared, [])(pa.array(["ab" * 300_000] * 5)))
    assert len(out) > 1 and sum(map(len, out)) == 5 and all(len(o[0]) == 300_000 for o in out)


def test_decode_unknown_and_missing_ids(spark):
    df = spark.createDataFrame([(0, [256, 9999, None, 97]), (1, None), (2, []), (3, [255, 98])], "doc_id long, ids array<int>").coalesce(1)
    back = [r.t for r in df.orderBy("doc_id").select(tokens.bpe_decode(F.col("ids"), [tokens.Merge(0, 104, 101, 256)]).alias("t")).collect()]
    assert back == ["he��a", "", "", "�b"]

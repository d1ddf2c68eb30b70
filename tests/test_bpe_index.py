"""Indexed training against the trainer that counts everything again."""

import random

import pytest

from quarry.operators.bpe_index import bpe_train_indexed
from quarry.operators.tokens import Merge, bpe_train
from tests.conftest import docs_df


def plain(texts, n_merges):
    """Merges over the words of all texts, every pair counted again for every merge."""
    words = [[list(w.encode()) for w in [t.split(" ")[0], *(" " + x for x in t.split(" ")[1:])]] for t in (x or "" for x in texts)]
    merges = []
    for r in range(n_merges):
        counts, first = {}, {}
        for d, doc in enumerate(words):
            for k, w in enumerate(doc):
                for i, p in enumerate(zip(w, w[1:])):
                    counts[p] = counts.get(p, 0) + 1
                    first.setdefault(p, (d, k, i))
        if not counts:
            break
        pair = min(counts, key=lambda p: (-counts[p], first[p]))
        merges.append(Merge(r, *pair, 256 + r))
        for doc in words:
            for w in doc:
                i = 0
                while i < len(w) - 1:
                    if (w[i], w[i + 1]) == pair:
                        w[i:i + 2] = [256 + r]
                    i += 1
    return merges


def some_texts(seed, n=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aaabcdé") for _ in range(rng.randrange(1, 9))) for _ in range(30)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(n)] + [None, "", " ", "aaaa aaa"]


@pytest.mark.parametrize("top, every", [(4096, 24), (3, 5), (1, 2)])
def test_equals_counting_again(spark, top, every):
    texts = some_texts(top)
    merges, rounds = bpe_train_indexed(docs_df(spark, texts).repartition(3), 14, rounds_per_index=every, top=top)
    assert merges == plain(texts, 14)
    assert all(a.n >= b.n for a, b in zip(rounds, rounds[1:]))


def test_equals_the_other_trainer_and_reads_holders_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    merges, rounds = bpe_train_indexed(docs, 12, rounds_per_index=8)
    assert merges == bpe_train(docs, 12, chunking="word")
    assert all(0 < r.chunks <= r.n for r in rounds)


def test_ends_when_no_pair_is_left(spark):
    merges, _ = bpe_train_indexed(docs_df(spark, ["ab ab", "ab"]), 50)
    assert merges == plain(["ab ab", "ab"], 50) and len(merges) == 2
    assert bpe_train_indexed(docs_df(spark, ["a", "", None]), 5)[0] == []
    assert bpe_train_indexed(docs_df(spark, ["a"]).limit(0), 5)[0] == []

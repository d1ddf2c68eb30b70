import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from quarry.llm import sentencepiece_bpe
from tests.llm.helpers import clashing, docs, edge_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_bpe.Codec(sentencepiece_bpe.read_model(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_text_equal_the_library(codec, library):
    rnd = random.Random(5)
    texts = ["", " ", "  ", "a", "\n", "▁▁a ▁", " x  y ", "Hello  world\n\nagain", "\x00<s></s><unk>", "日本語のテキスト", "fi ﬁ ½ Å", "a" * 3000, " " * 1500, "ab " * 700]
    texts += ["".join(rnd.choice("aeithn o\n\t▁é漢=-_") for _ in range(rnd.randrange(80))) for _ in range(800)]
    ids, offsets = codec.encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == library.encode(texts, add_bos=True, add_eos=True)
    assert [codec.decode(g) for g in got] == texts_without_marks(library, got)


def texts_without_marks(library, ids):
    return [library.decode(i) for i in ids]


def test_decode_of_any_ids(codec, library):
    rnd = random.Random(6)
    for _ in range(2000):
        ids = [rnd.randrange(1, 400) for _ in range(rnd.randrange(9))]
        assert codec.decode(ids) == library.decode(ids)


def test_forgetting_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "CACHE_UNITS", 3)
    for t in ("one two three four five", "six seven eight one two", "one"):
        assert codec.encode([t])[0].tolist() == library.encode(t, add_bos=True, add_eos=True)


def test_memory_of_texts_without_spaces(codec, library):
    """A long line without spaces is one unit; what is remembered is bounded in bytes, not in units."""
    import resource

    rnd = random.Random(9)
    lines = lambda: "\n".join("".join(rnd.choices("aeithnorsäé", k=10_000)) for _ in range(100))
    codec.encode([lines()])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for _ in range(20):
        text = lines()
        ids, _ = codec.encode([text])
    assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 150


def test_edges(spark, library):
    df = clashing(docs(spark, edge_rows()))
    got = sentencepiece_bpe.encode_decode(df, PATH, ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == len(edge_rows())
    want = {(i, t or "") for i, t in edge_rows()}
    for r in got:
        assert (r.doc_id, r.decoded) in want
        assert r.ids == library.encode(r.decoded, add_bos=True, add_eos=True)
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in r.ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert sentencepiece_bpe.encode_decode(docs(spark, [(1, "a")]).limit(0), PATH).collect() == []

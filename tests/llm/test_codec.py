import hashlib
import random

import pytest

from strataline.llm import sentencepiece_codec as codec

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def pair():
    path = codec.default_model_path()
    return codec.Codec(codec.load_model(path)), sentencepiece.SentencePieceProcessor(model_file=path)


EDGES = ["", " ", "  a", "a  ", "a▁b", "▁", "\n", "\n\n x </s> <s>", "é🙂\U0001f9ff\x00", "x²." * 3, "²;", "a" * 300, " " * 70, "the\tof", "ﬁ Å é", "<0x41>", "�"]


@pytest.mark.parametrize("text", EDGES)
def test_edges(pair, text):
    own, library = pair
    ids = own.encode(text)
    assert ids == library.encode(text)
    assert own.decode([*ids, own.end]) == library.decode([*ids, own.end])


def test_random_texts(pair):
    own, library = pair
    draw = random.Random(1)
    bits = [*" \n\t▁aé🙂tehion.,!?;#0²</>…ｔ梦́", "the ", "  ", "▁▁", "tion", "    ", "ing", "\n", "ness", "....", "://"]
    for _ in range(3000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(0, 40)))
        ids = own.encode(text)
        assert ids == library.encode(text), repr(text)
        assert own.decode(ids) == library.decode(ids), repr(text)


def test_decoding_of_any_ids(pair):
    own, library = pair
    draw = random.Random(2)
    for _ in range(2000):
        ids = [draw.randrange(32000) if draw.random() < 0.5 else draw.randrange(262) for _ in range(draw.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_long_text_without_a_cut(pair):
    own, library = pair
    text = "".join(random.Random(3).choice("abcdefgh") for _ in range(50_000))
    assert own.encode(text) == library.encode(text)


def test_operator(spark, pair):
    own, library = pair
    rows = [(1, "the end", "x"), (1, "the end", "x"), (2, None, "y"), (None, "", None), (4, "a" * 40_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    path = codec.default_model_path()
    got = codec.encode_digests(docs, path).collect()
    assert len(got) == 5
    for r, (doc_id, text, _) in zip(sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id, r.n_tokens)), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = library.encode(text or "", add_eos=True)
        assert (r.doc_id, r.n_tokens) == (doc_id, len(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    both = codec.decode(codec.encode(docs, path), path)
    assert {(r.text or "", r.decoded) for r in both.collect()} == {(t or "", t or "") for _, t, _ in rows}
    assert codec.encode_digests(docs.limit(0), path).count() == 0


def test_operator_keeps_ids(spark):
    big = (1 << 53) + 1
    docs = spark.createDataFrame([(big, "a", [1]), (None, "b", None)], "doc_id long, text string, more array<long>").coalesce(1)
    path = codec.default_model_path()
    assert {r.doc_id for r in codec.encode_digests(docs, path).collect()} == {big, None}
    assert {(r.doc_id, tuple(r.more or ())) for r in codec.encode(docs, path).collect()} == {(big, (1,)), (None, ())}

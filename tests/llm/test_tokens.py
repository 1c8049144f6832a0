"""Token counts, id files and pieces against the libraries and by brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from delaykit.llm import pieces, token_counts, token_files
from delaykit.llm.shared import fresh_path
from helpers import AWKWARD, LONG, SF, documents

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = " \n\t\x0b\x1c\x85\xa0 ab'sREé漢ñ1²½_-!<|>🙂́\x00ΣΚς"


def noise(n, seed=1, longest=40):
    r = random.Random(seed)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(0, longest))) for _ in range(n)]


def test_counts_are_the_librarys():
    counter = token_counts.MergeCounter(open(BYTES, encoding="utf-8").read())
    library = tokenizers.Tokenizer.from_file(BYTES)
    texts = [*noise(3000), "a<|endoftext|> b <|endoftext|>", "<|endoftext|>", LONG, "x" * 3000, "a   b", "a \n b\n\n c "]
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [counter.text(t) for t in texts] == expected


def test_count_tokens_rows(spark):
    df = documents(spark, AWKWARD)
    rows = token_counts.count_tokens(df, BYTES).collect()
    library = tokenizers.Tokenizer.from_file(BYTES)
    expected = []
    for doc_id, text, _ in AWKWARD:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 512))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert token_counts.count_tokens(df.limit(0), BYTES).collect() == []


def chunked(texts):
    return token_files.ChunkIds(tokenizers.Tokenizer.from_file(WORDS), size=50).encode(texts)


def test_chunks_give_the_ids_of_the_whole_text():
    library = tokenizers.Tokenizer.from_file(WORDS)
    texts = [*noise(2000, 2), "A<|endoftext|> b", "don't  STOP\r\nit's", LONG]
    for text, ids in zip(texts, chunked(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_new_chunks_share_a_text_and_keep_their_ids():
    tokenizer = tokenizers.Tokenizer.from_file(WORDS)
    draw, asked = random.Random(4), []
    signs = list("abcÀéßİΣσς\u0327\u0301ﬁ½²Ⅷ漢字\u0915\u094d👍🏽\u200d \t\r\x0b\u0085\u00a0\u3000.,;:!?'<|>$*_-09AB\u1100\u1161")
    signs += ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "  ", "\n", "x" * 70]
    texts = ["".join(draw.choices(signs, k=draw.randrange(0, 60))) for _ in range(2000)] + ["", " ", "\n"]

    class Counted:
        def __getattr__(self, name):
            return getattr(tokenizer, name)

        def encode_batch(self, batch, **kinds):
            asked.extend(batch)
            return tokenizer.encode_batch(batch, **kinds)

        def encode_batch_fast(self, batch, **kinds):
            asked.extend(batch)
            return tokenizer.encode_batch_fast(batch, **kinds)

    chunks = token_files.ChunkIds(Counted(), size=1000)
    wanted = [np.array(e.ids, dtype="<u2").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    found = [own for at in range(0, len(texts), 256) for own in chunks.encode(texts[at : at + 256])]
    assert found == wanted
    assert len(asked) < len({c for t in texts for c in t.replace("\n", " ").split(" ")}) / 8


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 5000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.zeros(n, dtype=token_files.KEY)
    keys["doc_id"] = np.arange(n) * 7 - 3
    keys["repeat"][: n // 2] = 1
    if n:
        salt, buckets = token_files.build_hash(keys)
        slots, _ = token_files.find_slots(keys, n, salt, buckets)
        assert sorted(slots.tolist()) == list(range(n))
    else:
        assert b"".join(token_files.packed(keys, np.zeros(0, np.int64), [], 2))


def test_files_round_trip(spark):
    df = documents(spark, AWKWARD)
    manifest = token_files.write_files(df, fresh_path(spark, "ids"), WORDS, file_bytes=100)
    rows = sorted(token_files.read_files(manifest).collect(), key=lambda r: r.start)
    library = tokenizers.Tokenizer.from_file(WORDS)
    ids = {(d, t): [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t, _ in AWKWARD}
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 5, 6, 6, 7, 8]
    start = 0
    for row in rows:
        own = next(v for (d, _), v in ids.items() if d == row.doc_id)
        assert (row.start, row.n_tokens) == (start, len(own))
        assert row.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)
    found = token_files.fetch(manifest, [6, 8, 999, -5]).collect()
    assert sorted((r.doc_id, r.repeat) for r in found) == [(6, 0), (6, 1), (8, 0)]
    assert all(r.ids == next(v for (d, _), v in ids.items() if d == r.doc_id) for r in found)
    empty = token_files.write_files(df.limit(0), fresh_path(spark, "ids"), WORDS)
    assert token_files.read_files(empty).collect() == []


def best_cover(text, scores):
    """By trying all ways to cut a short text."""
    if not text:
        return 0.0, []
    return max(
        (scores[text[:i]] + rest, [text[:i], *tail])
        for i in range(1, len(text) + 1)
        if text[:i] in scores
        for rest, tail in [best_cover(text[i:], scores)]
        if rest is not None
    ) if any(text[:i] in scores for i in range(1, len(text) + 1)) else (None, [])


def test_cover_is_the_best():
    vocabulary = pieces.read_vocabulary(PIECES)
    coder = pieces.PieceCoder(vocabulary)
    scores = {p: s for p, s, u in zip(vocabulary.pieces, vocabulary.scores, vocabulary.usable, strict=True) if u}
    r = random.Random(4)
    for _ in range(200):
        text = "▁" + "".join(r.choice("theandrioüñé") for _ in range(r.randint(1, 9)))
        ids = np.frombuffer(coder.part(text), "<u4").tolist()
        assert sum(vocabulary.scores[i] for i in ids) == best_cover(text, scores)[0]
        assert "".join(vocabulary.pieces[i] for i in ids) == text


def test_words_match_the_librarys_lattice():
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    model.ParseFromString(open(PIECES, "rb").read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    coder = pieces.PieceCoder(pieces.read_vocabulary(PIECES))
    for word in "the thing that overthrows Wissenschaft corazón être une idée".split():
        ids = np.frombuffer(coder.encode(word), "<u4").tolist()
        assert ids == library.nbest_encode(word, nbest_size=2)[0]


def test_texts_come_back():
    coder = pieces.PieceCoder(pieces.read_vocabulary(PIECES))
    for text in [*noise(1000, 3), "", " ", "  a  b ", "\n\na", LONG]:
        assert coder.decode(coder.encode(text)) == text, repr(text)


def test_unknown_characters_become_bytes():
    vocabulary = pieces.read_vocabulary(PIECES)
    coder = pieces.PieceCoder(vocabulary)
    ids = np.frombuffer(coder.encode("\U0001f9ff"), "<u4").tolist()
    assert ids[-4:] == [vocabulary.first_byte + b for b in "\U0001f9ff".encode()]


def test_pieces_rows(spark):
    rows = pieces.round_trip(documents(spark, AWKWARD), PIECES).collect()
    assert len(rows) == len(AWKWARD) and all(r.same for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (2, 3)} == {0}
    assert pieces.round_trip(documents(spark, AWKWARD).limit(0), PIECES).collect() == []
    text = spark.read.parquet(f"{SF}/documents.parquet")
    assert pieces.round_trip(text, PIECES).where("NOT same").count() == 0


def test_parts_are_dealt_to_widths_by_lengths_taken_once():
    coder, taken = pieces.PieceCoder(pieces.read_vocabulary(PIECES)), []

    class Bytes(bytes):
        def __len__(self):
            taken.append(1)
            return super().__len__()

    class Part(str):
        def encode(self):
            return Bytes(super().encode())

    words = [" a", " several", " considerably", " incomprehensibilities", " ünïcödé"]
    found = coder.encode_parts([Part(w) for w in words])
    assert found == [coder.part(w) for w in words]
    # Once to deal them out and once where they are stepped through.
    assert len(taken) <= 2 * len(words)

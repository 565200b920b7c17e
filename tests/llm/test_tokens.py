"""Encoding, decoding and counting against the library that owns the vocabularies."""

import hashlib
import pickle
import random
from array import array

import pytest
from helpers import BYTE_BPE, TEXTS, WORD_BPE, awkward, empty
from tokenizers import Tokenizer

from lapwright.llm import bpe, token_counts
from lapwright.llm.common import Built
from lapwright.llm.pieces import WordPieces, file_text, merge_long, merge_short, told_apart


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_ids_of_random_texts(path):
    library, encoder = Tokenizer.from_file(path), bpe.Encoder(WordPieces(path), remembered=50)
    draw = random.Random(3)
    some = [*range(9, 14), *range(28, 127), *range(0xA0, 0x250), *range(0x370, 0x400), *range(0x4E00, 0x4E40), 0x1F44D, 0x0301]
    texts = ["".join(chr(draw.choice(some)) for _ in range(draw.randrange(60))) for _ in range(800)] + [t or "" for t in TEXTS]
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert list(array("I", encoder(text))) == expected.ids, text


def test_long_words_are_merged_alike():
    vocabulary, draw = WordPieces(BYTE_BPE), random.Random(5)
    for n in (1, 2, 3, 40, 300):
        word = "".join(draw.choice("abcdethin") for _ in range(n))
        cuts = [*range(n + 1)]
        assert merge_short(word, [*cuts], vocabulary.ranks) == merge_long(word, [*cuts], vocabulary.ranks)


def test_round_trip_over_awkward_rows(spark):
    docs = awkward(spark)
    library = Tokenizer.from_file(WORD_BPE)
    done = bpe.decode(bpe.encode(docs, WORD_BPE), WORD_BPE)
    assert set(done.columns) == {*docs.columns, "n_tokens", "decoded"}
    rows = done.collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, list(array("I", r.ids))) == (len(ids), ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(empty(spark), WORD_BPE), WORD_BPE).count() == 0


@pytest.mark.parametrize("sent", [0, 10, 100_000])
def test_counts_over_awkward_rows(spark, sent):
    docs = awkward(spark)
    library = Tokenizer.from_file(BYTE_BPE)
    of = lambda d, t: (d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
    expected = sorted((of(r.doc_id, r.text) for r in docs.collect()), key=repr)
    got = token_counts.count_tokens(docs, BYTE_BPE, most_sent=sent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
    if not sent:
        assert token_counts.count_tokens(empty(spark), BYTE_BPE).count() == 0


def test_registered_digests(spark):
    folder = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(WORD_BPE)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in bpe.round_trip(spark, folder, WORD_BPE).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    library = Tokenizer.from_file(BYTE_BPE)
    for r in token_counts.counts(spark, folder, BYTE_BPE).collect():
        n = len(library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit) == (n, n > 512)


def test_vocabularies_are_made_by_the_workers():
    call = Built(bpe._encoder, file_text(WORD_BPE), told_apart())
    assert not any(isinstance(x, bpe.Encoder | WordPieces) for x in vars(call).values())
    assert len(pickle.dumps(call)) < 2_500_000
    made, here = pickle.loads(pickle.dumps(call)), bpe.Encoder(WordPieces(WORD_BPE))
    assert made("Some words, not many \u03a3.") == here("Some words, not many \u03a3.")

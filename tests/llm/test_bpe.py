import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from waybill.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", " a<|startoftext|>b<|endoftext|>", "ΑΣ ΟΔΥΣΣΕΥΣ Σ", "x\x1cy \x1f z\u0085q w​z", "İstanbul ǅ ﬁ",
       "é ñ ñ", "it's 'S 'LL don't we'll", "123٣²Ⅷ½", "日本語テキスト 👩‍👩‍👧", "a" * 3000, "!!!???..,", "<|startoftext|",
       "x﻿y\x00z", "<|STARTOFTEXT|>", "\t\n\r tab", "ab" * 40]


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as file:
        return bpe.Encoder(file.read(), cached_words=5)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", ODD)
def test_like_the_library(own, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None, derandomize=True)
@given(text=st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x2FFF), max_size=60))
def test_random_texts(own, library, text):
    # Characters that no library version has yet assigned alike are left out by the alphabet.
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, documents, library):
    texts = [row.text for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows = list(enumerate([*texts, None, "", *ODD])) + [(None, "again"), (3, "again"), (3, "again")]
    found = bpe.round_trip(documents(rows), bpe.read_vocabulary(spark, PATH)).collect()

    def expected(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        return ids, len(ids), *(hashlib.sha256(one.encode()).hexdigest() for one in (" ".join(map(str, ids)), decoded))

    assert sorted(((r.doc_id, r.ids, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found), key=str) == sorted(
        ((i, *expected(text)) for i, text in rows), key=str)


def test_empty_and_clashing(spark, documents, clashing):
    vocabulary = bpe.read_vocabulary(spark, PATH)
    assert bpe.round_trip(documents([]), vocabulary).count() == 0
    docs = clashing(documents([(1, "one two")]), "ids", "N_tokens")
    row = bpe.round_trip(docs, vocabulary, tuple(docs.columns)).first()
    assert (row["ids"], row["N_tokens"], row["n_tokens_"], len(row["ids_"])) == ("own ids", "own N_tokens", 2, 2)

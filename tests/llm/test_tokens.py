"""Token counts against the library over whole texts."""

import random

import public_tokenizers
import pytest
from partflow.llm import tokens
from tokenizers import Tokenizer

ODD = ["", "İIi ñ", "a<|endoftext|>b <|startoftext|>", "'s 'll it's", "²³ ½ 12", "x\x1cy\x85z\xa0w", "日本語 テスト ①", "ΟΔΟΣ", "é Å",
       "a_b__c!!", "<|ENDOFTEXT|>", "😀 👍🏽", "ﬁ İ̇", "a" * 3000, "<|endoftext|><|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))


def test_odd_texts(library):
    chance = random.Random(5)
    texts = ODD + ["".join(chance.choice("ab'sSt 12²½é\x1cΣ日①<|_!İ́ \n") for _ in range(20)) for _ in range(2000)]
    counter = tokens.PieceCounter(public_tokenizers.path(tokens.VOCABULARY), known=50)
    assert [counter.count(text) for text in texts] == [len(row.ids) for row in library.encode_batch(texts, add_special_tokens=False)]


def test_documents(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = {row.doc_id: (row.n_bytes, row.n_tokens, row.over_limit) for row in tokens.count_tokens(docs).collect()}
    for row in docs.collect():
        count = len(library.encode(row.text, add_special_tokens=False).ids)
        assert found[row.doc_id] == (len(row.text.encode()), count, count > 2048)


def test_odd_rows(odd_docs, odd_rows, library):
    found = sorted((str(row.doc_id), row.n_bytes, row.n_tokens) for row in tokens.count_tokens(odd_docs).collect())
    assert found == sorted((str(doc_id), len((text or "").encode()), len(library.encode(text or "", add_special_tokens=False).ids))
                           for doc_id, text, _ in odd_rows)
    assert tokens.count_tokens(odd_docs.where("false")).count() == 0

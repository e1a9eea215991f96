"""Token files against the library over whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from partflow.llm import token_files
from partflow.session import scratch_path
from tokenizers import Tokenizer

ODD = ["", "İIi ñ", "a<|endoftext|>b <|startoftext|>", "'s 'll it's", "²³ ½ 12", "x\x1cy\x85z\xa0w", "日本語 テスト ①", "ΟΔΟΣ ΟΔΟΣ.", "é Å",
       "a_b__c!!", "<|ENDOFTEXT|>", "😀 👍🏽", "ﬁ İ̇", "a" * 3000, "<|endoftext|><|endoftext|>", " ́a \ńb", "\t x \r\n", "a.b.c(d)'s it's,\"'ve",
       "x|>y<|endoftext|>,z.<|endoftext|>a", "Größe ÀÉÎ Ǆ ǅ ŉ Łódź ſ ĳ a,\u0301b e,", "A.\u0301B e'\u0301s don't.'t (x)[y]{z}~w_v`u@t"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))


def test_odd_texts(library):
    chance = random.Random(5)
    texts = ODD + ["".join(chance.choice("ab'sSt 12²½é\x1cΣ日①<|_!İ́ \n.,(Éßŉ") for _ in range(20)) for _ in range(2000)]
    words = token_files.WordEncoder(public_tokenizers.path(token_files.VOCABULARY), known=50)
    wanted = [row.ids for row in library.encode_batch(texts, add_special_tokens=False)]
    for step in (1, 7, len(texts)):
        found = []
        for at in range(0, len(texts), step):
            ids, count = words.encode(pa.array(texts, pa.string()).slice(at, step))
            found += [part.tolist() for part in np.split(ids, np.cumsum(count)[:-1])]
        assert found == wanted


def test_pack_round_trip():
    chance = np.random.default_rng(1)
    for n in range(40):
        ranks = (chance.integers(0, 2 ** 32, n) >> chance.integers(0, 32, n)).astype(np.uint32)
        control, data = token_files.pack(ranks)
        assert len(control) == -(-n // 4)
        assert np.array_equal(token_files.unpack(control, data, n), ranks)
    edges = np.array([0, 255, 256, 65535, 65536, 2 ** 24 - 1, 2 ** 24, 2 ** 32 - 1], np.uint32)
    control, data = token_files.pack(edges)
    assert (len(control), len(data)) == (2, 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4)
    assert np.array_equal(token_files.unpack(control, data, 8), edges)


def brute(rows, library):
    """Per (doc_id, ids): rows in order, with starts."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents_over_shards_and_blocks(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    wanted = brute([(row.doc_id, row.text) for row in docs.orderBy("doc_id").collect()], library)
    assert sorted(map(tuple, token_files.digest_tokens(docs).collect())) == wanted
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(docs.repartition(3, "source"), folder, shard_bytes=20_000, block_ids=300)
    assert spark.read.parquet(f"{folder}/blocks").select("shard").distinct().count() > 5
    read = sorted(token_files.read_tokens(spark, folder).collect())
    assert [(row.doc_id, row.start, row.n_tokens, zlib.crc32(row.ids)) for row in read] == wanted
    # The most frequent ids have the smallest ranks.
    counts = [row.n for row in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) == sum(row[2] for row in wanted)


def test_odd_rows(odd_docs, odd_rows, library):
    found = sorted(token_files.digest_tokens(odd_docs).collect(), key=lambda row: row.start)
    assert [row.doc_id for row in found] == sorted((row[0] for row in odd_rows), key=lambda i: (i is not None, i))
    upto = 0
    for row in found:
        assert row.start == upto
        upto += row.n_tokens
    single = brute([row[:2] for row in odd_rows], library)
    assert sorted((str(row.doc_id), row.n_tokens, row.ids_crc32) for row in found) == sorted(
        (str(doc_id), n, crc) for doc_id, _, n, crc in single)
    assert token_files.digest_tokens(odd_docs.where("false")).count() == 0

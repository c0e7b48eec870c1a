import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm.queries import QUERIES
from rollcall.llm.token_store import PieceEncoder, build_hash, hash_places, look_up, read_ids, stored_keys, write_store
from rollcall.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    tokenizer, at, result = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        result.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return result


def test_query_equals_a_plain_encoding(spark):
    sf = "/root/testdata/sf0.01"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.doc_id is not None)
    got = QUERIES["op7_token_store"](spark, sf).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 60_000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    k1, k2 = (rng.integers(0, 2**63, n, dtype=np.uint64) for _ in range(2))
    sizes, bits = build_hash(k1, k2)
    assert sorted(hash_places(k1, k2, sizes, bits)) == list(range(n))


def test_piecewise_encoding_equals_whole_text_encoding():
    with open(PATH, encoding="utf-8") as file:
        encoder = PieceEncoder(file.read(), 2)
    tokenizer = Tokenizer.from_file(PATH)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["​", "﻿", "́", "'s", "<|endoftext|>"]
    texts = [f"Ab{s}cd" for s in spaces] + [f"{s}É{s}{s}x9 y_z's" for s in spaces] + ["", " ", "a <|startoftext|>b", "ΑΣ Σ. ß"]
    texts += [f"x{a}{b}'{a}Y'S 1{b}" for a in map(chr, range(1, 0x180)) for b in "a1' -"]
    texts += [f"can''s I'LL d'être x'd'D''t {a}' '{a}" for a in "sStTmM1_-"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_edge_rows_and_repeated_keys(spark):
    rows = [(5, "five"), (None, "no id"), (5, "five again"), (None, None), (1, ""), (5, "five"), (2, "long " * 200_000)]
    df = spark.createDataFrame(rows * 1, "doc_id long, text string").repartition(3)
    df = df.selectExpr("*", "doc_id AS shard", "text AS file")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = scratch_path(spark, "tokens")
        write_store(df, path, PATH)
        keys = stored_keys(spark, path)
        assert sorted((r.doc_id is None, r.doc_id or 0, r.repeat) for r in keys.collect()) == [
            (False, 1, 0), (False, 2, 0), (False, 5, 0), (False, 5, 1), (False, 5, 2), (True, 0, 0), (True, 0, 1),
        ]
        got = sorted(read_ids(look_up(keys, path), path).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == [1, 2, 5, 5, 5, None, None]
        assert sum(r.n_tokens for r in got) == got[-1].start + got[-1].n_tokens
        assert sorted((x[2], x[3]) for x in expected(rows)) == sorted((r.n_tokens, r.ids_crc32) for r in got)
        missing = spark.createDataFrame([(77, 0), (5, 9), (None, 4)], "doc_id long, repeat long")
        assert look_up(missing, path).count() == 0
        path = scratch_path(spark, "tokens")
        write_store(df.limit(0), path, PATH)
        assert read_ids(look_up(stored_keys(spark, path), path), path).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

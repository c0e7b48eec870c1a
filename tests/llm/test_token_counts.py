"""Token counts against the tokenizer itself."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rollcall.llm import pieces, token_counts
from rollcall.llm.queries import QUERIES

PARTS = [
    "a", "B", "é", "ß", "中", "'", "'s", "'re", "'ll", "'S", " ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "1", "²", "٣", "!",
    "-", "…", "😀", "़", "İ", "<|endoftext|>", "<|", "'ve", "word", " word", "re", "\U000e0041", "\U00020000", "꙰",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_counts.count_tokenizer())


def plain(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def mixed_texts(n, longest=25):
    rng = random.Random(7)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_cuts_are_the_tokenizers(tokenizer):
    cutter = pieces.Cutter(pieces.char_classes(tokenizer.pre_tokenizer), True, specials=("<|endoftext|>",))
    texts = mixed_texts(3000)
    found, uncut = {}, set()
    for raw, begin, text in pieces.slices_of(pa.array(texts), 2000):
        cut = cutter.cut(raw, begin)
        uncut |= {int(text[k]) for k in cut.whole}
        for b, n, o in zip(cut.starts, cut.lengths, cut.owner, strict=True):
            found.setdefault(int(text[o]), []).append(cut.raw[b : b + n].tobytes().decode())
    for k, text in enumerate(texts):
        if k not in uncut:
            assert found.get(k, []) == [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def test_long_texts_are_cut_in_parts(tokenizer):
    text = " ".join(mixed_texts(400)) + " plain words follow here" * 300
    counter = token_counts._Counter(
        tokenizer.to_str(),
        pieces.Cutter(pieces.char_classes(tokenizer.pre_tokenizer), True, specials=("<|endoftext|>",)),
        None,
    )
    column = pa.array([text, "x", text])
    assert len(list(pieces.slices_of(column, 1000))) > 10
    whole = counter.counts(column).tolist()
    token_counts_slices, pieces_limit = token_counts.slices_of, 1000
    try:
        token_counts.slices_of = lambda c: token_counts_slices(c, pieces_limit)
        assert counter.counts(column).tolist() == whole == [plain(tokenizer, t) for t in (text, "x", text)]
    finally:
        token_counts.slices_of = token_counts_slices


def test_counts_equal_the_tokenizer(spark, tokenizer):
    texts = [*mixed_texts(300), None, "", "same", "same", "word " * 50_000, "ab" * 3000, "<|endoftext|>"]
    schema = T.StructType(
        [
            T.StructField("n_tokens", T.StringType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("piece", T.StringType()),
        ]
    )
    docs = spark.createDataFrame([("x", k // 2 if k % 50 else None, t, "y") for k, t in enumerate(texts)], schema)
    want = sorted(
        (k // 2 if k % 50 else -1, len((t or "").encode()), plain(tokenizer, t)) for k, t in enumerate(texts)
    )
    for frequent in (token_counts.FREQUENT, 3, 1):
        rows = token_counts.counted(docs, token_counts.count_tokenizer(), frequent).collect()
        assert sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in rows) == want


def test_empty_table_and_no_exchange_of_texts(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    counts = token_counts.counted(docs, token_counts.count_tokenizer())
    assert counts.collect() == []
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()


def test_summary_keeps_frequent_pieces():
    rng = np.random.default_rng(1)
    summary = token_counts._Summary()
    for _ in range(30):
        rare = rng.integers(1000, 2**50, 10_000).astype(np.uint64)
        low = np.concatenate([rare, np.repeat(np.arange(1, 4, dtype=np.uint64), 500)])
        summary.add(low, np.zeros(len(low), np.uint64))
    summary.shrink()
    assert len(summary.counts) <= token_counts.SUMMARY
    assert set(summary.low[np.argsort(-summary.counts)[:3]].tolist()) == {1, 2, 3}


def test_table_finds_what_was_added():
    rng = np.random.default_rng(2)
    low, high = rng.integers(0, 50, 4000).astype(np.uint64), rng.integers(0, 50, 4000).astype(np.uint64)
    first, number = pieces.distinct_keys(low, high)
    assert len(first) == len(set(zip(low.tolist(), high.tolist(), strict=True)))
    assert (low[first[number]] == low).all() and (high[first[number]] == high).all()
    table = pieces.PieceTable(4)
    for part in np.array_split(np.arange(len(first)), 7):
        table.add(low[first[part]], high[first[part]], part.astype(np.int32))
    assert (table.find(low, high) == number).all()
    assert (table.find(low + np.uint64(100), high) == -1).all()


def test_query_equals_the_tokenizer_on_the_given_table(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op11_two_tier_counts"](spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n = plain(tokenizer, row["text"])
        told = got[row["doc_id"]]
        assert (told["n_tokens"], told["n_bytes"], told["over_limit"]) == (n, len((row["text"] or "").encode()), n > 1024)

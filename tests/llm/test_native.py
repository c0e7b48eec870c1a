"""The native operators: every query against its SQL, plain versions, and the defined cases."""

import random
import zlib

import pytest
from brute import SPACES, words
from oracle import compare, connect

from rollcall.llm import line_templates, mixing, quality_rules, sharding
from rollcall.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "NestedLoop")

LONG = " ".join(f"w{k} the of" for k in range(40))
ROWS = [
    (1, LONG, "en", "b", "x"),
    (1, LONG, "en", "b", "x"),
    (2, None, None, None, None),
    (3, "", "xx", None, ""),
    (None, LONG + " more", None, "a", "y"),
    (4, "word " * 60_000, "de", "", "z"),
    (5, " \t\n\x0b", "en", "b", "q"),
]
CLASHING = "doc_id long, text string, lang string, source string, row string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, CLASHING).selectExpr("*", "row AS size", "row AS target", "row AS cell", "row AS t")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) in (None, "EMPTY")


@pytest.mark.parametrize("name", ["op1_template_lines", "op2_curriculum_mix", "op3_divergence_rules", "op6_slot_shards"])
def test_no_python_in_the_plan(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in text for node in PYTHON_NODES)


def test_base_counts_equal_plain_counts(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_divergence_rules"](spark, SF).collect():
        text, w = texts[r.doc_id], words(texts[r.doc_id])
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        counts = {g: grams.count(g) for g in set(grams)} if len(set(grams)) < len(grams) else {}
        covered = {k for i, g in enumerate(grams) if counts.get(g, 1) > 1 for k in (i, i + 1, i + 2)}
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(covered)
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_rules_on_odd_rows(spark, odd):
    got = quality_rules.judged(odd).collect()
    assert len(got) == len(ROWS)
    assert {r["row"].doc_id for r in got if r.base_failed} == {2, 3, 4, 5}
    kept = quality_rules.kept_documents(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]
    assert quality_rules.judged(odd.limit(0)).count() == 0


def test_common_words_are_learned_for_any_language(spark):
    fill = " ".join(["zu"] * 50)
    rows = [(k, f"{fill} ab {'ab ' * k}x{k}", "xx") for k in range(20)] + [(50, fill, None), (51, f"nu {fill}", "")]
    rows += [(52, None, None), (53, "", "xx"), (54, "solo " * 30_000, "yy"), (55, "few words", "zz")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    common = quality_rules.common_words(docs)
    listed = {r.ref: r.common for r in common.collect()}
    last = sorted(f"x{k}" for k in range(20))[: quality_rules.WORD_BINS - 2]
    assert listed == {"xx": ["ab", "zu", *last], "": ["zu", "nu"], "yy": ["solo"]}
    for r in quality_rules.measured(docs, common).collect():
        w, own = words(r["row"].text or ""), listed.get(r.ref, [])
        bins = [r[f"w{k}"] for k in range(quality_rules.WORD_BINS)]
        assert bins == [w.count(x) for x in own] + [0] * (len(bins) - len(own))
        assert sum(bins) + r.w_rest == len(w)


def test_text_of_another_language_is_rejected(spark):
    def text(stock, seed):
        draw = random.Random(seed)
        return " ".join(draw.choice(stock) if k % 2 else f"{draw.choice(stock)}{draw.randrange(99)}" for k in range(300))

    here = ["ma", "ne", "of", "ti"] + [f"word{c}" for c in "abcdefgh"]
    there = ["po", "qu", "ru", "su"] + [f"term{c}" for c in "abcdefgh"]
    rows = [(k, text(here, k), "xx") for k in range(60)] + [(100, text(there, 3), "xx"), (101, text(there, 3), "unseen")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = {r["row"].doc_id: r for r in quality_rules.judged(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [k for k, r in got.items() if not r.kept] == [100]
    assert got[101].word_distance is None


def test_sharding_is_even_gapless_and_repeatable(spark):
    rows = QUERIES["op6_slot_shards"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    load, places = [0] * 16, {}
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        load[r.shard] += r.size
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load) - min(load) < 0.02 * sum(load) / 16
    again = QUERIES["op6_slot_shards"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(again) == sorted(rows)


def test_rebalancing_edits_few_slots():
    sizes = [(k * 7919) % 1000 + 1 for k in range(4096)]
    one = sharding.rebalanced(sharding.first_map(16), sizes, 16)
    assert sharding.rebalanced(one, sizes, 16) == one
    grown = sharding.rebalanced(one, sizes, 17)
    load = [sum(s for s, x in zip(sizes, grown, strict=True) if x == shard) for shard in range(17)]
    assert max(load) - min(load) <= 1000
    moved = [k for k in range(4096) if one[k] != grown[k]]
    assert len(moved) < 4096 / 8
    assert sharding.rebalanced([0, 0, 0], [0, 0, 0], 2) == [0, 0, 0]


def test_shards_of_odd_rows(spark, odd):
    placed, slot_map = sharding.shard_records(odd, shards=3)
    rows = placed.collect()
    assert len(rows) == len(ROWS) and {r.size for r in rows if r.doc_id in (2, 3)} == {1}
    for shard in range(3):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    assert slot_map.groupBy("version").count().count() == 2
    assert sharding.shard_records(odd.limit(0))[0].count() == 0


def test_mixing_odd_rows(spark, odd):
    placed = mixing.place_documents(odd).collect()
    assert len(placed) == len(ROWS)
    assert all(0 <= r["copies"] <= 3 for r in placed)
    assert {r["source_size"] for r in placed if r["row"].source is None} == {0}
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r["copies"] for r in placed)
    assert mixing.place_documents(odd.limit(0)).count() == 0 and mixing.mixed_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("knots", list(mixing.SCHEDULES.values()) + [[(0.0, 2.0), (0.5, 2.0), (1.0, 0.5)]])
def test_inverted_demand_is_the_inverse(spark, knots):
    def cumulative(t):
        total = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
            if t > t0:
                end = min(t, t1)
                total += (w0 + w0 + (w1 - w0) * (end - t0) / (t1 - t0)) / 2 * (end - t0)
        return total

    shares = spark.range(0, 101).selectExpr("id / 100D AS u")
    for r in shares.select("u", mixing.invert_demand(mixing.F.col("u"), knots).alias("t")).collect():
        assert cumulative(r.t) == pytest.approx(r.u * cumulative(1.0))


def test_templates_generalise_and_copies_count_once(spark):
    rows = [(k, f"own line number{k} is here alone {k * 31}x\nVisit counter shows {k} hits today\nshort one") for k in range(12)]
    rows += [(100 + k, "same text everywhere in all of these\nsecond line of the copied text") for k in range(30)]
    rows += [(200, "Visit counter shows 7 hits today\nunique words stay in this line"), (None, None), (201, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text AS drop", "doc_id AS left")
    got = {r["row"].doc_id: r for r in line_templates.cleaned(df).collect()}
    assert got[200].text == "unique words stay in this line" and got[200].n_dropped == 1
    assert all(got[k].text == "" and got[k].n_dropped == 3 for k in range(12))
    assert got[100].text == rows[12][1] and got[100].n_dropped == 0
    assert got[None].text is None and got[201].text == "" and got[None].n_lines == 0
    assert line_templates.cleaned(df.limit(0)).count() == 0


def _cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["row"].doc_id: r.text for r in line_templates.cleaned(df).collect()}


def test_a_leaf_holds_several_families(spark):
    names = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    texts = [f"Posted by {n} in News on Monday today\nbody {n} {n}x first" for n in names]
    texts += [f"Posted by {n} from Sports desk at five\nrest {n} {n}y second" for n in names[:60]]
    got = _cleaned(spark, texts)
    assert not any("Posted" in t for t in got.values())
    assert all(len(t.split("\n")) == 1 and t for t in got.values())


@pytest.mark.parametrize("n_tokens,texts,stays", [(1, 10, False), (3, 10, False), (3, 9, True), (8, 8, False), (8, 7, True), (20, 2, False), (60, 2, False), (19, 2, True)])
def test_needed_texts_fall_with_length(spark, n_tokens, texts, stays):
    line = " ".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(n_tokens))
    got = _cleaned(spark, [f"{line}\nown {'x' * k} end of {'y' * k} text" for k in range(1, texts + 1)])
    assert all(t.startswith(line) == stays for t in got.values())


def test_lines_of_fields_long_texts_and_ties(spark):
    texts = [f"{k}\n{k} {k + 1}\n\nsame\n" + "tail " * (40_000 if k == 3 else k + 1) for k in range(12)]
    got = _cleaned(spark, [*texts, texts[0]])
    # Numbers alone and blank lines stay, a line in twelve texts goes, tails of different lengths are different lines.
    assert got[3] == "3\n3 4\n\n" + "tail " * 40_000 and got[0] == got[12] == "0\n0 1\n\ntail "
    # Two tokens stand equally often at a place: the greater one is the constant.
    tied = [f"Seen at {'aa' if k % 2 else 'bb'} place {chr(97 + k)}{chr(98 + k)}" for k in range(10)]
    assert set(_cleaned(spark, tied).values()) == {""}

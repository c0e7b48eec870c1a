"""Line dedup by a tree of line templates.

A line's path in the tree is its number of tokens and its first DEPTH tokens; tokens with a digit are variable
fields from the start. In a leaf, a position on which at least CONSTANT_SHARE of the leaf's different lines agree is
constant, any other is a variable field. Lines that agree with enough constant positions are instances of the
leaf's template. The other lines of the leaf go through the same test again, and so on until it finds no more instances, so a
leaf holds as many templates as it has families. A template that occurs in at least ``min_texts`` different texts recurs.

Every line is also a template by itself, with its fields as the only variables. How many texts it must stand in falls with the number of its
constant tokens, from ``min_texts`` at four tokens or fewer to two at twenty (:func:`needed_texts`): two texts seldom share a long line by
chance. A line of fields only is no template.

Lines whose template recurs are dropped from every document. Whole copies of a text count once. Passages inside a longer line are out of
reach of whole-line templates.

Lines travel as hashes; the tokens of a line are shuffled only if its leaf holds enough lines to matter, and what recurs is decided
per different line.

Defined cases: null texts stay null, texts without a recurring line stay as they are; blank lines are never dropped; very long texts
are worked on line by line; equally frequent tokens of a position go by the greater token; repeated rows are cleaned alike and count
as one text; an empty table gives no rows. Input columns are packed away, so any names may occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import SPACE, packed
from rollcall.session import materialize

DEPTH = 2

#: Shorter lines are templates by themselves only.
MIN_TOKENS = 4
MIN_TEXTS = 10
CONSTANT_SHARE = 0.5
SIMILARITY = 0.6
FIELD = "<*>"

#: A whole token that holds a digit; each token is tried once, from its start.
_WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"

#: What a line must hold to differ from its masked form: a digit, or white space other than single spaces between tokens.
_TO_MASK = r"[0-9\x09-\x0D]|\x20(?:\x20|$)|^\x20"


def _masked(line: Column) -> Column:
    """The line's tokens, variable fields masked, with one space between them; blank lines are empty."""
    masked = F.regexp_replace(F.regexp_replace(line, _WITH_DIGIT, FIELD), SPACE, " ")
    return F.when(line.rlike(_TO_MASK), F.trim(masked)).otherwise(line)


def _tokens(masked: Column) -> Column:
    return F.split(masked, " ", -1)


def _size(masked: Column) -> Column:
    return F.octet_length(masked) - F.octet_length(F.replace(masked, F.lit(" "), F.lit(""))) + 1


def _leaf_hash(masked: Column) -> Column:
    return F.xxhash64(_size(masked), F.substring_index(masked, " ", DEPTH))


def _row_hashes() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64("text", "doc_id", F.lit(1)).alias("r2")]


def constant_tokens(masked: Column) -> Column:
    with_fields = F.size(F.array_remove(_tokens(masked), FIELD))
    return F.when(F.contains(masked, F.lit(FIELD)), with_fields).otherwise(_size(masked))


def needed_texts(constants: Column, min_texts: int) -> Column:
    """Different texts in which a line must stand by itself: one less for every two constant tokens beyond four, at least two."""
    fewer = F.floor(F.greatest(constants - 4, F.lit(0)) / 2)
    return F.greatest(F.lit(min_texts) - fewer, F.lit(min(2, min_texts)))


def _all_lines(docs: DataFrame) -> DataFrame:
    """(r1, r2, text_hash, leaf, line, masked): the different lines of each row, but for blank ones."""
    masked = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), _masked)
    filled = F.array_remove(F.array_distinct(masked), "")
    return docs.select(*_row_hashes(), F.xxhash64("text").alias("text_hash"), F.explode(filled).alias("masked")).select(
        "r1", "r2", "text_hash", _leaf_hash(F.col("masked")).alias("leaf"), F.xxhash64("masked").alias("line"), "masked"
    )


def _families(different: DataFrame, min_texts: int) -> list[DataFrame]:
    """(leaf, line, template) of the lines that are instances of a template of their leaf; a template is named by its round."""
    found, turn = [], 0
    while True:
        tokens = different.select("leaf", F.posexplode("tokens").alias("at", "token"))
        counted = tokens.groupBy("leaf", "at", "token").agg(F.count("*").alias("n"))
        constants = (
            counted.groupBy("leaf", "at")
            .agg(F.max(F.struct("n", "token")).alias("top"), F.sum("n").alias("all"))
            .filter(F.col("top.n") >= CONSTANT_SHARE * F.col("all"))
            .groupBy("leaf")
            .agg(F.collect_list(F.struct("at", F.col("top.token").alias("token"))).alias("constants"))
        )
        agreeing = F.size(F.filter("constants", lambda c: F.get(F.col("tokens"), c["at"]) == c["token"]))
        judged = materialize(
            different.join(constants, "leaf").select(
                "leaf", "line", "tokens", (agreeing >= SIMILARITY * F.size("tokens")).alias("instance")
            ),
            "line-judged",
        )
        found.append(judged.where("instance").select("leaf", "line", F.lit(turn).alias("template")))
        # Leaves that gave a template and still hold enough lines for another one.
        again = (
            judged.groupBy("leaf")
            .agg(F.count_if("instance").alias("taken"), F.count_if(~F.col("instance")).alias("rest"))
            .where((F.col("taken") > 0) & (F.col("rest") >= min_texts))
            .select("leaf")
        )
        different = materialize(
            judged.where(~F.col("instance")).join(again, "leaf", "left_semi").select("leaf", "line", "tokens"), "line-rest"
        )
        turn += 1
        if different.isEmpty():
            return found


def recurring_lines(docs: DataFrame, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(r1, r2, line): for each row, named by its hashes, the hashes of its lines whose template recurs."""
    lines = _all_lines(docs)
    slim = materialize(
        lines.select(
            "r1", "r2", "text_hash", "leaf", "line",
            _size(F.col("masked")).alias("size"), constant_tokens(F.col("masked")).alias("constants"),
        ),
        "lines",
    )
    own = (
        slim.where(F.col("constants") > 0)
        .groupBy("line", "constants", "text_hash")
        .agg(F.lit(1).alias("one"))
        .groupBy("line", "constants")
        .agg(F.count("*").alias("texts"))
        .where(F.col("texts") >= needed_texts(F.col("constants"), min_texts))
        .select("line")
    )
    # A template cannot recur in a leaf that holds too few lines. Written, so that joins know its size.
    long = slim.where(F.col("size") >= MIN_TOKENS)
    leaves = materialize(
        long.groupBy("leaf").agg(F.count("*").alias("lines")).filter(F.col("lines") >= min_texts).select("leaf"),
        "line-leaves",
    )
    held = lines.where(_size(F.col("masked")) >= MIN_TOKENS).select("leaf", "line", "masked").join(leaves, "leaf")
    different = materialize(
        held.distinct().select("leaf", "line", _tokens(F.col("masked")).alias("tokens")), "line-different"
    )
    instances = None
    for part in _families(different, min_texts):
        instances = part if instances is None else instances.unionByName(part)
    instances = materialize(instances, "line-instances")
    recurring = (
        long.join(instances, ["leaf", "line"])
        .groupBy("leaf", "template", "text_hash")
        .agg(F.lit(1).alias("one"))
        .groupBy("leaf", "template")
        .agg(F.count("*").alias("texts"))
        .filter(F.col("texts") >= min_texts)
    )
    by_family = instances.join(recurring, ["leaf", "template"], "left_semi").select("line")
    dropped = materialize(own.unionByName(by_family).distinct(), "line-dropped")
    return slim.select("r1", "r2", "line").join(dropped, "line")


def cleaned(docs: DataFrame, keep: list[str] | None = None, min_texts: int = MIN_TEXTS) -> DataFrame:
    """Every row (columns ``keep``, or all, packed as ``row``) with n_lines, n_dropped and the cleaned text."""
    drops = materialize(
        recurring_lines(docs, min_texts).groupBy("r1", "r2").agg(F.collect_set("line").alias("drop")), "line-drops"
    )
    rows = packed(docs, keep, F.col("text"), *_row_hashes()).join(drops, ["r1", "r2"], "left")
    stays = lambda line: ~F.array_contains(F.col("drop"), F.xxhash64(_masked(line)))
    left = F.when(F.col("drop").isNotNull(), F.filter(F.split("text", "\n", -1), stays))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    return (
        rows.withColumn("left", left)
        .withColumn("n_lines", n_lines)
        .select(
            "row",
            F.col("n_lines").cast("long").alias("n_lines"),
            F.coalesce(F.col("n_lines") - F.size("left"), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join("left", "\n")).alias("text"),
        )
    )

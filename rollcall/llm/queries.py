"""The queries op1 to op13, and the SQL they must agree with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import default_tokenizer, table
from rollcall.llm import language_id, line_templates, quality_model
from rollcall.llm import quality_rules as rules
from rollcall.llm.decontaminate import find_leaks
from rollcall.llm.html_extract import extracted
from rollcall.llm.mixing import place_documents, position
from rollcall.llm.near_dups import near_duplicates
from rollcall.llm.sharding import shard_records
from rollcall.llm.source_audit import MIN_DOCUMENTS, TOP_TERMS, audited
from rollcall.llm.token_counts import count_tokenizer, counted
from rollcall.llm.token_store import token_digest
from rollcall.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, coded_vectors
from rollcall.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


#: Rounds of the SQL; a leaf that needs more families than this differs from the query, which goes on until none is left.
_OP1_ROUNDS = 5


def _op1_sql() -> str:
    rounds = []
    for k in range(_OP1_ROUNDS):
        rounds.append(f"""
constants{k} AS (
  SELECT leaf, place, token FROM (
    SELECT leaf, place, token, count(*) AS n
    FROM (SELECT leaf, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place FROM rest{k}) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY leaf, place ORDER BY n DESC, token DESC) = 1
      AND n >= {line_templates.CONSTANT_SHARE} * sum(n) OVER (PARTITION BY leaf, place)),
judged{k} AS MATERIALIZED (
  SELECT d.leaf, d.tokens,
         count(*) FILTER (WHERE d.tokens[c.place] = c.token) >= {line_templates.SIMILARITY} * len(d.tokens) AS instance
  FROM rest{k} d JOIN constants{k} c ON d.leaf = c.leaf GROUP BY d.leaf, d.tokens),
rest{k + 1} AS MATERIALIZED (
  SELECT leaf, tokens FROM judged{k}
  WHERE NOT instance AND leaf IN (
    SELECT leaf FROM judged{k} GROUP BY leaf
    HAVING bool_or(instance) AND count(*) FILTER (WHERE NOT instance) >= {line_templates.MIN_TEXTS}))""")
    instances = " UNION ALL ".join(f"SELECT leaf, tokens, {k} AS template FROM judged{k} WHERE instance" for k in range(_OP1_ROUNDS))
    return rf"""
WITH lines AS (
  SELECT doc_id, text, place, line,
         list_transform(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda t: t <> ''),
                        lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{line_templates.FIELD}' ELSE t END) AS tokens
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
        FROM documents)),
filled AS MATERIALIZED (
  SELECT DISTINCT doc_id, text, tokens, len(tokens) || ' ' || array_to_string(tokens[:{line_templates.DEPTH}], ' ') AS leaf
  FROM lines WHERE len(tokens) > 0),
own AS (
  SELECT tokens FROM (
    SELECT tokens, len(list_filter(tokens, lambda t: t <> '{line_templates.FIELD}')) AS constants, count(DISTINCT text) AS texts
    FROM filled GROUP BY tokens)
  WHERE constants > 0 AND texts >= greatest(2, {line_templates.MIN_TEXTS} - greatest(constants - 4, 0) // 2)),
held AS MATERIALIZED (
  SELECT * FROM filled
  WHERE len(tokens) >= {line_templates.MIN_TOKENS} AND leaf IN (
    SELECT leaf FROM filled WHERE len(tokens) >= {line_templates.MIN_TOKENS}
    GROUP BY leaf HAVING count(*) >= {line_templates.MIN_TEXTS})),
rest0 AS (SELECT DISTINCT leaf, tokens FROM held),
{",".join(rounds)},
instances AS MATERIALIZED ({instances}),
recurring AS (
  SELECT i.leaf, i.template FROM held h JOIN instances i ON h.leaf = i.leaf AND h.tokens = i.tokens
  GROUP BY ALL HAVING count(DISTINCT h.text) >= {line_templates.MIN_TEXTS}),
dropped AS (
  SELECT tokens FROM own
  UNION
  SELECT i.tokens FROM instances i JOIN recurring r ON i.leaf = r.leaf AND i.template = r.template),
cleaned AS (
  SELECT doc_id, count(d.tokens)::BIGINT AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE d.tokens IS NULL), '') AS text
  FROM lines l LEFT JOIN dropped d ON l.tokens = d.tokens GROUP BY doc_id)
SELECT o.doc_id, coalesce(len(string_split(o.text, chr(10))), 0)::BIGINT AS n_lines,
       coalesce(n_dropped, 0)::BIGINT AS n_dropped, c.text AS text
FROM documents o LEFT JOIN cleaned c ON o.doc_id = c.doc_id
"""


@query("op1_template_lines", _op1_sql())
def op1_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines whose template recurs: in ten texts, or in fewer if the line is long."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.cleaned(docs, keep=["doc_id"]).select("row.doc_id", "n_lines", "n_dropped", "text")


OP2_SQL = r"""
WITH rows AS (
  SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS no_src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
sizes AS (SELECT src, no_src, sum(size)::BIGINT AS source_size FROM rows GROUP BY ALL),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY no_src, src) - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM sizes),
walked AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(cap) OVER w, 0) AS caps_before, coalesce(sum(weight) OVER w, 0) AS weights_before
  FROM ranked
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, no_src, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (
  SELECT *, (total - caps_before)::DOUBLE / (weights - weights_before)::DOUBLE * weight > cap AS capped FROM walked),
summed AS (
  SELECT *, sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS taken_caps,
         sum(CASE WHEN capped THEN weight ELSE 0 END) OVER () AS taken_weights
  FROM judged),
targets AS (
  SELECT src, no_src, source_size, weight,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE least((total - taken_caps)::DOUBLE / (weights - taken_weights)::DOUBLE * weight, cap::DOUBLE)
         END AS target
  FROM summed),
placed AS (
  SELECT doc_id, size, source_size, weight, target,
         (sum(size) OVER (PARTITION BY src, no_src ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM rows JOIN targets USING (src, no_src)),
copied AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0
                 ELSE greatest(0, least(3, ceil((target - (start + size / 2.0::DOUBLE)) / source_size)))
            END::BIGINT AS copies
  FROM placed),
shared AS (SELECT *, least(1.0::DOUBLE, (start + size / 2.0::DOUBLE) / target) AS u FROM copied)
SELECT doc_id, size, source_size, target, size * copies AS taken,
       CASE WHEN copies = 0 THEN NULL ELSE round(CASE weight
         WHEN 1 THEN (sqrt(2.25::DOUBLE - 2.0::DOUBLE * u) - 1.5::DOUBLE) / -1.0::DOUBLE
         WHEN 2 THEN u
         ELSE CASE WHEN u <= 0.15625::DOUBLE
                   THEN sqrt(0.25::DOUBLE + 2.0::DOUBLE * u) - 0.5::DOUBLE
                   ELSE 0.25::DOUBLE + (sqrt(0.5625::DOUBLE + 2.0::DOUBLE * (u - 0.15625::DOUBLE)) - 0.75::DOUBLE) END
       END, 6) END AS position
FROM shared
"""


@query("op2_curriculum_mix", OP2_SQL)
def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what the mix takes of them and where their first copy stands."""
    placed = place_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep=["doc_id"])
    digest = placed.select(
        F.col("row.doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.when(F.col("copies") > 0, F.round(position(F.lit(0)), 6)).alias("position"),
    )
    return digest.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def _distance_sql(names: list[str], own: str, ref: str) -> str:
    """SQL of the Jensen-Shannon distance between the shares of two rows' counts."""
    terms = []
    totals = [f"greatest({' + '.join(f'{t}.{n}' for n in names)}, 1)::DOUBLE" for t in (own, ref)]
    for n in names:
        p, q = (f"({t}.{n} / {total})" for t, total in zip((own, ref), totals, strict=True))
        terms.append(f"CASE WHEN {own}.{n} > 0 THEN {p} * log2(2.0::DOUBLE * {p} / ({p} + {q})) ELSE 0 END")
        terms.append(f"CASE WHEN {ref}.{n} > 0 THEN {q} * log2(2.0::DOUBLE * {q} / ({p} + {q})) ELSE 0 END")
    return f"sqrt(greatest(0.0::DOUBLE, ({' + '.join(terms)}) / 2))"


def _op3_sql() -> str:
    without = "length(t) - length(regexp_replace(t, '{}', '', 'g'))"
    marks = r"""[!"''()+,./:;=?@\[\\\]^_`{}~-]"""
    punctuation = f"length(t) - length(regexp_replace(t, '{marks}', '', 'g'))"
    bins = [f"w{k}" for k in range(rules.WORD_BINS)]
    class_sum, bin_sum = (
        ", ".join(f"sum({n}) AS {n}" for n in names) for names in (rules.CLASSES, [*bins, "w_rest"])
    )
    counted = ", ".join(f"len(list_filter(w, lambda x: x = common[{k + 1}])) AS w{k}" for k in range(rules.WORD_BINS))
    return rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS ref,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w
  FROM documents),
listed AS (SELECT *,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ 	-
]')) AS lines FROM split),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM grams WHERE n >= 2) GROUP BY doc_id),
measures AS (
  SELECT l.doc_id, ref, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(t) AS chars, ({without.format('[#*$%&|<>]')})::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         {without.format('[A-Z]')} AS uppers, {without.format('[0-9]')} AS digits,
         {without.format(r'[!"' + "''" + r'()+,./:;=?@\[\\]^_`{}~-]').replace("^_`~", "^_`{}~")} AS punctuation,
         strlen(t) - length(t) AS wide, length(t) - length(array_to_string(w, '')) AS spaces, w
  FROM listed l LEFT JOIN repeats r ON l.doc_id = r.doc_id),
full_measures AS (
  SELECT *, greatest(0, chars - uppers - digits - punctuation - n_symbols - spaces - wide) AS others,
         n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM measures),
first_refs AS (SELECT ref, {class_sum} FROM full_measures WHERE NOT base_failed GROUP BY ref),
common AS (
  SELECT ref, list(word ORDER BY texts DESC, word) AS common
  FROM (SELECT ref, word, texts, row_number() OVER (PARTITION BY ref ORDER BY texts DESC, word) AS place
        FROM (SELECT ref, word, count(*) AS texts
              FROM (SELECT ref, unnest(list_distinct(w)) AS word FROM split WHERE len(w) >= {rules.MIN_WORDS}) GROUP BY ref, word))
  WHERE place <= {rules.WORD_BINS} GROUP BY ref),
binned AS (SELECT *, n_words - ({' + '.join(bins)}) AS w_rest
           FROM (SELECT m.*, {counted} FROM full_measures m LEFT JOIN common c ON m.ref = c.ref)),
last_refs AS (
  SELECT m.ref, sum(n_words) AS ref_words, {class_sum.replace('sum(', 'sum(m.')}, {bin_sum}
  FROM binned m JOIN first_refs r ON m.ref = r.ref
  WHERE NOT base_failed AND {_distance_sql(rules.CLASSES, 'm', 'r')} <= {rules.FIRST_CLASS_DISTANCE}
  GROUP BY m.ref)
SELECT doc_id, n_words, word_chars, m.n_symbols AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT coalesce(ref_words >= {rules.MIN_REFERENCE_WORDS} AND chars >= {rules.MIN_CHARS}
           AND {_distance_sql(rules.CLASSES, 'm', 'r')} > {rules.MAX_CLASS_DISTANCE}, FALSE)
       AND NOT coalesce(ref_words >= {rules.MIN_REFERENCE_WORDS} AND n_words >= {rules.MIN_HISTOGRAM_WORDS}
           AND {_distance_sql([*bins, 'w_rest'], 'm', 'r')} > {rules.MAX_WORD_DISTANCE}, FALSE) AS kept
FROM binned m LEFT JOIN last_refs r ON m.ref = r.ref
"""


@query("op3_divergence_rules", _op3_sql())
def op3_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their base counts and the verdict of the rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return rules.judged(docs, keep=["doc_id"]).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query("op4_ftrl_quality")
def op4_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the chance of a good label, learned from the folds 0 and 2 of three."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    weights = quality_model.train(docs, labels, quality_model.fold(F.col("doc_id"), 3) != 1)
    return quality_model.scored(docs, weights).select(
        "doc_id",
        (quality_model.fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op5_cgk_decontamination")
def op5_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair where the document holds the item, with the place and the edits."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_slot_shards")
def op6_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the rebalanced slot map; sizes are near equal."""
    placed, _ = shard_records(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


@query("op7_token_store")
def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as read back from the token store, found through its index."""
    docs = table(spark, sf_dir, "documents")
    return token_digest(docs, scratch_path(spark, "token-store"), default_tokenizer())


@query("op8_url_differencing")
def op8_url_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extracted(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@query("op9_ppm_language")
def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their language, learned from the folds 0, 1 and 3 of four."""
    docs = table(spark, sf_dir, "documents")
    trees = language_id.train(docs, quality_model.fold(F.col("doc_id"), 4) != 2)
    return language_id.identified(docs, trees).select(
        "doc_id",
        (quality_model.fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "lang_pred",
        "score",
    )


@query("op10_fast_sketch_dups")
def op10_fast_sketch_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the near-duplicate component they belong to (four-word shingles, 0.8)."""
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs, width=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


@query("op11_two_tier_counts")
def op11_two_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their bytes and tokens."""
    rows = counted(table(spark, sf_dir, "documents"), count_tokenizer())
    return rows.withColumn("over_limit", F.col("n_tokens") > 1024)


def _op12_sql() -> str:
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, part, (best % {ENTRIES})::BIGINT AS entry, (best // {ENTRIES})::BIGINT AS far
  FROM (SELECT r, part, min(far * {ENTRIES} + entry) AS best
        FROM (SELECT r, part, entry, sum((v - c) * (v - c)) AS far
              FROM places JOIN book{k} USING (part, place) GROUP BY ALL) GROUP BY ALL))""")
        if k < ROUNDS:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place, coalesce((s - ((s % n) + n) % n) // n, c)::BIGINT AS c
  FROM book{k} b LEFT JOIN (
    SELECT part, entry, place, sum(v)::BIGINT AS s, count(*) AS n
    FROM places JOIN near{k} USING (r, part) GROUP BY ALL) m
  ON b.part = m.part AND b.entry = m.entry AND b.place = m.place)""")
    return rf"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding AS e, row_number() OVER (ORDER BY vec_id) - 1 AS r, len(embedding) // {PARTS} AS width
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
places AS MATERIALIZED (
  SELECT r, (i - 1) // width AS part, (i - 1) % width AS place, floor({SCALE} * e[i]::DOUBLE)::BIGINT AS v
  FROM (SELECT r, e, width, unnest(range(1, len(e) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, r AS entry, place, v AS c FROM places WHERE r < {ENTRIES}),
{",".join(steps)},
coded AS (
  SELECT r, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(far)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


@query("op12_active_lloyd", _op12_sql())
def op12_active_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with their codes and the errors of these."""
    return coded_vectors(table(spark, sf_dir, "embeddings"))


OP13_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
grouped AS (SELECT DISTINCT lang, source FROM docs),
counted AS MATERIALIZED (
  SELECT lang, source, term, sum(n)::BIGINT AS n, count(*) AS documents
  FROM (SELECT r, lang, source, term, count(*) AS n
        FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs)
        GROUP BY ALL)
  GROUP BY ALL),
kept AS MATERIALIZED (
  SELECT lang, term, sum(n)::BIGINT AS n FROM counted GROUP BY ALL HAVING sum(documents) >= {MIN_DOCUMENTS}),
langs AS (
  SELECT l.lang, count(term) AS v, coalesce(sum(n), 0)::BIGINT AS total
  FROM (SELECT DISTINCT lang FROM grouped) l LEFT JOIN kept USING (lang) GROUP BY ALL),
cells AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM grouped g JOIN kept k USING (lang) LEFT JOIN counted c
    ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT lang, source, sum(n)::BIGINT AS total FROM cells GROUP BY ALL),
shares AS MATERIALIZED (
  SELECT c.lang, c.source, term, n, 1 + (1000000000 * (n + 2)) // (s.total + 2 * v) AS p,
         1 + (1000000000 * (lang_n + 2)) // (l.total + 2 * v) AS q
  FROM cells c JOIN sums s ON c.lang = s.lang AND c.source = s.source JOIN langs l ON c.lang = l.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0)::BIGINT AS value
  FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS f
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) m
  ON m.lang = a.lang AND m.source = a.source AND m.item = b.source),
overused AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM overused
QUALIFY rank <= {TOP_TERMS}
"""


@query("op13_source_audit", OP13_SQL)
def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources with the other sources of their language and their overused terms."""
    return audited(table(spark, sf_dir, "documents"))

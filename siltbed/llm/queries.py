"""Registered queries of the operators, each over its whole table, and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm import (
    bpe, cap_filters, conversations, fingerprints, forest, hilbert, line_spread, mixing, negatives, parity_join,
    quality_model, suffix_dedup, token_counts,
)
from siltbed.llm.common import parquet
from siltbed.registry.base import Registry

R = Registry()

SHARDS = 24
TOKENIZER = "byte_bpe_50k.json"


def vocabulary() -> str:
    """Path of the public vocabulary file; it has the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@R.query("op1_hilbert_shards")
def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    meta = docs.select(
        "doc_id", "lang", "source",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    dealt = hilbert.hilbert_shards(meta, ["lang", "source", "size"], SHARDS, "doc_id", ["text_crc32"])
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )


# The domain of a source and the weights of the tree are parameters of a mix, stated as rules.
def _number(source: Column) -> Column:
    return F.coalesce(F.regexp_extract(source, "([0-9]+)", 1).try_cast("int"), F.lit(0))


def mix_levels() -> dict[str, Column]:
    number = _number(F.coalesce("source", F.lit("")))
    return {
        "domain": F.when(number % 3 == 0, "web").when(number % 3 == 1, "books").otherwise("forum"),
        "lang": F.col("lang"),
        "source": F.col("source"),
    }


def mix_weights() -> list[Column]:
    domain, lang = F.col("mix_domain"), F.col("mix_lang")
    return [
        F.when(domain == "web", 5).when(domain == "books", 3).otherwise(2),
        F.when(lang == "en", 6).when(lang.isin("de", "fr"), 2).otherwise(1),
        1 + _number(F.col("mix_source")) % 4,
    ]


MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.9, 2, 17


def mixed(docs: DataFrame) -> DataFrame:
    return mixing.mix(docs, mix_levels(), mix_weights(), MIX_SHARE, epochs=MIX_EPOCHS, seed=MIX_SEED)


def _level_sql(depth: int, levels: list[str]) -> str:
    """One level of the budget tree: children of ``plan<depth>`` share its budgets."""
    node, at = levels[depth], ", ".join(levels[: depth + 1])
    over = ", ".join(levels[:depth])
    part = f"PARTITION BY {over}" if over else ""
    join = f"JOIN plan{depth} p USING ({over})" if over else f"CROSS JOIN plan{depth} p"
    room = f"{part} ORDER BY lim::DOUBLE / weight, {node}"
    return f"""
c{depth} AS (SELECT {at}, sum(tokens * {MIX_EPOCHS})::BIGINT AS lim, max(w_{node})::BIGINT AS weight
  FROM leaves GROUP BY {at}),
r{depth} AS (SELECT c.*, least(p.budget, sum(lim) OVER ({part}))::BIGINT AS total,
    coalesce(sum(lim) OVER ({room} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS used,
    sum(weight) OVER ({room} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rest
  FROM c{depth} c {join}),
f{depth} AS (SELECT *, lim * rest <= weight * (total - used) AS is_full FROM r{depth}),
o{depth} AS (SELECT *, sum(CASE WHEN is_full THEN lim ELSE 0 END) OVER ({part})::BIGINT AS full_lim,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part})::BIGINT AS open_weight FROM f{depth}),
g{depth} AS (SELECT *, CASE WHEN is_full THEN lim
    ELSE least((weight * (total - full_lim)) // open_weight, lim) END AS given FROM o{depth}),
l{depth} AS (SELECT *, total - sum(given) OVER ({part}) AS lost,
    row_number() OVER ({part} ORDER BY (given < lim)::INT DESC, {node}) AS turn FROM g{depth}),
plan{depth + 1} AS (SELECT {at}, (given + (CASE WHEN given < lim AND turn <= lost THEN 1 ELSE 0 END))::BIGINT AS budget
  FROM l{depth})"""


def mix_sql() -> str:
    levels = ["domain", "lang", "source"]
    return rf"""
WITH d AS (SELECT doc_id, coalesce(try_cast(nullif(regexp_extract(source, '([0-9]+)', 1), '') AS INT), 0) AS num,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents),
e AS (SELECT *, CASE num % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' ELSE 'forum' END AS domain FROM d),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens,
    CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END AS w_domain,
    CASE WHEN lang = 'en' THEN 6 WHEN lang IN ('de', 'fr') THEN 2 ELSE 1 END AS w_lang,
    1 + max(num) % 4 AS w_source FROM e GROUP BY domain, lang, source),
plan0 AS (SELECT floor(sum(tokens) * {MIX_SHARE})::BIGINT AS budget FROM leaves),
{", ".join(_level_sql(i, levels) for i in range(3))},
cut AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE budget END AS part FROM leaves JOIN plan3 USING (domain, lang, source)),
drawn AS (SELECT e.*, whole, part, md5('{MIX_SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, '')) AS ord
  FROM e JOIN cut USING (domain, lang, source)),
taken AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY ord, doc_id::VARCHAR
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  - sum(n_tokens) OVER (PARTITION BY domain, lang, source, ord, doc_id) AS before FROM drawn)
SELECT doc_id, domain AS mix_domain, lang AS mix_lang, source AS mix_source, n_tokens,
    (whole + CASE WHEN before < part THEN 1 ELSE 0 END)::BIGINT AS copies FROM taken"""


@R.query("op2_mix_sources", mix_sql())
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixed(docs).select("doc_id", "mix_domain", "mix_lang", "mix_source", "n_tokens", "copies")


@R.query("op3_difference_cover_dedup")
def op3_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.drop_repeated_bytes(parquet(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@R.query("op4_weighted_fingerprints")
def op4_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_likeness(parquet(spark, sf_dir, "documents"))


@R.query("op5_spherical_cap_dedup")
def op5_spherical_cap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(parquet(spark, sf_dir, "embeddings"), 0.95)


@R.query("op6_parity_sketch_join")
def op6_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_documents(parquet(spark, sf_dir, "documents"))


@R.query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels)
    scored = quality_model.quality_scores(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality_model.held_out("doc_id").alias("held_out"), "score", "predicted")


def sample_edits(text: Column) -> Column:
    """Three edits that depend on the text: replace in the first third, insert in the middle, delete near the end."""
    n = F.length(text)

    def edit(start: Column, length: int, insert: Column) -> Column:
        return F.struct(
            start.cast("long").alias("start"), F.lit(length).cast("long").alias("length"), insert.alias("insert")
        )

    return F.array(
        edit(F.floor(n / 3), 12, F.substring(text, 1, 20)),
        edit(F.floor(n / 2), 0, F.lit(" (revised) ")),
        edit(F.floor(n * 4 / 5), 5, F.lit("")),
    )


@R.query("op8_edit_aware_token_counts")
def op8_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.withColumn("edits", sample_edits(F.col("text")))
    return token_counts.edited_token_counts(rows, vocabulary())


def encoded(docs: DataFrame) -> DataFrame:
    """Digests of the ids of every text and of the text decoded from them."""
    back = bpe.bpe_encode(docs.select("doc_id", "text"), vocabulary(), decoded="decoded")
    return back.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@R.query("op9_forced_boundary_bpe")
def op9_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(parquet(spark, sf_dir, "documents"))


MIN_SITES = 10

LINE_SQL = f"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
s AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
h AS (SELECT l.*, s.line IS NOT NULL AS spread FROM l LEFT JOIN s USING (line)),
d AS (SELECT doc_id, text, count(*) AS n_lines, count(*) FILTER (spread) AS hits,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT spread), '') AS rest FROM h GROUP BY doc_id, text)
SELECT o.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(hits, 0)::BIGINT AS n_removed,
    md5(CASE WHEN hits = 0 THEN d.text ELSE rest END) AS kept_md5
FROM documents o LEFT JOIN d ON o.doc_id = d.doc_id AND o.text = d.text"""


@R.query("op10_line_spread", LINE_SQL)
def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents").select("doc_id", "source", "text")
    kept = line_spread.drop_spread_lines(docs, min_sites=MIN_SITES)
    return kept.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


NEGATIVES_SQL = """
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS y FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_dot_product(a.y, b.y)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS "rank", other_id AS negative_id,
    positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10"""


@R.query("op11_angular_negatives", NEGATIVES_SQL)
def op11_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parquet(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


@R.query("op12_forest_search")
def op12_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(parquet(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


# The repair by another way, as a check: the grammar is a machine of four states (0 at the start, then the last
# role), and each state keeps its cheapest and least audit from turn to turn.
REPAIR_SQL = r"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS k FROM conversations),
coded AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM keyed, crc_table),
damaged AS (SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded WHERE code <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged),
faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS ini FROM placed),
moves(state, ch, nxt) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts(state, nxt, n, chs) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 1, 'u'),
  (1, 2, 1, 'u'), (2, 3, 1, 'a'), (3, 2, 1, 'u'), (0, 3, 2, 'ua'), (1, 3, 2, 'ua')),
names(ch, name) AS (VALUES ('u', 'user'), ('a', 'assistant')),
steps AS (
  SELECT i.state, m.nxt, 3 * i.n AS cost, repeat('I', i.n) AS letters, i.chs, m.ch, 'K' AS edit FROM inserts i JOIN moves m ON m.state = i.nxt
  UNION ALL SELECT i.state, m.nxt, 3 * i.n + 3, repeat('I', i.n), i.chs, m.ch, 'R' FROM inserts i JOIN moves m ON m.state = i.nxt AND m.ch <> 's'
  UNION ALL SELECT state, nxt, 3 * n + 4, repeat('I', n), chs, NULL, 'D' FROM inserts),
walk AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, ''::VARCHAR AS done FROM faulty
  UNION ALL
  SELECT conv_id, i, nxt, c, a, d FROM (
    SELECT w.conv_id, f.i, s.nxt, w.cost + s.cost + CASE WHEN f.fault = 'truncated' AND s.edit <> 'D' THEN 3 ELSE 0 END AS c,
      w.audit || s.letters || s.edit AS a,
      w.done || CASE s.chs WHEN 'u' THEN E'
user:' WHEN 'a' THEN E'
assistant:' WHEN 'ua' THEN E'
user:
assistant:' ELSE '' END
        || CASE s.edit WHEN 'K' THEN E'
' || f.role || ':' || f.text
           WHEN 'R' THEN E'
' || CASE s.ch WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text ELSE '' END AS d
    FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN steps s ON s.state = w.state
    WHERE s.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (s.edit = 'R' OR s.ch = f.ini))
  QUALIFY row_number() OVER (PARTITION BY conv_id, nxt ORDER BY c, a) = 1),
ended AS (SELECT w.conv_id, w.cost + 3 * s.n AS cost, w.audit || repeat('I', s.n) AS audit,
    w.done || CASE s.chs WHEN 'u' THEN E'
user:' WHEN 'a' THEN E'
assistant:' WHEN 'ua' THEN E'
user:
assistant:' ELSE '' END AS done
  FROM walk w JOIN (SELECT conv_id, max(i) AS last FROM faulty GROUP BY 1) l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.last = w.i
  JOIN inserts s ON s.state = w.state AND s.nxt IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 3 * s.n, w.audit || repeat('I', s.n)) = 1),
pairs AS (SELECT conv_id, ini || lead(ini) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM faulty),
wrong AS (SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated FROM faulty GROUP BY 1)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
  coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
  coalesce(w.illegal, 0)::BIGINT AS illegal, coalesce(e.cost, 0)::BIGINT AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(substr(e.done, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN wrong w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""


@R.query("op13_turn_repair", REPAIR_SQL)
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = parquet(spark, sf_dir, "conversations")
    summary, repaired = conversations.repair_conversations(conversations.damaged(table))
    digests = conversations.turn_digests(repaired).withColumnsRenamed({"conv": "_d"})
    rows = table.select("conv_id").distinct()
    rows = rows.join(summary, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    rows = rows.join(digests, F.col("conv_id").eqNullSafe(F.col("_d")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return rows.select(
        "conv_id",
        *[F.when(F.col("audit").isNull(), F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

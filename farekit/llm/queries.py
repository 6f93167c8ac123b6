"""The training-data operators as registered queries, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farekit.catalog.registry import Query
from farekit.llm import audit, centroids, decontaminate, extract, hpyp, langid, mixing, quality, repair, repeats, sharding, simhash, toxicity
from farekit.llm.columns import fold
from farekit.session import scratch_path, stage

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_hpyp_score")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = hpyp.score_texts(docs, fold(F.col("doc_id"), 7) != 2)
    return scored.select(
        "doc_id", (~F.col("in_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "perplexity",
    )


@query("op2_extract_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.with_text(pages).select("page_id", "url", "text", "n_chars")


@query("op3_language")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    found = langid.with_language(docs.select("doc_id", "text"), docs.where(~held_out).select("text", "lang"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op4_simhash_groups")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.grouped(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS weight
  FROM totals),
filled AS (SELECT *, source_size * 2.0::DOUBLE / weight AS full_at FROM weighted),
ranked AS (
  SELECT *, sum(source_size) OVER (ORDER BY full_at RANGE UNBOUNDED PRECEDING)::DOUBLE * 2.0 AS full_below,
         sum(weight) OVER () - sum(weight) OVER (ORDER BY full_at RANGE UNBOUNDED PRECEDING) AS open_above,
         sum(source_size) OVER ()::DOUBLE * 1.5 AS wanted
  FROM filled),
marked AS (SELECT *, full_below + open_above * full_at <= wanted AS is_full FROM ranked),
levels AS (
  SELECT *, (wanted - sum(CASE WHEN is_full THEN source_size ELSE 0 END) OVER ()::DOUBLE * 2.0)
            / nullif(sum(CASE WHEN is_full THEN 0.0 ELSE weight END) OVER (), 0) AS level
  FROM marked),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN source_size * 2.0::DOUBLE ELSE weight * level END AS target FROM levels),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(t.target / nullif(t.source_size, 0), 0.0) AS rate,
         CAST('0x' || md5(concat_ws(':', 'mix-1', coalesce(CAST(s.doc_id AS VARCHAR), ''), md5(coalesce(s.text, ''))))[1:12] AS BIGINT)
           / 281474976710656.0::DOUBLE AS chance
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""


@query("op5_mix_sources", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op6_shard")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    body = F.coalesce(F.col("text"), F.lit(""))
    digests = docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    placed = sharding.shard(digests, key=("doc_id", "text_crc32"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    repair.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return repair.token_index(spark, path)


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0).select("doc_id", "toxic")
    scored = toxicity.with_toxicity(docs, labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_VALUES_SQL = """CASE rule WHEN 'symbols_per_word' THEN n_symbols WHEN 'repeated_share' THEN n_repeat_words
  WHEN 'dup_lines_per_word' THEN n_dup_lines ELSE word_chars END / nullif(n_words, 0)::DOUBLE"""
_CUTOFFS_SQL = ", ".join(
    f"('{rule.name}', {i}, {cutoff!r}::DOUBLE)" for rule in quality.RULES for i, cutoff in enumerate(rule.cutoffs, 1)
)
_N_RULES = len(quality.RULES)

OP10_SQL = rf"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
placed AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
windows AS (
  SELECT row, i, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM placed WINDOW w AS (PARTITION BY row ORDER BY i)),
repeated AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS n FROM windows WHERE c IS NOT NULL) WHERE n > 1),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS t(k) GROUP BY row),
counted AS (
  SELECT split.row, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (row)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
cutoffs AS (SELECT * FROM (VALUES {_CUTOFFS_SQL}) AS t(rule, step, cutoff)),
holdout AS (SELECT * FROM based JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IN (0, 1)),
rejected AS (
  SELECT lang, rule, step, cutoff, count(*) FILTER (WHERE quality = 1) AS n,
         count(*) FILTER (WHERE quality = 1 AND {_VALUES_SQL} >= cutoff) AS k,
         count(*) FILTER (WHERE quality = 0 AND {_VALUES_SQL} >= cutoff) AS hits
  FROM holdout, cutoffs GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k >= n THEN 1.0 ELSE least(1.0, (
           SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({quality.RISK / _N_RULES!r}::DOUBLE)
                          + (n - i) * ln(1 - {quality.RISK / _N_RULES!r}::DOUBLE)))
           FROM range(k + 1) AS r(i))) END
         <= {quality.ERROR!r}::DOUBLE / ({_N_RULES} * (SELECT count(*) FROM (SELECT DISTINCT lang FROM rejected))) AS passes
  FROM rejected),
certified AS (
  SELECT *, bool_and(passes) OVER (PARTITION BY lang, rule ORDER BY step) AS certified FROM tested),
chosen AS (SELECT lang, rule, arg_max(cutoff, step) AS cutoff FROM certified WHERE certified AND hits > k GROUP BY lang, rule),
failed AS (
  SELECT row, {", ".join(f"coalesce(bool_or(rule = '{r.name}' AND {_VALUES_SQL} >= cutoff), false) AS f{i}" for i, r in enumerate(quality.RULES))}
  FROM based JOIN chosen ON chosen.lang IS NOT DISTINCT FROM based.lang GROUP BY row),
named AS (
  SELECT row, concat_ws(',', {", ".join(f"CASE WHEN f{i} THEN '{r.name}' END" for i, r in enumerate(quality.RULES))}) AS failed_rules
  FROM failed)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(failed_rules, '') = '' AS kept, coalesce(failed_rules, '') AS failed_rules
FROM based LEFT JOIN named USING (row)
"""


@query("op10_quality_rules", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality.with_counts(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    counted = stage(counted.drop("text"), "quality-counted")
    cutoffs = quality.certified_cutoffs(counted, table(spark, sf_dir, "labels"))
    verdict = quality.judged(counted, cutoffs)
    return verdict.select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules")
    )


_BIT_SQL = "1 << (ascii(step_filter) - 65)"

OP11_SQL = rf"""
WITH split AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM split GROUP BY text),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
masked AS (
  SELECT part,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(split.text) - length(regexp_replace(split.text, '[A-Z]', '', 'g'))) > 5 * length(split.text)
                THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(split.text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN split.doc_id > first THEN 16 ELSE 0 END AS mask,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM split JOIN firsts ON firsts.text = split.text LEFT JOIN marks ON marks.doc_id = split.doc_id),
counted AS (SELECT part, mask, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS step_filter,
         list_sum([0] || [1 << (ascii(x) - 65) FOR x IN string_split(substr(filter_order, 1, step - 1), '') IF x <> '']) AS earlier
  FROM orders, range(1, 6) AS r(step)),
summed AS (
  SELECT part, filter_order, step, step_filter,
         sum(docs) FILTER (WHERE mask & (CAST(earlier AS BIGINT) | ({_BIT_SQL})) = 0) AS kept,
         sum(docs) FILTER (WHERE mask & CAST(earlier AS BIGINT) = 0 AND mask & ({_BIT_SQL}) <> 0) AS removed,
         sum(docs) FILTER (WHERE mask & CAST(earlier AS BIGINT) <> 0 AND mask & ({_BIT_SQL}) <> 0) AS redundant,
         sum(docs) FILTER (WHERE mask = ({_BIT_SQL})) AS unique_fails,
         sum(good) FILTER (WHERE mask & CAST(earlier AS BIGINT) = 0 AND mask & ({_BIT_SQL}) <> 0) AS good_lost,
         sum(toxic) FILTER (WHERE mask & CAST(earlier AS BIGINT) = 0 AND mask & ({_BIT_SQL}) <> 0) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, step_filter)
SELECT part, filter_order, step,
       {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, step_filter), 0) AS BIGINT) AS shapley
FROM summed
"""


@query("op11_filter_interactions", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _kmeans_sql(rounds: int) -> str:
    """The rounds written out one after the other; distances of whole numbers below 2^53 are exact in doubles."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor(1024 * CAST(v AS DOUBLE)) FOR v IN embedding] AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len([v FOR v IN embedding IF v IS NULL OR NOT isfinite(v)]) = 0)""",
        """c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY digest NULLS LAST, x) - 1 AS k, x
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS digest, x FROM kept ORDER BY digest NULLS LAST, x LIMIT 8))""",
    ]
    near = """near{i} AS MATERIALIZED (
  SELECT row, min(CAST(list_dot_product(kept.x, kept.x) - 2 * list_dot_product(kept.x, c.x) + list_dot_product(c.x, c.x) AS BIGINT)
                  * 8 + k) AS code
  FROM kept, c{i} c GROUP BY row)"""
    moved = """c{j} AS MATERIALIZED (
  SELECT k, coalesce(m.x, c.x) AS x
  FROM c{i} c LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY d) AS x
    FROM (SELECT code % 8 AS k, d, CAST(sum(CAST(kept.x[d] AS BIGINT)) AS BIGINT) AS s, count(*) AS n
          FROM near{i} JOIN kept USING (row), range(1, 65) AS r(d) GROUP BY code % 8, d)
    GROUP BY k) m USING (k))"""
    for i in range(rounds):
        steps += [near.format(i=i), moved.format(i=i, j=i + 1)]
    steps.append(near.format(i=rounds))
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, CAST(code % 8 AS INTEGER) AS cluster, code // 8 AS distance,
       CAST(sum(code // 8) OVER (PARTITION BY code % 8) AS BIGINT) AS cluster_inertia,
       CAST(sum(code // 8) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(v AS BIGINT) FOR v IN c.x], ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (row) JOIN c{rounds} c ON c.k = code % 8
"""


OP12_SQL = _kmeans_sql(centroids.ROUNDS)


@query("op12_centroid_clusters", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


# Bytes as pairs of hexadecimal digits.
OP13_SQL = """
WITH raw AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT row, doc_id, p, substr(h, 2 * p + 1, 100) AS string
  FROM (SELECT row, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM raw WHERE len(h) >= 100)),
firsts AS (SELECT string, min(doc_id) AS first FROM strings GROUP BY string HAVING count(*) > 1),
later AS (SELECT row, p FROM strings JOIN firsts USING (string) WHERE doc_id > first),
marked AS (SELECT row, p, CASE WHEN p <= lag(p) OVER (PARTITION BY row ORDER BY p) + 50 THEN 0 ELSE 1 END AS opens FROM later),
numbered AS (SELECT row, p, sum(opens) OVER (PARTITION BY row ORDER BY p) AS span FROM marked),
spans AS (SELECT row, span, min(p) AS b, max(p) + 50 AS e FROM numbered GROUP BY row, span),
pieces AS (
  SELECT row, span, substr(h, 2 * lag(e, 1, 0) OVER w + 1, 2 * (b - lag(e, 1, 0) OVER w)) AS piece, e - b AS gone
  FROM spans JOIN raw USING (row) WINDOW w AS (PARTITION BY row ORDER BY span)),
joined AS (
  SELECT row, string_agg(piece, '' ORDER BY span) AS before, CAST(sum(gone) AS BIGINT) AS n_removed, count(*) AS n_spans
  FROM pieces GROUP BY row),
ends AS (SELECT row, max(e) AS e FROM spans GROUP BY row)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(e, 0) + 1))) AS kept_sha256
FROM raw LEFT JOIN joined USING (row) LEFT JOIN ends USING (row)
"""


@query("op13_without_repeats", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("begins", "ends", lambda b, e: e - b), F.lit(0).cast("long"), lambda a, x: a + x)
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("begins").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

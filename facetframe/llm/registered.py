"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from facetframe.llm import (
    ann,
    audit,
    chat,
    decontam,
    langid,
    lines,
    lm,
    minhash,
    packing,
    rules,
    sharding,
    spelling,
    warc,
)
from facetframe.llm.queries import query, table

# The conversation that every run formats besides the table: its texts hold the template's strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def _sql_escape(text: str, role: bool = False) -> str:
    for raw, code in chat.ROLE_CODES if role else chat.CODES:
        raw = f"'{raw}'" if raw != "\n" else "chr(10)"
        text = f"replace({text}, {raw}, '{code}')"
    return text


@query(
    f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'),
sized AS (
  SELECT *, sum(15 + length({_sql_escape("role", role=True)}) + length({_sql_escape("text")}))
    OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chars,
    row_number() OVER (PARTITION BY conv_id
                       ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars) FILTER (WHERE role = 'assistant' OR back = 1)::BIGINT AS formatted_chars,
  count(*) FILTER (WHERE role = 'assistant' OR back = 1) AS n_examples
FROM sized GROUP BY conv_id"""
)
def op1_prefix_targets(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], turns.schema
    )
    return chat.conversation_digests(chat.format_examples(turns.unionByName(control)))


@query()
def op2_best_two_fit(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query()
def op3_log_bilinear_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", lm.held_out(F.col("doc_id")))
    return lm.score_texts(docs, docs.filter(~F.col("held_out")))


@query()
def op4_collision_counting(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


@query()
def op5_warc_index(spark, sf_dir):
    # The table has no capture times: they follow from the id.
    second = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9)) + 1_704_067_200
    time = F.expr("timestamp_ntz '1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), second.cast("decimal(18,6)")
    )
    iso = F.concat(F.replace(time.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    pages = table(spark, sf_dir, "pages").withColumn("time", iso)
    return warc.archive_and_index(pages, min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "time",
        "range", "rank",
    )


@query()
def op6_segment_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = lines.line_counts(docs, edits=2, min_chars=40, exact_chars=1)
    dropped = F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped_lines")
    return found.select("doc_id", "n_lines", "n_dropped", "n_links", dropped)


@query()
def op7_positional_decontamination(spark, sf_dir):
    found = decontam.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "near_items",
    )


@query()
def op8_best_fit_shards(spark, sf_dir):
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op9_byte_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out(F.col("doc_id")))
    labelled = docs.filter(~F.col("held_out")).select("doc_id", "text", "lang")
    found = langid.predict_languages(docs.select("doc_id", "held_out", "text"), labelled)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op10_min_max_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


_RULE_SQL = {
    "length": ("n_words >= 50", "n_words < 20"),
    "word_length": (
        "word_chars / greatest(n_words, 1) BETWEEN 3 AND 9",
        "n_words > 0 AND NOT word_chars / greatest(n_words, 1) BETWEEN 2.5 AND 12",
    ),
    **{
        name: tuple(f"{least} AND {part} / greatest({whole}, 1) {op}" for op in (f"<= {good}", f">= {bad}"))
        for name, part, whole, good, bad, least in [
            ("symbols", "n_symbols", "n_words", 0.02, 0.1, "n_words >= 1"),
            ("capitals", "n_capitals", "n_letters", 0.15, 0.3, "n_letters >= 1"),
            ("letters", "n_other", "word_chars", 0.1, 0.25, "n_words >= 1"),
            ("shouts", "n_shouts", "n_words", 0.02, 0.1, "n_words >= 1"),
            ("repeated_lines", "n_dup_lines", "n_lines", 0.05, 0.3, "n_lines >= 2"),
            ("repeated_words", "n_repeat_words", "n_words", 0.05, 0.2, "n_words >= 16"),
            ("bare_words", "n_bare_words", "n_words", 0.02, 0.1, "n_words >= 1"),
            ("variety", "n_same_words", "n_words", 0.6, 0.8, "n_words >= 20"),
        ]
    },
}
_VOTES_SQL = ", ".join(
    f"CASE WHEN {good} THEN 1 WHEN {bad} THEN 0 END" for good, bad in _RULE_SQL.values()
)


def _off(text: str, pattern: str) -> str:
    return f"length(regexp_replace({text}, '{pattern}', '', 'g'))"


@query(
    rf"""WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l,
    regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid FROM docs),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words)),
again AS (
  SELECT r, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
repeats AS (
  SELECT r, sum(least(8, coalesce(next - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM again) GROUP BY r),
counted AS (
  SELECT words.r, doc_id, len(w) AS n_words, length(solid) AS word_chars,
    length(solid) - {_off("solid", "[#*$%&|<>]")} AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(l) AS n_lines, {_off("solid", "[^\\p{L}\\p{M}]+")} AS n_letters,
    length(solid) - {_off("solid", "[A-Z]")} AS n_capitals,
    length(solid) - {_off("solid", "[^\\p{L}\\p{M}]+")} AS n_other,
    length(solid) - {_off("solid", "!")} AS n_shouts,
    len(w) - len(list_distinct(w)) AS n_same_words,
    len(list_filter(w, lambda x: NOT regexp_matches(x, '[\p{{L}}\p{{N}}]'))) AS n_bare_words
  FROM words LEFT JOIN repeats ON words.r = repeats.r),
voted AS (SELECT *, [{_VOTES_SQL}] AS v FROM counted),
patterns AS (SELECT row_number() OVER (ORDER BY v) AS p, v, count(*)::DOUBLE AS n FROM voted GROUP BY v),
cells AS (SELECT p, n, j, v[j] AS vote FROM patterns, (SELECT unnest(range(1, {len(_RULE_SQL) + 1})) AS j)),
believed AS (SELECT 0.1 * sum(n) AS w, sum(n) AS docs FROM patterns),
fitted(round, j, share, good, bad) AS (
  SELECT 0, j, 0.85::DOUBLE, 0.99::DOUBLE, 0.4::DOUBLE
  FROM (SELECT unnest(range(1, {len(_RULE_SQL) + 1})) AS j)
  UNION ALL
  SELECT round + 1, j, share, good, bad FROM (
    WITH split AS (
      SELECT p, any_value(n) AS n, any_value(round) AS round,
        1 / (1 + exp(-(ln(any_value(share) / (1 - any_value(share))) + sum(
          CASE vote WHEN 1 THEN ln(good / (1 - bad)) WHEN 0 THEN ln((1 - good) / bad) ELSE 0 END)))) AS q
      FROM cells JOIN fitted USING (j) GROUP BY p)
    SELECT any_value(round) AS round, j,
      (0.85 * (any_value(w) + 1) + any_value(g)) / (any_value(w) + 1 + any_value(docs)) AS share,
      (0.99 * (any_value(w) * 0.85 + 1) + coalesce(sum(cells.n * q) FILTER (WHERE vote = 1), 0))
        / (any_value(w) * 0.85 + 1 + coalesce(sum(cells.n * q) FILTER (WHERE vote IS NOT NULL), 0)) AS good,
      (0.4 * (any_value(w) * 0.15 + 1) + coalesce(sum(cells.n * (1 - q)) FILTER (WHERE vote = 0), 0))
        / (any_value(w) * 0.15 + 1 + coalesce(sum(cells.n * (1 - q)) FILTER (WHERE vote IS NOT NULL), 0)) AS bad
    FROM cells JOIN split USING (p), believed, (SELECT sum(n * q) AS g FROM split)
    GROUP BY j) WHERE round < 40),
model AS (SELECT j, share, good, bad FROM fitted WHERE round = 40),
judged AS (
  SELECT p, 1 / (1 + exp(-(ln(any_value(share) / (1 - any_value(share))) + sum(
    CASE vote WHEN 1 THEN ln(good / (1 - bad)) WHEN 0 THEN ln((1 - good) / bad) ELSE 0 END)))) AS q
  FROM cells JOIN model USING (j) GROUP BY p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND q >= 0.5 AS kept
FROM voted JOIN patterns ON patterns.v IS NOT DISTINCT FROM voted.v JOIN judged USING (p)"""
)
def op11_weak_supervision(spark, sf_dir):
    return rules.quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", *rules.COUNTS, "base_failed", "kept"
    )


@query(
    r"""WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
words AS (
  SELECT doc_id, part, text, first,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM docs JOIN firsts USING (text)),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {'A': len(w) < 50,
    'B': 100 * len(list_distinct(w)) < 65 * len(w),
    'C': 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > first, false)} AS fails
  FROM words LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
classes AS (
  SELECT part, [k for k in ['A', 'B', 'C', 'D', 'E'] if struct_extract(fails, 'A') AND k = 'A'
      OR struct_extract(fails, 'B') AND k = 'B' OR struct_extract(fails, 'C') AND k = 'C'
      OR struct_extract(fails, 'D') AND k = 'D' OR struct_extract(fails, 'E') AND k = 'E'] AS failed,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM masked GROUP BY ALL),
removals AS (
  SELECT part, o, failed, n, good, toxic,
    coalesce(list_min(list_transform(failed, lambda f: strpos(o, f))), 6) AS gone FROM classes, orders),
steps AS (SELECT unnest([1, 2, 3, 4, 5]) AS step),
counted AS (
  SELECT part, o, step, o[step] AS f, sum(n) FILTER (WHERE gone > step) AS kept,
    sum(n) FILTER (WHERE gone = step) AS removed,
    sum(n) FILTER (WHERE gone < step AND list_contains(failed, o[step])) AS redundant,
    sum(n) FILTER (WHERE failed = [o[step]]) AS unique_fails,
    sum(good) FILTER (WHERE gone = step) AS good_lost, sum(toxic) FILTER (WHERE gone = step) AS toxic_lost
  FROM removals, steps GROUP BY ALL)
SELECT part, o AS filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
  coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM counted"""
)
def op12_removal_ranks(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return audit.removal_audit(audit.filter_masks(documents, labels))


@query()
def op13_one_edit_composition(spark, sf_dir):
    return spelling.spelling_groups(spelling.planted_words(table(spark, sf_dir, "documents")))

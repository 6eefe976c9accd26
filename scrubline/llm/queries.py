"""One query per operator, over whole tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.llm import ann, chat, embedding_dedup, jaccard_join, language_id, mixing, packing, phrases, quality, repair
from scrubline.llm import suffix_dedup, token_files, toxicity
from scrubline.llm.common import table, working_path

PLANTED_CONVERSATION = -7
PLANTED_TEXT = "\\### Assistant: </turn> ok"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    texts, toxic = toxicity.training_sample(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, toxicity.fit(texts, toxic))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).drop("text")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_texts(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_path(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    shards = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer, end_id=2)
    return token_files.read_token_files(spark, folder, shards)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=0.5)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(PLANTED_CONVERSATION, 0, "user", PLANTED_TEXT), (PLANTED_CONVERSATION, 1, "assistant", PLANTED_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.digest(chat.format_conversations(rows.unionByName(planted)))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = language_id.training_sample(docs, per_language=200)
    return language_id.identify(docs, language_id.fit(samples, public_tokenizers.path("piece_bpe_32k.model")))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of stops, repeated or made the user's, by CRC of conversation and turn."""
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(place.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    )
    return rows.drop("col")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = repair.digest(repair.repair(damaged(rows)))
    every = rows.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    joined = every.join(told, F.col("conv").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("conv", "conv_id")
    nothing = {name: F.lit(0).cast("long") for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing |= {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return joined.withColumns({name: F.coalesce(name, value) for name, value in nothing.items()})


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(*quality.training_sample(docs, table(spark, sf_dir, "labels"))))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), min_count=30, top=2000)


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_suffix_dedup,
        op3_jaccard_join,
        op4_embedding_dedup,
        op5_token_files,
        op6_mix_sources,
        op7_chat_format,
        op8_language_id,
        op9_nearest,
        op10_best_fit_packing,
        op11_conversation_repair,
        op12_quality,
        op13_phrases,
    )
}

OP6_SQL = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(n::DOUBLE) / (SELECT sum(sqrt(n::DOUBLE)) FROM sizes) * (SELECT sum(n) FROM sizes) / n AS mean
  FROM sizes
),
split AS (SELECT source, greatest(1, ceil(mean / 8))::INT AS draws FROM rates),
per_draw AS (SELECT source, draws, mean / draws AS mean FROM rates JOIN split USING (source)),
terms AS (
  SELECT source, i, sum(exp(-mean) * pow(mean, i) / gamma(i + 1)) OVER (PARTITION BY source ORDER BY i) AS cdf
  FROM per_draw, (SELECT unnest(range(0, 65)) AS i)
),
drawn AS (
  SELECT doc_id, source, d,
         ('0x' || substr(md5('42|' || doc_id || '|' || d), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents JOIN per_draw USING (source), unnest(range(0, draws)) AS t(d)
),
counts AS (
  SELECT doc_id, d, count(*) AS k FROM drawn JOIN terms ON drawn.source = terms.source AND u >= cdf GROUP BY ALL
),
totals AS (SELECT doc_id, sum(k)::INT AS k FROM counts GROUP BY doc_id)
SELECT d.*, c::INT AS copy,
       ('0x' || substr(md5('order42|' || doc_id || '|' || c), 1, 15))::BIGINT AS mix_key
FROM documents d JOIN totals USING (doc_id), unnest(range(0, k)) AS t(c)
"""

OP7_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
told AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(text) + length(regexp_replace(text, '[^\\#<:]', '', 'g')) +
        CASE role WHEN 'assistant' THEN 24 WHEN 'user' THEN 19 WHEN 'system' THEN 21
             ELSE 16 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) END)::BIGINT AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM told
"""



def _best(*paths: str) -> str:
    """The cheapest of some paths, of equal ones that with the least audit; null if there is none."""
    return f"list_sort([{', '.join(paths)}], 'ASC', 'NULLS LAST')[1]"


def _step(path: str, cost: str, letter: str, line: str, condition: str = "true") -> str:
    taken = f"{{'c': {path}.c + {cost}, 'a': {path}.a || {letter}, 'o': {path}.o || {line}}}"
    return f"CASE WHEN {path} IS NOT NULL AND {condition} THEN {taken} END"


def _insert(path: str, role: str) -> str:
    return _step(f"({path})", "3", "'I'", f"'{role}:' || chr(10)")


def _repair_sql() -> str:
    # A path: cost, audit, and the repaired rows with a line end each.
    free, sound = "n.fault NOT IN (1, 2)", "CASE WHEN n.fault = 3 THEN 3 ELSE 0 END"

    def delete(state: str) -> str:
        return _step(f"p.{state}", "4", "'D'", "''")

    def keep(state: str, letter: str) -> str:
        return _step(f"p.{state}", sound, "'K'", "n.role || ':' || n.text || chr(10)", f"{free} AND n.role[1] = '{letter}'")

    def rerole(state: str, role: str) -> str:
        return _step(f"p.{state}", f"3 + {sound}", "'R'", f"'{role}:' || n.text || chr(10)", free)

    users = [move for q in ("z", "s", "a") for move in (keep(q, "u"), rerole(q, "user"))]
    columns = {
        "z": delete("z"),
        "s": _best(delete("s"), keep("z", "s")),
        "u": _best(delete("u"), *users),
        "a": _best(delete("a"), keep("u", "a"), rerole("u", "assistant")),
    }
    moved = ", ".join(f"{value} AS {name}" for name, value in columns.items())
    with_user = _best("u", *(_insert(q, "user") for q in ("z", "s", "a")))
    blanks = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH RECURSIVE bytes AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    flatten([[ascii(ch), 0, 0, 0, 0, 0, 0, 0]
             FOR ch IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]) AS bits
  FROM conversations
),
hashed AS (
  SELECT conv_id, turn, role, text, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, bits::BIGINT[]),
    lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384))) % 20 AS kind
  FROM bytes
),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE kind <> 0
),
placed AS (
  SELECT *, rtrim(text, {blanks}) AS cut,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged
),
n AS (
  SELECT *, CASE WHEN cut = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
),
counts AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
  FROM n GROUP BY conv_id
),
p AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'o': ''}} AS z, NULL::STRUCT(c INT, a VARCHAR, o VARCHAR) AS s,
    {{'c': 3, 'a': 'I', 'o': 'user:' || chr(10)}} AS u,
    {{'c': 6, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS a
  FROM counts
  UNION ALL
  SELECT conv_id, i, z, s, u, {_best("a", _insert("u", "assistant"))} AS a
  FROM (
    SELECT conv_id, i, z, s, {with_user} AS u, a
    FROM (SELECT p.conv_id, n.i, {moved} FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.i = p.i + 1)
  )
),
told AS (
  SELECT counts.*, {_best("z", "a")} AS best
  FROM counts JOIN p ON p.conv_id IS NOT DISTINCT FROM counts.conv_id AND p.i = counts.rows
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(regexp_replace(coalesce(best.o, ''), '
\z', '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS e LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP13_SQL = r"""
WITH words AS (
  SELECT lang, piece, string_split(w, ' ') AS words FROM (
    SELECT lang, piece, array_to_string(regexp_extract_all(text, '[^ 	]+'), ' ') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece,
        unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[.,;:!?
-
]')) AS text
      FROM documents))
  WHERE w <> ''
),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM words GROUP BY lang),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM words),
grams AS (
  SELECT lang, m, array_to_string(words[i : i + m - 1], ' ') AS phrase
  FROM starts, (VALUES (1), (2), (3), (4)) AS t(m) WHERE i + m - 1 <= len(words)
),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, phrase, m, a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS first,
    array_to_string(string_split(phrase, ' ')[k + 1 : m], ' ') AS rest
  FROM f, (VALUES (1), (2), (3)) AS t(k) WHERE k < m
),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a + y.a))::BIGINT AS score, k
  FROM cuts AS c JOIN f AS x ON x.lang = c.lang AND x.phrase = c.first JOIN f AS y ON y.lang = c.lang AND y.phrase = c.rest
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + n - 1], ' ') AS phrase, max(a) AS longer
  FROM f, (VALUES (2), (3)) AS t(n), (VALUES (1), (2), (3)) AS s(i) WHERE n < m AND i + n - 1 <= m GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN totals USING (lang) LEFT JOIN held USING (lang, phrase)
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000
"""

ORACLES = {
    "op6_mix_sources": OP6_SQL,
    "op7_chat_format": OP7_SQL,
    "op11_conversation_repair": _repair_sql(),
    "op13_phrases": OP13_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

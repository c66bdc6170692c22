"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.llm import bpe, chat, decontaminate, html, language, leaks, licences, repair, simhash, substrings, topk, urls, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query(
    "op1_substring_dedup",
    """WITH split AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS key FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM split WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split WHERE len(w) > 0),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_digest(read(spark, sf_dir, "documents"))


_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


def _shingles_sql(table: str, key: str, whole: bool) -> str:
    """Distinct shingles of five words; of items (``whole``) a shorter one is a shingle, of documents all runs of fewer words are."""
    sizes = "CASE WHEN len(w) < 5 THEN [len(w)] ELSE [5] END" if whole else "range(1, 6)"
    return f"""SELECT DISTINCT {key}, k, array_to_string(w[i:i + k - 1], ' ') AS shingle FROM (
    SELECT {key}, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT {key}, w, unnest({sizes}) AS k FROM (SELECT {key}, {_WORDS} AS w FROM {table}) WHERE len(w) >= 1){"" if whole else " WHERE k IN (SELECT k FROM items)"})"""


@query(
    "op2_benchmark_decontamination",
    f"""WITH items AS ({_shingles_sql("benchmark", "item_id", True)}), docs AS ({_shingles_sql("documents", "doc_id", False)}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM docs JOIN items USING (k, shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_shingles""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op3_simhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.component_digest(read(spark, sf_dir, "documents"))


_ESCAPED = "replace(replace(replace(replace(replace({}, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]')"


@query(
    "op4_prefix_target",
    f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
lengths AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 20) OVER w AS so_far
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (WHERE role = 'assistant' OR pos = n) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    table = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return chat.conversation_digest(table.unionByName(added))


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


#: (verdict, host, path), fixed by the contract
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(urls.example_urls(spark))
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, model, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip_digest(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query(
    "op8_exact_top_k",
    """WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    return topk.top_k(table, table.where(F.col("vec_id") % 100 == 0), 10)


_TEMPLATES = licences.BASE + licences.FURTHER
_TEMPLATES_SQL = ", ".join(f"({i}, {t.phrase.split()!r}, '{t.label}', {t.base})" for i, t in enumerate(_TEMPLATES))
_OPENINGS_SQL = ", ".join(f"({i}, {o.text.split()!r}, '{o.label}', {o.key.split()!r}, {licences._key_place(o)})" for i, o in enumerate(licences.OPENINGS))


@query(
    "op9_licence_scan",
    f"""WITH split AS (SELECT doc_id, {_WORDS} AS w FROM documents), templates(id, phrase, label, base) AS (VALUES {_TEMPLATES_SQL}),
openings(id, opening, label, key, key_at) AS (VALUES {_OPENINGS_SQL}),
words AS (SELECT doc_id, w, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split WHERE len(w) > 0),
parts AS (SELECT id, unnest(phrase) AS word FROM templates),
opened AS (SELECT id, unnest(opening) AS word, generate_subscripts(opening, 1) - 1 AS pos FROM openings),
idf AS (SELECT word, count(DISTINCT doc_id) AS df, ln((1 + (SELECT count(*) FROM documents)) / (1.0 + count(DISTINCT doc_id))) + 1 AS x
  FROM (SELECT word FROM parts UNION SELECT word FROM opened) LEFT JOIN words USING (word) GROUP BY word),
rare AS (SELECT id, word, pos, x FROM (SELECT id, word, min(pos) AS pos FROM opened GROUP BY id, word) JOIN idf USING (word) QUALIFY row_number() OVER (PARTITION BY id ORDER BY df, pos) <= {licences.RARE}),
mass AS (SELECT id, sum(x) AS m FROM parts JOIN idf USING (word) GROUP BY id),
heaviest AS (SELECT max(m) AS m FROM (SELECT m FROM mass UNION ALL SELECT sum(x) FROM rare GROUP BY id)),
places AS (SELECT doc_id, label, base, i - 1 AS start, m / (SELECT m FROM heaviest) AS weight
  FROM words JOIN templates ON word = phrase[1] AND w[i:i + len(phrase) - 1] = phrase JOIN mass USING (id)
  UNION ALL
  SELECT doc_id, label, FALSE, i - 1 - key_at, sum(x) / (SELECT m FROM heaviest)
  FROM words JOIN openings o ON word = key[1] AND w[i:i + len(key) - 1] = key JOIN rare ON rare.id = o.id AND i - key_at + rare.pos >= 1 AND w[i - key_at + rare.pos] = rare.word
  GROUP BY doc_id, i, o.id, label, key_at HAVING count(*) >= {licences.AGREE}),
found AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(weight) AS score
  FROM places GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, round(coalesce(score, 0), 6) AS score FROM split LEFT JOIN found USING (doc_id)""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_digest(read(spark, sf_dir, "documents")).withColumn("score", F.round("score", 6))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_digest(read(spark, sf_dir, "documents"))


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "[{}, 0, 0, 0, 0, 0, 0, 0, 0]"
    byte = f"list_reduce({bits.format('xor(c, b)')}, lambda t, k: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda h: CAST(ord(h) AS BIGINT))), lambda c, b: {byte}), 4294967295)"


_DIGITS_62 = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'"
_BASE_62 = "concat(" + ", ".join(f"substr({_DIGITS_62}, CAST(crc // {62**i} % 62 AS INTEGER) + 1, 1)" for i in range(5, -1, -1)) + ")"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: kind, its pattern, and what a match of it must fulfil
_SECRETS = [
    ("assign", "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key") + """)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "len(regexp_extract(m, pattern, 2)) >= 8"),
    ("access", "AKIA[A-Z0-9]+", "len(m) >= 16"),
    ("hex", "[0-9a-f]+", "len(m) >= 32"),
    ("github", "gh[pousr]_[0-9A-Za-z]+", None),
    ("npm", "npm_[0-9A-Za-z]+", None),
]


def _secret_sql(place: int, kind: str, pattern: str, good: str | None) -> str:
    """Matches of one kind with their places: the texts between them give the offsets."""
    parts = f"""SELECT doc_id, m, pattern, list_sum(list_transform(between[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(matches[:i - 1], lambda x: len(x))), 0) AS start
    FROM (SELECT doc_id, pattern, matches, between, unnest(matches) AS m, generate_subscripts(matches, 1) AS i FROM (
      SELECT doc_id, pattern, regexp_extract_all(text, pattern) AS matches, string_split_regex(text, pattern) AS between FROM texts, (SELECT '{pattern}' AS pattern)))"""
    if good is None:
        parts = f"SELECT *, {crc32_sql('substr(right(m, 36), 1, 30)')} AS crc FROM ({parts}) WHERE len(m) = 36 + len('{'npm_' if kind == 'npm' else 'ghp_'}')"
        good = f"right(m, 6) = {_BASE_62}"
    return f"SELECT doc_id, {place} AS place, '{kind}' AS kind, CAST(start AS BIGINT) AS start, CAST(start + len(m) AS BIGINT) AS stop FROM ({parts}) WHERE {good}"


@query(
    "op11_secret_scan",
    f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_secret_sql(i, *s) for i, s in enumerate(_SECRETS))}),
gathered AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
  string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, place) FILTER (place < 3) AS base,
  string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, place) AS spans FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM texts LEFT JOIN gathered USING (doc_id)""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.secret_digest(read(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.component_rows(read(spark, sf_dir, "embeddings"), 16)


_KEY_CRC = crc32_sql("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NEVER = "{'c': 1000000000, 'a': ''}"


def _step_sql(state: int) -> str:
    """The cheapest edits from a row on that begin with one of the row itself."""
    kept = {0: "CASE initial WHEN 's' THEN b[2] WHEN 'u' THEN b[3] END", 1: "CASE initial WHEN 'u' THEN b[3] END", 2: "CASE initial WHEN 'a' THEN b[4] END", 3: "CASE initial WHEN 'u' THEN b[3] END"}[state]
    then = 4 if state == 2 else 3
    keep = f"coalesce(CASE WHEN live THEN {kept} END, {_NEVER})"
    return f"""list_min([{{'c': 4 + b[{state + 1}].c, 'a': 'D' || b[{state + 1}].a}}, {{'c': more + ({keep}).c, 'a': 'K' || ({keep}).a}},
      CASE WHEN live THEN {{'c': 3 + more + b[{then}].c, 'a': 'R' || b[{then}].a}} ELSE {_NEVER} END])"""


def _inserted_sql(state: int) -> str:
    """As good, or better with one or two rows inserted before."""
    one, two = (3, 2) if state == 2 else (2, 3)
    return f"list_min([s[{state + 1}], {{'c': 3 + s[{one + 1}].c, 'a': 'I' || s[{one + 1}].a}}, {{'c': 6 + s[{two + 1}].c, 'a': 'II' || s[{two + 1}].a}}])"


@query(
    "op13_conversation_repair",
    f"""WITH RECURSIVE coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_KEY_CRC} % 20 AS fault FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE fault <> 0),
placed AS (SELECT *, rtrim(text, {_BLANKS}) AS body, substr(role, 1, 1) AS initial, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    lag(substr(role, 1, 1)) OVER w || substr(role, 1, 1) AS pair
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS wrong FROM placed),
coded_rows AS (SELECT *, wrong NOT IN ('blank', 'duplicate') AS live, CASE wrong WHEN 'truncated' THEN 3 ELSE 0 END AS more FROM judged),
best AS (
  SELECT DISTINCT conv_id, n + 1 AS i, [{{'c': 0, 'a': ''}}, {{'c': 6, 'a': 'II'}}, {{'c': 3, 'a': 'I'}}, {{'c': 0, 'a': ''}}] AS b FROM coded_rows
  UNION ALL
  SELECT conv_id, i, [{", ".join(map(_inserted_sql, range(4)))}] AS b
  FROM (SELECT r.conv_id, r.i, [{", ".join(map(_step_sql, range(4)))}] AS s FROM best JOIN coded_rows r ON r.conv_id IS NOT DISTINCT FROM best.conv_id AND r.i = best.i - 1)),
answers AS (SELECT conv_id, b[1].c AS cost, b[1].a AS audit FROM best WHERE i = 1),
edits AS (SELECT conv_id, audit, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS k FROM answers WHERE audit <> ''),
stays AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS place FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING)),
kept AS (SELECT s.conv_id, k, edit, place, CASE WHEN edit = 'K' THEN r.role END AS role, CASE WHEN edit = 'I' THEN '' ELSE r.text END AS text,
    coalesce(bool_or(edit = 'K' AND place = 1 AND r.initial = 's') OVER (PARTITION BY s.conv_id), FALSE) AS led
  FROM stays s LEFT JOIN coded_rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i WHERE edit <> 'D'),
texts AS (SELECT conv_id, string_agg(concat(coalesce(role, CASE WHEN (place - CAST(led AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END), ':', text), chr(10) ORDER BY k) AS repaired FROM kept GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (wrong = 'blank') AS blank, count(*) FILTER (wrong = 'duplicate') AS duplicate,
  count(*) FILTER (wrong = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM coded_rows GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM every LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM every.conv_id LEFT JOIN answers ON answers.conv_id IS NOT DISTINCT FROM every.conv_id
  LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM every.conv_id""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "conversations")
    return repair.summary(repair.damage(table), table)

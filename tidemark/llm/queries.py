"""The operators' queries over the given tables, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import context_tree, decontamination, jaccard_join, language_id, personal_data, quality_rules, repeated_spans, sentencepiece_bpe, structure_repair, token_counts, tool_calls, vector_codes, word_lexicon
from .common import id_bucket, table
from .tool_calls import Param, Tool

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    samples = language_id.sample_labelled(docs.filter(~held_out))
    return language_id.identify(docs.withColumn("held_out", F.coalesce(held_out, F.lit(False))), samples)


@query()
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.token_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return context_tree.score(docs.withColumn("held_out", id_bucket(F.col("doc_id"), 10) == 0))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT item_id, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p, w FROM i WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS win FROM iw
), dw AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS p, w FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
), hits AS (
  SELECT doc_id, dw.k, p, item_id FROM dw JOIN windows ON dw.k = windows.k AND array_to_string(w[p : p + dw.k - 1], ' ') = win
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY 1
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query(OP4_SQL)
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""


@query(OP7_SQL)
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op9_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def _common_words() -> str:
    rows = [(name, k, w) for name, own in quality_rules.COMMON_WORDS.items() for k, w in enumerate(own, 1)]
    return ", ".join(f"('{name}', {k}, '{w}')" for name, k, w in rows)


OP3_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p : p + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)
), repeats AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (
    SELECT doc_id, unnest(range(p, p + 3)) AS q
    FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1) GROUP BY 1
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1
), sizes AS (
  SELECT doc_id, length(text) AS n,
    length(regexp_replace(text, '[^a-z]+', '', 'g')) AS lower, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS upper,
    length(regexp_replace(text, '[\x00-\x7F]+', '', 'g')) AS high, length(regexp_replace(text, '[^0-9]+', '', 'g')) AS digits,
    length(regexp_replace(text, '[^\x20\x09-\x0D]+', '', 'g')) AS space,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS symbols FROM d
), base AS (
  SELECT d.doc_id, len(w) AS n_words, sizes.n - space AS word_chars, symbols AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    len(w) < {quality_rules.MIN_WORDS} OR 100 * coalesce(repeats.n, 0) > 50 * len(w) AS base_failed
  FROM d JOIN sizes USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), common(language, bin, word) AS (
  VALUES {_common_words()}
), hits AS (
  SELECT doc_id, lower(x) AS word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x FROM d) GROUP BY 1, 2
), best AS (
  SELECT doc_id, language, sum(n) AS n FROM hits JOIN common USING (word) GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY sum(n) DESC, language) = 1
), named AS (
  SELECT base.*, language, coalesce(best.n, 0) AS found FROM base LEFT JOIN best USING (doc_id)
), bins AS (
  SELECT doc_id, 'class' AS kind, unnest([1, 2, 3, 4, 5, 6]) AS bin,
    unnest([lower + high, space, upper, digits, symbols, n - lower - high - space - upper - digits - symbols]) AS n FROM sizes
  UNION ALL SELECT doc_id, 'word', 0, n_words - found FROM named WHERE language IS NOT NULL
  UNION ALL SELECT doc_id, 'word', bin, coalesce(hits.n, 0) FROM named JOIN common USING (language)
    LEFT JOIN hits USING (doc_id, word)
), reference AS (
  SELECT language, kind, bin, sum(n) AS n FROM bins JOIN named USING (doc_id)
  WHERE language IS NOT NULL AND NOT base_failed GROUP BY ROLLUP (language), kind, bin
), shares AS (
  SELECT doc_id, language, kind, bin, n / nullif(sum(n) OVER (PARTITION BY doc_id, kind), 0) AS p
  FROM bins JOIN named USING (doc_id) WHERE n_words >= {quality_rules.MIN_HISTOGRAM_WORDS}
), known AS (
  SELECT language, kind, bin, n / sum(n) OVER (PARTITION BY language, kind) AS q FROM reference
), distances AS (
  SELECT doc_id, s.kind, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS js
  FROM shares s JOIN known k ON s.language IS NOT DISTINCT FROM k.language AND s.kind = k.kind AND s.bin = k.bin
  GROUP BY 1, 2
), far AS (
  SELECT DISTINCT doc_id FROM distances WHERE kind = 'class' AND js > {quality_rules.MAX_CLASS_DISTANCE}
    OR kind = 'word' AND js > {quality_rules.MAX_WORD_DISTANCE}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM far) AS kept FROM base
"""


@query(OP3_SQL)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data.find(docs, personal_data.fit_field(docs))


TOOLS = (
    Tool("search", (Param("query", "string", True), Param("limit", "integer", True), Param("exact", "boolean"))),
    Tool("fetch", (Param("query", "string", True), Param("url", "string", True), Param("limit", "number"))),
    Tool("calculate", (Param("query", "string"), Param("exact", "boolean", True), Param("limit", "string"))),
)


def conversation_calls(turns: DataFrame) -> DataFrame:
    """Each assistant turn read as a tool call: tool, arguments and the call it follows depend on turn and text."""
    n = F.length("text")
    name = F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn")
    tool = F.get(F.array(*[F.lit(t) for t in ("search", "fetch", "calculate", "lookup")]), (n % 4).cast("int"))
    query, exact = F.col("text").alias("query"), (n % 2 == 0).alias("exact")
    as_text = F.to_json(F.struct(query, F.col("turn").cast("string").alias("limit"), exact))
    whole = F.when(n % 5 == 0, as_text).otherwise(F.to_json(F.struct(query, F.col("turn").alias("limit"), exact)))
    arguments = F.when(n % 11 == 0, F.expr("left(whole, length(whole) - 1)")).otherwise(F.col("whole"))
    step = F.when(n % 13 == 0, 2).when(n % 7 == 0, -4).otherwise(-2)
    after = F.concat(F.lit("c"), "conv_id", F.lit("-"), (F.col("turn") + step).cast("string"))
    calls = turns.filter("role = 'assistant' and text is not null").withColumn("whole", whole)
    return calls.select("conv_id", name.alias("call_id"), "turn", tool.alias("tool"), arguments.alias("arguments"), after.alias("after"))


def conversation_results(turns: DataFrame) -> DataFrame:
    """Each turn of others read as the result of the turn before."""
    name = F.concat(F.lit("c"), "conv_id", F.lit("-"), (F.col("turn") - 1).cast("string"))
    others = turns.filter("role <> 'assistant'")
    return others.select("conv_id", name.alias("call_id"), "turn", F.col("text").alias("content"))


OP2_SQL = r"""
WITH RECURSIVE a AS (
  SELECT conv_id, turn, text, length(text) AS n FROM conversations WHERE role = 'assistant' AND text IS NOT NULL
), raw AS (
  SELECT conv_id, 'c' || conv_id || '-' || turn AS call_id, turn, n,
    ['search', 'fetch', 'calculate', 'lookup'][n % 4 + 1] AS tool, text AS query,
    CASE WHEN n % 5 = 0 THEN to_json(CAST(turn AS VARCHAR)) ELSE to_json(turn) END AS lim, n % 2 = 0 AS exact,
    'c' || conv_id || '-' || (turn + CASE WHEN n % 13 = 0 THEN 2 WHEN n % 7 = 0 THEN -4 ELSE -2 END) AS after FROM a
), calls AS (
  SELECT conv_id, call_id, min(turn) AS turn, arg_min(n, turn) AS n, arg_min(tool, turn) AS tool, arg_min(query, turn) AS query,
    arg_min(lim, turn) AS lim, arg_min(exact, turn) AS exact, arg_min(after, turn) AS after, count(*) AS copies
  FROM raw GROUP BY 1, 2
), depths AS (
  SELECT conv_id, call_id, 0 AS depth FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
  UNION ALL
  SELECT c.conv_id, c.call_id, depth + 1 FROM depths d JOIN calls c ON c.conv_id = d.conv_id AND c.after = d.call_id
), results AS (
  SELECT conv_id, 'c' || conv_id || '-' || (turn - 1) AS call_id, min(turn) AS turn, arg_min(text, turn) AS content, count(*) AS n
  FROM conversations WHERE role <> 'assistant' GROUP BY 1, 2
), judged AS (
  SELECT c.*, d.depth, r.turn AS result_turn, r.content, coalesce(r.n, 0) AS n_results,
    CASE WHEN c.n % 11 = 0 THEN ['not_an_object'] WHEN tool = 'lookup' THEN ['unknown_tool']
      WHEN tool = 'search' THEN CASE WHEN c.n % 5 = 0 THEN ['type:limit'] ELSE [] END
      WHEN tool = 'fetch' THEN list_concat(['missing:url'],
        list_concat(CASE WHEN c.n % 5 = 0 THEN ['type:limit'] ELSE [] END, ['unknown:exact']))
      ELSE CASE WHEN c.n % 5 = 0 THEN [] ELSE ['type:limit'] END END AS errors
  FROM calls c LEFT JOIN depths d USING (conv_id, call_id) LEFT JOIN results r USING (conv_id, call_id)
)
SELECT conv_id, call_id, row_number() OVER (PARTITION BY conv_id ORDER BY depth NULLS LAST, turn, call_id) AS position,
  depth, turn, tool, result_turn, n_results, copies,
  array_to_string(CASE WHEN depth IS NULL THEN list_concat(errors, ['circular']) ELSE errors END, ',') AS errors,
  '{' || CASE WHEN n % 11 = 0 THEN '' ELSE '"arguments":{"exact":' || exact || ',"limit":' || lim || ',"query":' || to_json(query) || '},' END
  || '"id":"' || call_id || '","name":"' || tool || '"' || coalesce(',"result":' || to_json(content), '') || '}' AS message
FROM judged
"""


@query(OP2_SQL)
def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    linked = tool_calls.link_calls(conversation_calls(turns), conversation_results(turns), TOOLS)
    return linked.withColumn("errors", F.array_join("errors", ","))


@query()
def op12_word_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_lexicon.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _op13_round(number: int, books: str) -> str:
    """One assignment of all parts to the codebooks ``books``, and the codebooks after it."""
    return f"""
near{number} AS (
  SELECT vec_id, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
    SELECT x.vec_id, x.p, b.e, list_sum(list_transform(range(1, len(x.v) + 1), lambda i : (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))) AS d
    FROM parts x JOIN {books} b ON x.p = b.p
  ) GROUP BY ALL
)"""


def _op13_books(number: int, before: str) -> str:
    return f"""
books{number} AS (
  SELECT b.p, b.e, CASE WHEN m.v IS NULL THEN b.v ELSE m.v END AS v FROM {before} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT p, e, i, sum(c) AS s, count(*) AS n FROM (
        SELECT x.p, a.e, unnest(range(1, len(x.v) + 1)) AS i, unnest(x.v) AS c
        FROM near{number} a JOIN parts x ON a.vec_id = x.vec_id AND a.p = x.p
      ) GROUP BY ALL
    ) GROUP BY ALL
  ) m ON b.p = m.p AND b.e = m.e
)"""


OP13_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x : CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x : isfinite(x))) = len(embedding)
), parts AS (
  SELECT vec_id, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS v FROM (SELECT vec_id, v, unnest(range(16)) AS p FROM kept)
), books0 AS (
  SELECT p, e, v FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64
  ) USING (vec_id)
), {_op13_round(1, "books0")}, {_op13_books(1, "books0")}, {_op13_round(2, "books1")}, {_op13_books(2, "books1")}, {_op13_round(3, "books2")},
codes AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near3 GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), digest
"""


@query(OP13_SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.product_codes(table(spark, sf_dir, "embeddings"))


# The cheapest repair row by row: per place of the grammar the cost, the audit and the text so far. What cannot be has a
# cost of a thousand million. A row is first preceded by insertions, then kept, reroled or deleted.


def _op11_edit(state: str, cost: str, letter: str, line: str | None) -> str:
    text = f"{state}.t" if line is None else f"{state}.t || chr(10) || {line}"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}}"


_OP11_INSERTED = f"""
  SELECT * REPLACE (least(a, {_op11_edit("u", "5", "I", "'assistant:'")}) AS a) FROM (
    SELECT * REPLACE (least(u, {", ".join(_op11_edit(q, "5", "I", "'user:'") for q in ("s0", "s1", "a"))}) AS u) FROM walk
  )"""


def _op11_row(place: str, keeps: dict[str, str], gives: tuple[str, str] | None) -> str:
    options = [_op11_edit(place, "2", "D", None)]
    stays = "extra + CASE WHEN goes THEN 1000000000 ELSE 0 END"
    for state, first in keeps.items():
        options.append(_op11_edit(state, f"{stays} + CASE WHEN initial = '{first}' THEN 0 ELSE 1000000000 END", "K", "role || ':' || text"))
        if gives:
            options.append(_op11_edit(state, f"1 + {stays}", "R", f"'{gives[1]}:' || text"))
    return f"least({', '.join(options)})" if len(options) > 1 else options[0]


OP11_SQL = f"""
WITH RECURSIVE byte(n, k, c) AS (
  SELECT n, 0, CAST(n AS BIGINT) FROM range(256) r(n)
  UNION ALL SELECT n, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM byte WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY n) AS t FROM byte WHERE k = 8
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(name, ''), lambda x : CAST(ord(x) AS BIGINT))),
    lambda c, x : xor(t[CAST(xor(c, x) & 255 AS INTEGER) + 1], c >> 8))) % 20 AS kind
  FROM named, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged
), rows AS (
  SELECT *, fault IN ('blank', 'duplicate') AS goes, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM (
    SELECT *, left(role, 1) AS initial, CASE WHEN text_end = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
      WHEN right(text_end, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text_end FROM placed)
  )
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0,
    {", ".join(f"{{'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''}} AS {q}" for q in ("s1", "u", "a"))}
  FROM (SELECT DISTINCT conv_id FROM rows)
  UNION ALL
  SELECT w.conv_id, r.n, {_op11_row("s0", {}, None)}, {_op11_row("s1", {"s0": "s"}, None)},
    {_op11_row("u", {"s0": "u", "s1": "u", "a": "u"}, ("u", "user"))}, {_op11_row("a", {"u": "a"}, ("a", "assistant"))}
  FROM ({_OP11_INSERTED}) w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.n = w.n + 1
), ends AS (
  SELECT conv_id, least(s0, a) AS best FROM ({_OP11_INSERTED})
  QUALIFY n = max(n) OVER (PARTITION BY conv_id)
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
    count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
    count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM rows) GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted ON c.conv_id IS NOT DISTINCT FROM counted.conv_id LEFT JOIN ends ON c.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


@query(OP11_SQL)
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return structure_repair.repair_report(turns, structure_repair.damaged(turns))

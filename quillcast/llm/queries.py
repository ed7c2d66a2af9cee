"""The operators of this package as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.llm import (
    conversation_repair,
    decontamination,
    filter_audit,
    language_id,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    token_files,
    tool_calls,
    warc,
)
from quillcast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by 64-bit fingerprints at 4 or fewer bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words found in whole documents."""
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


ORACLES["op9_benchmark_decontamination"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL
), win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), occ AS (
    SELECT rid, i, l, array_to_string(w[i:i + l - 1], ' ') AS s
    FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS i
          FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l)
), hit AS (SELECT rid, i, l, item_id FROM occ JOIN win USING (l, s)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM hit) GROUP BY rid),
its AS (
    SELECT rid, count(*) AS n_items, sha256(string_agg(it, ',' ORDER BY it)) AS h
    FROM (SELECT DISTINCT rid, item_id::VARCHAR AS it FROM hit) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""


@query
def op4_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes of quality rules on all documents and the posterior verdict."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2,048 tokens."""
    import public_tokenizers

    found = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op8_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every line of all documents; one line of each class is kept."""
    found = line_dedup.classes(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("doc", "doc_id")


@query
def op6_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from preference pairs."""
    found = quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents with their places."""
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        F.col("id").alias("doc_id"), *(count(kind) for kind in secrets.KINDS), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans")
    )


@query
def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back through the capture index."""
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@query
def op3_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversation turns as calls and results, linked, ordered, checked and written as JSON."""
    calls, results = tool_calls.conversation_calls(table(spark, sf_dir, "conversations"))
    return tool_calls.link(calls, results, tool_calls.CHAT_SCHEMAS)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents tokenised, written as range-coded files and read back."""
    import public_tokenizers

    return token_files.round_trip(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(hex, 5 * g + 1, 5))::INT // {} % 32), 1)"
_BASE32 = "array_to_string(list_transform(range(8), lambda g: " + " || ".join(_DIGIT.format(32**k) for k in (3, 2, 1, 0)) + "), '')"

ORACLES["op1_warc_index"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, {_BASE32} AS digest, max(page_id) OVER (PARTITION BY hex) AS latest FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM d
"""

ORACLES["op3_tool_call_linking"] = """
WITH asked AS (
    SELECT conv_id, turn, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run
    FROM conversations WHERE role = 'user'
), deep AS (
    SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS depth FROM asked
), calls AS (
    SELECT c.conv_id, c.turn, c.conv_id || '-' || c.turn AS call_id, c.text, coalesce(depth, 0) AS depth,
           CASE role WHEN 'user' THEN 'ask' ELSE 'configure' END AS name,
           CASE role WHEN 'user' THEN 'prompt' ELSE 'instructions' END AS field
    FROM conversations c LEFT JOIN deep d ON c.conv_id = d.conv_id AND c.turn = d.turn WHERE role <> 'assistant'
), results AS (
    SELECT conv_id || '-' || (turn - 1) AS result_id, turn AS result_turn, text AS content FROM conversations WHERE role = 'assistant'
)
SELECT conv_id, coalesce(call_id, result_id) AS call_id, depth, coalesce(turn, result_turn) AS turn, name,
       CASE WHEN call_id IS NULL THEN 'orphan' WHEN result_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       CASE WHEN call_id IS NOT NULL THEN coalesce(text, '') <> '' END AS valid,
       CASE WHEN call_id IS NULL THEN NULL WHEN text IS NULL THEN '$.' || field || ': not of type string'
            WHEN text = '' THEN '$.' || field || ': length out of range' ELSE '' END AS problems,
       ((call_id IS NOT NULL)::BIGINT + (result_id IS NOT NULL)::BIGINT) AS copies,
       json_object('arguments', CASE WHEN call_id IS NOT NULL THEN json_object(field, text, 'turn', turn) END,
                   'id', coalesce(call_id, result_id), 'name', name, 'result', content)::VARCHAR AS record
FROM calls FULL JOIN results ON call_id = result_id
"""


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors, removals and label losses of five filters over all documents, in all orders."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (
    SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM documents LEFT JOIN l USING (doc_id)
), m AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d
), c AS (
    SELECT part, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic,
           CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
    FROM m GROUP BY ALL
), f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
    WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x
      AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x
), s AS (
    SELECT filter_order, step::INT AS step, filter_order[step] AS filter, left(filter_order, step - 1) AS before
    FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
    SELECT part, filter_order, step, filter,
           sum(n) FILTER (NOT gone AND NOT here) AS kept, sum(n) FILTER (NOT gone AND here) AS removed,
           sum(n) FILTER (gone AND here) AS redundant, sum(n) FILTER (fails = filter) AS unique_fails,
           sum(n_good) FILTER (NOT gone AND here) AS good_lost, sum(n_toxic) FILTER (NOT gone AND here) AS toxic_lost
    FROM (SELECT c.*, s.*, contains(fails, filter) AS here,
                 before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone FROM c, s)
    GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, filter), 0)::BIGINT AS shapley
FROM r
"""


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents by a network over the bytes of whole texts."""
    return language_id.identify(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule, with their faults and the cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    found, turns = conversation_repair.repair(conversation_repair.damaged(rows))
    known = found.join(conversation_repair.digests(turns), "conv", "left")
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    named = rows.select("conv_id").distinct().withColumn("conv", conv).join(known, "conv", "left")
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return named.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in zeros),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _move(before: str, cost: object, letter: str, line: str = "", when: str = "") -> str:
    """The cheapest edits up to state ``before`` and one more, as SQL; null unless ``when``."""
    said = f" || chr(10) || {line}" if line else ""
    moved = f"{{'c': {before}.c + {cost}, 'a': {before}.a || '{letter}', 't': {before}.t{said}}}"
    return f"CASE WHEN {when} THEN {moved} END" if when else moved


def _least(*moves: str) -> str:
    return f"list_min([{', '.join(moves)}])"


_TO_USER = [
    move
    for before in ("p0", "ps", "a2")
    for move in (
        _move(before, "extra", "K", "line", "NOT gone AND initial = 'u'"),
        _move(before, "3 + extra", "R", "'user:' || text", "NOT gone"),
    )
]
_RELAXED = f"""
SELECT *, {_least("pa", _move("u2", 3, "I", "'assistant:'"))} AS a2
FROM (SELECT *, {_least("pu", *(_move(before, 3, "I", "'user:'") for before in ("p0", "ps", "pa")))} AS u2 FROM walk)"""
_NOWHERE = "{'c': 1000000000::BIGINT, 'a': '~', 't': ''}"

# The cheapest edits row by row with the least audit of each state; the SQL needs no chunks.
ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), drawn AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1), lambda i: ord(key[i])::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 20 AS draw
    FROM given
), hurt AS (
    SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
           CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM drawn WHERE draw <> 0
), placed AS (
    SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
           NOT regexp_matches(text, '[^ 	-
]') AS empty,
           NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut
    FROM hurt
), r AS (
    SELECT *, empty OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS extra, role || ':' || text AS line,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
    FROM placed
), walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS p0, {_NOWHERE} AS ps, {_NOWHERE} AS pu, {_NOWHERE} AS pa
    FROM conversations
    UNION ALL
    SELECT w.conv_id, n, {_move("p0", 4, "D")},
           {_least(_move("ps", 4, "D"), _move("p0", "extra", "K", "line", "NOT gone AND initial = 's'"))},
           {_least(_move("u2", 4, "D"), *_TO_USER)},
           {_least(_move("a2", 4, "D"), _move("u2", "extra", "K", "line", "NOT gone AND initial = 'a'"), _move("u2", "3 + extra", "R", "'assistant:' || text", "NOT gone"))}
    FROM ({_RELAXED}) w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.i + 1
), ended AS (
    SELECT conv_id, i, {_least("p0", "a2")} AS best FROM ({_RELAXED})
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), told AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (empty) AS blank,
           count(*) FILTER (again AND NOT empty) AS duplicate, count(*) FILTER (cut AND NOT gone) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM r GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
       sha256(substr(best.t, 2)) AS repaired_sha256
FROM ended e LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""

"""Registered queries of the text operators, with the digest columns their contracts ask for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowlens.llm.common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
SHARDS = 40


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_token_counts(spark, sf_dir):
    from flowlens.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


@query
def op9_binary_output(spark, sf_dir):
    from flowlens.llm.binary_output import read_ids, write_ids

    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER), path)
    return read_ids(spark, path)


@query
def op8_packing(spark, sf_dir):
    from flowlens.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER)).drop("ids")


@query
def op4_quality_rules(spark, sf_dir):
    from flowlens.llm.quality_rules import quality

    return quality(table(spark, sf_dir, "documents")).drop("rejected_by")


@query
def op2_simhash_dedup(spark, sf_dir):
    from flowlens.llm.simhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark, sf_dir):
    from flowlens.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_secret_scan(spark, sf_dir):
    from flowlens.llm.secret_scan import report

    return report(table(spark, sf_dir, "documents"))


@query
def op10_decontamination(spark, sf_dir):
    from flowlens.llm.decontaminate import report

    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_chat_format(spark, sf_dir):
    from flowlens.llm.chat_format import report

    return report(table(spark, sf_dir, "conversations"))


@query
def op7_quality_classifier(spark, sf_dir):
    from flowlens.llm.quality_classifier import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_token_alignment(spark, sf_dir):
    from flowlens.llm.alignment import align_documents

    path = public_tokenizers.path
    return align_documents(table(spark, sf_dir, "documents"), path(BYTE_TOKENIZER), path(PIECE_TOKENIZER))


@query
def op12_sharding(spark, sf_dir):
    from flowlens.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


@query
def op13_ranked_search(spark, sf_dir):
    from flowlens.llm.ranked_search import ranked

    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# SQL twins of the queries that SQL can express.
SPLIT = r"list_filter(regexp_split_to_array({text}, '{by}'), lambda x: x <> '')"
SHINGLES = """(SELECT DISTINCT {key}, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM (SELECT {key}, """ + SPLIT.format(text="lower(coalesce(text, ''))", by=r"[^\p{{L}}\p{{N}}]+") + """ AS w FROM {table}) AS t, {lengths})"""

SQL["op10_decontamination"] = f"""
WITH i AS {SHINGLES.format(key="item_id", table="benchmark", lengths="(VALUES (1), (2), (3), (4), (5)) AS v(k) WHERE k = least(len(w), 5)")},
d AS {SHINGLES.format(key="doc_id", table="documents", lengths="(SELECT DISTINCT k FROM i) AS v")},
n AS (SELECT item_id, COUNT(*) AS n FROM i GROUP BY 1)
SELECT doc_id, item_id, n AS n_item, COUNT(*) AS n_found, COUNT(*) / CAST(n AS DOUBLE) AS containment
FROM d JOIN i USING (k, s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n HAVING COUNT(*) * 100 >= n * 80"""

ESCAPED = r"regexp_replace({x}, '([<\[])(\\*)(\|[a-z_]+\|>|/?s>|/?INST\])', '\1\\\2\3', 'g')"

SQL["op6_chat_format"] = f"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
a AS (SELECT conv_id, COUNT(*) AS n_turns, string_agg(concat(r, chr(10), t, chr(10)), '' ORDER BY turn, r, t) AS turns,
  string_agg(CASE WHEN r = 'assistant' THEN t ELSE '' END, '' ORDER BY turn, r, t) AS loss,
  SUM(8 + length({ESCAPED.format(x="r")}) + 1 + length({ESCAPED.format(x="t")}) + 8) + 7 AS formatted_chars FROM m GROUP BY 1)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars FROM a"""

SQL["op4_quality_rules"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {SPLIT.format(text="t", by="[" + r"\x20\x09-\x0D" + "]+")} AS w FROM d),
c AS (SELECT doc_id, t, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM w),
l AS (SELECT doc_id, COUNT(*) - COUNT(DISTINCT x) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) AS s
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY 1),
g AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, x) AS times FROM (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS x
  FROM w WHERE len(w) >= 3) AS s),
r AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n_repeat_words FROM g, (VALUES (0), (1), (2)) AS o(k) WHERE times > 1 GROUP BY 1),
b AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  t, w FROM c LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols > 0.1 * n_words OR n_dup_lines > 0.5 * len(string_split(t, chr(10)))
    OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words
    OR len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]') AND strlen(x) > 1)) > 0.4 * n_words
    OR len(list_filter(w, lambda x: regexp_full_match(x, '[\x00-\x40\x5B-\x60\x7B-\x7F]*'))) > 0.6 * n_words
    OR len(list_distinct(w)) < 0.5 * sqrt(n_words)) AS kept FROM f"""

SQL["op13_ranked_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT COUNT(*) FILTER (WHERE len(w) > 0) AS n, SUM(len(w))::BIGINT AS l FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
p AS (SELECT r, doc_id, size, t, COUNT(*) AS tf FROM (SELECT r, doc_id, len(w) AS size, unnest(w) AS t FROM d) AS u
  WHERE t IN (SELECT t FROM q) GROUP BY ALL),
f AS (SELECT t, COUNT(*) AS df FROM p GROUP BY t),
v AS (SELECT t, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM f, c),
s AS (SELECT item_id, r, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // l)))) AS BIGINT) AS score
  FROM q JOIN p USING (t) JOIN v USING (t), c GROUP BY item_id, r, doc_id),
o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10"""

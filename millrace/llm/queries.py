"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    adaptive_rules,
    alignment,
    byte_pairs,
    centroids,
    digest_index,
    grammar_ids,
    html_density,
    packing,
    quality_net,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
)
from millrace.llm.centroids_sql import centroids_sql
from millrace.llm.common import documents, fresh_path, load
from millrace.llm.registry import QUERIES, SQL, query

#: Tokenizer files by name; their folder is found by the package that brings them.
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


WS = "[\\x20\\x09-\\x0D]"


@query(
    "op6_digest_index",
    f"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
               sha256(regexp_replace(coalesce(text, ''), '{WS}', '', 'g')) AS h
        FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
    FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
    """,
)
def op6_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.deduplicate(documents(spark, sf_dir)).drop("n_chars")


def _rules_sql() -> str:
    r = adaptive_rules
    rate = {
        "symbol_rate": "coalesce(n_symbols * 1000 // nullif(word_chars, 0), 0)",
        "dup_line_rate": "coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0)",
        "repeat_rate": "coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0)",
        "word_length": "coalesce(word_chars * 10 // nullif(n_words, 0), 0)",
    }
    level = lambda name, keys: f"""
    {name} AS (
        SELECT {keys} measure, max(n) AS n, min(bucket) FILTER (below * 100 >= n * 50) AS mid,
               min(bucket) FILTER (below * 100 >= n * 75) AS high
        FROM (SELECT *, sum(c) OVER (PARTITION BY {keys} measure) AS n,
                     sum(c) OVER (PARTITION BY {keys} measure ORDER BY bucket) AS below
              FROM (SELECT {keys} measure, bucket, count(*) AS c FROM s GROUP BY ALL))
        GROUP BY ALL),
    {name}_cut AS (SELECT * EXCLUDE (mid, high), mid + {r.SPREAD} * greatest(high - mid, CASE measure
        {" ".join(f"WHEN '{m}' THEN {v}" for m, v in r.FLOORS.items())} END) AS cut FROM {name})"""  # noqa: E731
    measured = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m} AS v FROM m" for m in r.FLOORS)
    return f"""
    WITH t AS (
        SELECT doc_id, lang, source, coalesce(text, '') AS text,
               list_filter(string_split_regex(coalesce(text, ''), '{WS}+'), lambda w: w <> '') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_replace(l, '{WS}', '', 'g') <> '') AS lines
        FROM documents),
    wins AS (
        SELECT doc_id, i, array_to_string(words[i:i + {r.WINDOW_WORDS - 1}], ' ') AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {r.WINDOW_WORDS - 2})) AS i FROM t)),
    twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM wins) WHERE c > 1),
    rep AS (
        SELECT doc_id, sum(least({r.WINDOW_WORDS}, coalesce(nxt - i, {r.WINDOW_WORDS})))::BIGINT AS n_repeat_words
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
    b AS (
        SELECT t.doc_id, lang, source, len(words)::BIGINT AS n_words,
               length(regexp_replace(text, '{WS}', '', 'g'))::BIGINT AS word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM t LEFT JOIN rep USING (doc_id)),
    m AS (SELECT *, {", ".join(f"{x} AS {m}" for m, x in rate.items())} FROM b),
    s AS (SELECT lang, source, measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket
          FROM ({measured})),
    {level("fine", "lang, source,")}, {level("middle", "lang,")}, {level("coarse", "")},
    cuts AS (
        SELECT f.lang, f.source, f.measure,
               CASE WHEN f.n >= {r.LEAST_ROWS} THEN f.cut WHEN g.n >= {r.LEAST_ROWS} THEN g.cut ELSE h.cut END AS cut
        FROM fine_cut f JOIN middle_cut g ON f.lang IS NOT DISTINCT FROM g.lang AND f.measure = g.measure
        JOIN coarse_cut h ON f.measure = h.measure),
    j AS (
        SELECT m.*, (n_words < {r.LEAST_WORDS} OR 100 * n_repeat_words > {r.REPEAT_PERCENT} * n_words) AS base_failed,
               {" OR ".join(f"{x} > (SELECT cut FROM cuts c WHERE c.measure = '{x}' AND c.lang IS NOT DISTINCT FROM m.lang AND c.source IS NOT DISTINCT FROM m.source)" for x in rate)} AS beyond
        FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT beyond AS kept
    FROM j
    """


@query("op10_adaptive_rules", _rules_sql())
def op10_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_rules.quality_report(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op1_nearest_toxic")
def op1_nearest_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


@query("op2_simhash_trie")
def op2_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op3_random_index_net")
def op3_random_index_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.quality(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


@query("op4_grammar_ids")
def op4_grammar_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-ids")
    grammar_ids.write_ids(documents(spark, sf_dir), path, tokenizer(WORD_BPE), end_id=2)
    return grammar_ids.read_documents(spark, path)


@query("op5_text_density")
def op5_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.main_texts(load(spark, sf_dir, "pages"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer(WORD_BPE), limit=2048)


@query("op8_guess_and_check")
def op8_guess_and_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.round_trip(documents(spark, sf_dir), tokenizer(BYTE_BPE))


@query("op9_best_fit")
def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer(WORD_BPE), end_id=1, capacity=4096)


_WINDOW = substring_dedup.WINDOW


@query(
    "op11_fm_passages",
    f"""
    WITH t AS (
        SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{WS}+'), lambda w: w <> '') AS words FROM documents),
    wins AS (SELECT doc_id, i, array_to_string(words[i:i + {_WINDOW - 1}], ' ') AS win
             FROM (SELECT doc_id, words, unnest(range(1, len(words) - {_WINDOW - 2})) AS i FROM t)),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + {_WINDOW})) AS i
        FROM (SELECT *, min(doc_id) OVER (PARTITION BY win) AS least FROM wins) WHERE least < doc_id),
    each AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM t),
    kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
)
def op11_fm_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return left.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_heap_centroids", centroids_sql())
def op12_heap_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_report(load(spark, sf_dir, "embeddings"))


@query("op13_token_overlap")
def op13_token_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), tokenizer(BYTE_BPE), tokenizer(PIECE_BPE))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""One query per operator over whole tables, and its SQL where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import bpe, conversations, exact, html, language, minhash, mixing, passages, phrases, pii, quality, simhash, suffixes
from broadsheet.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.without_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_language_id, op3_simhash, op4_bpe, op5_pii,
        op6_substring_dedup, op7_suffix_dedup, op8_quality, op9_mixing, op10_html,
        op11_collocations, op12_conversation_trie, op13_minhash,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_substring_dedup": f"""
        WITH split AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        placed AS (
            SELECT doc_id, len(words) AS n, i, words[i] AS word,
                   CASE WHEN i + 49 <= len(words) THEN md5(array_to_string(words[i:i + 49], ' ')) END AS passage
            FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM split)
        ),
        judged AS (
            SELECT *, passage IS NOT NULL AND min(doc_id) OVER (PARTITION BY passage) < doc_id AS repeats FROM placed
        ),
        marked AS (
            SELECT *, coalesce(max(CASE WHEN repeats THEN i END) OVER (PARTITION BY doc_id ORDER BY i) > i - 50, false) AS gone
            FROM judged
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM split LEFT JOIN (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM marked GROUP BY doc_id
        ) USING (doc_id)
    """,
    "op8_quality": rf"""
        WITH split AS (
            SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words,
                   [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
            FROM documents
        ),
        grams AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
        ),
        repeated AS (
            SELECT doc_id, count(DISTINCT i + k) AS n FROM grams, (VALUES (0), (1), (2)) AS shift(k) WHERE times > 1 GROUP BY doc_id
        ),
        measured AS (
            SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
                   coalesce(repeated.n, 0) AS n_repeat_words
            FROM split LEFT JOIN repeated USING (doc_id)
        ),
        failing AS (
            SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEATED_PERCENT} * n_words AS base_failed FROM measured
        ),
        ruled AS (
            SELECT *, base_failed OR 100 * n_symbols > {quality.SYMBOL_PERCENT} * word_chars
                   OR 100 * n_dup_lines > {quality.DUP_LINE_PERCENT} * n_lines
                   OR word_chars < {quality.MEAN_WORD[0]} * n_words OR word_chars > {quality.MEAN_WORD[1]} * n_words AS failed
            FROM failing
        ),
        hosts AS (
            SELECT source, count(*) AS n, count(*) FILTER (failed) AS f FROM ruled GROUP BY source
        ),
        moments AS (
            SELECT sum(n) AS docs, count(*) AS hosts, sum(f) AS failed, sum(f) / sum(n) AS m,
                   sum(f * f / n) AS squares, sum(n) - sum(n * n) / sum(n) AS scale FROM hosts
        ),
        spread AS (
            SELECT *, CASE WHEN scale > 0 THEN (squares - failed * m - m * (1 - m) * (hosts - 1)) / scale ELSE 0 END AS v FROM moments
        ),
        prior AS (
            SELECT m, greatest({quality.LEAST_PRIOR}, CASE WHEN v <= 0 THEN docs ELSE m * (1 - m) / v - 1 END) AS weight FROM spread
        ),
        rates AS (SELECT source, (f + m * weight) / (n + weight) AS rate FROM hosts, prior)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT (failed AND rate > {quality.HOST_RATE}) AS kept
        FROM ruled JOIN rates ON ruled.source IS NOT DISTINCT FROM rates.source
    """,
    "op9_mixing": f"""
        WITH sizes AS (
            SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
                   md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
            FROM documents
        ),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sizes GROUP BY source
        ),
        stopped AS (
            SELECT *, 2.0 * source_size / weight AS ratio, lead(2.0 * source_size / weight) OVER by_ratio AS next_ratio,
                   1.5 * sum(source_size) OVER () - sum(2.0 * source_size) OVER upto AS rest,
                   sum(weight) OVER () - sum(weight) OVER upto AS free
            FROM sources
            WINDOW by_ratio AS (ORDER BY 2.0 * source_size / weight, source),
                   upto AS (ORDER BY 2.0 * source_size / weight, source ROWS UNBOUNDED PRECEDING)
        ),
        levels AS (
            SELECT rest / free AS level FROM stopped WHERE free > 0 AND rest / free >= ratio AND rest / free <= next_ratio
            UNION ALL
            SELECT first_level FROM (SELECT 1.5 * sum(source_size) / sum(weight) AS first_level, min(2.0 * source_size / weight) AS least FROM sources)
            WHERE first_level <= least
        ),
        aimed AS (
            SELECT source, source_size,
                   CAST(round(least(2.0 * source_size, weight * (SELECT max(level) FROM levels)), 6) AS DOUBLE) AS target FROM sources
        ),
        cut AS (
            SELECT *, CAST(floor(floor(target) / nullif(source_size, 0)) AS BIGINT) AS times FROM aimed
        ),
        ordered AS (
            SELECT doc_id, source, size, source_size, target, coalesce(times, 0) AS times,
                   CAST(floor(target) AS BIGINT) - coalesce(times, 0) * source_size AS rest,
                   CAST(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
            FROM sizes JOIN cut USING (source)
        )
        SELECT doc_id, size, source_size, target,
               CAST(times * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
        FROM ordered
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
            )) AS piece
            FROM documents
        ),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
        placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split),
        shown AS (
            SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
            FROM placed, (VALUES (1), (2), (3)) AS size(k) WHERE i + k - 1 <= len(words)
        ),
        counts AS (SELECT lang, k, phrase, count(*) AS f FROM shown GROUP BY lang, k, phrase),
        sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
        parts AS MATERIALIZED (SELECT lang, phrase AS part, f FROM counts WHERE k < 3 AND f >= 10),
        candidates AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE k > 1 AND f >= 10),
        cuts AS MATERIALIZED (
            SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS first_part, array_to_string(w[c + 1:k], ' ') AS rest
            FROM candidates, (VALUES (1), (2)) AS place(c) WHERE c < k
        ),
        scored AS (
            SELECT cuts.*, x.f AS l, y.f AS r,
                   CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cuts
            JOIN parts AS x ON x.lang = cuts.lang AND x.part = first_part
            JOIN parts AS y ON y.lang = cuts.lang AND y.part = rest
        ),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        longer AS (
            SELECT lang, part, max(a) AS most FROM (
                SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM candidates WHERE k = 3
            ) GROUP BY lang, part
        ),
        ranked AS (
            SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
            FROM lowest LEFT JOIN longer ON longer.lang = lowest.lang AND part = phrase
            WHERE most IS NULL OR 100 * most < 50 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
    """,
    "op12_conversation_trie": """
        WITH RECURSIVE ids AS (
            SELECT conv_id AS c, CAST(conv_id AS VARCHAR) AS digits, count(*) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        crc AS (
            SELECT c, digits, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM ids
            UNION ALL
            SELECT c, digits, i + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
            FROM (
                SELECT c, digits, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(substr(digits, i // 8 + 1, 1))) ELSE v END AS x
                FROM crc WHERE i < 8 * length(digits)
            )
        ),
        heads AS (
            SELECT crc.c, xor(v, 4294967295) % 9 AS h, least(xor(v, 4294967295) % 9, coalesce(first.turns, 0)) AS m
            FROM crc LEFT JOIN ids AS first ON first.c = crc.c - crc.c % 5 WHERE i = 8 * length(crc.digits)
        ),
        marked AS (
            SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS bytes,
                   md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        placed AS (
            SELECT c, digest, bytes, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS p FROM marked
        ),
        rebuilt AS (
            SELECT heads.c, p AS d, digest, bytes FROM heads JOIN placed ON placed.c = heads.c - heads.c % 5 WHERE p <= m
            UNION ALL
            SELECT c, m + p - h, digest, bytes FROM heads JOIN placed USING (c) WHERE p > h
        ),
        paths AS (
            SELECT c, d, bytes, string_agg(digest, '') OVER (PARTITION BY c ORDER BY d) AS node FROM rebuilt
            UNION ALL
            SELECT c, 0, 0, '' FROM heads
        ),
        nodes AS (SELECT node, d, min(c) AS conv_id, count(*) AS n, max(bytes) AS bytes FROM paths GROUP BY node, d),
        children AS (
            SELECT substr(node, 1, length(node) - 32) AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
        ),
        below AS (
            SELECT paths.node, sum((nodes.n - 1) * nodes.bytes) AS saved, count(*) FILTER (n_children IS NULL) AS leaves
            FROM nodes LEFT JOIN children USING (node) JOIN paths ON paths.c = nodes.conv_id AND paths.d <= nodes.d
            GROUP BY paths.node
        ),
        lengths AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
        ends AS (
            SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM paths JOIN lengths USING (c, d) GROUP BY node
        )
        SELECT nodes.conv_id, nodes.d AS depth, parents.conv_id AS parent_conv_id, nodes.n AS n_convs,
               coalesce(n_children, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
               sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes
        LEFT JOIN nodes AS parents ON nodes.d > 0 AND parents.node = substr(nodes.node, 1, length(nodes.node) - 32)
        LEFT JOIN children ON children.node = nodes.node
        JOIN below ON below.node = nodes.node
        LEFT JOIN ends ON ends.node = nodes.node
    """,
}

"""The same results in DuckDB SQL, one statement per query."""

import re

from broadsheet.settings import PROFILE_PARTS
from broadsheet.testbed.views import HAN, LETTERS

PARTS = {
    "news": """
        SELECT doc_id AS news_id, split_part(text, chr(10), 1) AS title, text AS content,
               timestamp '2024-01-01 00:00:00' - to_hours(cast(doc_id % 720 AS int)) AS publish_ts,
               CASE WHEN doc_id % 7 = 0 THEN 'NULL' ELSE strftime(
                   timestamp '2024-01-01 00:00:00' - to_hours(cast(doc_id % 720 AS int)),
                   '%Y年%m月%d日%H:%M') END AS publish_text
        FROM documents""",
    "clicks": """
        SELECT user_id, cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS news_id, ts AS click_ts
        FROM events WHERE event_type IN ('click', 'view')""",
    "raw_log": """
        WITH opened AS (
            SELECT news_id % 97 AS user_id, news_id,
                   timestamp '2024-01-01 00:00:00' + to_seconds(news_id % 86400) AS click_ts FROM news
        ), lines AS (
            SELECT user_id, news_id, click_ts FROM clicks UNION ALL SELECT * FROM opened
            UNION ALL SELECT user_id, news_id, click_ts + interval 20 days FROM opened WHERE news_id % 3 = 0
        )
        SELECT user_id, news_id, click_ts,
               CASE WHEN changed THEN 'Update: ' || title ELSE title END AS title,
               CASE WHEN changed THEN content || ' (updated)' ELSE content END AS content, publish_text
        FROM (SELECT *, news_id % 3 = 0 AND click_ts >= timestamp '2024-01-16 00:00:00' AS changed
              FROM lines JOIN news USING (news_id))""",
    "timed_clicks": """
        SELECT user_id, news_id, click_ts,
               CASE WHEN news_id % 7 = 0 THEN timestamp '1970-01-01 00:00:00'
                    ELSE timestamp '2024-01-01 00:00:00' - to_hours(cast(news_id % 720 AS int))
               END AS publish_ts
        FROM clicks""",
    "assignment": """
        SELECT vec_id AS news_id, label AS category,
               timestamp '2024-01-01 00:00:00' - to_hours(cast(vec_id % 720 AS int)) AS publish_ts
        FROM embeddings""",
    "graded": "SELECT doc_id AS news_id, quality AS label FROM labels",
    # category track
    "tokens": r"""
        SELECT news_id, unnest(regexp_extract_all(lower(content), '[\p{L}\p{N}]+')) AS term FROM news""",
    "counts": "SELECT news_id, term, count(*) AS n FROM tokens GROUP BY news_id, term",
    "lengths": "SELECT news_id, count(*) AS n_terms FROM tokens GROUP BY news_id",
    "dfs": "SELECT term, count(*) AS df FROM counts GROUP BY term",
    "scored": """
        SELECT news_id, term, n, n_terms, df, cast(n AS double) / n_terms AS tf,
               cast(n AS double) / n_terms
                 * log10(cast((SELECT count(*) FROM news) AS double) / df) AS tfidf
        FROM counts JOIN lengths USING (news_id) JOIN dfs USING (term)""",
    "best": """
        SELECT *, row_number() OVER (PARTITION BY news_id ORDER BY round(tfidf, 9) DESC, term) AS rank
        FROM scored""",
    "top": "SELECT * FROM best WHERE rank <= 50",
    "words": "SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM (SELECT DISTINCT term FROM top)",
    "sparse_cells": "SELECT news_id, term_id, n FROM top JOIN words USING (term)",
    "han_counts": rf"""
        SELECT news_id, term, count(*) AS n FROM (
            SELECT news_id, unnest(CASE WHEN regexp_full_match(run, '\p{{Han}}{{2,}}')
                THEN list_transform(range(1, length(run)), lambda i: substr(run, i, 2))
                ELSE [run] END) AS term
            FROM (SELECT news_id, unnest(regexp_extract_all(token, '\p{{Han}}+|[^\p{{Han}}]+')) AS run
                  FROM (SELECT news_id, unnest(regexp_extract_all(
                            translate(lower(content), '{LETTERS}', '{HAN}'), '[\p{{L}}\p{{N}}]+')) AS token FROM news)))
        GROUP BY news_id, term""",
    "han_scored": """
        SELECT news_id, term, cast(n AS double) / n_terms
                 * log10(cast((SELECT count(*) FROM news) AS double) / df) AS tfidf
        FROM han_counts
        JOIN (SELECT news_id, sum(n) AS n_terms FROM han_counts GROUP BY news_id) USING (news_id)
        JOIN (SELECT term, count(*) AS df FROM han_counts GROUP BY term) USING (term)""",
    # profile track
    "title_tokens": r"""
        SELECT news_id, unnest(regexp_extract_all(lower(title), '[\p{L}\p{N}]+')) AS term FROM news""",
    "title_scored": """
        SELECT news_id, term, cast(n AS double) / n_terms
                 * log10(cast((SELECT count(*) FROM news) AS double) / coalesce(df, 1)) AS tfidf
        FROM (SELECT news_id, term, count(*) AS n FROM title_tokens GROUP BY news_id, term)
        JOIN (SELECT news_id, count(*) AS n_terms FROM title_tokens GROUP BY news_id) USING (news_id)
        LEFT JOIN dfs USING (term)""",
    "title_best": """
        SELECT *, row_number() OVER (PARTITION BY news_id ORDER BY round(tfidf, 9) DESC, term) AS rank
        FROM title_scored""",
    "tags": """
        SELECT news_id, term, sum(tfidf) AS weight FROM (
            SELECT news_id, term, tfidf FROM best WHERE rank <= 20
            UNION ALL SELECT news_id, term, tfidf FROM title_best WHERE rank <= 5)
        WHERE tfidf > 0 GROUP BY news_id, term""",
    "profile": """
        SELECT user_id, term, sum(weight) AS weight FROM clicks JOIN tags USING (news_id)
        GROUP BY user_id, term""",
    "dealt": f"""
        SELECT *, cast('0x' || substr(md5(term), 1, 8) AS bigint) % {PROFILE_PARTS} AS part FROM profile""",
    "pairs": """
        SELECT user_id, news_id, coalesce(n_shared, 0) AS n_shared, coalesce(shared, 0) AS shared
        FROM (SELECT DISTINCT user_id FROM clicks) u CROSS JOIN (SELECT news_id FROM news) a
        LEFT JOIN (SELECT user_id, news_id, count(*) AS n_shared, sum(p.weight + t.weight) AS shared
                   FROM profile p JOIN tags t USING (term) GROUP BY user_id, news_id)
        USING (user_id, news_id)""",
    "overlap": """
        SELECT user_id, news_id, n_shared,
               coalesce(user_tags, 0) + coalesce(news_tags, 0) - 2 * n_shared AS n_differing,
               1e-6::double + shared AS s1,
               coalesce(user_weight, 0) + coalesce(news_weight, 0) - shared AS s2,
               coalesce(news_weight, 0) AS news_weight
        FROM pairs
        LEFT JOIN (SELECT user_id, sum(weight) AS user_weight, count(*) AS user_tags
                   FROM profile GROUP BY user_id) USING (user_id)
        LEFT JOIN (SELECT news_id, sum(weight) AS news_weight, count(*) AS news_tags
                   FROM tags GROUP BY news_id) USING (news_id)""",
    "overlap_lists": """
        SELECT *, s1 / (s1 + s2) AS score, row_number() OVER (
            PARTITION BY user_id ORDER BY n_shared > 0 DESC,
            CASE WHEN n_shared > 0 THEN round(s1 / (s1 + s2), 9) END DESC,
            CASE WHEN n_shared = 0 THEN round(news_weight, 9) END ASC, news_id DESC) AS rank
        FROM overlap""",
    # categories and preference
    "user_categories": """
        SELECT user_id, category, count(*) AS clicks
        FROM timed_clicks JOIN assignment USING (news_id, publish_ts) GROUP BY user_id, category""",
    "shares": """
        SELECT user_id, category, clicks / sum(clicks) OVER (PARTITION BY user_id) AS share
        FROM user_categories""",
    "gravities": """
        SELECT category, news_id, votes, age_h, votes / pow(greatest(age_h, 0) + 2, 1.8) AS gravity FROM (
            SELECT category, news_id, n_news AS votes,
                   datesub('hour', publish_ts, timestamp '2024-01-31 00:00:00') AS age_h
            FROM assignment
            JOIN (SELECT category, count(DISTINCT news_id) AS n_news FROM assignment GROUP BY category)
            USING (category))""",
    "preferred": """
        SELECT user_id, category, news_id, gravity, share * gravity AS score,
               row_number() OVER (PARTITION BY user_id ORDER BY round(share * gravity, 9) DESC,
                                  round(gravity, 9) DESC, news_id) AS rank
        FROM shares JOIN gravities USING (category)""",
    # k-means on embeddings
    "first_centres": """
        SELECT vec_id, embedding, row_number() OVER (ORDER BY md5(cast(vec_id AS varchar)), vec_id) - 1 AS cluster
        FROM embeddings QUALIFY cluster < 10""",
    "distances": """
        SELECT v.vec_id, c.cluster,
               round(sum(pow(v.x::double - c.x::double, 2)), 9) AS distance
        FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings) v
        JOIN (SELECT cluster, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM first_centres) c
        USING (d) GROUP BY v.vec_id, c.cluster""",
    "nearest": """
        SELECT vec_id, cluster, distance FROM distances
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1""",
    # Naive Bayes
    "train_news": "SELECT * FROM news WHERE news_id IN (SELECT news_id FROM graded)",
    "new_news": "SELECT * FROM news WHERE news_id NOT IN (SELECT news_id FROM graded)",
}


def _lloyd(steps: int = 3, delta: float = 0.01) -> str:
    """Rounds of k-means on the embeddings, one after the other; they stand still once no centre moves far."""
    parts = ["c0 AS (SELECT cluster, embedding::DOUBLE[] AS v, false AS done FROM first_centres)"]
    near = """SELECT vec_id, embedding, cluster, distance FROM (
        SELECT e.vec_id, e.embedding, c.cluster, round(list_distance(e.embedding::DOUBLE[], c.v) ** 2, 9) AS distance
        FROM embeddings e, {c} c) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1"""
    for i in range(steps):
        parts.append(f"n{i} AS ({near.format(c=f'c{i}')})")
        parts.append(f"""m{i} AS (
            SELECT cluster, list(x ORDER BY d) AS v FROM (
                SELECT cluster, d, avg(x) AS x FROM (
                    SELECT cluster, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM n{i})
                GROUP BY cluster, d) GROUP BY cluster)""")
        parts.append(f"""c{i + 1} AS (
            SELECT c.cluster, CASE WHEN c.done THEN c.v ELSE coalesce(m.v, c.v) END AS v,
                   c.done OR max(coalesce(list_distance(m.v, c.v), 0)) OVER () <= {delta} AS done
            FROM c{i} c LEFT JOIN m{i} m USING (cluster))""")
    return f"""
        WITH {", ".join(parts)}
        SELECT cluster, count(*) AS n_members, round(sum(distance), 6) AS inertia FROM ({near.format(c=f'c{steps}')})
        GROUP BY cluster"""


def _corpus(name: str) -> None:
    """Top-50 keywords of one part of the news, on its own corpus."""
    PARTS[f"{name}_counts"] = rf"""
        SELECT news_id, term, count(*) AS n FROM (
            SELECT news_id, unnest(regexp_extract_all(lower(content), '[\p{{L}}\p{{N}}]+')) AS term
            FROM {name}_news) GROUP BY news_id, term"""
    PARTS[f"{name}_top"] = f"""
        SELECT news_id, term, n FROM (
            SELECT news_id, term, n, cast(n AS double) / n_terms * log10(
                cast((SELECT count(*) FROM {name}_news) AS double) / df) AS tfidf
            FROM {name}_counts
            JOIN (SELECT news_id, sum(n) AS n_terms FROM {name}_counts GROUP BY news_id) USING (news_id)
            JOIN (SELECT term, count(*) AS df FROM {name}_counts GROUP BY term) USING (term))
        QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY round(tfidf, 9) DESC, term) <= 50"""


_corpus("train")
_corpus("new")
PARTS |= {
    "train_cells": "SELECT news_id, label, term, n FROM train_top JOIN graded USING (news_id)",
    "train_words": "SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM (SELECT DISTINCT term FROM train_cells)",
    "classes": """
        SELECT label, n_docs, coalesce(total, 0)::bigint AS total,
               ln((n_docs + 1.0::double) / ((SELECT count(*) FROM graded)
                   + (SELECT count(DISTINCT label) FROM graded))) AS prior,
               ln(1.0::double / (coalesce(total, 0) + (SELECT count(*) FROM train_words))) AS unseen
        FROM (SELECT label, count(*) AS n_docs FROM graded GROUP BY label)
        LEFT JOIN (SELECT label, sum(n) AS total FROM train_cells GROUP BY label) USING (label)""",
    "likelihoods": """
        SELECT label, term, weight, ln((weight + 1.0::double)
                   / (total + (SELECT count(*) FROM train_words))) AS logp
        FROM (SELECT label, term, sum(n)::bigint AS weight FROM train_cells GROUP BY label, term)
        JOIN classes USING (label)""",
}


def _predicted(name: str, docs: str, cells: str) -> None:
    PARTS[f"{name}_scores"] = f"""
        SELECT d.news_id, k.label,
               any_value(prior) + coalesce(sum(n * coalesce(logp, unseen)) FILTER (w.term IS NOT NULL), 0) AS score
        FROM {docs} d CROSS JOIN classes k
        LEFT JOIN {cells} c ON c.news_id = d.news_id
        LEFT JOIN train_words w ON w.term = c.term
        LEFT JOIN likelihoods l ON l.term = c.term AND l.label = k.label
        GROUP BY d.news_id, k.label"""
    PARTS[f"{name}_predicted"] = f"""
        SELECT news_id, label, score FROM {name}_scores
        QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY round(score, 9) DESC, label) = 1"""


_predicted("new", "new_news", "new_top")
_predicted("train", "graded", "train_top")

K = 10
PARTS["lloyd_seeds"] = f"""
    SELECT news_id, row_number() OVER (ORDER BY md5(cast(news_id AS varchar)), news_id) - 1 AS cluster
    FROM (SELECT DISTINCT news_id FROM top) QUALIFY cluster < {K}"""
PARTS["lloyd_centres_0"] = "SELECT cluster, term, cast(n AS double) AS x FROM top JOIN lloyd_seeds USING (news_id)"
for _step in range(4):
    PARTS[f"lloyd_assigned_{_step}"] = f"""
        SELECT d.news_id, k.cluster FROM (SELECT DISTINCT news_id FROM top) d
        CROSS JOIN (SELECT cluster, sum(x * x) AS norm FROM lloyd_centres_{_step} GROUP BY cluster) k
        LEFT JOIN (SELECT news_id, cluster, sum(n * x) AS dot FROM top
                   JOIN lloyd_centres_{_step} USING (term) GROUP BY news_id, cluster) p
            USING (news_id, cluster)
        QUALIFY row_number() OVER (PARTITION BY d.news_id ORDER BY
            round(norm - 2 * coalesce(dot, 0), 9), k.cluster) = 1"""
    PARTS[f"lloyd_centres_{_step + 1}"] = f"""
        SELECT cluster, term, sum(n) / any_value(members) AS x
        FROM top JOIN lloyd_assigned_{_step} USING (news_id)
        JOIN (SELECT cluster, cast(count(*) AS double) AS members FROM lloyd_assigned_{_step}
              GROUP BY cluster) USING (cluster)
        GROUP BY cluster, term
        UNION ALL SELECT cluster, term, x FROM lloyd_centres_{_step}
        WHERE cluster NOT IN (SELECT cluster FROM lloyd_assigned_{_step})"""


def _keyword_text(source: str, key: str, term: str = "term") -> str:
    entry = f"{term} || ':' || printf('%.6f', weight) || '|'"
    return f"SELECT {key}, string_agg({entry}, '' ORDER BY {entry}) AS keywords FROM {source} GROUP BY {key}"


_LINE = r"regexp_replace({0}, '[\t\r\n]+', ' ', 'g')"
_SHARE = "regexp_replace(printf('%.3f', round_even(coalesce({0}, 0), 3)), '0$', '')"
_TYPED = "CASE WHEN try_cast(cell AS double) IS NULL THEN cell END"
_LABELLED = """
    SELECT news_id, label, unnest([0, 1, 2]) AS position,
           unnest([lang, source, cast(n_chars AS varchar)]) AS cell
    FROM (SELECT doc_id AS news_id, lang, source, n_chars FROM documents) {0} JOIN graded USING (news_id)"""

BODIES = {
    # sources and sinks
    "read_click_log": f"""
        SELECT user_id, news_id, date_trunc('second', click_ts) AS click_ts,
               {_LINE.format('title')} AS title, {_LINE.format('content')} AS content, publish_text
        FROM raw_log""",
    "read_brief_log": "SELECT user_id, news_id, date_trunc('second', click_ts) AS click_ts FROM raw_log",
    "read_assignments": "SELECT news_id, publish_ts, category FROM assignment",
    "read_keyword_map": "SELECT news_id, term, round(weight, 6) AS weight FROM tags",
    "write_keyword_map": _keyword_text("tags", "news_id"),
    "read_labelled_csv": f"""
        SELECT cast(label AS varchar) AS label, position, cell, count(*) AS n_rows
        FROM ({_LABELLED.format('')}) GROUP BY ALL""",
    "cell_index": f"""
        WITH seen AS ({_LABELLED.format('')}), dictionary AS (
            SELECT cell, row_number() OVER (ORDER BY count(*) DESC, cell) AS cell_id
            FROM seen WHERE try_cast(cell AS double) IS NULL GROUP BY cell), fresh AS (
            SELECT doc_id AS news_id, unnest([0, 1, 2]) AS position,
                   unnest([lang, source, cast(n_chars AS varchar)]) AS cell
            FROM documents WHERE doc_id NOT IN (SELECT news_id FROM graded))
        SELECT news_id, position, cell,
               coalesce(try_cast(cell AS double), cast(cell_id AS double), 0) AS value
        FROM fresh LEFT JOIN dictionary USING (cell)""",
    "union_tagged_sources": """
        SELECT source, news_id, count(*) AS n_rows, count(user_id) AS n_users,
               count(category) AS n_categories FROM (
            SELECT 'clicks' AS source, news_id, user_id, NULL AS category FROM timed_clicks
            UNION ALL SELECT 'assignments', news_id, NULL, category FROM assignment)
        GROUP BY source, news_id""",
    "write_table": "SELECT doc_id, lang, source, n_chars FROM documents",
    "save_state": """
        SELECT 'assignment' AS source, news_id, cast(category AS bigint) AS value FROM assignment
        UNION ALL SELECT 'labels', news_id, cast(label AS bigint) FROM graded""",
    # projections and filters
    "brief_clicks": "SELECT user_id, news_id, click_ts FROM raw_log",
    "user_news_map": """
        SELECT user_id, news_id, CASE WHEN publish_text = 'NULL' THEN timestamp '1970-01-01 00:00:00'
               ELSE strptime(publish_text, '%Y年%m月%d日%H:%M') END AS publish_ts FROM raw_log""",
    "nonzero_preferences": "SELECT user_id, category, round(share, 6) AS share FROM shares",
    "category_membership": """
        SELECT news_id, publish_ts, category FROM assignment
        WHERE category IN (SELECT category FROM shares)""",
    "vocab_membership": "SELECT news_id, term, n FROM new_top WHERE term IN (SELECT term FROM train_words)",
    "vocab_unknown": "SELECT news_id, term, n FROM new_top WHERE term NOT IN (SELECT term FROM train_words)",
    # scalar functions
    "tokenize_terms": "SELECT news_id, term, n FROM counts",
    "tokenize_bigrams": r"""
        SELECT news_id, term, count(*) AS n FROM (
            SELECT news_id, unnest(CASE WHEN regexp_full_match(run, '\p{Han}{2,}')
                THEN list_transform(range(1, length(run)), lambda i: substr(run, i, 2))
                ELSE [run] END) AS term
            FROM (SELECT news_id, unnest(regexp_extract_all(term, '\p{Han}+|[^\p{Han}]+')) AS run
                  FROM tokens))
        GROUP BY news_id, term""",
    "parse_publish_time": """
        SELECT news_id, CASE WHEN publish_text = 'NULL' THEN 0
               ELSE epoch_ms(strptime(publish_text, '%Y年%m月%d日%H:%M')) END AS publish_ms FROM news""",
    "composite_key": """
        SELECT news_id || '|' || epoch_ms(publish_ts) AS article_key,
               news_id || '|' || n_terms || '|' || epoch_ms(publish_ts) AS long_key,
               news_id AS id_part, epoch_ms(publish_ts) AS time_part
        FROM news JOIN lengths USING (news_id)""",
    "keyword_hash": "SELECT term, md5(trim(term)) AS term_hash FROM dfs",
    "article_age_hours": "SELECT news_id, age_h FROM gravities",
    "recover_counts": "SELECT news_id, term, n, cast(round(tf * n_terms) AS bigint) AS recovered FROM scored",
    "share_format": f"SELECT user_id, category, {_SHARE.format('share')} AS share_text FROM shares",
    # distinct and dedupe
    "dedup_exact": """
        SELECT DISTINCT news_id, CASE WHEN publish_text = 'NULL' THEN timestamp '1970-01-01 00:00:00'
               ELSE strptime(publish_text, '%Y年%m月%d日%H:%M') END AS publish_ts, content FROM raw_log""",
    "dedup_exact_content": "SELECT DISTINCT news_id, content FROM raw_log",
    "dedup_latest": """
        SELECT news_id, title, content, publish_text FROM raw_log
        QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY click_ts DESC, content DESC) = 1""",
    "vocabulary": "SELECT term, term_id FROM words",
    "vocabulary_append": """
        SELECT term, term_id FROM train_words UNION ALL
        SELECT term, (SELECT count(*) FROM train_words) + row_number() OVER (ORDER BY term) - 1
        FROM (SELECT DISTINCT term FROM top WHERE term NOT IN (SELECT term FROM train_words))""",
    "category_list": "SELECT DISTINCT cast(category AS varchar) AS category FROM assignment",
    "keyword_dictionary": "SELECT DISTINCT md5(term) AS term_hash, term FROM tags",
    # joins
    "clicks_join_category": """
        SELECT user_id, news_id, publish_ts, click_ts, category
        FROM timed_clicks JOIN assignment USING (news_id, publish_ts)""",
    "clicks_without_category": """
        SELECT user_id, news_id, publish_ts, click_ts
        FROM timed_clicks ANTI JOIN assignment USING (news_id, publish_ts)""",
    "label_join_matrix": """
        SELECT coalesce(a.news_id, r.news_id) AS news_id,
               coalesce(cast(category AS varchar), '') || ',' || coalesce(cells, '') AS line
        FROM assignment a FULL JOIN (
            SELECT news_id, string_agg(term || ':' || n, ',' ORDER BY term || ':' || n) AS cells
            FROM top GROUP BY news_id) r ON a.news_id = r.news_id""",
    "clicks_join_keywords": """
        SELECT user_id, news_id, click_ts, term, round(weight, 6) AS weight
        FROM clicks JOIN tags USING (news_id)""",
    "doc_vocab_zero_fill": """
        SELECT news_id, (SELECT count(*) FROM words) AS width,
               coalesce(string_agg(term_id, ',' ORDER BY term_id), '') AS indices,
               coalesce(string_agg(n, ',' ORDER BY term_id), '') AS values
        FROM news LEFT JOIN sparse_cells USING (news_id) GROUP BY news_id""",
    "hash_to_keyword": "SELECT news_id, md5(term) AS term_hash, term, round(weight, 6) AS weight FROM tags",
    "attach_titles": """
        SELECT user_id, rank, news_id, title FROM overlap_lists JOIN news USING (news_id) WHERE rank <= 10""",
    "pref_join_scores": """
        SELECT user_id, category, news_id, place, round(score, 6) AS score FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY round(gravity, 9) DESC, news_id) AS place
            FROM preferred)""",
    # aggregations
    "term_counts": "SELECT news_id, n_terms, term, n FROM counts JOIN lengths USING (news_id)",
    "doc_lengths": "SELECT news_id, n_terms FROM lengths",
    "doc_frequency": "SELECT term, df FROM dfs",
    "user_category_counts": "SELECT user_id, category, clicks FROM user_categories",
    "user_category_share": "SELECT user_id, category, round(share, 6) AS share FROM shares",
    "user_preference_matrix": "SELECT user_id, " + ", ".join(
        f"round(coalesce(sum(share) FILTER (category = {c}), 0), 6) AS cat_{c}" for c in range(K)
    ) + " FROM shares GROUP BY user_id",
    "user_preference_lines": "SELECT user_id, concat_ws(' ', " + ", ".join(
        _SHARE.format(f"sum(share) FILTER (category = {c})") for c in range(K)
    ) + ") AS shares FROM shares GROUP BY user_id",
    "cluster_sizes": "SELECT cluster, count(*) AS n_members FROM nearest GROUP BY cluster",
    "category_distinct_news": "SELECT category, count(DISTINCT news_id) AS n_news FROM assignment GROUP BY category",
    "user_keyword_profile": "SELECT user_id, term, round(weight, 6) AS weight FROM profile",
    "user_profile_map": """
        SELECT user_id, part, string_agg(term, '|' ORDER BY term) AS terms, round(sum(weight), 6) AS total
        FROM dealt
        GROUP BY user_id, part
        UNION ALL SELECT DISTINCT user_id, 0, '', 0.0 FROM clicks
        WHERE user_id NOT IN (SELECT user_id FROM profile)""",
    "user_profile_lines": _keyword_text(
        "dealt", "user_id, part"
    ),
    "news_keyword_hashed": _keyword_text("tags", "news_id", "md5(term)"),
    "classification_accuracy": """
        SELECT count(*) AS n_docs, count(*) FILTER (p.label = q.label) AS n_correct,
               round(count(*) FILTER (p.label = q.label) / cast(count(*) AS double), 6) AS accuracy
        FROM train_predicted p JOIN graded q USING (news_id)""",
    # ranking
    "top_keywords": "SELECT news_id, term, rank, round(tfidf, 6) AS tfidf FROM top",
    "han_keywords": """
        SELECT news_id, term, round(tfidf, 6) AS tfidf,
               row_number() OVER (PARTITION BY news_id ORDER BY round(tfidf, 9) DESC, term) AS rank
        FROM han_scored QUALIFY rank <= 50""",
    "gravity_rank_in_category": """
        SELECT category, news_id, row_number() OVER (PARTITION BY category
                   ORDER BY round(gravity, 9) DESC, news_id) AS rank, round(gravity, 6) AS gravity
        FROM gravities""",
    "top10_per_user": """
        SELECT user_id, news_id, rank FROM overlap_lists WHERE rank <= 10""",
    "user_score_order": """
        SELECT user_id, news_id, category, rank, round(score, 6) AS score FROM preferred""",
    "first_n_keywords": "SELECT news_id, term, rank FROM best WHERE rank <= 5",
    # text scoring and recommendation
    "term_frequency": "SELECT news_id, term, round(tf, 6) AS tf FROM scored",
    "inverse_doc_frequency": """
        SELECT term, df, round(log10(cast((SELECT count(*) FROM news) AS double) / df), 6) AS idf FROM dfs""",
    "tfidf": "SELECT news_id, term, n, n_terms, df, round(tfidf, 6) AS tfidf FROM scored",
    "title_body_keywords": "SELECT news_id, term, round(weight, 6) AS weight FROM tags",
    "doc_term_matrix": "SELECT news_id, term_id, n FROM sparse_cells",
    "doc_term_dense": """
        SELECT news_id, concat_ws(' ', news_id || '|' || epoch_ms(publish_ts), (SELECT count(*) FROM words),
                                  string_agg(term_id || ':' || n, ' ' ORDER BY term_id)) AS line
        FROM news LEFT JOIN sparse_cells USING (news_id) GROUP BY news_id, publish_ts""",
    "doc_term_binary": "SELECT news_id, term_id, 1 AS cell FROM sparse_cells WHERE n = 1",
    "new_doc_matrix": "SELECT news_id, term_id, n FROM new_top JOIN train_words USING (term)",
    "gravity_score": "SELECT category, news_id, votes, age_h, round(gravity, 6) AS gravity FROM gravities",
    "gravity_by_clicks": """
        SELECT category, news_id, votes, age_h, round(votes / pow(greatest(age_h, 0) + 2, 1.8), 6) AS gravity FROM (
            SELECT category, news_id, age_h, coalesce(n, 1) - 1 AS votes FROM gravities
            LEFT JOIN (SELECT news_id, count(*) AS n FROM clicks GROUP BY news_id) USING (news_id))""",
    "recommend_by_preference": """
        SELECT user_id, news_id, category, rank, round(score, 6) AS score FROM preferred WHERE rank <= 10""",
    "recommend_new_articles": """
        SELECT user_id, news_id, category,
               row_number() OVER (PARTITION BY user_id ORDER BY round(share, 9) DESC, category, news_id) AS rank
        FROM shares JOIN (SELECT news_id, label AS category FROM new_predicted) USING (category)""",
    "recommend_by_overlap": """
        SELECT user_id, news_id, rank, round(score, 6) AS score FROM overlap_lists WHERE rank <= 10""",
    "recommend_unread_by_overlap": """
        SELECT user_id, news_id, round(score, 6) AS score,
               row_number() OVER (PARTITION BY user_id ORDER BY rank) AS rank
        FROM overlap_lists ANTI JOIN clicks USING (user_id, news_id)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank) <= 10""",
    "overlap_counts": """
        SELECT user_id, news_id, n_shared, n_differing, round(s1, 6) AS s1, round(s2, 6) AS s2
        FROM overlap WHERE n_shared > 0""",
    # machine learning
    "kmeans_seeds": """
        SELECT cluster, vec_id, unnest(range(len(embedding))) AS dim,
               round(unnest(embedding)::double, 6) AS value FROM first_centres""",
    "kmeans_fit": _lloyd(),
    "kmeans_assign": "SELECT vec_id, cluster, round(distance, 6) AS distance FROM nearest",
    "kmeans_centres": """
        SELECT cluster, dim, round(avg(value), 6) AS mean FROM (
            SELECT cluster, unnest(range(len(embedding))) AS dim, unnest(embedding)::double AS value
            FROM nearest JOIN embeddings USING (vec_id))
        GROUP BY cluster, dim""",
    "kmeans_articles": "SELECT news_id, cluster FROM lloyd_assigned_3",
    "naive_bayes_fit": "SELECT label, term, weight, round(logp, 6) AS logp FROM likelihoods",
    "naive_bayes_labels": """
        SELECT label, n_docs, total, round(prior, 6) AS prior, round(unseen, 6) AS unseen FROM classes""",
    "naive_bayes_info": """
        SELECT (SELECT count(*) FROM train_words) AS n_features,
               (SELECT count(DISTINCT label) FROM graded) AS n_labels""",
    "naive_bayes_predict": "SELECT news_id, label, round(score, 6) AS score FROM new_predicted",
    "label_index": """
        SELECT label, row_number() OVER (ORDER BY label) - 1 AS index
        FROM (SELECT DISTINCT label FROM graded)""",
    # described only
    "decayed_profile": """
        SELECT user_id, term, round(sum(weight * pow(2, -(epoch_us(timestamp '2024-01-31 00:00:00')
                   - epoch_us(click_ts)) / 3.6e9 / 24)), 6) AS weight
        FROM clicks JOIN tags USING (news_id) GROUP BY user_id, term""",
    "user_hour_distribution": """
        SELECT user_id, slot, clicks, round(clicks / sum(clicks) OVER (PARTITION BY user_id), 6) AS share
        FROM (SELECT user_id, cast(floor(hour(click_ts) / 4) AS bigint) AS slot, count(*) AS clicks
              FROM clicks GROUP BY user_id, slot)""",
    "slot_boosted_profile": """
        SELECT user_id, term, round(CASE WHEN boosted THEN weight * 1.1::double ELSE weight END, 6) AS weight
        FROM (SELECT user_id, term, sum(weight) AS weight, bool_or(floor(hour(click_ts) / 4) = 0) AS boosted
              FROM clicks JOIN tags USING (news_id) GROUP BY user_id, term)""",
    # streams
    "stream_daily_clicks": """
        SELECT cast(click_ts AS date) AS day, cast(floor(hour(click_ts) / 4) AS bigint) AS slot,
               count(*) AS clicks
        FROM clicks GROUP BY day, slot
        HAVING day + 1 <= (SELECT max(click_ts) - INTERVAL 1 HOUR FROM clicks)""",
}
PARTS["boosted_profile"] = """
        SELECT user_id, term, CASE WHEN boosted THEN weight * 1.1::double ELSE weight END AS weight
        FROM (SELECT user_id, term, sum(weight) AS weight, bool_or(floor(hour(click_ts) / 4) = 0) AS boosted
              FROM clicks JOIN tags USING (news_id) GROUP BY user_id, term)"""
for _part in ("pairs", "overlap", "overlap_lists"):  # the same lists from the boosted profile
    PARTS[f"boosted_{_part}"] = re.sub(r"\b(profile|pairs|overlap)\b", r"boosted_\1", PARTS[_part])
BODIES["recommend_for_session"] = """
        SELECT user_id, news_id, rank, round(score, 6) AS score FROM boosted_overlap_lists WHERE rank <= 10"""
BODIES["recommend_after_updates"] = BODIES["recommend_by_overlap"]
BODIES["stream_user_profile"] = BODIES["user_keyword_profile"]
BODIES["stream_decayed_profile"] = BODIES["decayed_profile"]
BODIES["stream_category_counts"] = BODIES["user_category_counts"]


def _needed(sql: str, found: dict[str, None]) -> None:
    for word in dict.fromkeys(re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", sql)):
        if word in PARTS and word not in found:
            _needed(PARTS[word], found)
            found[word] = None


def statement(body: str) -> str:
    """A query with the common parts it uses, in order, in front."""
    found: dict[str, None] = {}
    _needed(body, found)
    parts = [f"{name} AS MATERIALIZED ({PARTS[name].strip()})" for name in found]
    head, own = "", body.strip()
    if own.startswith("WITH "):
        own_parts, own = own[5:], ""
        return f"WITH {', '.join([*parts, own_parts])}"
    if parts:
        head = f"WITH {', '.join(parts)} "
    return head + own


def oracle_sql() -> dict[str, str]:
    return {name: statement(body) for name, body in BODIES.items()}

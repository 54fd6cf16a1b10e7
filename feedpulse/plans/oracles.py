"""Plain SQL for the registered queries, written apart from the Spark code.

Each statement computes what the query of the same name returns, with other
means where there are any: token lists for regular expressions, window
functions for ``max_by``, date functions for arithmetic.
"""

from __future__ import annotations

from feedpulse.functions.wordlists import (
    LANGUAGE_PROFILES,
    LETTER_PROFILES,
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
)
from feedpulse.operators.language import (
    ENOUGH_WORDS,
    LEAST_POINTS,
    WORD_POINTS,
    group_points,
)
from feedpulse.plans.catalog import AS_OF, FEED

_WS = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _strip(col: str) -> str:
    return f"regexp_replace({col}, '^{_WS}+|{_WS}+$', '', 'g')"


def _normalize(col: str) -> str:
    return f"""array_to_string(list_transform(string_split({col}, ' '), lambda t:
        CASE WHEN starts_with(t, '@') AND length(t) > 1 THEN '@user'
             WHEN starts_with(t, 'http') THEN 'http' ELSE t END), ' ')"""


def _title(text: str) -> str:
    return f"""CASE WHEN strpos({text}, chr(10)) > 0
        THEN substr({text}, 1, strpos({text}, chr(10)) - 1) ELSE {text} END"""


def _body(text: str) -> str:
    return f"""CASE WHEN strpos({text}, chr(10)) > 0
        THEN substr({text}, strpos({text}, chr(10)) + 1) ELSE '' END"""


_POSTS = f"""
posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS subreddit, lang,
         {_title('text')} AS title, {_body('text')} AS text
  FROM documents)"""

# posts -> chunks of the normalised text -> word counts -> best chunk per post.
_SCORING = f"""
processed AS (
  SELECT *, {_normalize("title || ' ' || text")} AS processed,
         length({_strip("title || ' ' || text")}) < 3 AS short
  FROM posts),
chunks AS (
  SELECT id, pos, lower(substr(processed, 1 + 512 * pos, 512)) AS chunk
  FROM (SELECT id, processed,
               unnest(range(0, (length(processed) + 511) // 512)) AS pos
        FROM processed WHERE NOT short)),
tokens AS (SELECT id, pos, regexp_extract_all(chunk, '\\p{{L}}+') AS words FROM chunks),
counts AS (
  SELECT id, pos,
         len(list_filter(words, lambda w: list_contains({_list(POSITIVE_WORDS)}, w))) AS p,
         len(list_filter(words, lambda w: list_contains({_list(NEGATIVE_WORDS)}, w))) AS n
  FROM tokens),
verdicts AS (
  SELECT id, pos,
         CASE WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END AS label,
         CASE WHEN p + n = 0 THEN 0.5e0
              ELSE 0.5e0 + 0.5e0 * abs(p - n) / (p + n) END AS score
  FROM counts),
best AS (
  SELECT id, label, score FROM verdicts
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, pos) = 1),
scored AS (
  SELECT r.id, subreddit, title, text, lang, 'submission' AS type,
         coalesce(label, 'neutral') AS sentiment_label,
         coalesce(score, 0.5e0) AS sentiment_score,
         CASE WHEN short THEN '' ELSE processed END AS cleaned_text
  FROM processed r LEFT JOIN best b ON r.id = b.id)"""

_SCORED = f"""{_POSTS}, {_SCORING},
timed AS (
  SELECT s.*, e.ts AS created_at
  FROM scored s JOIN events e ON s.id = CAST(e.event_id AS VARCHAR))
"""

_SCORED_POSTS = f"""WITH {_SCORED}
SELECT id, sentiment_label, round(sentiment_score, 6) AS sentiment_score, cleaned_text
FROM scored"""

_LANGUAGES = sorted(LANGUAGE_PROFILES)


def _language(text: str) -> str:
    """CTEs ``hits`` and ``detected`` over a relation ``texts(id, t)``."""
    def letters(g: str) -> str:
        return " + ".join(
            f"(length(t) - length(replace(t, '{x}', ''))) // {len(x)} * {group_points(x)}"
            for x in LETTER_PROFILES[g]
        )

    counts = ", ".join(
        f"len(list_filter(words, lambda w: list_contains({_list(LANGUAGE_PROFILES[g])}, w))) AS n_{g}"
        for g in _LANGUAGES
    )
    known = sorted({w for words in LANGUAGE_PROFILES.values() for w in words})
    points = ", ".join(
        f"CASE WHEN n >= {ENOUGH_WORDS} THEN n_{g} ELSE n_{g} * {WORD_POINTS} + {letters(g)} END AS {g}"
        for g in _LANGUAGES
    )
    most = f"greatest({', '.join(_LANGUAGES)})"
    cases = " ".join(f"WHEN {g} = {most} THEN '{g}'" for g in _LANGUAGES)
    return f"""
texts AS ({text}),
counted AS (
  SELECT id, t, {counts}, len(list_filter(words, lambda w: list_contains({_list(known)}, w))) AS n
  FROM (SELECT id, lower(t) AS t, regexp_extract_all(lower(t), '\\p{{L}}+') AS words FROM texts)),
hits AS (SELECT id, n, {points} FROM counted),
detected AS (
  SELECT id, CASE WHEN {most} < CASE WHEN n >= {ENOUGH_WORDS} THEN 1 ELSE {LEAST_POINTS} END
              THEN NULL {cases} END AS lang_detected FROM hits)"""


def _events_view(pace: int = 1) -> str:
    return f"""
view AS (
  SELECT CAST(event_id AS VARCHAR) AS id, make_timestamp(epoch_us(ts) // {pace}) AS created_at,
         'user' || user_id AS subreddit, event_type AS sentiment_label,
         value AS sentiment_score
  FROM events)"""


def _trend(view: str, positive: str) -> str:
    return f"""WITH {view},
span AS (SELECT epoch_us(max(created_at)) - epoch_us(min(created_at)) AS d FROM view),
bucketed AS (
  SELECT CASE WHEN d < 43200000000 THEN time_bucket(INTERVAL 15 MINUTE, created_at)
              WHEN d < 86400000000 THEN date_trunc('hour', created_at)
              WHEN d < 604800000000 THEN CAST(date_trunc('day', created_at) AS TIMESTAMP)
              ELSE CAST(date_trunc('week', created_at) AS TIMESTAMP) END AS bucket,
         sentiment_score, sentiment_label
  FROM view, span WHERE created_at IS NOT NULL),
grouped AS (
  SELECT bucket, avg(sentiment_score) AS a, count(sentiment_score) AS posts,
         avg(CASE WHEN sentiment_label = '{positive}' THEN 1e0 ELSE 0e0 END) AS r
  FROM bucketed GROUP BY bucket)
SELECT bucket, round(a, 6) AS avg_score, posts, round(r, 6) AS positive_ratio
FROM grouped WHERE (SELECT count(*) FROM grouped) >= 2 ORDER BY bucket"""


def _headline(view: str) -> str:
    return f"""WITH {view}
SELECT count(*) AS total_posts, count(DISTINCT subreddit) AS unique_subreddits,
       round(avg(sentiment_score), 6) AS avg_score,
       coalesce((SELECT sentiment_label FROM view WHERE sentiment_label IS NOT NULL
                 GROUP BY sentiment_label ORDER BY count(*) DESC, sentiment_label LIMIT 1),
                'N/A') AS most_common_label
FROM view"""


def _cards(order: str = "") -> str:
    return f"""WITH {_SCORED}
SELECT id,
       CASE WHEN length(title) > 80 THEN substr(title, 1, 80) || '...' ELSE title END AS title,
       subreddit, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS posted,
       upper(sentiment_label) AS sentiment,
       CASE sentiment_label WHEN 'positive' THEN 'green' WHEN 'negative' THEN 'red'
            ELSE 'gray' END AS color,
       round(sentiment_score, 6) AS score,
       CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || '...' ELSE text END AS content
FROM timed {order}"""


_NOISY = r"""chr(32) || chr(9) || '@bob http://x.y/z  @ ' || text || ' @' || source
    || ' https://' || source || chr(10) || chr(160) || ' '"""

_PADDED = r"""CASE WHEN lang = 'de' THEN '  ' || chr(10) || ' '
    ELSE chr(9) || ' ' || text || '  ' END"""

_STRIPPED = f"""
stripped AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS subreddit, lang,
         {_strip(_title('text'))} AS title, {_strip(_body('text'))} AS text
  FROM documents)"""

_STRIPPED_LANGUAGE = _language(
    "SELECT id, title || ' ' || text AS t FROM stripped WHERE title <> '' OR text <> ''"
)

ORACLES: dict[str, str] = {
    "sentiment_distribution": f"""WITH {_SCORED}
SELECT upper(sentiment_label) AS sentiment_label, count(*) AS posts,
       round(count(*) / (SELECT count(*) FROM scored), 6) AS share
FROM scored GROUP BY 1 ORDER BY posts DESC, sentiment_label""",
    "scored_posts": _SCORED_POSTS.replace(
        "range(0, (length(processed) + 511) // 512)",
        "range(0, least(3, (length(processed) + 511) // 512))",
    ),
    "scored_whole_posts": _SCORED_POSTS,
    "model_scored_posts": _SCORED_POSTS,
    "stream_scored_posts": _SCORED_POSTS,
    "normalize_mentions_links": f"""
SELECT doc_id, {_normalize('noisy')} AS normalized, {_strip('noisy')} AS stripped
FROM (SELECT doc_id, {_NOISY} AS noisy FROM documents)""",
    "chunk_text": """
SELECT doc_id, CAST(pos AS INTEGER) AS chunk_no, substr(text, 1 + 512 * pos, 512) AS chunk,
       pos < 3 AS scored
FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 511) // 512)) AS pos FROM documents)""",
    "detect_language": f"""
WITH {_language('SELECT doc_id AS id, text AS t FROM documents')}
SELECT id AS doc_id, lang_detected FROM detected""",
    "language_filter": f"""WITH {_STRIPPED}, {_STRIPPED_LANGUAGE}
SELECT s.id, subreddit, title, text, 'submission' AS type
FROM stripped s JOIN detected d ON s.id = d.id WHERE lang_detected = 'en'""",
    "stream_feed": f"""WITH {_STRIPPED}, {_STRIPPED_LANGUAGE},
posts AS (
  SELECT s.* FROM stripped s JOIN detected d ON s.id = d.id
  WHERE lang_detected = 'en' AND list_contains({_list(FEED)}, subreddit)),
{_SCORING}
SELECT id, subreddit, title, text, type, upper(sentiment_label) AS sentiment_label,
       round(sentiment_score, 6) AS sentiment_score
FROM scored""",
    "clean_feed": f"""
WITH padded AS (SELECT doc_id, source, {_PADDED} AS t FROM documents),
stripped AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS subreddit,
         {_strip(_title('t'))} AS title, {_strip(_body('t'))} AS text
  FROM padded)
SELECT *, 'submission' AS type FROM stripped
WHERE list_contains({_list(FEED)}, subreddit) AND (title <> '' OR text <> '')""",
    "feed_by_table": f"""
SELECT CAST(doc_id AS VARCHAR) AS id, source AS subreddit, {_title('text')} AS title
FROM documents
WHERE source IN (SELECT source FROM documents GROUP BY source HAVING avg(n_chars) > 2450)""",
    "event_times": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown,
       time_bucket(INTERVAL 15 MINUTE, ts) AS start_minutes,
       date_trunc('hour', ts) AS start_hour,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS start_day,
       CAST(date_trunc('week', ts) AS TIMESTAMP) AS start_week, ts AS back
FROM events""",
    "event_cards": """
WITH cards AS (
  SELECT *, repeat('é' || event_type || ' ', 12) AS title,
         CASE WHEN event_type <> 'click' THEN repeat(event_type || chr(10), 70) ELSE '' END AS text
  FROM events)
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN length(title) > 80 THEN left(title, 80) || '...' ELSE title END AS title,
       'user' || user_id AS subreddit,
       CASE WHEN event_type = 'signup' THEN 'Unknown'
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS posted,
       CASE event_type WHEN 'purchase' THEN 'POSITIVE' WHEN 'error' THEN 'NEGATIVE'
            WHEN 'view' THEN 'UNKNOWN' ELSE 'NEUTRAL' END AS sentiment,
       CASE event_type WHEN 'purchase' THEN 'green' WHEN 'error' THEN 'red' ELSE 'gray' END
         AS color,
       value AS score, printf('%.2f', value) AS score_text,
       CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END AS content
FROM cards""",
    "json_roundtrip": f"""
SELECT CAST(doc_id AS VARCHAR) AS id, ts AS created_at, source AS subreddit,
       {_title('text')} AS title, {_body('text')} AS text, 'submission' AS type
FROM documents JOIN events ON doc_id = event_id""",
    "event_props": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "dead_letters": """
SELECT event_id, left(props, length(props) - 1) AS value, 'malformed' AS reason
FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, replace(props, '"k"', '"j"'), 'no_key' FROM events WHERE event_type = 'signup'""",
    "posts_view": """
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END AS created_at,
       'events' AS subreddit, CASE WHEN event_type = 'click' THEN '' ELSE props END AS title,
       '' AS text, 'submission' AS type, upper(event_type) AS sentiment_label,
       CASE WHEN event_type = 'error' THEN 0.5 ELSE value END AS sentiment_score
FROM events""",
    "headline_metrics": _headline(
        f"{_SCORED}, view AS (SELECT * REPLACE (upper(sentiment_label) AS sentiment_label) "
        "FROM scored)"
    ),
    "headline_metrics_events": _headline(_events_view()),
    "most_common_label": f"""WITH {_events_view()}
SELECT sentiment_label AS most_common_label FROM view
GROUP BY sentiment_label ORDER BY count(*) DESC, sentiment_label LIMIT 1""",
    "trend_15min": _trend(_events_view(100), "purchase"),
    "trend_hourly": _trend(_events_view(40), "purchase"),
    "trend_daily": _trend(_events_view(8), "purchase"),
    "trend_weekly": _trend(_events_view(), "purchase"),
    "trend_of_rollup": _trend(_events_view(8), "purchase"),
    "trend_posts": _trend(f"{_SCORED}, view AS (SELECT * FROM timed)", "positive"),
    "trend_summary": """
SELECT min(ts) AS first_post, max(ts) AS last_post,
       CASE WHEN max(ts) - min(ts) < INTERVAL 12 HOUR THEN '15-Minute Intervals'
            WHEN max(ts) - min(ts) < INTERVAL 1 DAY THEN 'Hourly'
            WHEN max(ts) - min(ts) < INTERVAL 7 DAY THEN 'Daily' ELSE 'Weekly' END
         AS time_grouping,
       count(DISTINCT CASE WHEN d < INTERVAL 12 HOUR THEN time_bucket(INTERVAL 15 MINUTE, ts)
                           WHEN d < INTERVAL 1 DAY THEN date_trunc('hour', ts)
                           WHEN d < INTERVAL 7 DAY THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
                           ELSE CAST(date_trunc('week', ts) AS TIMESTAMP) END) AS points
FROM events, (SELECT max(ts) - min(ts) AS d FROM events)""",
    "time_span": """
SELECT min(ts) AS first_post, max(ts) AS last_post,
       epoch_us(max(ts)) - epoch_us(min(ts)) AS span_micros
FROM events""",
    "adaptive_bucket": f"""WITH {_events_view(100)}
SELECT id, CASE WHEN d < 43200000000 THEN time_bucket(INTERVAL 15 MINUTE, created_at)
                WHEN d < 86400000000 THEN date_trunc('hour', created_at)
                WHEN d < 604800000000 THEN CAST(date_trunc('day', created_at) AS TIMESTAMP)
                ELSE CAST(date_trunc('week', created_at) AS TIMESTAMP) END AS bucket
FROM view, (SELECT epoch_us(max(created_at)) - epoch_us(min(created_at)) AS d FROM view)""",
    "community_sentiment": f"""WITH {_SCORED}
SELECT subreddit, round(avg(sentiment_score), 6) AS avg_score, count(id) AS posts
FROM scored GROUP BY subreddit""",
    "top_communities": f"""WITH {_events_view()}
SELECT subreddit, round(avg(sentiment_score), 6) AS avg_score, count(id) AS posts
FROM view GROUP BY subreddit ORDER BY posts DESC, subreddit LIMIT 10""",
    "post_cards": _cards(),
    "recent_posts": _cards("ORDER BY created_at DESC NULLS LAST, id LIMIT 10"),
    "raw_sample": f"""WITH {_events_view()}
SELECT id, created_at, subreddit, sentiment_label,
       round(sentiment_score, 6) AS sentiment_score
FROM view ORDER BY id LIMIT 3""",
    "table_summary": """
SELECT max(ts) AS newest_post, count(*) AS records
FROM documents JOIN events ON doc_id = event_id""",
    "schema_report": """
SELECT column_name, type, status, filled FROM (
  SELECT 'id' AS column_name, 'string' AS type, 'present' AS status, count(doc_id) AS filled
  FROM documents
  UNION ALL SELECT 'created_at', 'timestamp', 'present', 0
  UNION ALL SELECT 'subreddit', 'string', 'present', count(source) FROM documents
  UNION ALL SELECT 'title', 'string', 'present', count(text) FROM documents
  UNION ALL SELECT 'text', 'string', 'present', count(text) FROM documents
  UNION ALL SELECT 'type', 'string', 'present', count(*) FROM documents
  UNION ALL SELECT 'sentiment_label', NULL, 'missing', 0
  UNION ALL SELECT 'sentiment_score', NULL, 'missing', 0)""",
    "latest_per_id": """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "retained_posts": f"""
SELECT event_id, ts AS insertion_time, CAST(hour(ts) AS INTEGER) AS bucket,
       CAST(ts AS DATE) AS dt
FROM events WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY""",
    "stored_posts": f"""WITH {_SCORED.replace(
        _title('text') + ' AS title',
        "CASE WHEN lang = 'en' THEN 'edited: ' ELSE '' END || " + _title('text') + ' AS title',
    )}
SELECT id, subreddit, title, text, type, upper(sentiment_label) AS sentiment_label,
       round(sentiment_score, 6) AS sentiment_score
FROM scored""",
    "stream_batch_log": """
SELECT count(*) AS rows_in,
       count(*) FILTER (source NOT IN ('src7', 'src9')) AS rows_valid,
       count(*) FILTER (source IN ('src7', 'src9')) AS rows_dead,
       count(*) FILTER (source NOT IN ('src7', 'src9')) AS rows_written
FROM documents""",
    "stream_rollup": """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, 'events' AS subreddit,
       upper(event_type) AS sentiment_label, count(*) AS posts, count(value) AS scored,
       round(sum(value), 4) AS score_sum, min(ts) AS first_post, max(ts) AS last_post
FROM events GROUP BY 1, 3""",
    "cut_texts": """
SELECT doc_id, CASE WHEN length(text) > 512 THEN substr(text, 1, 512) || '... [truncated]'
                    ELSE text END AS cut
FROM documents""",
    "title_language": f"""
WITH {_language(f"SELECT doc_id AS id, {_title('text')} AS t FROM documents")}
SELECT id AS doc_id, lang_detected FROM detected""",
    "short_posts": f"""
SELECT doc_id, n, length({_strip('t')}) < 3 AS short
FROM (SELECT doc_id, CAST(n AS INTEGER) AS n, substr(text, 1, n) AS t
      FROM documents, (SELECT unnest(range(0, 5)) AS n))""",
    "new_posts": f"""
SELECT event_id, ts AS created_at FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY""",
    "undated_trend": _trend(
        """view AS (
  SELECT CASE WHEN event_type <> 'view' THEN ts END AS created_at, value AS sentiment_score,
         CASE WHEN event_type <> 'click' THEN event_type END AS sentiment_label FROM events)""",
        "purchase",
    ),
    "single_bucket": "SELECT count(*) AS posts, 0::BIGINT AS buckets FROM events",
    "approx_headline": """
SELECT count(*) AS total_posts, true AS communities_within_5_percent FROM events""",
    "stored_events": f"""
SELECT CAST(event_id AS VARCHAR) AS id, 'events' AS subreddit, TIMESTAMP '{AS_OF}' AS insertion_time,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END::BIGINT AS version,
       CASE WHEN event_type = 'error' THEN 'NEGATIVE' ELSE 'POSITIVE' END AS sentiment_label
FROM events""",
    "limited_scan": """
SELECT CAST(event_id AS VARCHAR) AS id, date_trunc('second', ts) AS created_at FROM events
ORDER BY date_trunc('second', ts) DESC, CAST(event_id AS VARCHAR) LIMIT 25""",
    "model_errors": f"""WITH {_SCORED}
SELECT id, CASE WHEN subreddit IN ('src1', 'src2', 'src3') THEN 'neutral'
                ELSE sentiment_label END AS sentiment_label,
       CASE WHEN subreddit IN ('src1', 'src2', 'src3') THEN 0.5
            ELSE round(sentiment_score, 6) END AS sentiment_score,
       subreddit IN ('src1', 'src2', 'src3') AS score_error
FROM scored""",
    "stream_resent_rollup": f"""WITH {_SCORED.replace(
        _body('text') + ' AS text',
        "CASE WHEN lang = 'en' THEN 'useless garbage ' ELSE '' END || " + _body('text') + ' AS text',
    )}
SELECT subreddit, upper(sentiment_label) AS sentiment_label, count(*) AS posts,
       round(sum(sentiment_score), 4) AS score_sum
FROM scored GROUP BY 1, 2""",
    "stream_progress": """
SELECT 4::BIGINT AS batches, count(*) AS rows, true AS logged FROM documents""",
    "dashboard_panels": f"""WITH {_events_view()},
labels AS (
  SELECT sentiment_label AS label, count(*) AS n FROM view
  WHERE sentiment_label IS NOT NULL GROUP BY 1),
weeks AS (
  SELECT date_trunc('week', created_at) AS week, count(*) AS n, avg(sentiment_score) AS score,
         avg(CASE WHEN sentiment_label = 'POSITIVE' THEN 1.0 ELSE 0.0 END) AS share
  FROM view GROUP BY 1),
communities AS (
  SELECT subreddit, count(*) AS n, avg(sentiment_score) AS score FROM view GROUP BY 1
  ORDER BY n DESC, subreddit LIMIT 10),
newest AS (SELECT * FROM view ORDER BY created_at DESC NULLS LAST, id LIMIT 10)
SELECT 'headline' AS panel, (SELECT label FROM labels ORDER BY n DESC, label LIMIT 1) AS key,
       count(*) AS posts, round(avg(sentiment_score), 6) AS score, NULL::DOUBLE AS share FROM view
UNION ALL
SELECT 'distribution', label, n, NULL, round(n / (SELECT sum(n) FROM labels), 6) FROM labels
UNION ALL SELECT 'communities', subreddit, n, round(score, 6), NULL FROM communities
UNION ALL
SELECT 'trend', strftime(week, '%Y-%m-%d %H:%M:%S'), n, round(score, 6), round(share, 6) FROM weeks
UNION ALL SELECT 'trend_summary', 'Weekly', count(*), NULL, NULL FROM weeks
UNION ALL
SELECT 'summary', strftime(max(created_at), '%Y-%m-%d %H:%M:%S'), count(*), NULL, NULL FROM view
UNION ALL SELECT 'recent_posts', id, 1, round(sentiment_score, 6), NULL FROM newest""",
    "retained_rollup": """
SELECT time_bucket(INTERVAL '15 minutes', date_trunc('second', ts)) AS bucket,
       'events' AS subreddit, 'POSITIVE' AS sentiment_label,
       count(*) AS posts, count(*) AS stored, round(count(*) * 1.0::DOUBLE, 4) AS score_sum
FROM events WHERE event_type = 'error' GROUP BY 1""",
    "stream_trend": """
WITH e AS (
  SELECT time_bucket(INTERVAL '15 minutes', date_trunc('second', ts)) AS bucket, value,
         event_id % 10 = 7 AS second_batch, date_trunc('second', ts) AS t FROM events),
over AS (
  SELECT max(t) FILTER (WHERE NOT second_batch) - INTERVAL '1 hour' AS first,
         max(t) - INTERVAL '1 hour' AS last FROM e)
SELECT bucket, second_batch AND bucket + INTERVAL '15 minutes' <= first AS late,
       count(*) AS posts, round(sum(value), 4) AS score_sum
FROM e, over WHERE bucket + INTERVAL '15 minutes' <= last GROUP BY 1, 2""",
    "compacted_windows": """
WITH n AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS e FROM events)
SELECT n AS posts, n AS ids, e AS best, n AS posts_before, 6::BIGINT AS batches,
       (3 * n + 3 * e)::BIGINT AS rows_in, 6 AS folders_before, 3 AS folders FROM n""",
    "indexed_lookup": """
SELECT CAST(event_id AS VARCHAR) AS id, date_trunc('second', ts) AS created_at,
       CASE WHEN event_type = 'error' THEN 'NEGATIVE' ELSE 'POSITIVE' END AS sentiment_label,
       true AS files_skipped
FROM events WHERE event_id IN (SELECT doc_id FROM documents)""",
    "newest_stored": """
SELECT CAST(event_id AS VARCHAR) AS id, date_trunc('second', ts) AS created_at,
       CASE WHEN event_type = 'error' THEN 'NEGATIVE' ELSE 'POSITIVE' END AS sentiment_label
FROM events ORDER BY date_trunc('second', ts) DESC, CAST(event_id AS VARCHAR) LIMIT 25""",
    "learned_language": """
SELECT count(*) AS told, count(*) FILTER (WHERE doc_id % 4 = 2) AS unseen, true AS right
FROM documents""",
    "learned_scores": """
SELECT count(*) AS posts, 0::BIGINT AS errors, true AS separates FROM documents""",
    "new_files_only": """
SELECT CAST(doc_id AS VARCHAR) AS id, source AS subreddit, split_part(text, chr(10), 1) AS title
FROM documents WHERE lang = 'en'""",
}

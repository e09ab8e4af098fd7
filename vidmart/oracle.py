"""DuckDB SQL for the registered queries, written independently of the DataFrame code.

Everything starts from the benchmark tables; common table expressions stand for the sources,
the cleaned sources, the warehouse tables, and each query is a final SELECT over them.
"""

from __future__ import annotations

import re


def half_up(x: str, k: int) -> str:
    """Round a double that stands for an exact quotient: decimal ties go away from zero."""
    if k == 0:
        return f"round({x}, 0)"
    return f"CAST(round(CAST({x} AS DECIMAL(38,{k + 5})), {k}) AS DOUBLE)"


def printed(x: str, k: int) -> str:
    """Round a double by its shortest printed form, as Spark's round does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {k}) AS DOUBLE)"


SPACE = r"[\s\x0B\x1c-\x1f\x{85}\pZ]+"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}|{SPACE}$', '', 'g')"


def tags(x: str) -> str:
    return (
        f"[regexp_replace(lower(regexp_replace(w, '^#+', '')), '^[.,!?;:]+|[.,!?;:]+$', '', 'g')"
        f" for w in string_split_regex(coalesce({x}, ''), '{SPACE}')"
        " if starts_with(w, '#') and length(w) > 1]"
    )


_FOLLOWERS = "CAST(floor({b} * abs({b}) / 8) AS BIGINT)"
_VIDEO_COLUMNS = (
    "authorMeta_avatar", "authorMeta_name", "text", "diggCount", "shareCount", "playCount",
    "commentCount", "videoMeta_duration", "musicMeta_musicName", "musicMeta_musicAuthor",
    "musicMeta_musicOriginal", "createTimeISO", "webVideoUrl",
)
_CREATOR_COLUMNS = (
    "influencer_id", "username", "display_name", "follower_count", "following_count",
    "total_videos", "avg_views_per_video", "country", "niche_category", "is_verified",
    "account_type", "joined_date", "bio_length_chars", "has_external_link",
)


def _best(first: str, columns) -> str:
    rest = [c for c in columns if c != first]
    return ", ".join(f"{c} DESC NULLS LAST" for c in [first, *rest])


def _customers(followers: str) -> str:
    return f"""
SELECT 'INF' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS influencer_id,
  upper(c_name) || ' ' AS username, c_name AS display_name, {followers} AS follower_count,
  nullif(c_custkey % 5000, 0) AS following_count, c_custkey % 900 AS total_videos,
  c_custkey * 31 AS avg_views_per_video, n_name AS country, c_mktsegment AS niche_category,
  CAST(c_custkey % 6 = 0 AS BIGINT) AS is_verified,
  ['Personal', 'Creator', 'Business'][c_custkey % 3 + 1] AS account_type,
  strftime(DATE '2015-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y-%m-%d') AS joined_date,
  length(c_mktsegment) AS bio_length_chars, c_custkey % 2 AS has_external_link
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _suppliers(prefix: str) -> str:
    return f"""
SELECT 'SUP' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0'),
  {prefix} || lpad(CAST(s_suppkey AS VARCHAR), 9, '0'), s_name,
  {_FOLLOWERS.format(b='s_acctbal')}, s_suppkey, CAST(NULL AS BIGINT), s_suppkey * 17, n_name,
  'SUPPLIER', CAST(NULL AS BIGINT), 'Business', '2014-01-01', 0, 1
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def _taxonomy_part(prefix: str, spelling: str) -> str:
    return f"""
SELECT '{prefix}' || lpad(CAST(w AS VARCHAR), 6, '0') AS hashtag_id, {spelling} AS hashtag,
  ['Entertainment', 'Music', 'Comedy', 'Sports', 'Travel'][w % 5 + 1] AS category,
  CASE WHEN w % 3 > 0 THEN 'sub' || CAST(w % 3 AS VARCHAR) END AS subcategory,
  CAST(CASE WHEN w % 4 = 0 THEN 0 WHEN w % 7 <> 0 THEN 1 END AS BIGINT) AS is_brand_safe,
  'PG' AS content_rating,
  ['low', 'medium', 'high', 'viral', 'huge'][w % 5 + 1] AS search_volume_tier,
  'en' AS language_primary, '1995-01-01' AS created_at, '1995-01-01' AS last_updated
FROM words"""


_NEW_VERSION = """creator_nk, display_name, coalesce(follower_count, 0) AS follower_count,
  coalesce(following_count, 0) AS following_count, coalesce(total_videos, 0) AS total_videos,
  country, niche_category, coalesce(is_verified = 1, false) AS is_verified, account_type"""
_NUMBER = "row_number() OVER (ORDER BY substr(md5({k}), 1, 4), {k})"

_TIERS = ("Nano (<10K)", "Micro (10K-100K)", "Mid (100K-1M)", "Macro (1M-10M)", "Mega (>10M)")


def tier(x: str, numbered: bool) -> str:
    names = [f"{i + 1}. {n}" if numbered else n for i, n in enumerate(_TIERS)]
    return (
        f"CASE WHEN {x} < 10000 THEN '{names[0]}' WHEN {x} < 100000 THEN '{names[1]}'"
        f" WHEN {x} < 1000000 THEN '{names[2]}' WHEN {x} < 10000000 THEN '{names[3]}'"
        f" ELSE '{names[4]}' END"
    )


DURATION_KEY = """CASE WHEN videoMeta_duration <= 15 THEN 'short_15s'
  WHEN videoMeta_duration <= 60 THEN 'medium_60s' WHEN videoMeta_duration <= 180 THEN 'long_3m'
  ELSE 'extended' END"""


def duration_label(x: str) -> str:
    return (
        f"CASE WHEN {x} <= 15 THEN 'Short (<=15s)' WHEN {x} <= 60 THEN 'Medium (<=60s)'"
        f" WHEN {x} <= 180 THEN 'Long (<=3m)' ELSE 'Extended (>3m)' END"
    )


SENTIMENT_LABEL = """CASE WHEN positive_comment_pct >= 70 THEN 'Highly Positive (>=70%)'
  WHEN positive_comment_pct >= 50 THEN 'Mostly Positive (50-69%)'
  WHEN positive_comment_pct >= 30 THEN 'Mixed (30-49%)' ELSE 'Mostly Negative (<30%)' END"""

def _tidy(rows: str) -> str:
    return f"""
SELECT * REPLACE (lower({strip('authorMeta_name')}) AS authorMeta_name,
  coalesce(shareCount, 0) AS shareCount, coalesce(commentCount, 0) AS commentCount,
  TRY_CAST(replace(replace(createTimeISO, 'T', ' '), 'Z', '') AS TIMESTAMP) AS createTimeISO)
FROM {rows}"""


def _rules() -> dict[str, str]:
    lengths = {"hashtag_id": 10, "hashtag": 100, "category": 50, "subcategory": 60,
               "content_rating": 10, "search_volume_tier": 10, "language_primary": 5}
    rules = {f"{c} is null": f"{c} IS NULL" for c in ("hashtag_id", "hashtag", "category")}
    rules["is_brand_safe not 0 or 1"] = "is_brand_safe NOT IN (0, 1)"
    rules["search_volume_tier unknown"] = (
        "search_volume_tier NOT IN ('low', 'medium', 'high', 'viral')"
    )
    rules |= {f"{c} longer than {n}": f"length({c}) > {n}" for c, n in lengths.items()}
    return rules


BROKEN_TAG = " OR ".join(f"coalesce({bad}, false)" for bad in _rules().values())
# What the fact's columns cannot hold.
TOO_LARGE = """coalesce(engagement_rate >= 99.9999995, false)
  OR greatest(commentCount, shareCount, videoMeta_duration, total_comments_scraped) > 2147483647
  OR hashtag_count > 32767 OR coalesce(abs(avg_sentiment_score) >= 9.99995, false)"""


# In order: each expression may use the ones above it.
CTES: dict[str, str] = {
    "videos_raw": """
SELECT 'https://cdn.example/' || CAST(c_custkey AS VARCHAR) || '.jpg' AS authorMeta_avatar,
  CASE WHEN c_nationkey <> 24 THEN ' ' || upper(c_name) || chr(9) END AS authorMeta_name,
  CASE WHEN p_size = 1 THEN NULL WHEN p_type = 'LARGE' THEN p_name
    WHEN p_type = 'MEDIUM' THEN '#' || p_brand || ' #!'
    ELSE 'Watch #' || split_part(p_name, ' ', 1) || ', ##' || upper(split_part(p_name, ' ', 2))
      || '! x#no' || chr(160) || '#' || p_brand || ' #' || split_part(p_name, ' ', 1)
  END AS text,
  nullif(CAST(round(l_discount * 100) AS BIGINT), 0) * CAST(l_quantity AS BIGINT) * 100
    AS diggCount,
  nullif(CAST(round(l_tax * 100) AS BIGINT), 0) * CAST(l_quantity AS BIGINT) AS shareCount,
  CASE WHEN l_quantity > 1 THEN (CAST(floor(l_extendedprice) AS BIGINT) - 2000) * 11 END
    AS playCount,
  nullif(CAST(l_linenumber AS BIGINT), 7) AS commentCount,
  nullif((o_custkey * 7 + o_orderkey) % 400, 0) AS videoMeta_duration,
  p_name AS musicMeta_musicName,
  CASE WHEN p_size <= 45 THEN p_brand END AS musicMeta_musicAuthor,
  p_type IN ('PROMO', 'ECONOMY') AS musicMeta_musicOriginal,
  CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN 'n/a'
    ELSE strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)),
                  '%Y-%m-%dT%H:%M:%S.000Z') END AS createTimeISO,
  'https://v.example/@' || c_name
    || CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' AND l_discount = 0
         THEN '/live/' ELSE '/video/' END
    || CAST(o_orderkey AS VARCHAR)
    || CASE WHEN l_linestatus = 'O' THEN '?lang=en' ELSE '' END AS webVideoUrl
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey""",
    "creators_first_raw": _customers(_FOLLOWERS.format(b="c_acctbal")),
    "creators_raw": _customers(
        f"CAST(floor({_FOLLOWERS.format(b='c_acctbal')} * (90 + c_custkey % 21) / 100) AS BIGINT)"
    )
    + " UNION ALL "
    + _suppliers("chr(9) || 'customer#'")
    + " UNION ALL "
    + _suppliers("'Supplier#'"),
    "comments_raw": """
SELECT 'CMT' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS _id,
  CASE WHEN value >= 1 THEN CAST(user_id * 100 + event_id % 5 AS VARCHAR) END AS video_id,
  'https://v.example/video/' || CAST(user_id * 100 + event_id % 5 AS VARCHAR) AS video_url,
  'user' || CAST(user_id AS VARCHAR) AS creator_username,
  event_type || ': ' || props || ' café 日本 it''s ok!' AS comment_text,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive'
    WHEN event_type = 'error' THEN 'negative' WHEN event_type = 'view' THEN 'neutral'
    ELSE 'unknown' END AS sentiment_label,
  value / 500 AS sentiment_score, CAST(floor(value) AS BIGINT) AS like_count,
  event_id % 4 = 0 AS is_reply, CAST(NULL AS VARCHAR) AS parent_comment_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0')
    || 'Z' AS comment_timestamp,
  ['nano', 'micro', 'mid', 'macro', 'mega'][event_id % 5 + 1] AS user_follower_tier,
  'en' AS language_detected
FROM events""",
    "words": """
SELECT word, min(p_partkey * 2 + pos) AS w FROM (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word,
    unnest(range(len(string_split(p_name, ' ')))) AS pos
  FROM part) GROUP BY word""",
    "taxonomy_raw": _taxonomy_part("HT", "word")
    + " UNION ALL "
    + _taxonomy_part("HU", "upper(word) || ' '"),
    "holidays": """
SELECT CAST(o_orderdate AS DATE) AS full_date,
  min(CASE WHEN month(o_orderdate) = 1 THEN 'New Year' ELSE 'Christmas Day' END) AS holiday_name
FROM orders
WHERE (month(o_orderdate) = 1 AND day(o_orderdate) = 1)
  OR (month(o_orderdate) = 12 AND day(o_orderdate) = 25)
GROUP BY 1""",
    "played": """
SELECT *, nullif(regexp_extract(webVideoUrl, '/video/(\\d+)', 1), '') AS video_id
FROM videos_raw WHERE playCount > 0""",
    "kept_addresses": f"""
SELECT * FROM played QUALIFY row_number() OVER (PARTITION BY webVideoUrl
  ORDER BY {_best('playCount', _VIDEO_COLUMNS)}) = 1""",
    "kept_videos": f"""
SELECT * FROM kept_addresses WHERE video_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY video_id
  ORDER BY {_best('playCount', _VIDEO_COLUMNS)}) = 1""",
    "by_address": _tidy("kept_addresses"),
    "videos": _tidy("kept_videos"),
    "creators_first": f"""
SELECT * REPLACE (lower({strip('username')}) AS username) FROM creators_first_raw
WHERE follower_count > 0
QUALIFY row_number() OVER (PARTITION BY lower({strip('username')})
  ORDER BY {_best('follower_count', _CREATOR_COLUMNS)}) = 1""",
    "creators": f"""
SELECT * REPLACE (lower({strip('username')}) AS username) FROM creators_raw
WHERE follower_count > 0
QUALIFY row_number() OVER (PARTITION BY lower({strip('username')})
  ORDER BY {_best('follower_count', [c for c in _CREATOR_COLUMNS if c != 'username'])}) = 1""",
    "comments": """
SELECT * REPLACE (regexp_replace(comment_text, '[^\\w\\s\\x0B.,!?]', '', 'g') AS comment_text)
FROM comments_raw
WHERE sentiment_label IN ('positive', 'negative', 'neutral') AND video_id IS NOT NULL""",
    "taxonomy": f"""
SELECT * REPLACE (lower({strip('hashtag')}) AS hashtag) FROM taxonomy_raw WHERE NOT ({BROKEN_TAG})
QUALIFY row_number() OVER (PARTITION BY lower({strip('hashtag')}) ORDER BY hashtag_id) = 1""",
    "all_entries": f"""
SELECT * REPLACE (lower({strip('hashtag')}) AS hashtag) FROM taxonomy_raw
QUALIFY row_number() OVER (PARTITION BY lower({strip('hashtag')}) ORDER BY hashtag_id) = 1""",
    "features": f"""
SELECT *, {printed('(diggCount + commentCount + shareCount) / playCount', 6)} AS engagement_rate,
  playCount >= 1000000 AS is_viral, hour(createTimeISO) AS post_hour,
  dayofweek(createTimeISO) + 1 AS post_day_of_week, month(createTimeISO) AS post_month,
  year(createTimeISO) AS post_year, {tags('text')} AS hashtag_list,
  {DURATION_KEY} AS duration_bucket, len({tags('text')}) AS hashtag_count
FROM videos""",
    "sentiment": f"""
SELECT video_id, count(*) AS total_comments_scraped,
  {printed("count(*) FILTER (sentiment_label = 'positive') / count(*) * 100", 2)}
    AS positive_pct,
  {printed("count(*) FILTER (sentiment_label = 'negative') / count(*) * 100", 2)}
    AS negative_pct,
  {printed("count(*) FILTER (sentiment_label = 'neutral') / count(*) * 100", 2)}
    AS neutral_pct,
  {half_up('sum(CAST(sentiment_score AS DECIMAL(18,12))) / count(sentiment_score)', 4)}
    AS avg_sentiment_score
FROM comments GROUP BY video_id""",
    "tags": """
SELECT video_id, tag_position, tag FROM (
  SELECT video_id, unnest(hashtag_list) AS tag, unnest(range(len(hashtag_list))) AS tag_position
  FROM features) WHERE tag <> ''""",
    "tag_categories": """
SELECT video_id, tag_position, tag, hashtag_id, category, is_brand_safe
FROM tags LEFT JOIN taxonomy ON tag = hashtag""",
    "tag_entries": """
SELECT video_id, tag_position, tag, hashtag_id, category, is_brand_safe
FROM tags LEFT JOIN all_entries ON tag = hashtag""",
    "categories": """
SELECT video_id, category AS primary_category, is_brand_safe AS primary_brand_safe
FROM tag_categories
QUALIFY row_number() OVER (PARTITION BY video_id
  ORDER BY is_brand_safe DESC NULLS LAST, tag_position, hashtag_id) = 1""",
    "pairs": "SELECT DISTINCT video_id, hashtag_id FROM tags JOIN taxonomy ON tag = hashtag",
    "entry_pairs": "SELECT DISTINCT video_id, hashtag_id FROM tags JOIN all_entries ON tag = hashtag",
    "final": """
SELECT f.*, total_comments_scraped, positive_pct, negative_pct, neutral_pct,
  avg_sentiment_score, coalesce(primary_category, 'Entertainment') AS primary_category,
  coalesce(primary_brand_safe, 1) AS primary_brand_safe, username, follower_count,
  following_count, country, niche_category, is_verified, account_type
FROM features f LEFT JOIN sentiment USING (video_id) LEFT JOIN categories USING (video_id)
LEFT JOIN creators ON authorMeta_name = username""",
    "span": """
SELECT make_date(year(min(createTimeISO)), 1, 1) AS lo,
  make_date(year(max(createTimeISO)), 12, 31) AS hi FROM videos""",
    "dim_date": """
SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_id,
  strftime(d, '%Y-%m-%d') AS full_date, year(d) AS year, quarter(d) AS quarter,
  month(d) AS month, strftime(d, '%B') AS month_name, week(d) AS week_of_year,
  isodow(d) AS day_of_week, strftime(d, '%A') AS day_name, isodow(d) >= 6 AS is_weekend,
  holiday_name IS NOT NULL AS is_holiday, holiday_name
FROM (SELECT CAST(unnest(range(lo, hi + 1, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
LEFT JOIN holidays ON d = full_date""",
    "music": """
SELECT coalesce(musicMeta_musicName, '') AS n, coalesce(musicMeta_musicAuthor, '') AS a,
  max(musicMeta_musicName) AS music_name, max(musicMeta_musicAuthor) AS music_author,
  coalesce(bool_or(musicMeta_musicOriginal), false) AS is_original
FROM videos_raw GROUP BY 1, 2""",
    "dim_music": """
SELECT row_number() OVER (ORDER BY substr(md5(n || chr(31) || a), 1, 4), n, a) AS music_sk,
  music_name, music_author, is_original FROM music""",
    "dim_hashtag": """
SELECT hashtag_id, hashtag, category, subcategory,
  coalesce(is_brand_safe = 1, false) AS is_brand_safe, search_volume_tier FROM taxonomy""",
    "versions_first": f"""
SELECT {_NUMBER.format(k='creator_nk')} AS creator_sk, {_NEW_VERSION}
FROM (SELECT *, username AS creator_nk FROM creators_first)""",
    "matched": f"""
SELECT o.creator_sk AS old_sk, n.creator_nk AS new_nk,
  coalesce(o.follower_count > 0 AND n.creator_nk IS NOT NULL
    AND abs(n.follower_count - o.follower_count) / o.follower_count > 0.05, false) AS moved,
  o, n
FROM versions_first o FULL JOIN
  (SELECT {_NEW_VERSION} FROM (SELECT *, username AS creator_nk FROM creators)) n
  ON o.creator_nk = n.creator_nk""",
    "dim_creator": f"""
SELECT old_sk AS creator_sk, o.creator_nk, o.display_name, o.follower_count,
  o.following_count, o.total_videos, o.country, o.niche_category, o.is_verified,
  o.account_type, '2001-08-01' AS valid_from,
  CASE WHEN moved THEN '2001-08-02' END AS valid_to, NOT moved AS is_current
FROM matched WHERE old_sk IS NOT NULL
UNION ALL
SELECT (SELECT max(creator_sk) FROM versions_first) + {_NUMBER.format(k='n.creator_nk')},
  n.creator_nk, n.display_name, n.follower_count, n.following_count, n.total_videos, n.country,
  n.niche_category, n.is_verified, n.account_type, '2001-08-02', NULL, true
FROM matched WHERE new_nk IS NOT NULL AND (old_sk IS NULL OR moved)""",
    "fact": f"""
SELECT {_NUMBER.format(k='video_id')} AS video_sk, video_id, creator_sk,
  year(createTimeISO) * 10000 + month(createTimeISO) * 100 + day(createTimeISO) AS date_id,
  music_sk, playCount AS play_count, coalesce(diggCount, 0) AS like_count,
  commentCount AS comment_count, shareCount AS share_count,
  coalesce(videoMeta_duration, 0) AS video_duration_sec,
  engagement_rate, is_viral,
  coalesce(total_comments_scraped, 0) AS total_comments_scraped,
  positive_pct AS positive_comment_pct, negative_pct AS negative_comment_pct,
  neutral_pct AS neutral_comment_pct, avg_sentiment_score, primary_category, hashtag_count,
  '2001-08-02 19:00:00' AS loaded_at, 'RUN_20010802_190000' AS pipeline_run_id, post_hour,
  primary_brand_safe, post_year, post_month
FROM (SELECT * FROM final WHERE NOT ({TOO_LARGE}))
LEFT JOIN (SELECT creator_nk, creator_sk FROM dim_creator WHERE is_current)
  ON authorMeta_name = creator_nk
LEFT JOIN dim_music ON coalesce(musicMeta_musicName, '') = coalesce(music_name, '')
  AND coalesce(musicMeta_musicAuthor, '') = coalesce(music_author, '')""",
    "bridge": "SELECT video_sk, hashtag_id FROM pairs JOIN fact USING (video_id)",
    "dated": "SELECT * FROM fact JOIN dim_date USING (date_id)",
    "credited": """
SELECT * FROM fact JOIN (SELECT * FROM dim_creator WHERE is_current) USING (creator_sk)""",
}

PLAYS = f"{half_up('avg(play_count)', 0)} AS avg_play_count"
VIRAL = "count(*) FILTER (is_viral)"


def _exact_rate(k: int = 4) -> str:
    # Rates have six decimals: their sum is exact in millionths.
    return half_up(
        "sum(CAST(round(engagement_rate * 1000000) AS BIGINT)) / count(engagement_rate) / 10000",
        k,
    )


RATE = _exact_rate()
VIRAL_RATE = half_up(f"{VIRAL} / count(*) * 100", 2)


def _avg_2dp(x: str, k: int) -> str:
    return half_up(f"sum(CAST(round({x} * 100) AS BIGINT)) / count({x}) / 100", k)


_MONTHLY = f"""count(*) AS total_videos, {PLAYS},
  {half_up('avg(like_count)', 0)} AS avg_like_count, {RATE} AS avg_engagement_rate_pct,
  {VIRAL} AS viral_count"""
_CATEGORY = f"""count(*) AS total_videos, {PLAYS}, {RATE} AS avg_engagement_pct,
  {half_up('avg(hashtag_count)', 1)} AS avg_hashtags_used, {VIRAL} AS viral_count"""
_POSTING = f"""count(*) AS video_count, {PLAYS}, {RATE} AS avg_engagement_pct,
  {VIRAL} AS viral_count"""
_RANKING = f"""
SELECT creator_nk AS username, niche_category, country, is_verified,
  {tier('follower_count', False)} AS influencer_tier, count(*) AS total_videos, {PLAYS},
  {RATE} AS avg_engagement_rate_pct, {VIRAL} AS viral_videos,
  max(play_count) AS best_video_play_count
FROM credited GROUP BY ALL
ORDER BY avg_engagement_rate_pct DESC NULLS FIRST, username LIMIT {{n}}"""
_TIER = f"""count(DISTINCT creator_nk) AS creator_count, count(*) AS total_videos, {PLAYS},
  {RATE} AS avg_engagement_rate_pct,
  {_avg_2dp('positive_comment_pct', 2)} AS avg_positive_sentiment,
  {VIRAL} AS total_viral_videos, {VIRAL_RATE} AS viral_rate_pct"""
_TOP_MUSIC = f"""
SELECT music_name, music_author, is_original, count(*) AS usage_count, {PLAYS}{{more}}
FROM fact JOIN dim_music USING (music_sk) WHERE is_viral
GROUP BY music_name, music_author, is_original
ORDER BY usage_count DESC, music_name NULLS FIRST, music_author NULLS FIRST LIMIT 10"""
_MUSIC = f"""
SELECT is_original, count(*) AS total_videos, {PLAYS}, {RATE} AS avg_engagement_pct,
  {VIRAL} AS viral_count
FROM fact JOIN dim_music USING (music_sk) GROUP BY is_original"""
_PATTERNS = f"""
SELECT is_viral, primary_category, day_name,
  {duration_label('video_duration_sec')} AS duration_bucket, count(*) AS video_count, {PLAYS},
  {RATE} AS avg_engagement_pct, {half_up('avg(hashtag_count)', 1)} AS avg_hashtag_count
FROM dated GROUP BY ALL"""
_WEEKDAY = f"SELECT day_name, day_of_week, is_weekend, {_POSTING} FROM dated GROUP BY ALL"
_DAY_HOUR = f"""
SELECT day_name, is_weekend, is_holiday, post_hour, {_POSTING} FROM dated GROUP BY ALL"""
_TREND = f"""
SELECT primary_category, {_CATEGORY} FROM dated WHERE year >= 2000 GROUP BY primary_category"""
_SAFETY = [(1, "Safe for all advertisers and general audience", "Eligible"),
           (0, "Sensitive content, restricted audience", "Not Eligible")]
_STATES = ", ".join(f"({a}, '{b}', '{c}')" for a, b, c in _SAFETY)


def _rollup(keys: str) -> str:
    return f"""
SELECT {keys}, grouping({keys}) AS grouping_level, {_MONTHLY}
FROM dated GROUP BY ROLLUP ({keys})"""


def _stats(rate: str = "engagement_rate") -> str:
    micros = f"sum(CAST(round({rate} * 1000000) AS HUGEINT)) / count({rate}) / 1000000"
    return f"""{half_up('avg(playCount)', 0)} AS avg_play_count,
  {half_up(micros, 6)} AS avg_engagement_rate"""


def _lengths() -> str:
    tables = {
        ("dim_date", "dim_date"): {"month_name": 15, "day_name": 10, "holiday_name": 100},
        ("dim_creator", "dim_creator"): {
            "creator_nk": 50, "display_name": 100, "country": 5, "niche_category": 50,
            "account_type": 20},
        ("dim_hashtag", "dim_hashtag"): {
            "hashtag_id": 10, "hashtag": 100, "category": 50, "subcategory": 60,
            "search_volume_tier": 10},
        ("dim_music", "dim_music"): {"music_name": 200, "music_author": 150},
        ("fact", "fact_video_performance"): {
            "video_id": 50, "primary_category": 50, "pipeline_run_id": 50},
    }
    return " UNION ALL ".join(
        f"SELECT '{shown}' AS table_name, '{c} longer than {n}' AS rule,"
        f" count(*) FILTER (length({c}) > {n}) AS violations FROM {t}"
        for (t, shown), cols in tables.items()
        for c, n in cols.items()
    )


def _fk(child: str, column: str, parent: str, key: str, name: str) -> str:
    return f"""
SELECT '{name}' AS constraint_name, count(DISTINCT {column}) AS missing_values,
  count(*) AS orphan_rows
FROM {child} WHERE {column} IS NOT NULL
  AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"""


def _unique(name: str, table: str, keys: str) -> str:
    key_list = keys.split(", ")
    null = " OR ".join(f"{k} IS NULL" for k in key_list)
    return f"""
SELECT '{name}({keys})' AS constraint_name,
  count(*) FILTER (NOT missing AND n > 1) AS repeated_keys,
  CAST(coalesce(sum(n) FILTER (missing), 0) AS BIGINT) AS null_keys
FROM (SELECT {keys}, {null} AS missing, count(*) AS n FROM {table} GROUP BY ALL)"""


def _shares(name: str, table: str, column: str, top: int | None = None) -> str:
    cut = f" ORDER BY records DESC, value LIMIT {top}" if top else ""
    return f"""
SELECT '{name}' AS attribute, value, records, share_pct FROM (
  SELECT CAST({column} AS VARCHAR) AS value, count(*) AS records,
    {printed(f'count(*) / (SELECT count(*) FROM {table}) * 100', 1)} AS share_pct
  FROM {table} GROUP BY 1{cut})"""


def _quartiles() -> str:
    parts = ", ".join(
        f"{half_up(f'quantile_cont(engagement_rate, {p})', 6)} AS p{int(p * 100)}_rate"
        for p in (0.25, 0.5, 0.75)
    )
    return f"""
SELECT {tier('follower_count', True)} AS influencer_tier, count(engagement_rate) AS videos,
  min(engagement_rate) AS min_rate, {parts}, max(engagement_rate) AS max_rate
FROM credited WHERE engagement_rate IS NOT NULL GROUP BY 1"""


_FEATURES = """SELECT * REPLACE (strftime(createTimeISO, '%Y-%m-%d %H:%M:%S') AS createTimeISO,
  array_to_string(hashtag_list, '|') AS hashtag_list) FROM {t}"""
_VIDEOS = """SELECT * REPLACE (strftime(createTimeISO, '%Y-%m-%d %H:%M:%S') AS createTimeISO)
FROM {t}"""
_CREATOR_STATS = f"""
SELECT authorMeta_name, count(*) AS total_videos_in_period, {_stats()},
  {VIRAL} AS viral_video_count, max(playCount) AS max_play_count
FROM final GROUP BY authorMeta_name"""

_KEY_NAMES = _NUMBER.format(k="nk")


def _selects() -> dict[str, str]:
    tag_list = tags("text")
    return {
        "source_videos_json": "SELECT * FROM videos_raw",
        "source_creators_csv": "SELECT * FROM creators_raw",
        "source_creators_csv_reordered": "SELECT * FROM creators_raw",
        "source_comments_fallback": "SELECT *, 'fallback' AS source_used FROM comments_raw",
        "source_taxonomy_fallback": "SELECT *, 'fallback' AS source_used FROM taxonomy_raw",
        "staged_videos": "SELECT * FROM videos_raw",
        "sink_insert_if_absent": f"SELECT * FROM taxonomy_raw WHERE NOT ({BROKEN_TAG})",
        "sink_load_once": "SELECT * FROM creators_first_raw",
        "sink_append": """
SELECT run AS pipeline_run_id, post_year, count(*) AS videos,
  CAST(sum(play_count) AS BIGINT) AS plays
FROM fact, (VALUES ('RUN_1'), ('RUN_2')) r(run) GROUP BY ALL""",
        "optional_input": """
SELECT 'bridge_hashtag' AS staged_pairs, count(*) AS bridge_rows FROM bridge
UNION ALL SELECT 'never_written', 0""",
        "clean_videos": _VIDEOS.format(t="videos"),
        "unique_addresses": _VIDEOS.format(t="by_address"),
        "rejected_videos": """
SELECT CASE WHEN coalesce(playCount <= 0, true) THEN 'no plays' ELSE 'no video id' END
    AS reject_reason, count(*) AS videos, CAST(sum(playCount) AS BIGINT) AS plays
FROM videos_raw
WHERE coalesce(playCount <= 0, true) OR NOT regexp_matches(webVideoUrl, '/video/\\d+')
GROUP BY 1""",
        "clean_creators": "SELECT * FROM creators",
        "clean_comments": "SELECT * FROM comments",
        "clean_taxonomy": "SELECT * FROM all_entries",
        "scrub_documents": """
SELECT doc_id, md5(regexp_replace(text, '[^\\w\\s\\x0B.,!?]', '', 'g')) AS ascii_md5,
  length(regexp_replace(text, '[^\\w\\s\\x0B.,!?]', '', 'g')) AS ascii_chars,
  length(regexp_replace(text,
    '[^\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}\\s\\x0B\\x{85}\\pZ.,!?]', '', 'g')) AS unicode_chars
FROM documents""",
        "video_features": _FEATURES.format(t="features"),
        "hashtag_extract": f"""
SELECT text, count(*) AS videos, array_to_string({tag_list}, '|') AS hashtag_list,
  len({tag_list}) AS hashtag_count FROM videos_raw GROUP BY text""",
        "document_hashtags": f"""
SELECT doc_id, len({tag_list}) AS hashtag_count, array_to_string({tag_list}, ' ') AS hashtags
FROM documents""",
        "duration_bucket_counts": f"""
SELECT {DURATION_KEY} AS duration_bucket,
  {duration_label('videoMeta_duration')} AS duration_label, count(*) AS videos
FROM videos_raw GROUP BY ALL""",
        "tier_counts": f"""
SELECT {tier('follower_count', False)} AS tier, {tier('follower_count', True)} AS numbered_tier,
  count(*) AS creators FROM creators_raw GROUP BY ALL""",
        "videos_with_creator": """
SELECT video_id, authorMeta_name, playCount, username, follower_count, following_count, country,
  niche_category, is_verified, account_type
FROM videos LEFT JOIN creators ON authorMeta_name = username""",
        "sentiment_by_video": "SELECT * FROM sentiment",
        "videos_with_sentiment": """
SELECT video_id, playCount, total_comments_scraped, positive_pct, negative_pct, neutral_pct,
  avg_sentiment_score FROM videos LEFT JOIN sentiment USING (video_id)""",
        "tag_categories": "SELECT * FROM tag_entries",
        "primary_category": "SELECT * FROM categories",
        "videos_final": _FEATURES.format(t="final"),
        "bridge_pairs": "SELECT * FROM entry_pairs",
        "creator_stats": _CREATOR_STATS,
        "mart_creator_stats": _CREATOR_STATS,
        "category_stats": f"""
SELECT primary_category, count(*) AS total_videos, {_stats()},
  {_avg_2dp('positive_pct', 2)} AS avg_positive_sentiment_pct
FROM final GROUP BY primary_category""",
        "time_stats": f"""
SELECT post_day_of_week, post_hour, count(*) AS video_count, {_stats()}
FROM final GROUP BY ALL""",
        "validate_videos": """
SELECT count(*) AS total_records, count(*) FILTER (video_id IS NULL) AS null_video_id,
  count(*) FILTER (playCount IS NULL OR playCount <= 0) AS invalid_play_count,
  count(*) FILTER (engagement_rate < 0) AS negative_engagement_rate,
  count(*) FILTER (video_id IS NULL OR playCount IS NULL OR playCount <= 0
    OR engagement_rate < 0) = 0 AS passed
FROM final""",
        "constraint_violations": " UNION ALL ".join(
            f"SELECT '{name}' AS rule, count(*) FILTER ({bad}) AS violations FROM taxonomy_raw"
            for name, bad in _rules().items()
        ),
        "length_violations": _lengths(),
        "unfit_values": """
SELECT 'engagement_rate as decimal(8,6)' AS column_name,
  count(*) FILTER (engagement_rate >= 99.9999995) AS unfit_rows FROM final
UNION ALL SELECT 'commentCount as int', count(*) FILTER (commentCount > 2147483647) FROM final
UNION ALL SELECT 'shareCount as int', count(*) FILTER (shareCount > 2147483647) FROM final
UNION ALL SELECT 'videoMeta_duration as int',
  count(*) FILTER (videoMeta_duration > 2147483647) FROM final
UNION ALL SELECT 'total_comments_scraped as int',
  count(*) FILTER (total_comments_scraped > 2147483647) FROM final
UNION ALL SELECT 'hashtag_count as smallint', count(*) FILTER (hashtag_count > 32767)
  FROM final
UNION ALL SELECT c || '_pct as decimal(5,2)', 0 FROM (VALUES ('positive'), ('negative'), ('neutral')) s(c)
UNION ALL SELECT 'avg_sentiment_score as decimal(5,4)',
  count(*) FILTER (abs(avg_sentiment_score) >= 9.99995) FROM final""",
        "quarantined_videos": """
SELECT *, CASE WHEN coalesce(playCount <= 0, true) THEN 'no plays' ELSE 'no video id' END
    AS reject_reason
FROM videos_raw
WHERE coalesce(playCount <= 0, true) OR NOT regexp_matches(webVideoUrl, '/video/\\d+')""",
        "quarantined_creators": """
SELECT *, 'no followers' AS reject_reason FROM creators_raw WHERE coalesce(follower_count, 0) <= 0""",
        "quarantined_comments": """
SELECT *, CASE WHEN sentiment_label IN ('positive', 'negative', 'neutral') THEN 'no video'
    ELSE 'unknown label' END AS reject_reason
FROM comments_raw WHERE video_id IS NULL
  OR coalesce(sentiment_label NOT IN ('positive', 'negative', 'neutral'), true)""",
        "quarantined_fact_rows": f"""
SELECT video_id, 'RUN_20010802_190000' AS pipeline_run_id,
  'engagement_rate=' || CAST(engagement_rate AS VARCHAR) || ' as decimal(8,6)' AS misfits
FROM final WHERE {TOO_LARGE}""",
        "unreadable_rows": """
SELECT 'comments' AS feed, 'not a JSON object' AS reject_reason, '{"_id": "' || _id || '", "sentiment_label": "'
    || sentiment_label || '", "like_count": ' || CAST(like_count AS VARCHAR) AS raw_text, 1 AS records
FROM comments_raw WHERE like_count % 7 = 3
UNION ALL SELECT 'comments', 'read', NULL, count(*) FROM comments_raw WHERE like_count % 7 <> 3
UNION ALL SELECT 'taxonomy', 'wrong number of cells', concat_ws(',', hashtag_id, hashtag, category,
    coalesce(subcategory, ''), coalesce(CAST(is_brand_safe AS VARCHAR), ''), content_rating,
    search_volume_tier, 'en', 'xx', created_at, last_updated), 1
FROM taxonomy_raw WHERE hashtag_id LIKE '%7'
UNION ALL SELECT 'taxonomy', 'read', NULL, count(*) FROM taxonomy_raw WHERE hashtag_id NOT LIKE '%7'""",
        "unfit_source_cells": """
SELECT feed, column_name, text, wanted, count(*) AS cells FROM (
  SELECT 'creators' AS feed, 'follower_count' AS column_name,
    CAST(follower_count AS VARCHAR) || ' approx' AS text, 'bigint' AS wanted
  FROM creators_raw WHERE influencer_id LIKE '%3'
  UNION ALL SELECT 'creators', 'total_videos', '1.5', 'int' FROM creators_raw WHERE influencer_id LIKE '%5'
  UNION ALL SELECT 'creators', 'joined_date', 'unknown', 'date' FROM creators_raw WHERE influencer_id LIKE '%7'
  UNION ALL SELECT 'taxonomy', 'is_brand_safe', 'yes', 'smallint' FROM taxonomy_raw WHERE hashtag_id LIKE '%4'
  UNION ALL SELECT 'taxonomy', 'created_at', '1995-13-01', 'date' FROM taxonomy_raw WHERE hashtag_id LIKE '%8'
  UNION ALL SELECT 'holidays', 'full_date', strftime(full_date, '%Y-%m-%d') || '?', 'date'
  FROM holidays WHERE holiday_name = 'New Year'
  UNION ALL SELECT 'comments', 'like_count', 'many', 'int' FROM comments_raw WHERE _id LIKE '%1'
  UNION ALL SELECT 'comments', 'sentiment_score', 'n/a', 'double' FROM comments_raw WHERE _id LIKE '%2'
) GROUP BY ALL""",
        "quarantined_taxonomy": "SELECT hashtag_id, hashtag, violations FROM ("
        "SELECT hashtag_id, hashtag, concat_ws('|', "
        + ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in _rules().items())
        + ") AS violations FROM taxonomy_raw) WHERE violations <> ''",
        "calendar_coverage": """
SELECT date_id // 10000 AS year, count(*) AS dated_rows, count(*) AS reported_rows
FROM fact WHERE date_id IS NOT NULL GROUP BY 1""",
        "mart_fk_violations": " UNION ALL ".join(
            [
                _fk("fact", "creator_sk", "dim_creator", "creator_sk", "fact to creator"),
                _fk("fact", "date_id", "dim_date", "date_id", "fact to date"),
                _fk("fact", "music_sk", "dim_music", "music_sk", "fact to music"),
                _fk("bridge", "video_sk", "fact", "video_sk", "bridge to fact"),
                _fk("bridge", "hashtag_id", "dim_hashtag", "hashtag_id", "bridge to hashtag"),
            ]
        ),
        "mart_unique_violations": " UNION ALL ".join(
            [
                _unique("dim_date", "dim_date", "date_id"),
                _unique("dim_creator", "dim_creator", "creator_sk"),
                _unique("current dim_creator", "(SELECT * FROM dim_creator WHERE is_current)",
                        "creator_nk"),
                _unique("dim_hashtag", "dim_hashtag", "hashtag_id"),
                _unique("dim_music", "dim_music", "music_sk"),
                _unique("fact", "fact", "video_sk"),
                _unique("fact", "fact", "video_id"),
                _unique("bridge", "bridge", "video_sk, hashtag_id"),
            ]
        ),
        "fk_violations": " UNION ALL ".join(
            [
                _fk("fact", "creator_sk", "dim_creator", "creator_sk", "fact to creator"),
                _fk("fact", "date_id", "dim_date", "date_id", "fact to date"),
                _fk("fact", "music_sk", "dim_music", "music_sk", "fact to music"),
                _fk("bridge", "video_sk", "fact", "video_sk", "bridge to fact"),
                _fk("bridge", "hashtag_id", "dim_hashtag", "hashtag_id", "bridge to hashtag"),
                _fk("taxonomy_raw", "is_brand_safe", "(VALUES (0), (1)) s(k)", "k",
                    "taxonomy to safety"),
                _fk("comments", "video_id", "fact", "video_id", "comment to fact"),
                _fk("comments_raw", "sentiment_label",
                    "(VALUES ('positive'), ('negative'), ('neutral')) s(k)", "k",
                    "comment to label"),
            ]
        ),
        "unique_violations": " UNION ALL ".join(
            [
                _unique("dim_date", "dim_date", "date_id"),
                _unique("dim_creator", "dim_creator", "creator_sk"),
                _unique("current dim_creator", "(SELECT * FROM dim_creator WHERE is_current)",
                        "creator_nk"),
                _unique("dim_hashtag", "dim_hashtag", "hashtag_id"),
                _unique("dim_music", "dim_music", "music_sk"),
                _unique("fact", "fact", "video_sk"),
                _unique("fact", "fact", "video_id"),
                _unique("bridge", "bridge", "video_sk, hashtag_id"),
                _unique("raw creators",
                        f"(SELECT lower({strip('username')}) AS username FROM creators_raw)",
                        "username"),
                _unique("raw videos", "videos_raw", "webVideoUrl"),
            ]
        ),
        "source_profile": f"""
SELECT count(*) AS records, {half_up('avg(playCount)', 0)} AS "mean_playCount",
  max(playCount) AS "max_playCount",
  {half_up('avg(videoMeta_duration)', 0)} AS "mean_videoMeta_duration",
  max(videoMeta_duration) AS "max_videoMeta_duration",
  strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first_posted,
  strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last_posted,
  count(DISTINCT authorMeta_name) AS "distinct_authorMeta_name"
FROM (SELECT *, TRY_CAST(replace(replace(createTimeISO, 'T', ' '), 'Z', '') AS TIMESTAMP) AS t
  FROM videos_raw)""",
        "source_value_shares": " UNION ALL ".join(
            [
                _shares("videos.original", "videos_raw", "musicMeta_musicOriginal"),
                _shares("creators.verified", "creators_raw", "is_verified"),
                _shares("creators.account", "creators_raw", "account_type"),
                _shares("creators.niche", "creators_raw", "niche_category"),
                _shares("creators.country", "creators_raw", "country", 5),
                _shares("comments.label", "comments_raw", "sentiment_label"),
                _shares("taxonomy.category", "taxonomy_raw", "category"),
                _shares("taxonomy.safe", "taxonomy_raw", "is_brand_safe"),
            ]
        ),
        "dim_date": "SELECT * FROM dim_date",
        "dim_music": "SELECT * FROM dim_music",
        "dim_hashtag": "SELECT * FROM dim_hashtag",
        "scd2_creator": "SELECT * FROM dim_creator",
        "scd2_summary": """
SELECT valid_from, valid_to, is_current, count(*) AS versions,
  CAST(sum(follower_count) AS BIGINT) AS followers FROM dim_creator GROUP BY ALL""",
        "scd2_rerun": "SELECT * FROM dim_creator",
        "fact_video": "SELECT * FROM fact",
        "bridge_video_hashtag": "SELECT * FROM bridge",
        "brand_safety_usage": f"""
SELECT safety_status, description, monetization_status, count(*) AS hashtags
FROM all_entries LEFT JOIN (VALUES {_STATES}) s(safety_status, description, monetization_status)
  ON is_brand_safe = safety_status GROUP BY ALL""",
        "surrogate_keys": f"""
SELECT nk, {_KEY_NAMES} AS sk FROM (SELECT s_name AS nk FROM supplier)
UNION ALL
SELECT nk, (SELECT count(*) FROM supplier) + {_KEY_NAMES}
FROM (SELECT c_name AS nk FROM customer)""",
        "olap1_monthly": f"SELECT year, month, month_name, {_MONTHLY} FROM dated GROUP BY ALL",
        "olap1_monthly_sql": f"""
SELECT year, month, month_name, {_MONTHLY} FROM dated GROUP BY ALL""",
        "olap1_monthly_kept": f"""
SELECT year, month, month_name, {_MONTHLY} FROM dated GROUP BY ALL""",
        "olap4_category_kept": _TREND,
        "olap6_weekday_kept": _WEEKDAY,
        "olap8_active_creators": f"""
SELECT {tier('follower_count', True)} AS influencer_tier, post_year,
  count(DISTINCT creator_sk) AS creator_count
FROM credited GROUP BY ALL""",
        "olap1_rollup": _rollup("year, month, month_name"),
        "olap1_weekly": _rollup("year, month, week_of_year"),
        "olap1_series": f"""
SELECT year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period,
  {RATE} AS avg_engagement_rate_pct FROM dated GROUP BY year, month""",
        "olap2_viral_patterns": _PATTERNS,
        "olap2_viral_by_duration": f"""
SELECT duration_bucket, CAST(sum(video_count) AS BIGINT) AS video_count
FROM ({_PATTERNS}) WHERE is_viral GROUP BY duration_bucket""",
        "olap3_creator_ranking": _RANKING.format(n=50),
        "olap3_ranking_chart": f"""
SELECT username, avg_engagement_rate_pct FROM ({_RANKING.format(n=20)})""",
        "olap4_category_trend": _TREND,
        "olap4_brand_safe": f"""
SELECT primary_category, primary_brand_safe = 1 AS is_brand_safe, {_CATEGORY}
FROM dated WHERE year >= 2000 GROUP BY ALL""",
        "olap4_category_share": f"""
SELECT primary_category, total_videos,
  {printed('total_videos / sum(total_videos) OVER () * 100', 1)} AS share_pct FROM ({_TREND})""",
        "olap5_sentiment": f"""
SELECT {SENTIMENT_LABEL} AS sentiment_bucket, count(*) AS video_count, {PLAYS},
  {RATE} AS avg_engagement_pct,
  {half_up('sum(CAST(round(avg_sentiment_score * 10000) AS BIGINT))'
           ' / count(avg_sentiment_score) / 10000', 4)} AS avg_sentiment_score,
  {VIRAL} AS viral_count, {VIRAL_RATE} AS viral_rate_pct
FROM fact WHERE total_comments_scraped > 0 GROUP BY 1""",
        "olap5_viral_crosstab": f"""
SELECT {SENTIMENT_LABEL} AS sentiment_bucket, count(*) FILTER (NOT is_viral) AS not_viral,
  {VIRAL} AS viral FROM fact WHERE total_comments_scraped > 0 GROUP BY 1""",
        "olap6_weekday": _WEEKDAY,
        "olap6_weekday_chart": f"""
SELECT day_name, CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_kind,
  avg_play_count FROM ({_WEEKDAY})""",
        "olap6_day_hour": _DAY_HOUR,
        "olap6_heatmap": "SELECT day_name, "
        + ", ".join(f"avg(avg_play_count) FILTER (post_hour = {h}) AS h{h}" for h in range(24))
        + f" FROM ({_DAY_HOUR}) GROUP BY day_name",
        "olap6_holiday": f"""
SELECT CASE WHEN is_holiday THEN 'Holiday' ELSE 'Regular Day' END AS day_type,
  count(*) AS total_videos, {PLAYS}, {RATE} AS avg_engagement_pct FROM dated GROUP BY 1""",
        "olap7_music_original": _MUSIC,
        "olap7_original_chart": f"""
SELECT CASE WHEN is_original THEN 'Original' ELSE 'Non-Original' END AS music_kind,
  total_videos, avg_engagement_pct FROM ({_MUSIC})""",
        "olap7_top_music": _TOP_MUSIC.format(more=""),
        "olap7_top_music_detail": _TOP_MUSIC.format(more=f", {VIRAL} AS viral_videos"),
        "olap8_tier": f"""
SELECT {tier('follower_count', True)} AS influencer_tier, {_TIER} FROM credited GROUP BY 1""",
        "olap8_tier_niche": f"""
SELECT {tier('follower_count', True)} AS influencer_tier, niche_category, {_TIER}
FROM credited GROUP BY 1, 2""",
        "olap8_tier_distribution": _quartiles(),
    }


def _with_needed(select: str) -> str:
    """Prefix the expressions a SELECT uses, directly or through another."""
    needed, todo = set(), [select]
    while todo:
        found = set(re.findall(r"\w+", todo.pop())) & set(CTES) - needed
        needed |= found
        todo += [CTES[name] for name in found]
    ctes = ",\n".join(f"{n} AS ({sql})" for n, sql in CTES.items() if n in needed)
    return f"WITH {ctes}\n{select}" if ctes else select


def sql() -> dict[str, str]:
    return {name: _with_needed(select) for name, select in _selects().items()}

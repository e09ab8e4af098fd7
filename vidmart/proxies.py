"""Source-shaped frames derived from the benchmark tables.

Whole tables go in: a line item is one scraped copy of the video its order stands for, a
customer or a supplier is a creator profile, an event is a comment, and the words of part
names are the hashtags. Odd values (no likes, no address, no time, unknown labels, names in
other spellings) sit where a column happens to have a certain value.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from vidmart import schemas
from vidmart.sources.readers import spread

AS_OF_FIRST = date(2001, 8, 1)
AS_OF = date(2001, 8, 2)
MIN_YEAR = 2000

# Orders meet their customers first, so that line items, the most rows, are not shuffled for that. What
# a table alone decides is worked out before it is shuffled, as whole numbers; flags share one.
VIDEOS = """
select
  concat('https://cdn.example/', c_custkey, '.jpg') as authorMeta_avatar,
  case when c_nationkey <> 24 then concat(' ', upper(c_name), '\\t') end as authorMeta_name,
  case part_flags & 3
    when 0 then null
    when 1 then p_name
    when 2 then concat('#', p_brand, ' #!')
    else concat('Watch #', split(p_name, ' ')[0], ', ##', upper(split(p_name, ' ')[1]),
                '! x#no\\u00a0#', p_brand, ' #', split(p_name, ' ')[0])
  end as text,
  diggCount, shareCount, playCount, commentCount,
  nullif((o_custkey * 7 + o_orderkey) % 400, 0) as videoMeta_duration,
  p_name as musicMeta_musicName,
  case when part_flags & 4 <> 0 then p_brand end as musicMeta_musicAuthor,
  case part_flags & 24 when 8 then false when 16 then true end as musicMeta_musicOriginal,
  case when item_flags & 1 <> 0 then 'n/a'
    else date_format(o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int)),
                     "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
  end as createTimeISO,
  concat('https://v.example/@', c_name, if(item_flags & 2 <> 0, '/live/', '/video/'),
         o_orderkey, if(item_flags & 4 <> 0, '?lang=en', '')) as webVideoUrl
from (select l_orderkey, l_partkey,
        nullif(cast(round(l_discount * 100) as bigint), 0) * cast(l_quantity as bigint) * 100
          as diggCount,
        nullif(cast(round(l_tax * 100) as bigint), 0) * cast(l_quantity as bigint) as shareCount,
        case when l_quantity > 1 then (cast(floor(l_extendedprice) as bigint) - 2000) * 11 end
          as playCount,
        nullif(cast(l_linenumber as bigint), 7) as commentCount,
        if(l_tax = 0.08 and l_discount = 0.1, 1, 0)
          + if(l_linestatus = 'O' and l_returnflag = 'A' and l_discount = 0, 2, 0)
          + if(l_linestatus = 'O', 4, 0) as item_flags
      from {lineitem})
join (select p_partkey, p_name, p_brand,
        case when p_size = 1 then 0 when p_type = 'LARGE' then 1 when p_type = 'MEDIUM' then 2 else 3 end
          + if(p_size <= 45, 4, 0)
          + case when p_type in ('PROMO', 'ECONOMY') then 16 when p_type is null then 0 else 8 end as part_flags
      from {part}) on l_partkey = p_partkey
join (select o_orderkey, o_custkey, o_orderdate, c_custkey, c_name, c_nationkey
      from {orders} join {customer} on o_custkey = c_custkey) on l_orderkey = o_orderkey
"""

_FOLLOWERS = "cast(floor({b} * abs({b}) / 8) as bigint)"

_CUSTOMER_PROFILE = """
select concat('INF', lpad(c_custkey, 9, '0')) as influencer_id,
  concat(upper(c_name), ' ') as username, c_name as display_name, {followers} as follower_count,
  cast(nullif(c_custkey % 5000, 0) as int) as following_count,
  cast(c_custkey % 900 as int) as total_videos, c_custkey * 31 as avg_views_per_video,
  n_name as country, c_mktsegment as niche_category,
  cast(c_custkey % 6 = 0 as int) as is_verified,
  element_at(array('Personal', 'Creator', 'Business'), cast(c_custkey % 3 as int) + 1)
    as account_type,
  date_add(date'2015-01-01', cast(c_custkey % 1000 as int)) as joined_date,
  cast(length(c_mktsegment) as int) as bio_length_chars,
  cast(c_custkey % 2 as int) as has_external_link
from {{customer}} join {{nation}} on c_nationkey = n_nationkey
"""

_SUPPLIER_PROFILE = """
select concat('SUP', lpad(s_suppkey, 9, '0')) as influencer_id,
  concat({prefix}, lpad(s_suppkey, 9, '0')) as username, s_name as display_name,
  {followers} as follower_count, cast(s_suppkey as int) as following_count,
  cast(null as int) as total_videos, s_suppkey * 17 as avg_views_per_video, n_name as country,
  'SUPPLIER' as niche_category, cast(null as int) as is_verified, 'Business' as account_type,
  date'2014-01-01' as joined_date, 0 as bio_length_chars, 1 as has_external_link
from {{supplier}} join {{nation}} on s_nationkey = n_nationkey
"""

_BASE = _FOLLOWERS.format(b="c_acctbal")
_SUPPLIER_BASE = _FOLLOWERS.format(b="s_acctbal")
_MOVED = f"cast(floor({_BASE} * (90 + c_custkey % 21) / 100) as bigint)"

CREATORS_FIRST = _CUSTOMER_PROFILE.format(followers=_BASE)
# The next day: counts have moved, suppliers are new, and each also turns up once under the
# name of a customer in another spelling.
CREATORS = " union all ".join(
    [
        _CUSTOMER_PROFILE.format(followers=_MOVED),
        _SUPPLIER_PROFILE.format(prefix="'\\tcustomer#'", followers=_SUPPLIER_BASE),
        _SUPPLIER_PROFILE.format(prefix="'Supplier#'", followers=_SUPPLIER_BASE),
    ]
)

COMMENTS = """
select concat('CMT', lpad(event_id, 12, '0')) as _id,
  case when value >= 1 then cast(user_id * 100 + event_id % 5 as string) end as video_id,
  concat('https://v.example/video/', user_id * 100 + event_id % 5) as video_url,
  concat('user', user_id) as creator_username,
  concat(event_type, ': ', props, ' caf\\u00e9 \\u65e5\\u672c it''s ok!') as comment_text,
  case event_type when 'purchase' then 'positive' when 'signup' then 'positive'
    when 'error' then 'negative' when 'view' then 'neutral' else 'unknown' end
    as sentiment_label,
  value / 500 as sentiment_score, cast(floor(value) as int) as like_count,
  event_id % 4 = 0 as is_reply, cast(null as string) as parent_comment_id,
  date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") as comment_timestamp,
  element_at(array('nano', 'micro', 'mid', 'macro', 'mega'), cast(event_id % 5 as int) + 1)
    as user_follower_tier,
  'en' as language_detected
from {events}
"""

# A tag's number comes from where its word first stands; each word has two spellings.
_WORDS = """
select word, min(p_partkey * 2 + pos) as w
from (select p_partkey, posexplode(split(p_name, ' ')) as (pos, word) from {part})
group by word
"""
_ENTRY = """
select concat('{prefix}', lpad(w, 6, '0')) as hashtag_id, {spelling} as hashtag,
  element_at(array('Entertainment', 'Music', 'Comedy', 'Sports', 'Travel'),
             cast(w % 5 as int) + 1) as category,
  case when w % 3 > 0 then concat('sub', w % 3) end as subcategory,
  case when w % 4 = 0 then 0 when w % 7 <> 0 then 1 end as is_brand_safe,
  'PG' as content_rating,
  element_at(array('low', 'medium', 'high', 'viral', 'huge'), cast(w % 5 as int) + 1)
    as search_volume_tier,
  'en' as language_primary, date'1995-01-01' as created_at, date'1995-01-01' as last_updated
from ({words})
"""
TAXONOMY = " union all ".join(
    [
        _ENTRY.format(prefix="HT", spelling="word", words=_WORDS),
        _ENTRY.format(prefix="HU", spelling="concat(upper(word), ' ')", words=_WORDS),
    ]
)

HOLIDAYS = """
select cast(o_orderdate as date) as full_date,
  if(month(o_orderdate) = 1, 'New Year', 'Christmas Day') as holiday_name
from {orders}
where (month(o_orderdate), dayofmonth(o_orderdate)) in ((1, 1), (12, 25))
group by all
"""

_TABLES = ("lineitem", "orders", "customer", "part", "nation", "supplier", "events")


def _frame(spark: SparkSession, sf_dir: str, sql: str, ddl: str) -> DataFrame:
    used = [t for t in _TABLES if "{" + t + "}" in sql]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    if "lineitem" in frames:
        frames["lineitem"] = spread(frames["lineitem"])
    return schemas.conform(spark.sql(sql, **frames), ddl)


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, VIDEOS, schemas.VIDEO)


def creators_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, CREATORS_FIRST, schemas.CREATOR)


def creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, CREATORS, schemas.CREATOR)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, COMMENTS, schemas.COMMENT)


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, TAXONOMY, schemas.TAXONOMY)


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, HOLIDAYS, schemas.HOLIDAY)

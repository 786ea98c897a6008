"""Queries over page paths and traffic."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import paths as P
from tradewake.plans.logs import URL_SQL
from tradewake.plans.oracle import percent, percent_text, ratio, rounded, sql
from tradewake.plans.registry import query
from tradewake.sources.tables import Tables

c = F.col
LAST_DAY = "2024-01-30"
PAGE_TYPE = f"""CASE WHEN page_id IN ('home','search','good_list','cart','trade') THEN '{X.PAGE_TYPE_STORE}'
    WHEN page_id = 'good_detail' THEN '{X.PAGE_TYPE_DETAIL}' ELSE '{X.PAGE_TYPE_OTHER}' END"""
GROUP = "CASE WHEN page_id = 'trade' THEN 'trade' WHEN page_id = 'good_detail' THEN 'detail' WHEN page_id IN ('spec','list','comment') THEN 'other' END"
NEXT = "SELECT *, lead(page_id) OVER (PARTITION BY mid ORDER BY ts, event_id) AS next_page_id FROM page_log"


@query("next_page_payment", sql("""
    SELECT dt, CASE WHEN page_id = 'trade' THEN 'trade' WHEN page_id = 'good_detail' THEN 'good_detail' ELSE 'other' END AS page_group, count(*) AS views,
           CAST(sum(CASE WHEN next_page_id = 'payment' THEN 1 ELSE 0 END) AS BIGINT) AS payments
    FROM nxt WHERE page_id IN ('trade','good_detail','spec','list','comment') GROUP BY ALL""", nxt=NEXT))
def next_page_payment(t):
    return P.before_payment(t.page_log)


def share_columns() -> str:
    views, pays = "(trade_count + detail_count + other_count)", "(trade_payment + detail_payment + other_payment)"
    return ", ".join(
        f"""{n}_count, {n}_payment, {percent_text(f'{n}_count', views)} AS {n}_ratio, {percent_text(f'{n}_payment', pays)} AS {n}_payment_ratio,
            {percent_text(f'{n}_payment', f'{n}_count')} AS {n}_conversion""" for n in ("trade", "detail", "other"))


@query("path_share_nday", sql(f"SELECT recent_days, {share_columns()} FROM s", nxt=NEXT, s=f"""
    SELECT recent_days, {', '.join(f"count(CASE WHEN g = '{n}' THEN 1 END) AS {n}_count, count(CASE WHEN g = '{n}' AND next_page_id = 'payment' THEN 1 END) AS {n}_payment" for n in ('trade', 'detail', 'other'))}
    FROM (SELECT *, {GROUP} AS g FROM nxt) JOIN (VALUES (1::BIGINT), (7), (30)) p(recent_days)
      ON CAST(dt AS DATE) > DATE '{LAST_DAY}' - CAST(recent_days AS INTEGER) AND CAST(dt AS DATE) <= DATE '{LAST_DAY}'
    WHERE g IS NOT NULL GROUP BY recent_days"""))
def path_share_nday(t):
    return P.shares_by_period(t.page_log, LAST_DAY)


@query("latest_page_type", sql(f"""
    SELECT page_id, item_type AS page_item_type, {PAGE_TYPE} AS page_type
    FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ts DESC, event_id DESC) AS rn FROM page_log) WHERE rn = 1"""))
def latest_page_type(t):
    return P.latest_page_types(t.page_log)


@query("page_type_rank", sql(f"""
    SELECT row_number() OVER (ORDER BY uv DESC, page_type) AS rank, * FROM (
        SELECT {PAGE_TYPE} AS page_type, count(*) AS pv, count(DISTINCT mid) AS uv,
               {rounded(ratio('sum(during_time)', 'count(during_time)') + ' / 1000', 2)} AS avg_stay_duration_seconds FROM page_log GROUP BY 1)"""))
def page_type_rank(t):
    return P.page_type_ranks(t.page_log)


def paid_by_user(t: Tables):
    return t.order_info.where(c("status") != "CREATED").select(c("user_id").cast("string").alias("uid"), X.day_text("pay_time").alias("dt"), "amount")


def path_sql(extra: str) -> str:
    return sql(f"""
        SELECT dt, source_page, target_page, visitor_count, {percent('visitor_count', 'sum(visitor_count) OVER (PARTITION BY dt)', 2)} AS visitor_percentage,
               CAST(paid AS DOUBLE) AS total_payment_amount, {percent('paid', 'sum(paid) OVER (PARTITION BY dt)', 2)} AS payment_percentage
        FROM (SELECT l.dt, last_page_id AS source_page, page_id AS target_page, count(DISTINCT mid) AS visitor_count, sum(coalesce(u.paid, 0)) AS paid
              FROM page_log l LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS uid, strftime(pay_time, '%Y-%m-%d') AS dt, sum(amount) AS paid
                                         FROM order_info WHERE status <> 'CREATED' GROUP BY ALL) u ON l.uid = u.uid AND l.dt = u.dt
              WHERE last_page_id IS NOT NULL {extra} GROUP BY ALL)""")


@query("path_share", path_sql(""))
def path_share(t):
    return P.path_shares(t.page_log, paid_by_user(t))


@query("path_share_other", path_sql("AND last_page_id NOT IN ('home','search','good_list','cart','trade','good_detail')"))
def path_share_other(t):
    return P.path_shares(t.page_log, paid_by_user(t), other_sources_only=True)


@query("channel_bounce_top20", sql(f"""
    SELECT coalesce(ch, '未知渠道') AS ch, count(DISTINCT uid) AS uv,
           {percent('sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END)', 'count(DISTINCT uid)', 2)} AS bounce_rate
    FROM page_log GROUP BY page_log.ch ORDER BY bounce_rate DESC, 1 LIMIT 20"""))
def channel_bounce_top20(t):
    return P.channel_bounces(t.page_log)


@query("url_rank", sql(f"""
    SELECT {URL_SQL.format(p='page_id')} AS url, count(*) AS pv, count(DISTINCT mid) AS uv,
           {rounded(ratio('sum(during_time)', 'count(during_time)') + ' / 1000', 2)} AS during_time FROM page_log WHERE page_id IS NOT NULL GROUP BY 1"""))
def url_rank(t):
    return P.url_ranks(t.page_log)

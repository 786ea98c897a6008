"""Queries of the product diagnosis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import scoring as S
from tradewake.plans.oracle import percent, ratio, rounded, sql
from tradewake.plans.products import DAY_STEPS, product_day
from tradewake.plans.registry import query
from tradewake.sources.tables import Tables

c = F.col

# Score inputs come from the product days: visitors, buyers and amounts, scaled so that all grades occur.
INPUTS = {
    "traffic": {"total_uv": ("visit_cnt * 9000", None), "hand_search_uv": ("micro_visit_cnt * 20000", None),
                "group_buy_uv": ("order_user_cnt * 30000", None), "direct_car_uv": ("cart_add_cnt * 40000", None)},
    "conversion": {"pay_conversion_rate": ("pay_user_cnt", 5), "cart_conversion_rate": ("cart_add_cnt * 2", 3),
                   "uv_value": ("order_amount", 50), "collect_conversion_rate": ("micro_visit_cnt * 4", 3)},
    "engagement": {"content_guide_uv": ("browse_cnt * 500", None), "content_collect_rate": ("micro_visit_cnt", 3),
                   "content_cart_rate": ("cart_add_cnt", 2), "content_pay_amount": ("order_amount", 2), "content_pay_buyers": ("order_user_cnt * 70", None)},
    "acquisition": {"new_buyer_ratio": ("order_user_cnt * 9", 1), "new_buyer_amount_ratio": ("order_cnt * 11", 1), "refund_rate": ("pay_user_cnt", 3)},
    "service": {"pic_review_count": ("micro_visit_cnt * 700", None), "positive_review_count": ("visit_cnt * 600", None)},
}


def inputs(day, *names: str):
    """The inputs of some scores as columns of a product day."""
    cols = []
    for name in names:
        for out, (expr, per) in INPUTS[name].items():
            value = F.expr(expr)
            cols.append((value if per is None else X.ratio(value, F.lit(per), 4)).alias(out))
    return day.select("product_id", F.to_date("dt").alias("date_key"), *cols)


def side_sql(name: str, weights: dict, factor: str = "") -> str:
    cols = [f"CAST({e} AS BIGINT) AS {o}" if p is None else f"{ratio(e, str(p), 4)} AS {o}" for o, (e, p) in INPUTS[name].items()]
    total = " + ".join(f"CAST({o} AS DECIMAL(18,4)) * CAST({w} AS DECIMAL(7,5))" for o, w in weights.items())
    return f"""SELECT *, CAST(round(least(({total}){factor}, 100), 2) AS DECIMAL(5,2)) AS {name}_score
        FROM (SELECT product_id, dt AS date_key, {', '.join(cols)} FROM product_day)"""


SIDES = {
    "traffic": side_sql("traffic", S.TRAFFIC, " * 100"),
    "conversion": side_sql("conversion", S.CONVERSION),
    "engagement": side_sql("engagement", S.ENGAGEMENT),
    "acquisition": side_sql("acquisition", S.ACQUISITION),
    "service": side_sql("service", S.SERVICE),
}
TOTAL = "(" + " + ".join(f"CAST({s} AS DECIMAL(18,4)) * CAST({w} AS DECIMAL(7,5))" for s, w in S.TOTAL.items()) + ")"
EVALUATION = f"""
    SELECT product_id, date_key, {', '.join(S.SCORES)}, CAST(round(least({TOTAL}, 100), 2) AS DECIMAL(5,2)) AS total_score,
           CASE WHEN {TOTAL} >= 85 THEN 'A' WHEN {TOTAL} >= 70 THEN 'B' WHEN {TOTAL} >= 50 THEN 'C' ELSE 'D' END AS grade
    FROM traffic JOIN conversion USING (product_id, date_key) JOIN engagement USING (product_id, date_key)
    JOIN acquisition USING (product_id, date_key) JOIN service USING (product_id, date_key)"""
MARKET = f"""
    SELECT e.*, p.item_name AS product_name, p.category_name, p.brand_name,
           CAST({rounded('(CAST(sum(total_score) OVER w AS DOUBLE) / count(*) OVER w)', 2)} AS DECIMAL(5,2)) AS market_avg_score
    FROM evaluation e JOIN dim_item p ON e.product_id = p.item_id WINDOW w AS (PARTITION BY date_key, category_name)"""
DIAGNOSIS = """
    SELECT m.*, traffic_score - market_avg_score AS traffic_score_diff, conversion_score - market_avg_score AS conversion_score_diff, t.total_uv AS uv_count,
           c.pay_conversion_rate, c.cart_conversion_rate, a.new_buyer_ratio, a.refund_rate, s.pic_review_count
    FROM market m JOIN (SELECT product_id, date_key, total_uv FROM traffic) t USING (product_id, date_key)
    JOIN (SELECT product_id, date_key, pay_conversion_rate, cart_conversion_rate FROM conversion) c USING (product_id, date_key)
    JOIN (SELECT product_id, date_key, new_buyer_ratio, refund_rate FROM acquisition) a USING (product_id, date_key)
    JOIN (SELECT product_id, date_key, pic_review_count FROM service) s USING (product_id, date_key)"""
STEPS = {**DAY_STEPS, **SIDES, "evaluation": EVALUATION, "market": MARKET, "diagnosis": DIAGNOSIS}


def as_double(*names: str) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names) + ")"


for _name in INPUTS:
    query(f"score_{_name}", sql(f"SELECT {as_double(f'{_name}_score')} FROM {_name}", **DAY_STEPS, **{_name: SIDES[_name]}))(
        lambda t, name=_name: getattr(S, f"{name}_score")(inputs(product_day(t), name)))


def evaluated(day):
    return S.all_scores(inputs(day, *INPUTS))


def diagnosed(t: Tables):
    return t.stored("product_diagnosis", lambda: build_diagnosis(t))


def build_diagnosis(t: Tables):
    product = t.dim_item.select(c("item_id").alias("product_id"), c("item_name").alias("product_name"), "category_name", "brand_name")
    scores = t.stored("product_scores", lambda: evaluated(product_day(t)))  # read for the rows and for the market mean
    return S.diagnosis(S.with_market(scores, product))


@query("product_evaluation", sql(f"SELECT {as_double(*S.SCORES, 'total_score')} FROM evaluation", **STEPS))
def product_evaluation(t):
    return evaluated(product_day(t)).select(*S.KEYS, *S.SCORES, "total_score", "grade")


DIAG_DOUBLES = (*S.SCORES, "total_score", "market_avg_score", "traffic_score_diff", "conversion_score_diff")


@query("product_diagnosis", sql(f"SELECT {as_double(*DIAG_DOUBLES)} FROM diagnosis", **STEPS))
def product_diagnosis(t):
    return build_diagnosis(t)


RANKED = "SELECT *, row_number() OVER (PARTITION BY grade, date_key ORDER BY total_score DESC, product_id) AS rk FROM diagnosis"


@query("grade_rank", sql("SELECT grade, date_key, product_id, CAST(total_score AS DOUBLE) AS total_score, rk FROM r", **STEPS, r=RANKED))
def grade_rank(t):
    return S.grade_ranks(diagnosed(t).select("grade", "date_key", "product_id", "total_score"))


@query("grade_top_product", sql("""
    SELECT grade, date_key, product_id AS top_product_id, product_name AS top_product_name, CAST(total_score AS DOUBLE) AS top_score FROM r WHERE rk = 1""", **STEPS, r=RANKED))
def grade_top_product(t):
    return S.grade_top(diagnosed(t))


def avg(x: str) -> str:
    return ratio(f"sum({x})", f"count({x})")


@query("grade_diagnosis", sql(f"""
    SELECT grade, date_key, {', '.join(f'{avg(s)} AS avg_{s}' for s in S.SCORES)}, {avg('total_score')} AS avg_total_score, count(DISTINCT product_id) AS product_count,
           {avg('market_avg_score')} AS market_avg_score, {avg('total_score')} - {avg('market_avg_score')} AS avg_score_diff,
           max(CASE WHEN rk = 1 THEN product_id END) AS top_product_id, max(CASE WHEN rk = 1 THEN product_name END) AS top_product_name,
           CAST(max(CASE WHEN rk = 1 THEN total_score END) AS DOUBLE) AS top_score
    FROM r GROUP BY grade, date_key""", **STEPS, r=RANKED))
def grade_diagnosis(t):
    return S.grade_days(diagnosed(t))


@query("competitor_rank", sql(f"""
    SELECT date_key, product_id, product_name, category_name, grade, {', '.join(f'CAST({s} AS DOUBLE) AS {s}' for s in S.SCORES)},
           {', '.join(f"rank() OVER (PARTITION BY date_key, category_name ORDER BY {s} DESC) AS {s.replace('_score', '_rank')}" for s in S.SCORES)},
           CAST(total_score AS DOUBLE) AS total_score, CAST(market_avg_score AS DOUBLE) AS market_avg_score,
           CAST(total_score - market_avg_score AS DOUBLE) AS total_score_diff FROM diagnosis""", **STEPS))
def competitor_rank(t):
    return S.competitors(diagnosed(t))


@query("product_overview", sql(f"""
    SELECT date_key, 'score' AS analysis_dimension, grade, count(DISTINCT product_id) AS product_count,
           {percent('count(DISTINCT product_id)', 'any_value(n)', 2)} AS product_ratio, 0::DOUBLE AS total_amount, 0::DOUBLE AS avg_price, 0::BIGINT AS total_sales,
           CAST(sum(uv_count) AS BIGINT) AS total_uv, 0::DOUBLE AS uv_sales_ratio, {avg('total_score')} AS avg_total_score
    FROM diagnosis JOIN (SELECT date_key, count(DISTINCT product_id) AS n FROM diagnosis GROUP BY 1) USING (date_key) GROUP BY date_key, grade
    UNION ALL SELECT date_key, 'price', '', count(DISTINCT product_id), 0, CAST(sum(amount) AS DOUBLE), {ratio('sum(price)', 'sum(lines)')}, CAST(sum(quantity) AS BIGINT), 0, 0, 0
    FROM diagnosis JOIN sales USING (product_id) GROUP BY date_key
    UNION ALL SELECT date_key, 'visitor', '', count(DISTINCT product_id), 0, 0, 0, CAST(sum(quantity) AS BIGINT), CAST(sum(uv_count) AS BIGINT), {ratio('sum(quantity)', 'sum(uv_count)', 4)}, 0
    FROM diagnosis JOIN sales USING (product_id) GROUP BY date_key""", **STEPS,
    sales="SELECT product_id, sum(amount) AS amount, sum(quantity) AS quantity, sum(price) AS price, count(*) AS lines FROM order_item JOIN dim_item ON product_id = item_id GROUP BY 1"))
def product_overview(t):
    item = t.order_item.select("product_id", "amount", "quantity").join(t.dim_item.select(c("item_id").alias("product_id"), "price"), "product_id")
    return S.overview(diagnosed(t), item)

"""Derived column expressions (the study's C-family).

Every helper returns a Column and keeps the study's three-valued logic: a
flag is 1, 0 or null, and a value that cannot be assessed stays null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000.0

# Delay buckets (right-closed edges 0, 3, 7, 14) and their order.
DELAY_BUCKETS = ["A l'heure", "1-3 jours", "4-7 jours", "8-14 jours", "15 jours et plus"]
DELAY_EDGES = [0, 3, 7, 14]
# Labels of the BI model.
DELIVERY_LABELS = ("Non évaluable", "En retard", "À l'heure")
ORDER_TYPE_LABELS = ("Plusieurs vendeurs", "Un vendeur", "Sans articles")
REPEAT_LABELS = ("Avec réachat", "Sans réachat")
BASKET_LABELS = ("1 article", "Plusieurs articles")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_between(start, end) -> Column:
    """Fractional days from ``start`` to ``end`` (null if either is null)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(DAY_US)


def purchase_date(ts="order_purchase_timestamp") -> Column:            # C01
    return F.to_date(_c(ts))


def purchase_month(ts="order_purchase_timestamp") -> Column:           # C01
    return F.date_format(_c(ts), "yyyy-MM")


def gross_value(item="item_value", freight="freight_value") -> Column:  # C02
    return _c(item) + _c(freight)


def freight_share(freight="freight_value", gross="gross_value") -> Column:  # C03
    g = _c(gross)
    return F.when(g > 0, _c(freight).cast("double") / g.cast("double"))


def payment_gap(paid="payment_total", gross="gross_value") -> Column:  # C04
    return _c(paid) - _c(gross)


def valid_duration(days: Column, status="order_status") -> Column:      # C05, C06
    """Keep a duration only for delivered orders and when it is not negative."""
    return F.when((_c(status) == "delivered") & (days >= 0), days)


def delivery_days(purchase="order_purchase_timestamp",
                  received="order_delivered_customer_date", status="order_status") -> Column:
    return valid_duration(days_between(purchase, received), status)


def valid_delivery(purchase="order_purchase_timestamp", received="order_delivered_customer_date",
                   promised="order_estimated_delivery_date", status="order_status") -> Column:
    return ((_c(status) == "delivered") & (days_between(purchase, received) >= 0)
            & _c(promised).isNotNull())


def delay_days(received="order_delivered_customer_date",
               promised="order_estimated_delivery_date", valid: Column | None = None) -> Column:  # C07
    d = F.datediff(F.to_date(_c(received)), F.to_date(_c(promised)))
    return d if valid is None else F.when(valid, d)


def is_late(delay: Column, valid: Column) -> Column:                    # C08
    return F.when(valid, (delay > 0).cast("int"))


def is_late_timestamp(received="order_delivered_customer_date",
                      promised="order_estimated_delivery_date", valid: Column | None = None) -> Column:  # C09
    return F.when(valid, (_c(received) > _c(promised)).cast("int"))


def promise_days(promised="order_estimated_delivery_date", day="purchase_date") -> Column:  # C10
    return days_between(F.to_timestamp_ntz(_c(day).cast("string")), promised)


def bad_review(score="review_score") -> Column:                         # C11
    s = _c(score)
    return F.when(s.isNotNull(), (s <= 2).cast("int"))


def has_comment(message="review_comment_message") -> Column:            # C12
    """1 when the message holds anything but whitespace (any Unicode space)."""
    stripped = F.regexp_replace(F.coalesce(_c(message), F.lit("")), r"(?U)^\s+|\s+$", "")
    return (F.length(stripped) > 0).cast("int")


def in_period(ts, start: str, end: str) -> Column:                      # C13
    t = _c(ts)
    return ((t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz"))).cast("int")


def category(translated="product_category_name_english", original="product_category_name") -> Column:  # C14
    return F.coalesce(_c(translated), _c(original), F.lit("unknown"))


def same_state(a="seller_state", b="customer_state") -> Column:        # C15
    return F.coalesce(_c(a) == _c(b), F.lit(False)).cast("int")


def haversine_km(lat1, lng1, lat2, lng2, radius: float = 6371.0) -> Column:  # C16
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lng2) - _c(lng1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(radius) * 2 * F.asin(F.sqrt(a))


def delay_bucket(delay="delay_days") -> Column:                         # C17
    d = _c(delay)
    expr = F.when(d.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(DELAY_EDGES, DELAY_BUCKETS):
        expr = expr.when(d <= edge, F.lit(label))
    return expr.otherwise(F.lit(DELAY_BUCKETS[-1]))


def delay_bucket_order(delay="delay_days") -> Column:                   # C17
    d = _c(delay)
    expr = F.when(d.isNull(), F.lit(None).cast("int"))
    for i, edge in enumerate(DELAY_EDGES):
        expr = expr.when(d <= edge, F.lit(i))
    return expr.otherwise(F.lit(len(DELAY_EDGES)))


def delivery_status_label(late="is_late") -> Column:                    # C18
    x = _c(late)
    return (F.when(x.isNull(), DELIVERY_LABELS[0]).when(x == 1, DELIVERY_LABELS[1])
            .otherwise(DELIVERY_LABELS[2]))


def order_type_label(sellers="seller_count") -> Column:                 # C19
    x = _c(sellers)
    return (F.when(x.isNull(), ORDER_TYPE_LABELS[2]).when(x > 1, ORDER_TYPE_LABELS[0])
            .otherwise(ORDER_TYPE_LABELS[1]))


def repeat_label(flag="repeat_90") -> Column:                           # C20
    return F.when(_c(flag) == 1, REPEAT_LABELS[0]).otherwise(REPEAT_LABELS[1])


def basket_segment(items="item_count") -> Column:                       # C22
    return F.when(_c(items) == 1, BASKET_LABELS[0]).otherwise(BASKET_LABELS[1])


def date_parts(ts="order_purchase_timestamp") -> dict[str, Column]:    # C24
    t = _c(ts)
    return {"year": F.year(t), "month": F.month(t), "day_of_week": F.weekday(t)}

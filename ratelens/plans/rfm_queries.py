"""Registered queries: RFM base, scores, segments and reports."""

from __future__ import annotations

from ..fixtures import views
from ..operators.rfm import (box_stats, rf_heatmap, rfm_base, rfm_describe, rfm_scores, rfm_segments,
                             score_histogram, segment_rollup, segment_sizes)
from .eda_queries import describe_sql
from .params import RFM_REFERENCE
from .registry import query, round_doubles
from .sqlviews import with_views

BASE = ("base", f"""SELECT customer_id, CAST(DATE '{RFM_REFERENCE}' - max(rating_date) AS INTEGER) AS R,
       count(*) AS F, avg(rating) AS M FROM ratings GROUP BY customer_id""")
SCORES = ("scores", """SELECT customer_id, R, F, M,
       CAST(greatest(1, (5 * (rr - 1) + n - 2) // (n - 1)) AS INTEGER) AS R_score,
       CAST(greatest(1, (5 * (rf - 1) + n - 2) // (n - 1)) AS INTEGER) AS F_score,
       CAST(greatest(1, (5 * (rm - 1) + n - 2) // (n - 1)) AS INTEGER) AS M_score
FROM (SELECT b.*, row_number() OVER (ORDER BY R DESC, customer_id) AS rr,
             row_number() OVER (ORDER BY F, customer_id) AS rf,
             row_number() OVER (ORDER BY M, customer_id) AS rm,
             count(*) OVER () AS n FROM base b) t""")
SEG = ("seg", """SELECT *, CAST(R_score + F_score + M_score AS INTEGER) AS RFM_score,
  CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Best Customers'
       WHEN R_score >= 3 AND F_score >= 4 AND M_score >= 4 THEN 'Loyal Customers'
       WHEN M_score >= 4 THEN 'Big Spenders'
       WHEN R_score <= 2 AND F_score >= 3 AND M_score >= 3 THEN 'At Risk'
       WHEN R_score <= 2 AND F_score <= 2 AND M_score <= 2 THEN 'Lost Cheap Customers'
       WHEN R_score <= 2 THEN 'Lost Customers'
       WHEN R_score >= 4 AND M_score >= 4 AND F_score <= 3 THEN 'Potential Loyal'
       WHEN R_score >= 4 AND M_score <= 2 THEN 'Need Attention'
       WHEN R_score <= 2 AND F_score >= 3 THEN 'Hibernating'
       ELSE 'Others' END AS segment
FROM scores""")


def rfm_sql(select: str, *extra) -> str:
    return with_views(select, BASE, SCORES, SEG, *extra)


def base_df(spark, sf_dir):
    return rfm_base(views(spark, sf_dir).ratings, RFM_REFERENCE)


def segments_df(spark, sf_dir):
    return rfm_segments(rfm_scores(base_df(spark, sf_dir)))


@query("rfm_base", rfm_sql("SELECT customer_id, R, F, round(M, 6) AS M FROM base"), check="R")
def q_rfm_base(spark, sf_dir):
    return round_doubles(base_df(spark, sf_dir))


@query("rfm_describe", with_views(describe_sql("base", ["R", "F", "M"]), BASE), check="R")
def q_rfm_describe(spark, sf_dir):
    return round_doubles(rfm_describe(base_df(spark, sf_dir)))


@query("rfm_scores", rfm_sql(
    "SELECT customer_id, R, F, round(M, 6) AS M, R_score, F_score, M_score, RFM_score FROM seg"))
def q_rfm_scores(spark, sf_dir):
    return round_doubles(rfm_scores(base_df(spark, sf_dir)))


@query("rfm_segments", rfm_sql("SELECT customer_id, R_score, F_score, M_score, RFM_score, segment FROM seg"))
def q_rfm_segments(spark, sf_dir):
    return segments_df(spark, sf_dir).select("customer_id", "R_score", "F_score", "M_score", "RFM_score", "segment")


@query("rfm_segment_sizes", rfm_sql(
    "SELECT segment, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM seg GROUP BY segment"),
    check="R")
def q_rfm_segment_sizes(spark, sf_dir):
    return round_doubles(segment_sizes(segments_df(spark, sf_dir)))


@query("rfm_heatmap_rf", rfm_sql(
    "SELECT R_score, " + ", ".join(f"count(*) FILTER (WHERE F_score = {i}) AS f_{i}" for i in range(1, 6))
    + " FROM seg GROUP BY R_score"))
def q_rfm_heatmap_rf(spark, sf_dir):
    return rf_heatmap(segments_df(spark, sf_dir))


_BOX = ("long", "SELECT segment, 'R' AS metric, CAST(R AS DOUBLE) AS value FROM seg UNION ALL "
        "SELECT segment, 'F', CAST(F AS DOUBLE) FROM seg UNION ALL SELECT segment, 'M', M FROM seg")
_Q = ("q", """SELECT segment, metric, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
       quantile_cont(value, 0.75) AS q3 FROM long GROUP BY segment, metric""")


@query("rfm_box_stats", rfm_sql(
    """SELECT l.segment, l.metric, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median,
       round(any_value(q3), 6) AS q3,
       round(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
       round(max(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
       count(*) FILTER (WHERE NOT (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM long l JOIN q ON l.segment = q.segment AND l.metric = q.metric GROUP BY l.segment, l.metric""", _BOX, _Q),
    check="R")
def q_rfm_box_stats(spark, sf_dir):
    return round_doubles(box_stats(segments_df(spark, sf_dir), "segment", ["R", "F", "M"]))


@query("rfm_score_histogram", rfm_sql(
    """SELECT CAST(b.bin AS INTEGER) AS bin, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM range(3, 16) b(bin) LEFT JOIN (SELECT RFM_score, count(*) AS n FROM seg GROUP BY RFM_score) c
  ON c.RFM_score = b.bin"""))
def q_rfm_score_histogram(spark, sf_dir):
    return score_histogram(segments_df(spark, sf_dir))


@query("rfm_segment_rollup", rfm_sql(
    """SELECT segment AS label, 'All' AS parent, count(*) AS n FROM seg GROUP BY segment
UNION ALL SELECT 'All', '', count(*) FROM seg"""))
def q_rfm_segment_rollup(spark, sf_dir):
    return segment_rollup(segments_df(spark, sf_dir))


@query("rfm_scatter_sample", rfm_sql("SELECT customer_id, R, F, round(M, 6) AS M, segment FROM seg"))
def q_rfm_scatter_sample(spark, sf_dir):
    """The rows behind the 3-D R/F/M scatter: every user (a plot's sample is :func:`~ratelens.operators.sampling.sample_rows` of it)."""
    return round_doubles(segments_df(spark, sf_dir).select("customer_id", "R", "F", "M", "segment"))

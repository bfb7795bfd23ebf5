"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 -------------------------------------------------------------------------
def clean_line(c) -> Column:
    """Strip leading and trailing whitespace (tabs and CR too, like str.strip)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


# F2 -------------------------------------------------------------------------
def split_fields(c, limit: int = -1) -> Column:
    """``str.split(',', maxsplit)`` with Spark's limit = maxsplit + 1."""
    return F.split(_c(c), ",", limit)


# F3 -------------------------------------------------------------------------
def is_header(c) -> Column:
    return _c(c).endswith(":")


def header_text(c) -> Column:
    """``12:`` -> ``12`` (text; conversion decides failfast vs drop)."""
    c = _c(c)
    return c.substr(F.lit(1), F.length(c) - F.lit(1))


# F4 -------------------------------------------------------------------------
def int_or_null(c) -> Column:
    """All-digit text to int, anything else to null."""
    c = _c(c)
    return F.when(c.rlike(r"^[0-9]+$"), c.try_cast("int"))


# F5 -------------------------------------------------------------------------
def try_long(c) -> Column:
    """Python ``int()`` on a field: surrounding spaces allowed, else null."""
    return _c(c).try_cast("bigint")


def try_int(c) -> Column:
    return _c(c).try_cast("int")


# F6 -------------------------------------------------------------------------
def calendar_columns(date_col) -> dict[str, Column]:
    """Year, month and day of week with Monday = 0 (``weekday``)."""
    d = _c(date_col)
    return {"year": F.year(d), "month": F.month(d), "day_of_week": F.weekday(d)}


# F8 -------------------------------------------------------------------------
def safe_div(a, b, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(_c(a), _c(b)), F.lit(default))


# F9 -------------------------------------------------------------------------
# RFM segment labels and their rules, first match wins.
def segment_expr(r, f, m) -> Column:
    r, f, m = _c(r), _c(f), _c(m)
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Best Customers")
        .when((r >= 3) & (f >= 4) & (m >= 4), "Loyal Customers")
        .when(m >= 4, "Big Spenders")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Lost Cheap Customers")
        .when(r <= 2, "Lost Customers")
        .when((r >= 4) & (m >= 4) & (f <= 3), "Potential Loyal")
        .when((r >= 4) & (m <= 2), "Need Attention")
        .when((r <= 2) & (f >= 3), "Hibernating")
        .otherwise("Others")
    )


# F10 ------------------------------------------------------------------------
# Cluster display names by cluster id.
USER_CLUSTER_NAMES = {
    0: "Casual Users",
    1: "Power Users",
    2: "Harsh Critics",
    3: "Generous Raters",
    4: "Selective Viewers",
    5: "Active Explorers",
}
MOVIE_CLUSTER_NAMES = {
    0: "Blockbusters",
    1: "Niche Favorites",
    2: "Polarizing Films",
    3: "Forgotten Films",
    4: "Classic Hits",
    5: "Cult Favourites",
}


def label_map(c, names: dict[int, str], prefix: str = "Cluster ") -> Column:
    c = _c(c)
    m = F.create_map(*[x for k, v in sorted(names.items()) for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, c), F.concat(F.lit(prefix), c.cast("string")))


# F12 ------------------------------------------------------------------------
def sigmoid(z, bound: float = 500.0) -> Column:
    z = F.least(F.greatest(_c(z), F.lit(-bound)), F.lit(bound))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


# F14 ------------------------------------------------------------------------
def abs_weighted_mean(sim, value) -> Column:
    """Aggregate: sum(s*r) / sum(|s|); 0.0 when all weights are zero."""
    s, r = _c(sim), _c(value)
    return F.coalesce(F.try_divide(F.sum(s * r), F.sum(F.abs(s))), F.lit(0.0))

"""The fixture views as SQL CTE text, run unchanged by DuckDB (oracle)."""

from __future__ import annotations

VIEW_CTES = {
    "ratings": """SELECT CAST(o_custkey AS BIGINT) AS customer_id, CAST(l_partkey AS BIGINT) AS movie_id,
       CAST(ceil(l_quantity / 10) AS INT) AS rating, CAST(o_orderdate AS DATE) AS rating_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "movie_titles": """SELECT CAST(p_partkey AS BIGINT) AS movie_id,
       CAST(CASE WHEN p_size % 10 = 0 THEN NULL ELSE 1950 + p_size END AS INTEGER) AS year_of_release,
       concat(p_name, ', ', p_brand) AS title
FROM part""",
    "probe": """SELECT DISTINCT customer_id, movie_id FROM ratings
WHERE md5(concat(CAST(customer_id AS VARCHAR), ':', CAST(movie_id AS VARCHAR))) < '04'""",
}


def with_views(select: str, *ctes: tuple[str, str]) -> str:
    """``WITH ratings AS (...), movie_titles AS (...), probe AS (...), <ctes> <select>``."""
    parts = [f"{name} AS (\n{body}\n)" for name, body in VIEW_CTES.items()]
    parts += [f"{name} AS (\n{body}\n)" for name, body in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select

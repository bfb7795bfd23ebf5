"""Registered queries: text sources, enrichment, sampling."""

from __future__ import annotations

from ..fixtures import probe_section_lines, rating_section_lines, title_lines, views
from ..operators.prep import enrich
from ..operators.sampling import assign_folds, sample_items, sample_rows
from ..schemas import CUSTOMER, DATE, MOVIE, RATING
from ..sources.text import parse_movie_titles, parse_probe_sections, parse_rating_sections, to_ratings
from .params import SAMPLE_FRACTION, SEED
from .registry import query
from .sqlviews import with_views


@query("parse_movie_titles", with_views("SELECT movie_id, year_of_release, title FROM movie_titles"))
def q_parse_movie_titles(spark, sf_dir):
    return parse_movie_titles(title_lines(views(spark, sf_dir).movie_titles))


@query("parse_rating_sections", with_views("SELECT customer_id, movie_id, rating, rating_date FROM ratings"))
def q_parse_rating_sections(spark, sf_dir):
    lines = rating_section_lines(views(spark, sf_dir).ratings)
    return to_ratings(parse_rating_sections(lines))


@query("parse_probe_sections", with_views("SELECT customer_id, movie_id FROM probe"))
def q_parse_probe_sections(spark, sf_dir):
    return parse_probe_sections(probe_section_lines(views(spark, sf_dir).probe))


@query("enrich_ratings", with_views(
    """SELECT r.movie_id, r.customer_id, r.rating, r.rating_date, t.year_of_release, t.title,
       CAST(year(r.rating_date) AS INTEGER) AS year, CAST(month(r.rating_date) AS INTEGER) AS month,
       CAST(isodow(r.rating_date) - 1 AS INTEGER) AS day_of_week
FROM ratings r LEFT JOIN movie_titles t ON r.movie_id = t.movie_id"""))
def q_enrich_ratings(spark, sf_dir):
    v = views(spark, sf_dir)
    return enrich(v.ratings, v.movie_titles)


_ITEMS_CTE = ("items", "SELECT DISTINCT movie_id FROM ratings")
_CHOSEN_CTE = ("chosen", f"""SELECT movie_id FROM items
QUALIFY row_number() OVER (ORDER BY md5(concat('{SEED}:', CAST(movie_id AS VARCHAR))), movie_id)
      <= greatest(1, CAST(floor((SELECT count(*) FROM items) * {SAMPLE_FRACTION}) AS BIGINT))""")


@query("sample_items", with_views(
    "SELECT r.customer_id, r.movie_id, r.rating, r.rating_date FROM ratings r SEMI JOIN chosen c ON r.movie_id = c.movie_id",
    _ITEMS_CTE, _CHOSEN_CTE))
def q_sample_items(spark, sf_dir):
    return sample_items(views(spark, sf_dir).ratings, SAMPLE_FRACTION, SEED)


_N_SAMPLE = 5000


@query("sample_rows", with_views(
    f"""SELECT customer_id, movie_id, rating, rating_date FROM ratings
QUALIFY row_number() OVER (ORDER BY md5(concat('{SEED}:', CAST(customer_id AS VARCHAR), ':', CAST(movie_id AS VARCHAR),
        ':', CAST(rating_date AS VARCHAR), ':', CAST(rating AS VARCHAR))), customer_id, movie_id, rating_date, rating)
      <= {_N_SAMPLE}"""))
def q_sample_rows(spark, sf_dir):
    return sample_rows(views(spark, sf_dir).ratings, _N_SAMPLE, SEED, [CUSTOMER, MOVIE, DATE, RATING])


@query("kfold_assign", with_views(
    f"""SELECT customer_id, movie_id, rating, rating_date,
       CAST(CAST(('0x' || substr(md5(concat('{SEED}:', CAST(customer_id AS VARCHAR), ':', CAST(movie_id AS VARCHAR))), 1, 8)) AS BIGINT) % 3 AS INTEGER) AS fold
FROM ratings"""))
def q_kfold_assign(spark, sf_dir):
    return assign_folds(views(spark, sf_dir).ratings, 3, SEED, [CUSTOMER, MOVIE])

"""Registered queries opN_<name> and pipeline: thin digests over the operators."""

from __future__ import annotations

import hashlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, langid, lm, mixing, pii, quality, sharding, simhash, toxicity
from .common import fold, table
from .params import MIX_SEED, MIX_WEIGHTS, N_SHARDS
from .registry import query

_MIX_NAMES = ", ".join(f"('{k}', {v!r})" for k, v in MIX_WEIGHTS.items())
MIX_SQL = f"""
WITH w(name, weight) AS (VALUES {_MIX_NAMES}),
d AS (SELECT d.*, coalesce('=' || w.name, '*') AS grp, strlen(coalesce(text, '')) + 1 AS size
      FROM documents d LEFT JOIN w ON d.source = w.name),
by_group AS (SELECT grp, sum(size) AS bytes FROM d GROUP BY grp),
rates AS (SELECT b.grp, coalesce(w.weight, {max(0.0, 1.0 - sum(MIX_WEIGHTS.values()))!r})
                 * (SELECT sum(bytes) FROM by_group) / b.bytes AS rate
          FROM by_group b LEFT JOIN w ON b.grp = '=' || w.name),
ks AS (SELECT grp, rate, unnest(range(0, CASE WHEN rate > 0 THEN CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) ELSE 0 END + 1)) AS k
       FROM rates),
pmf AS (SELECT grp, k, exp(sum(CASE WHEN k = 0 THEN -rate ELSE ln(rate / k) END) OVER (PARTITION BY grp ORDER BY k)) AS p FROM ks),
cdf AS (SELECT grp, list(c ORDER BY k) AS cdf FROM
        (SELECT grp, k, sum(p) OVER (PARTITION BY grp ORDER BY k) AS c FROM pmf) GROUP BY grp),
drawn AS (SELECT d.*, len(list_filter(cdf.cdf, lambda c:
              c <= CAST(concat('0x', substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0)) AS copies
          FROM d JOIN cdf ON d.grp = cdf.grp)
SELECT doc_id, text, lang, source, n_chars, copies, copy,
       md5('shuffle{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn)
"""


@query("op8_poisson_mix", MIX_SQL)
def op8_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SEED)


@query("op9_byte_shards")
def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = sharding.row_sizes(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "size", "text_crc32")
    out = sharding.shard_sized(narrow, N_SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def _pii_sql() -> str:
    """The spans again for DuckDB: pieces between matches and matches, running lengths by list sums."""
    digits = "regexp_replace({m}, '[ -]', '', 'g')"
    patterns = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
               "list_bool_and(list_transform(string_split({m}, '.'), lambda p: coalesce(try_cast(p AS HUGEINT), 256) <= 255))"),
        "card": (r"[0-9]([\x20-]?[0-9])+",
                 f"len({digits}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, len({digits}) + 1), lambda i: "
                 f"CASE WHEN i % 2 = 1 THEN try_cast(substr(reverse({digits}), i, 1) AS INT) "
                 f"WHEN try_cast(substr(reverse({digits}), i, 1) AS INT) > 4 THEN 2 * try_cast(substr(reverse({digits}), i, 1) AS INT) - 9 "
                 f"ELSE 2 * try_cast(substr(reverse({digits}), i, 1) AS INT) END)) % 10 = 0"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(regexp_replace({m}, '[^0-9]', '', 'g')) BETWEEN 9 AND 15"),
    }
    parts, lists = [], []
    for kind, (pattern, valid) in patterns.items():
        parts.append(f"""{kind} AS (SELECT doc_id, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS m FROM d)""")
        parts.append(f"""{kind}_at AS (SELECT doc_id, i, m[i] AS s,
            list_sum(list_transform(p[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS pos
            FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {kind}))""")
        parts.append(f"""{kind}_ok AS (SELECT doc_id, count(*) AS n, string_agg(concat('{kind}:', CAST(pos AS BIGINT), ':', CAST(pos + len(s) AS BIGINT)), ',' ORDER BY pos) AS spans
            FROM {kind}_at WHERE {valid.format(m='s')} GROUP BY doc_id)""")
        lists.append(kind)
    joined = "concat_ws(',', " + ", ".join(f"{k}_ok.spans" for k in lists) + ")"
    return ("WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),\n" + ",\n".join(parts)
            + "\nSELECT d.doc_id, " + ", ".join(f"coalesce({k}_ok.n, 0) AS n_{k}" for k in lists)
            + f", sha256({joined}) AS base_sha256 FROM d " + " ".join(f"LEFT JOIN {k}_ok ON {k}_ok.doc_id = d.doc_id" for k in lists))


#: DuckDB's form of the base columns; the tests compare them with it (the span list also holds the method's own kinds).
PII_BASE_SQL = _pii_sql()


@query("op5_pii_spans")
def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select("doc_id", *[n(k) for k in pii.BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))


@query("op2_simhash_groups")
def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = simhash.with_fingerprints(docs).select("doc_id", "simhash")  # the text does not travel on
    out = simhash.group_rows(rows, radius=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def _chat_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for tree, formatted, mask in zip(*(c.to_pylist() for c in b.columns)):
            turns = chat.read_back(formatted)
            loss = "".join(chat.unescape(formatted[m["start"]:m["end"]]) for m in mask)
            rows.append((tree, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                         hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        cols = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
            pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


#: conversation -1: texts that hold another template's control strings
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op6_chat_trees")
def op6_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(CONTROL_TURNS, "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    # each row answers the row before it in turn order: a tree with one branch
    ordered = sharding.number_rows(rows, ["conv_id", "turn", "role", "text"])
    before = ordered.select((F.col("row") + 1).alias("row"), F.col("row").alias("parent"), F.col("conv_id").alias("__conv"))
    nodes = ordered.join(before, "row", "left").select(
        F.col("conv_id").alias("tree"), F.col("row").alias("node"),
        F.when(F.col("conv_id").eqNullSafe(F.col("__conv")), F.col("parent")).alias("parent"), "role", "text",
        F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"))
    formatted = chat.format_trees(nodes).select("tree", "formatted", "mask")
    return formatted.mapInArrow(_chat_digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                              "loss_sha256 string, formatted_chars bigint")


@query("op1_line_frequency")
def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_frequency_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])


@query("op4_hyperdimensional_lang")
def op4_hyperdimensional_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, proto = langid.train_prototypes(langid.training_rows(docs, fold("doc_id", 4) != 2))
    held_out = (fold("doc_id", 4) == 2).alias("held_out")
    return langid.identify(docs.select("doc_id", held_out, "text"), langs, proto).drop("text")


@query("op3_fm_index")
def op3_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op10_crf_toxicity")
def op10_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train_field(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    scored = toxicity.score_documents(docs.select("doc_id", held_out, "text"), model)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("spans").cast("long").alias("n_spans"))


@query("op7_context_tree_weighting")
def op7_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 5) == 1).alias("held_out"))
    return lm.score_texts(docs, ~F.col("held_out"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)

"""Registered queries over the supplied tables, and DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as X
from ..functions.similarity import cosine, on_distinct_pairs
from ..functions.text import ADDRESS_ABBREVIATIONS, COUNTRY_VARIANTS, NAME_ABBREVIATIONS, char_ngrams, index_ngrams
from ..operators import bm25, bm25_texts, candidates, metrics, ml, outputs, state, vectors
from ..sources.entities import discover_countries, explode_truth, missing_targets, union_targets
from ..sources.scratch import written
from . import workload as W
from .cycles import run_cycles
from .match import features, match, retrieve

K = 20
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# SQL pieces -----------------------------------------------------------------------------------------------------


def _nested(value: str, table: dict[str, str]) -> str:
    for short, long in table.items():
        value = f"regexp_replace({value}, '\\b{short}\\b', '{long}', 'g')"
    return value


def _plain(value: str) -> str:
    return f"trim(regexp_replace(replace(replace(replace(lower({value}), '.', ''), '@', ' at '), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


_COUNTRY = "lower(trim(country))"
ENTITIES = f"""
nat AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
raw AS (
  SELECT s_suppkey AS key, 'S1-' || s_suppkey AS entity_id, 'S1' AS source, s_name AS business_name, r_name || ', ' || n_name || ' ' || CAST(floor(s_acctbal) AS BIGINT) AS business_address, ' ' || upper(n_name) AS country FROM supplier JOIN nat ON s_nationkey = n_nationkey
  UNION ALL SELECT c_custkey, 'S2-' || c_custkey, 'S2', c_name, c_mktsegment || ' ' || r_name || ', ' || n_name || ' ' || CAST(floor(c_acctbal) AS BIGINT), ' ' || upper(n_name) FROM customer JOIN nat ON c_nationkey = n_nationkey
  UNION ALL SELECT p_partkey, 'S3-' || p_partkey, 'S3', p_name, p_brand || ' & ' || p_type || ' ' || p_size, ' ' || upper(n_name) FROM part JOIN nat ON p_size % 25 = n_nationkey),
clean AS (
  SELECT key, entity_id, source, business_name AS name_original, business_address AS addr_original,
         CASE {_COUNTRY} {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in COUNTRY_VARIANTS.items())} ELSE {_COUNTRY} END AS country,
         trim(regexp_replace(lower(business_name), '\\s+', ' ', 'g')) AS name_for_vectors,
         {_nested(_plain('business_name'), NAME_ABBREVIATIONS)} AS name_for_bm25,
         {_nested(_plain('business_address'), ADDRESS_ABBREVIATIONS)} AS addr_for_bm25,
         key * 2 + CASE source WHEN 'S2' THEN 1 ELSE 0 END AS pos
  FROM raw)"""


def _grams(text: str) -> str:
    return f"CASE WHEN {text} IS NULL OR {text} = '' THEN [] WHEN length({text}) < 3 THEN [{text}] ELSE list_transform(range(1, length({text}) - 1), lambda i: substr({text}, i::BIGINT, 3)) END"


def _bm25(name: str, corpus: str, queries: str) -> str:
    """CTEs {name}_vocab, {name}_stats, {name}_ranked; corpus: block, pos, id, tokens; queries: block, query_id, tokens."""
    return f"""
{name}_c AS ({corpus}), {name}_q AS ({queries}),
{name}_stats AS (SELECT block, count(*) AS n, avg(len(tokens)) AS avgdl FROM {name}_c GROUP BY block),
{name}_tf AS (SELECT block, pos, id, tok, count(*) AS tf, any_value(dl) AS dl FROM (SELECT block, pos, id, len(tokens) AS dl, unnest(tokens) AS tok FROM {name}_c) GROUP BY ALL HAVING true),
{name}_raw AS (SELECT v.block, tok, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM (SELECT block, tok, count(*) AS df FROM {name}_tf GROUP BY block, tok) v JOIN {name}_stats s ON v.block = s.block),
{name}_vocab AS (SELECT block, tok, df, CASE WHEN raw < 0 THEN 0.25 * avg(raw) OVER (PARTITION BY block) ELSE raw END AS idf FROM {name}_raw),
{name}_w AS (SELECT t.block, t.tok, pos, id, idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl)) AS weight FROM {name}_tf t JOIN {name}_vocab v ON t.block = v.block AND t.tok = v.tok JOIN {name}_stats s ON t.block = s.block),
{name}_qf AS (SELECT block, query_id, tok, count(*) AS qf FROM (SELECT block, query_id, unnest(tokens) AS tok FROM {name}_q) GROUP BY ALL),
{name}_scored AS (SELECT q.block, query_id, pos, id, round(sum(qf * weight), 6) AS score FROM {name}_qf q JOIN {name}_w w ON q.block = w.block AND q.tok = w.tok GROUP BY ALL),
{name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY block, query_id ORDER BY score DESC, pos, id) AS rank FROM {name}_scored WHERE score > 0)"""


def _entity_bm25(stream: str) -> str:
    field = f"{stream}_for_bm25"
    return _bm25(stream, f"SELECT country AS block, pos, entity_id AS id, {_grams(field)} AS tokens FROM clean WHERE source <> 'S1'", f"SELECT country AS block, entity_id AS query_id, {_grams(field)} AS tokens FROM clean WHERE source = 'S1'")


_TOPK = "SELECT block, query_id, id, pos, score, CAST(rank AS INTEGER) AS rank FROM {0}_ranked WHERE rank <= 20"
_SELF = """
SELECT q.block, q.query_id, CASE WHEN total > 0 THEN round(total, 6) ELSE 1e-9 END AS self_score
FROM {0}_q q LEFT JOIN (
  SELECT f.block, f.query_id, sum(idf * qf * qf * 2.5 / (qf + 1.5 * (0.25 + 0.75 * len(q.tokens) / avgdl))) AS total
  FROM {0}_qf f JOIN {0}_q q ON f.query_id = q.query_id JOIN {0}_vocab v ON f.block = v.block AND f.tok = v.tok JOIN {0}_stats s ON s.block = f.block GROUP BY ALL) t
ON q.query_id = t.query_id"""
_PAIRS = "pairs AS (SELECT m.entity_id, m.cand_id, a.name_for_bm25 AS name_a, b.name_for_bm25 AS name_b, a.addr_for_bm25 AS addr_a, b.addr_for_bm25 AS addr_b FROM merged m JOIN clean a ON m.entity_id = a.entity_id JOIN clean b ON m.cand_id = b.entity_id)"
_STREAMS = f"""
WITH {ENTITIES}, {_entity_bm25('name')}, {_entity_bm25('addr')},
streams AS (SELECT query_id AS entity_id, id AS cand_id, 'name' AS stream, rank, score FROM name_ranked WHERE rank <= 20
  UNION ALL SELECT query_id, id, 'addr', rank, score FROM addr_ranked WHERE rank <= 20),
merged AS (SELECT entity_id, cand_id, CAST(max(rank) FILTER (stream = 'name') AS INTEGER) AS rank_name, max(score) FILTER (stream = 'name') AS score_name,
  CAST(max(rank) FILTER (stream = 'addr') AS INTEGER) AS rank_addr, max(score) FILTER (stream = 'addr') AS score_addr,
  CAST(NULL AS INTEGER) AS rank_vector, CAST(NULL AS DOUBLE) AS score_vector, CAST(count(*) AS INTEGER) AS stream_count FROM streams GROUP BY entity_id, cand_id)"""


# Text and entities ----------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, len(g) AS n_grams, len(list_distinct(g)) AS n_distinct FROM (SELECT doc_id, {_grams('text')} AS g FROM documents)")
def char_3grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = W.table(spark, sf_dir, "documents").select("doc_id", char_ngrams(F.col("text")).alias("g"))
    return grams.select("doc_id", F.size("g").cast("long").alias("n_grams"), F.size(F.array_distinct("g")).cast("long").alias("n_distinct"))


@query(f"WITH {ENTITIES} SELECT entity_id, country, source, name_original, addr_original, name_for_vectors, name_for_bm25, addr_for_bm25, CAST(0 AS TINYINT) AS is_cross_script FROM clean")
def clean_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = W.entities(spark, sf_dir)
    return a.unionByName(b).drop("pos")


@query(f"WITH {ENTITIES} SELECT source, country, count(*) AS n FROM clean WHERE source <> 'S1' GROUP BY ALL")
def union_target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = W.entities(spark, sf_dir)[1]
    both = union_targets(targets.where("source = 'S2'"), targets.where("source = 'S3'"))
    return both.groupBy("source", "country").agg(F.count("*").alias("n"))


@query(f"WITH {ENTITIES} SELECT DISTINCT country FROM clean WHERE source = 'S1'")
def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover_countries(W.entities(spark, sf_dir)[0])


@query(f"WITH {ENTITIES} SELECT country FROM clean WHERE source = 'S1' EXCEPT SELECT country FROM clean WHERE source <> 'S1'")
def countries_without_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_targets(*W.entities(spark, sf_dir))


# Retrieval ------------------------------------------------------------------------------------------------------


def _index(spark: SparkSession, sf_dir: str, stream: str) -> tuple[bm25.Index, DataFrame]:
    return _indexed(*W.entities(spark, sf_dir), stream)


def _indexed(queries: DataFrame, targets: DataFrame, stream: str) -> tuple[bm25.Index, DataFrame]:
    field = f"{stream}_for_bm25"
    tokens = index_ngrams(F.col(field), f"null{stream}")
    return bm25.build(targets.select(F.col("country").alias("block"), "pos", F.col("entity_id").alias("id"), field), tokens=tokens), queries.select(F.col("country").alias("block"), F.col("entity_id").alias("query_id"), tokens.alias("tokens"))


@query(f"WITH {ENTITIES}, {_entity_bm25('name')} {_TOPK.format('name')}")
def bm25_name_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.search(*_index(spark, sf_dir, "name"), K)


@query(f"WITH {ENTITIES}, {_entity_bm25('addr')} {_TOPK.format('addr')}")
def bm25_addr_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.search(*_index(spark, sf_dir, "addr"), K)


@query(f"WITH {ENTITIES}, {_entity_bm25('name')} SELECT block, tok, df, round(idf, 9) AS idf FROM name_vocab")
def bm25_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir, "name")[0].vocab.select("block", "tok", "df", F.round("idf", 9).alias("idf"))


@query(f"WITH {ENTITIES}, {_entity_bm25('name')} SELECT block, n, round(avgdl, 9) AS avgdl FROM name_stats")
def bm25_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir, "name")[0].stats.select("block", "n", F.round("avgdl", 9).alias("avgdl"))


@query(f"WITH {ENTITIES}, {_entity_bm25('name')} {_SELF.format('name')}")
def bm25_name_self_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.self_scores(*_index(spark, sf_dir, "name")).withColumn("self_score", F.when(F.col("self_score") > 1e-9, F.round("self_score", 6)).otherwise(F.col("self_score")))


_DOCS = f"SELECT '' AS block, doc_id AS pos, doc_id AS id, {_grams('text')} AS tokens FROM documents"


@query(f"WITH {_bm25('d', _DOCS, f'SELECT block, id AS query_id, tokens FROM ({_DOCS}) WHERE id % 100 = 0')} {_TOPK.format('d')}")
def bm25_document_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 100, against the whole texts of all documents."""
    docs = W.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return bm25_texts.search(docs, "id % 100 = 0", K).select(F.lit("").alias("block"), "query_id", "id", F.col("id").alias("pos"), "score", "rank")


_VECTORS = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v)"


@query(f"""WITH {_VECTORS}, s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, round(greatest(-1, least(1, list_dot_product(q.e, c.e))), 6) AS score FROM u q, u c WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
SELECT CAST(query_id AS VARCHAR) AS query_id, CAST(id AS VARCHAR) AS id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 20""")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 100, against all."""
    rows = W.table(spark, sf_dir, "embeddings").select(F.lit("").alias("block"), F.col("vec_id").alias("pos"), F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vectors.search(rows, rows.where("id % 100 = 0").withColumnRenamed("id", "query_id"), K).select("query_id", "id", "score", "rank")


@query(f"WITH {_VECTORS} SELECT vec_id, round(sqrt(list_dot_product(e, e)), 6) AS length, 1.0::DOUBLE AS self_score FROM v")
def vector_self_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    scores = vectors.self_scores(rows, "embedding")
    return rows.select(F.col("query_id").alias("vec_id"), F.round(vectors.norm(F.col("embedding")), 6).alias("length")).join(scores, F.col("vec_id") == F.col("query_id")).drop("query_id")


@query(f"WITH {_VECTORS} SELECT a.vec_id AS vec_a, b.vec_id AS vec_b, round(greatest(0, least(1, list_dot_product(a.e, b.e))), 6) AS dim_7_semantic_cosine FROM u a JOIN u b ON a.label = b.label WHERE a.vec_id % 100 = 0")
def semantic_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.table(spark, sf_dir, "embeddings").select("vec_id", "label", vectors.unit(F.col("embedding")).alias("e"))
    a, b = rows.where("vec_id % 100 = 0").select("label", F.col("vec_id").alias("vec_a"), F.col("e").alias("ea")), rows.select("label", F.col("vec_id").alias("vec_b"), F.col("e").alias("eb"))
    return a.join(b, "label").select("vec_a", "vec_b", F.round(cosine(F.col("ea"), F.col("eb")), 6).alias("dim_7_semantic_cosine"))


# Features -------------------------------------------------------------------------------------------------------

def _two_streams(queries: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    found, selfs = {}, queries.select("entity_id")
    for stream in ("name", "addr"):
        index, asked = _indexed(queries, targets, stream)
        found[stream] = bm25.search(index, asked, K).select(F.col("query_id").alias("entity_id"), F.col("id").alias("cand_id"), "rank", "score")
        selfs = selfs.join(bm25.self_scores(index, asked).select(F.col("query_id").alias("entity_id"), F.col("self_score").alias(f"bm25_{stream}_self_score")), "entity_id")
    return candidates.tag_streams(**found), selfs


def _candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, cand_id, name_a, name_b, addr_a, addr_b of the candidates by name and by address, from all targets."""
    queries, targets = W.entities(spark, sf_dir)
    merged = candidates.merge_streams(_two_streams(queries, targets)[0]).select("entity_id", "cand_id")
    # Written once: features of distinct pairs are joined back to it.
    return written(candidates.enrich(merged, queries, targets).select("entity_id", "cand_id", "name_a", "name_b", "addr_a", "addr_b"))


_W = "list_filter(string_split_regex({0}, '\\s+'), lambda t: t <> '')"
_LEV = "(1 - levenshtein({0}, {1}) / greatest(length({0}), length({1}), 1))"


def _one_way(x: str, y: str) -> str:
    return f"list_avg(list_transform({x}, lambda s: list_max(list_transform({y}, lambda t: 1 - levenshtein(s, t) / greatest(length(s), length(t), 1)))))"


_INITIALS = "array_to_string(list_transform({0}, lambda t: substr(t, 1, 1)), '')"


@query(f"""{_STREAMS}, {_PAIRS}, w AS (SELECT *, {_W.format('name_a')} AS x, {_W.format('name_b')} AS y FROM pairs),
n AS (SELECT *, jaro_winkler_similarity({_INITIALS.format('CASE WHEN len(x) >= len(y) THEN x ELSE y END')}, CASE WHEN len(x) >= len(y) THEN name_b ELSE name_a END) AS j1, jaro_winkler_similarity({_INITIALS.format('y')}, name_a) AS j2 FROM w)
SELECT entity_id, cand_id, round(jaro_winkler_similarity(name_a, name_b), 6) AS dim_1_name_jaro_winkler, round(({_one_way('x', 'y')} + {_one_way('y', 'x')}) / 2, 6) AS dim_2_name_monge_elkan,
round({_LEV.format('name_a', 'name_b')}, 6) AS dim_3_name_levenshtein_norm, CAST(name_a = name_b AS INTEGER) AS dim_4_name_exact_match,
round(CASE WHEN greatest(len(x), len(y)) <= 1 THEN 0 WHEN len(x) = len(y) THEN greatest(j1, j2) ELSE j1 END, 6) AS dim_6_name_acronym_match FROM n""")
def name_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.name_lexical(F.col("name_a"), F.col("name_b"))
    made = on_distinct_pairs(_candidate_pairs(spark, sf_dir), "name_a", "name_b", found)
    return made.select("entity_id", "cand_id", *[F.round(n, 6).alias(n) if n != "dim_4_name_exact_match" else F.col(n) for n in found])


@query()
def name_phonetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.name_phonetic(F.col("name_a"), F.col("name_b"))
    return on_distinct_pairs(_candidate_pairs(spark, sf_dir), "name_a", "name_b", found).select("entity_id", "cand_id", *found)


_NUMS = "list_distinct(regexp_extract_all({0}, '\\d+'))"


@query(f"""{_STREAMS}, {_PAIRS}, w AS (SELECT *, list_distinct({_W.format('addr_a')}) AS x, list_distinct({_W.format('addr_b')}) AS y, {_NUMS.format('addr_a')} AS m, {_NUMS.format('addr_b')} AS n FROM pairs)
SELECT entity_id, cand_id, round(len(list_intersect(x, y)) / greatest(len(list_distinct(x || y)), 1), 6) AS dim_8_addr_jaccard, round(len(list_intersect(x, y)) / greatest(least(len(x), len(y)), 1), 6) AS dim_9_addr_containment,
CAST(addr_a = addr_b AS INTEGER) AS dim_10_addr_exact_match, round(len(list_intersect(m, n)) / greatest(len(list_distinct(m || n)), 1), 6) AS dim_11_num_jaccard,
CASE WHEN len(m) = 0 OR len(n) = 0 THEN -1 WHEN list_sort(m) = list_sort(n) THEN 1 ELSE 0 END AS dim_12_num_exact_match, CASE WHEN len(m) = 0 OR len(n) = 0 THEN 0 ELSE 1 END AS dim_13_num_presence FROM w""")
def address_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.address_structural(F.col("addr_a"), F.col("addr_b")) | X.address_numeric(F.col("addr_a"), F.col("addr_b"))
    shares = {"dim_8_addr_jaccard", "dim_9_addr_containment", "dim_11_num_jaccard"}
    return _candidate_pairs(spark, sf_dir).select("entity_id", "cand_id", *[F.round(c, 6).alias(n) if n in shares else c.alias(n) for n, c in found.items()])


@query(_STREAMS + " SELECT * FROM merged")
def merged_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.merge_streams(_two_streams(*W.entities(spark, sf_dir))[0])


@query(_STREAMS + " SELECT *, CAST(row_number() OVER (PARTITION BY entity_id ORDER BY stream_count DESC, rank_name NULLS LAST, rank_addr NULLS LAST, cand_id) AS INTEGER) AS seq FROM merged")
def prioritised_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.prioritise(candidates.merge_streams(_two_streams(*W.entities(spark, sf_dir))[0]))


_RATIO = "round(least(length({0}), length({1})) / greatest(length({0}), length({1}), 1), 6)"


@query(_STREAMS + f""", ns AS ({_SELF.format('name').replace('round(total, 6)', 'total')}), sa AS ({_SELF.format('addr').replace('round(total, 6)', 'total')})
SELECT m.entity_id, m.cand_id, round(coalesce(score_name, 0) / ns.self_score, 6) AS dim_14_name_bm25_norm, round(coalesce(score_addr, 0) / sa.self_score, 6) AS dim_15_addr_bm25_norm,
round(coalesce(1.0 / (60 + rank_name), 0) + coalesce(1.0 / (60 + rank_addr), 0), 6) AS dim_16_rrf_score, stream_count AS dim_17_overlap_count,
{_RATIO.format('a.name_for_bm25', 'b.name_for_bm25')} AS dim_18_name_len_ratio, {_RATIO.format('a.addr_for_bm25', 'b.addr_for_bm25')} AS dim_19_addr_len_ratio,
0 AS dim_20_s1_name_missing, 0 AS dim_21_cand_name_missing, 0 AS dim_22_s1_addr_missing, 0 AS dim_23_cand_addr_missing, 0 AS dim_24_cross_script,
CASE b.source WHEN 'S3' THEN 1 ELSE 0 END AS dim_25_source_origin, a.country AS dim_26_country_raw
FROM merged m JOIN clean a ON m.entity_id = a.entity_id JOIN clean b ON m.cand_id = b.entity_id JOIN ns ON ns.query_id = m.entity_id JOIN sa ON sa.query_id = m.entity_id""")
def stream_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, targets = W.entities(spark, sf_dir)
    streams, selfs = _two_streams(queries, targets)
    pairs = candidates.enrich(candidates.merge_streams(streams), queries, targets).join(selfs, "entity_id").withColumnsRenamed({"score_name": "bm25_name_score", "score_addr": "bm25_addr_score"})
    shares = {"dim_14_name_bm25_norm", "dim_15_addr_bm25_norm", "dim_16_rrf_score", "dim_18_name_len_ratio", "dim_19_addr_len_ratio"}
    return pairs.select("entity_id", "cand_id", *[F.round(c, 6).alias(n) if n in shares else c.alias(n) for n, c in X.stream_metadata().items()])


@query()
def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 26 features of every candidate of one cycle's depth, vectors from the stand-in encoder."""
    queries, targets = W.entities(spark, sf_dir)
    streams, selfs = retrieve(queries, targets)
    merged = candidates.merge_streams(candidates.first_of_each_stream(streams, K))
    return features(merged, queries, targets, selfs).select("entity_id", "cand_id", *ml.FEATURE_COLS)


@query()
def cycle_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of all cycles of training; a test holds them against a plain model."""
    return match(*W.entities(spark, sf_dir)).select("entity_id", "cand_id", "cycle", "seq", "accepted", "stream_count")


# State and outputs ----------------------------------------------------------------------------------------------

_DECISIONS = """d0 AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, json_extract_string(props, '$.k') AS cand_id, CAST(day(ts) AS INTEGER) AS cycle, event_id AS seq, event_type = 'purchase' AS accepted FROM events),
d AS (SELECT * FROM d0 QUALIFY row_number() OVER (PARTITION BY entity_id, cand_id ORDER BY seq) = 1), e AS (SELECT DISTINCT entity_id FROM d0)"""


def _events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    made = W.decisions(spark, sf_dir)
    return made.select("entity_id").distinct(), made


@query(f"WITH {_DECISIONS} SELECT * FROM d")
def first_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.first_decisions(W.decisions(spark, sf_dir))


@query(f"WITH {_DECISIONS} SELECT entity_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id) FILTER (accepted), '') AS accepted, coalesce(string_agg(cand_id, ',' ORDER BY cand_id) FILTER (NOT accepted), '') AS rejected FROM d GROUP BY entity_id")
def seen_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.seen_sets(W.decisions(spark, sf_dir)).select("entity_id", F.array_join("accepted", ",").alias("accepted"), F.array_join("rejected", ",").alias("rejected"))


@query(f"WITH {_DECISIONS} SELECT entity_id, cycle, string_agg(cand_id, ',' ORDER BY seq) AS ids FROM d GROUP BY entity_id, cycle")
def seen_per_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.per_cycle(W.decisions(spark, sf_dir)).select("entity_id", "cycle", F.array_join("cand_ids", ",").alias("ids"))


@query(f"WITH {_DECISIONS} SELECT e.entity_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id) FILTER (accepted), '') AS ids FROM e LEFT JOIN d USING (entity_id) GROUP BY ALL")
def matching_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.matching_results(*_events(spark, sf_dir))


@query(f"WITH {_DECISIONS} SELECT e.entity_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS ids FROM e LEFT JOIN d USING (entity_id) GROUP BY ALL")
def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.candidate_pairs(*_events(spark, sf_dir))


@query(f"WITH {_DECISIONS} SELECT e.entity_id, coalesce(CAST(cycle AS VARCHAR), '') AS cycle, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS ids FROM e LEFT JOIN d USING (entity_id) GROUP BY ALL")
def candidate_pairs_per_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outputs.candidate_pairs_per_cycle(*_events(spark, sf_dir))


@query(f"WITH {_DECISIONS} SELECT DISTINCT d0.entity_id FROM d0 WHERE entity_id NOT IN (SELECT entity_id FROM d0 WHERE accepted AND cycle = 2)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities, made = _events(spark, sf_dir)
    return state.pending(entities, made.where("accepted and cycle = 2").select("entity_id").distinct())


@query(f"WITH {_DECISIONS} SELECT a.entity_id, a.cand_id, a.seq FROM d0 a WHERE NOT EXISTS (SELECT 1 FROM d0 b WHERE b.accepted AND a.entity_id = b.entity_id AND a.cand_id = b.cand_id)")
def unseen_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = W.decisions(spark, sf_dir)
    return candidates.unseen(made, made.where("accepted")).select("entity_id", "cand_id", "seq")


# Labels and metrics ---------------------------------------------------------------------------------------------

_TRUTH = "truth AS (SELECT a.entity_id, b.entity_id AS cand_id FROM raw a JOIN raw b ON a.source = 'S1' AND b.source <> 'S1' AND a.country = b.country AND a.key % 100 = b.key % 100)"
_SCORED = "s AS (SELECT source AS entity_id, CAST(doc_id AS VARCHAR) AS cand_id, quality AS label, (n_chars % 100) / 100.0::DOUBLE AS prob, lang AS country, doc_id % 5 AS fold FROM labels JOIN documents USING (doc_id))"
_F = """SELECT t, entity_id, count(*) FILTER (prob > t AND label = 1) AS tp, count(*) FILTER (prob > t AND label = 0) AS fp, count(*) FILTER (prob <= t AND label = 1) AS fn FROM s, g GROUP BY t, entity_id"""
_MACRO = f"f AS (SELECT t, avg(CASE WHEN tp + fn = 0 THEN CASE WHEN fp = 0 THEN 1.0 ELSE 0.0 END WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / (tp + fp)) * (tp / (tp + fn)) / (0.25 * (tp / (tp + fp)) + tp / (tp + fn)) END) AS macro_f FROM ({_F}) GROUP BY t)"


@query(f"WITH {ENTITIES}, {_TRUTH}, pairs AS (SELECT a.entity_id, b.entity_id AS cand_id FROM clean a JOIN clean b ON a.country = b.country AND a.source = 'S1' AND b.source <> 'S1' AND b.key % 100 IN (a.key % 100, (a.key + 1) % 100)) SELECT p.entity_id, p.cand_id, CAST(t.cand_id IS NOT NULL AS TINYINT) AS label FROM pairs p LEFT JOIN truth t ON p.entity_id = t.entity_id AND p.cand_id = t.cand_id")
def truth_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.label(W.blocked_pairs(spark, sf_dir), explode_truth(W.truth(spark, sf_dir)))


@query(f"WITH {ENTITIES}, {_TRUTH}, {_entity_bm25('name')}, p AS (SELECT query_id AS entity_id, id AS cand_id FROM name_ranked WHERE rank <= 20), c AS (SELECT (SELECT count(*) FROM p) AS n_pairs, (SELECT count(*) FROM clean WHERE source = 'S1') * (SELECT count(*) FROM clean WHERE source <> 'S1') AS all_pairs, (SELECT count(*) FROM truth) AS true_pairs, (SELECT count(*) FROM truth SEMI JOIN p USING (entity_id, cand_id)) AS true_found) SELECT n_pairs, all_pairs, round(1 - n_pairs / all_pairs, 9) AS reduction_ratio, true_pairs, true_found, round(true_found / true_pairs, 9) AS recall_ceiling FROM c")
def blocking_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, targets = W.entities(spark, sf_dir)
    pairs = bm25_name_topk(spark, sf_dir).select(F.col("query_id").alias("entity_id"), F.col("id").alias("cand_id"))
    made = metrics.blocking_quality(queries, targets, pairs, explode_truth(W.truth(spark, sf_dir)))
    return made.withColumns({c: F.round(c, 9) for c in ("reduction_ratio", "recall_ceiling")})


@query(f"WITH {_SCORED} SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, round(count(*) FILTER (label = 0) / count(*) FILTER (label = 1), 9) AS scale_pos_weight FROM s")
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_balance(W.scored_pairs(spark, sf_dir)).withColumn("scale_pos_weight", F.round("scale_pos_weight", 9))


@query(f"WITH {_SCORED} SELECT country, round(avg(label), 9) AS encoded, round((SELECT avg(label) FROM s), 9) AS global_mean FROM s GROUP BY country")
def target_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.target_encoding(W.scored_pairs(spark, sf_dir), "country").withColumns({c: F.round(c, 9) for c in ("encoded", "global_mean")})


@query(f"WITH {_SCORED} SELECT a.cand_id, a.fold::INTEGER AS fold, round((SELECT avg(b.label) FROM s b WHERE b.country = a.country AND b.fold <> a.fold), 9) AS encoded FROM s a")
def out_of_fold_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.out_of_fold_encoding(W.scored_pairs(spark, sf_dir), "country", "fold").select("cand_id", "fold", F.round("encoded", 9).alias("encoded"))


@query(f"WITH {_SCORED}, g AS (SELECT 0.5::DOUBLE AS t), {_MACRO} SELECT round(macro_f, 9) AS macro_f FROM f")
def macro_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.macro_f_beta(W.scored_pairs(spark, sf_dir), 0.5).select(F.round("macro_f", 9).alias("macro_f"))


@query(f"WITH {_SCORED}, g AS (SELECT i / 100.0::DOUBLE AS t FROM range(50, 100) r(i)), {_MACRO} SELECT t AS threshold, round(macro_f, 9) AS macro_f FROM f")
def threshold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.threshold_scores(W.scored_pairs(spark, sf_dir)).withColumn("macro_f", F.round("macro_f", 9))


@query(f"WITH {_SCORED}, g AS (SELECT i / 100.0::DOUBLE AS t FROM range(50, 100) r(i)), {_MACRO} SELECT t AS threshold, round(macro_f, 9) AS macro_f FROM f ORDER BY round(macro_f, 9) DESC, t LIMIT 1")
def threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_threshold(W.scored_pairs(spark, sf_dir))


@query()
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair scored out of fold by the monotone model."""
    labelled = candidates.label(pair_features(spark, sf_dir), explode_truth(W.truth(spark, sf_dir)))
    return ml.out_of_fold(written(labelled)).select("entity_id", "cand_id", "label", "prob", "fold")

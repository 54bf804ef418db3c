"""Queries for near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm import jaccard_join, repeated_bytes, vector_links
from stemma.llm.common import read


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shingle count and near-duplicate component."""
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that repeated strings of 200 bytes cover."""
    found = repeated_bytes.remove(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its number of near-duplicates and their component."""
    return vector_links.links(read(spark, sf_dir, "embeddings"))


OP3_SQL = """
with recursive v as materialized (
  select vec_id, label, embedding::double[] as x from embeddings
  where label is not null and len(list_filter(embedding, lambda e: e is null or isnan(e) or isinf(e))) = 0
    and len(list_filter(embedding, lambda e: e <> 0)) > 0),
links as materialized (
  select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.x) = len(b.x)
  where list_cosine_similarity(a.x, b.x) >= 0.93),
reach as (select vec_id as x, vec_id as y from embeddings union select r.x, l.y from reach r join links l on r.y = l.x),
counts as (select x, count(*) as n from links group by x)
select e.vec_id, coalesce(c.n, 0)::bigint as n_links, min(r.y) as component_id, e.vec_id = min(r.y) as kept
from embeddings e left join counts c on c.x = e.vec_id join reach r on r.x = e.vec_id group by e.vec_id, c.n
"""
_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""
OP4_SQL = f"""
with recursive words as materialized (select doc_id, {_WORDS} as w from documents),
grams as materialized (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from words),
sizes as materialized (select doc_id, count(*) as n from grams group by doc_id),
pairs as materialized (
  select a.doc_id as x, b.doc_id as y, count(*) as c from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as materialized (
  select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)),
both_ways as materialized (select x, y from links union all select y, x from links),
reach as (select doc_id as x, doc_id as y from words union select r.x, b.y from reach r join both_ways b on r.y = b.x)
select w.doc_id, coalesce(s.n, 0)::bigint as n_shingles, min(r.y) as component_id
from words w left join sizes s on s.doc_id = w.doc_id join reach r on r.x = w.doc_id group by 1, 2
"""
QUERIES = {f.__name__: f for f in (op2_repeated_bytes, op3_vector_links, op4_jaccard_join)}
ORACLES = {"op3_vector_links": OP3_SQL, "op4_jaccard_join": OP4_SQL}

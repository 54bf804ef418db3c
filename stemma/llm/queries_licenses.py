"""Query for licence scans. Documents have no path, so one is made of source and id: two levels of directories in each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm import licenses
from stemma.llm.common import read


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its own or its directory's licence."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat(F.lit("/"), F.coalesce("source", F.lit("none")), F.expr("concat('/', doc_id div 4096, '/', doc_id div 64, '/', doc_id, '.txt')"))
    return licenses.scan(docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")).withColumnRenamed("file_id", "doc_id")


_TEMPLATES = ", ".join("({}, '{}', '{}')".format(i, *x) for i, x in enumerate(licenses.TEMPLATES))
_TERMS = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda w: w <> '')"
_WEIGHTED = """
  select k, term, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by k)) as weight
  from (select k, term, count(*) as tf from (select {key} as k, unnest({terms}) as term from {table}) group by 1, 2) join idf using (term)"""
OP6_SQL = f"""
with files as (
  select doc_id, '/' || coalesce(source, 'none') || '/' || (doc_id // 4096) || '/' || (doc_id // 64) || '/' || doc_id || '.txt' as path,
    '/' || coalesce(source, 'none') || '/' || (doc_id // 4096) || '/' || (doc_id // 64) as directory, coalesce(text, '') as text from documents),
templates(template, license, line) as (values {_TEMPLATES}),
headed as materialized (
  select doc_id, directory, len({_TERMS.format('text')}) as words, line from (
    select doc_id, directory, text, unnest(string_split(text, chr(10))) as line from files)
  where regexp_matches(line, '{licenses.SIGNAL}')),
headers as materialized (select line, count(*) as n from headed group by line),
both_kinds as (select line, n from headers union all select line, 1 from templates),
idf as materialized (
  select term, ln((1 + (select sum(n) from both_kinds)) / (1 + sum(n))) + 1 as idf
  from (select n, unnest(list_distinct({_TERMS.format('line')})) as term from both_kinds) group by term),
own as materialized ({_WEIGHTED.format(key='line', terms=_TERMS.format('line'), table='headers')}),
given as materialized ({_WEIGHTED.format(key='template', terms=_TERMS.format('line'), table='templates')}),
scored as (
  select o.k as line, t.license, round(sum(o.weight * g.weight), 6) as score
  from own o join given g using (term) join templates t on t.template = g.k group by o.k, t.template, t.license),
liked as (
  select line, license, score from scored qualify row_number() over (partition by line order by score desc, license) = 1),
licensed as materialized (select h.*, l.license, l.score from headed h join liked l using (line) where l.score >= {licenses.LIKE}),
mine as materialized (
  select doc_id, any_value(directory) as directory, arg_min(license, (-score, license)) as license, max(score) as score,
    2 * sum(len({_TERMS.format('line')})) >= any_value(words) as is_file
  from licensed group by doc_id),
held as materialized (
  select directory as above, arg_min(license, (-score, license)) as license, max(score) as score from mine where is_file group by directory),
near as (
  select f.doc_id, arg_max(h.above, length(h.above)) as above, arg_max(h.license, length(h.above)) as license, arg_max(h.score, length(h.above)) as score
  from files f join held h on f.directory = h.above or starts_with(f.directory, h.above || '/') group by f.doc_id)
select f.doc_id, f.path, coalesce(m.license, n.license) as license,
  case when m.license is not null then 'own' when n.doc_id is not null then 'inherited' else 'none' end as found,
  coalesce(m.score, n.score) as score, case when m.license is null then n.above end as directory
from files f left join mine m on m.doc_id = f.doc_id left join near n on n.doc_id = f.doc_id
"""
QUERIES = {f.__name__: f for f in (op6_license_scan,)}
ORACLES = {"op6_license_scan": OP6_SQL}

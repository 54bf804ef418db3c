"""Query for collocations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stemma.llm import collocations
from stemma.llm.common import read


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language by how closely their words stand together."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
  from documents),
split as materialized (select lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from split group by lang),
sizes(k) as (values (1), (2), (3), (4)),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from split, sizes where len(w) >= k),
f as materialized (select lang, phrase, k, count(*) as a from grams group by lang, phrase, k),
candidates as materialized (select lang, phrase, k as words, a, string_split(phrase, ' ') as w from f where k >= 2 and a >= 30),
cuts as (select lang, phrase, a, w, unnest(range(1, words)) as k from candidates),
scored as (
  select c.lang, c.phrase, c.a, c.k, x.a as l, y.a as r, (2000000::hugeint * c.a) // (x.a + y.a)::hugeint as score
  from cuts c join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
spans as (select lang, a, words, w, unnest(range(2, words)) as n from candidates where words > 2),
inner_phrases as (select lang, a, unnest(list_transform(range(1, words - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) as phrase from spans),
above as (select lang, phrase, max(a) as above from inner_phrases group by lang, phrase),
kept as (
  select b.* from best b left join above u on u.lang = b.lang and u.phrase = b.phrase
  where u.above is null or 100::hugeint * u.above < 80::hugeint * b.a)
select k.lang, row_number() over (partition by k.lang order by k.score desc, k.a desc, k.phrase) as rank,
  k.phrase, k.a, k.l, k.r, t.n, k.score::bigint as score
from kept k join totals t on t.lang = k.lang
qualify row_number() over (partition by k.lang order by k.score desc, k.a desc, k.phrase) <= 2000
"""
QUERIES = {f.__name__: f for f in (op12_collocations,)}
ORACLES = {"op12_collocations": OP12_SQL}

"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

from stratalake.llm import cells, centroids, line_quality, line_spread, substring
from stratalake.llm.common import WORD

BLANK = r"[\x20\x09-\x0D]+"

WORDS = f"""
word as (
  select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as place, len(ws) as n
  from (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as ws from documents)
)"""


def windows(words: int) -> str:
    """Every whole window of a text, by its first word's place."""
    return f"""
win as (
  select * from (
    select doc_id, place, n, string_agg(word, ' ') over (
      partition by doc_id order by place rows between current row and {words - 1} following) as txt
    from word) where place <= n - {words - 1}
)"""


ORACLES = {}

ORACLES["op1_substring_dedup"] = f"""
with {WORDS}, {windows(substring.WINDOW)},
again as (select txt from win group by txt having count(*) > 1),
gone as (
  select distinct doc_id, place + k as place
  from win join again using (txt), range({substring.WINDOW}) as t(k)
), judged as (
  select w.*, g.place is not null as is_gone from word w left join gone g using (doc_id, place)
), kept as (
  select doc_id, count(*) as n_words, count(*) filter (where is_gone) as n_removed,
    string_agg(word, ' ' order by place) filter (where not is_gone) as txt
  from judged group by doc_id
)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(txt, '')) as kept_sha256
from documents d left join kept k using (doc_id)
"""

ORACLES["op3_line_quality"] = f"""
with {WORDS}, {windows(line_quality.REPEAT_WINDOW)},
again as (select doc_id, txt from win group by doc_id, txt having count(*) > 1),
twice as (
  select doc_id, count(distinct place + k) as n_repeat_words
  from win join again using (doc_id, txt), range({line_quality.REPEAT_WINDOW}) as t(k)
  group by doc_id
), line as (
  select doc_id, coalesce(source, '') as host, text, unnest(string_split(text, chr(10))) as line
  from documents where text is not null
), normal as (
  select *, trim(regexp_replace(lower(line), '{BLANK}', ' ', 'g')) as norm from line
), held as (
  select *, length(norm) - length(replace(norm, ' ', '')) + 1 as w from normal where norm <> ''
), hosts as (
  select coalesce(source, '') as host, sqrt(count(*)) as root from documents group by 1
), frequent as (
  select host, norm from (
    select host, norm, count(distinct doc_id) as n from held group by host, norm)
  join hosts using (host) where n > {line_quality.MIN_DOCUMENTS} and n > root
), lost as (
  select doc_id, sum(w) as lost from held join frequent using (host, norm) group by doc_id
), lines as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines from held group by doc_id
), counted as (select doc_id, any_value(n) as n from word group by doc_id
), measured as (
  select d.doc_id, coalesce(c.n, 0) as n_words,
    length(regexp_replace(coalesce(text, ''), '{BLANK}', '', 'g')) as word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    coalesce(cast(lost as bigint), 0) as n_removed_words
  from documents d left join counted c using (doc_id) left join twice using (doc_id)
    left join lines using (doc_id) left join lost using (doc_id)
), failed as (
  select *, n_words < {line_quality.MIN_WORDS}
    or 100 * n_repeat_words > {line_quality.REPEAT_PERCENT} * n_words as base_failed from measured
)
select *, not base_failed and not (
  n_words - n_removed_words < n_words * {line_quality.LEAST_LEFT}) as kept from failed
"""

ORACLES["op6_line_spread"] = f"""
with split as (
  select doc_id, source, string_split(text, chr(10)) as lines from documents where text is not null
), line as (
  select doc_id, source, unnest(lines) as line, generate_subscripts(lines, 1) as place from split
), normal as (
  select *, trim(regexp_replace(lower(line), '{BLANK}', ' ', 'g')) as norm from line
), bad as (
  select norm from normal where norm <> '' group by norm
  having count(distinct source) >= {line_spread.MIN_SITES}
), marked as (
  select n.*, b.norm is not null as gone from normal n left join bad b on n.norm = b.norm
), kept as (
  select doc_id, count(*) filter (where gone) as n_removed,
    coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '') as text
  from marked group by doc_id
)
select d.doc_id, coalesce(k.n_removed, 0) as n_removed_lines,
  length(coalesce(k.text, '')) as n_kept_chars, sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join kept k using (doc_id)
"""

ORACLES["op9_embedding_dedup"] = f"""
with recursive vec as (
  select vec_id, cast(embedding as double[]) as v from embeddings
), link as (
  select a.vec_id as a, b.vec_id as b from vec a join vec b
    on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= {cells.LEAST_COSINE}
), reach(a, b) as (
  select vec_id, vec_id from vec union select r.a, l.b from reach r join link l on r.b = l.a
), least as (select a as vec_id, min(b) as component_id from reach group by a
), counted as (select a as vec_id, count(*) as n from link group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from least left join counted using (vec_id)
"""


def _assigned(number: int) -> str:
    """The nearest of centroids ``number`` to each vector."""
    return f"""
near{number} as (
  select place, vec_id, x, cluster, distance from (
    select *, row_number() over (partition by place order by distance, cluster) as nth from (
      select v.place, v.vec_id, v.x, c.cluster, list_sum(list_transform(
        range(1, {centroids.DIMENSIONS + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])
        )) as distance
      from vec v, centroid{number} c))
  where nth = 1
)"""


def _moved(number: int) -> str:
    """Centroids ``number`` from the vectors assigned before."""
    return f"""{_assigned(number - 1)},
total{number} as (
  select cluster, i, sum(x[i]) as s, count(*) as n
  from near{number - 1}, range(1, {centroids.DIMENSIONS + 1}) as t(i) group by cluster, i
), mean{number} as (
  select cluster, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as x
  from total{number} group by cluster
), centroid{number} as (
  select cluster, coalesce(m.x, c.x) as x
  from centroid{number - 1} c left join mean{number} m using (cluster)
)"""


ORACLES["op13_centroid_clustering"] = f"""
with vec as (
  select row_number() over () as place, vec_id, list_transform(embedding, lambda c:
    cast(floor({centroids.SCALE} * cast(c as double)) as bigint)) as x
  from embeddings
  where len(embedding) = {centroids.DIMENSIONS} and len(list_filter(embedding, lambda c:
    c is not null and isfinite(c))) = {centroids.DIMENSIONS}
), centroid0 as (
  select row_number() over (order by hash, x) - 1 as cluster, x
  from (select sha256('1:' || vec_id) as hash, x from vec order by hash, x limit {centroids.CLUSTERS})
), {",".join(_moved(number) for number in range(1, centroids.ROUNDS + 1))},
{_assigned(centroids.ROUNDS)}, inertias as (
  select cluster, sum(distance) as cluster_inertia from near{centroids.ROUNDS} group by cluster
)
select vec_id, cast(cluster as integer) as cluster, cast(distance as bigint) as distance,
  cast(cluster_inertia as bigint) as cluster_inertia,
  cast((select sum(distance) from near{centroids.ROUNDS}) as bigint) as inertia,
  sha256(array_to_string(c.x, ',')) as centroid_sha256
from near{centroids.ROUNDS} join inertias using (cluster)
  join centroid{centroids.ROUNDS} c using (cluster)
"""

"""DuckDB statements for the registered queries that SQL can express."""

OP8 = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         coalesce(('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint, 0) as place
  from documents),
totals as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rank,
         count(*) over () as n, sum(sum(size)) over ()::bigint as total
  from sized group by source),
weighted as (select *, 1 + rank % 3 as weight, 3 * source_size as most from totals),
level as (
  select *, most * sum(weight) over later <= (total - coalesce(sum(most) over earlier, 0))::double * weight as is_full
  from weighted
  window earlier as (order by most / weight, rank rows between unbounded preceding and 1 preceding),
         later as (order by most / weight, rank rows between current row and unbounded following)),
targets as (
  select source, source_size,
         case when is_full then most::double
              else (total - coalesce(sum(most) filter (is_full) over (), 0))::double * weight
                   / (sum(weight) filter (not is_full) over ())::double end as target,
         case when n > 1 then 0.5::double * (2.0::double * rank / (n - 1)::double - 1.0::double) else 0.0::double end as drift
  from level),
placed as (
  select s.doc_id, s.size, s.source, t.source_size, t.target, floor(t.target)::bigint as demand, t.drift,
         (coalesce(sum(s.size) over (partition by s.source order by place, s.doc_id, s.size
                   rows between unbounded preceding and 1 preceding), 0))::bigint as before
  from sized s join targets t on s.source is not distinct from t.source),
passed as (
  select *, case when source_size > 0 then demand // source_size else 0 end as whole from placed),
rested as (
  select *, greatest(0, least(size, demand - whole * source_size - before)) as last from passed),
timed as (
  select *, whole * size + last as taken,
         least((before + (case when whole > 0 then size else last end) / 2.0::double) / demand, 1.0::double) as u from rested)
select doc_id, size, source, source_size, target, taken::bigint as taken,
       (whole + (2 * last >= greatest(size, 1))::bigint)::bigint as passes,
       case when taken > 0 then 2.0::double * u / ((1.0::double - drift)
            + sqrt((1.0::double - drift) * (1.0::double - drift) + 4.0::double * drift * u)) end as position,
       demand, drift
from timed
"""

VECTORS = """
with vectors as (
  select vec_id, {label} as label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as vec
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)"""

OP1 = VECTORS.format(label="label", scale=64) + """,
scored as (
  select q.vec_id as query_id, v.vec_id, list_dot_product(q.vec::double[], v.vec::double[])::bigint as score
  from vectors q join vectors v on q.vec_id <> v.vec_id where q.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

OP12 = VECTORS.format(label="case when vec_id % 7 = 0 then (label + 1) % 10 else label end", scale=256) + """,
scored as (
  select a.vec_id as anchor_id, v.vec_id, v.label = a.label as same,
         list_dot_product(a.vec::double[], v.vec::double[])::bigint as score
  from vectors a join vectors v on a.vec_id <> v.vec_id
  where a.vec_id % 100 = 0 and a.label is not null and v.label is not null),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
ranked as (
  select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank
  from positives join scored using (anchor_id)
  where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 5
"""


def _assigned(books: str) -> str:
    """Every part with its nearest entry: the least (distance, index)."""
    return f"""
  select vec_id, label, part, cell, min(struct_pack(d := list_sum(list_transform(list_zip(cell, book),
         lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, entry := entry)) as best
  from cells join {books} using (part) group by vec_id, label, part, cell"""


def _round(k: int) -> str:
    """Codebooks after one more round: floored means by component, unused entries as they were."""
    return f""",
assigned{k} as ({_assigned(f"books{k - 1}")}),
moved{k} as (
  select part, entry, list(mean order by place) as book
  from (select part, best.entry as entry, place, floor(sum(cell[place])::hugeint::double / count(*))::bigint as mean
        from assigned{k}, generate_series(1, (select max(len(cell)) from cells)) as s(place) group by all)
  group by part, entry),
books{k} as (
  select part, entry, coalesce(m.book, b.book) as book from books{k - 1} b left join moved{k} m using (part, entry))"""


OP13 = VECTORS.format(label="label", scale=1024) + """,
cells as (
  select vec_id, label, part, vec[part * (len(vec) // 4) + 1: (part + 1) * (len(vec) // 4)] as cell
  from vectors, generate_series(0, 3) as s(part)),
books0 as (
  select part, row_number() over (partition by part order by vec_id) - 1 as entry, cell as book
  from cells where vec_id in (select vec_id from vectors order by vec_id limit 256))""" + "".join(map(_round, range(1, 5))) + f""",
coded as ({_assigned("books4")}),
rows as (
  select vec_id, label, string_agg(printf('%02x', best.entry), '' order by part) as code, sum(best.d)::bigint as error
  from coded group by vec_id, label),
digest as (
  select sha256(string_agg(array_to_string(book, ','), ',' order by part, entry)) as codebooks_sha256 from books4)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from rows, digest
"""

#: Smallest id that each node of ``links`` (a, b, both ways) reaches, by breadth; ``nodes`` has every id.
REACHED = """
reached(node, seen) as (
  select node, node from nodes
  union
  select r.node, l.b from reached r join links l on r.seen = l.a),
component as (select node, min(seen) as component_id from reached group by node)"""

OP2 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) >= 4 then list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i: i + 3], ' ')))
                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words),
items as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
links as (
  select x.doc_id as a, y.doc_id as b from items x join items y on x.shingle = y.shingle and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))),
nodes as (select doc_id as node from documents),""" + REACHED + """
select doc_id, len(s)::bigint as n_shingles, component_id from sets join component on node = doc_id
"""

OP7 = """
with recursive sound as (
  select vec_id, label, embedding::double[] as vec from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select x.vec_id as a, y.vec_id as b from sound x join sound y on x.label = y.label and x.vec_id <> y.vec_id
  where list_cosine_similarity(x.vec, y.vec) >= 0.93::double),
nodes as (select vec_id as node from embeddings),""" + REACHED + """
select node as vec_id, (select count(*) from links where a = node)::bigint as n_links, component_id, component_id = node as kept
from component
"""

LLM_ORACLE: dict[str, str] = {"op1_topk_search": OP1, "op2_ngram_jaccard": OP2, "op7_embedding_near_dedup": OP7,
                              "op8_source_mix": OP8, "op12_hard_negatives": OP12, "op13_vector_codes": OP13}

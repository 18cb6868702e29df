"""SQL (DuckDB) that gives the rows of the queries that SQL can express."""

# Lengths of what the chat template adds and of its escapes, written out independently.
_OP7 = """
with messages as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as body from conversations
  union all
  select * from (values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), sized as (
  select *, length(replace(replace(replace(replace(replace(replace(body,
      '~', '~0'), '<|', '~1'), '[INST]', '~2'), '[/INST]', '~3'), '<s>', '~4'), '</s>', '~5')) as inside,
    length(replace(replace(replace(replace(replace(replace(replace(role,
      '~', '~0'), '<|', '~1'), '[INST]', '~2'), '[/INST]', '~3'), '<s>', '~4'), '</s>', '~5'), chr(10), '~6')) as head
  from messages
)
select conv_id,
  count(*) as n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' order by turn)) as turns_sha256,
  coalesce(sum(length(body)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(body, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  sum(8 + head + 1 + inside + 7)::bigint as formatted_chars,
  0::bigint as n_attachments,
  0::bigint as expanded_tokens
from sized group by conv_id
"""

_OP5 = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as weights
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, v.vec_id,
    coalesce(list_sum(list_transform(range(1, least(len(q.weights), len(v.weights)) + 1),
      lambda i: q.weights[i] * v.weights[i])), 0)::bigint as score
  from vectors q, vectors v where q.vec_id % 20 = 0 and v.vec_id <> q.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

_OP10 = """
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s
  from words
), shingles as (
  select doc_id, len(s) as n, unnest(s) as shingle from sets
), pairs as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as shared
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
    and 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  group by all
), links as (
  select a, b from pairs where 100 * shared >= 90 * (n + m - shared)
), edges as (
  select a, b from links union select b, a from links
), reach(a, b) as (
  select doc_id, doc_id from documents
  union
  select reach.a, edges.b from reach join edges on reach.b = edges.a
)
select s.doc_id, len(s.s)::bigint as n_shingles, r.component_id
from sets s join (select a, min(b) as component_id from reach group by a) r on r.a = s.doc_id
"""

_OP11 = """
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents
), said as (
  select d, lang, source, unnest(terms) as term from docs
), kept as (
  select lang, term, count(*)::hugeint as n from said group by all having count(distinct d) >= 3
), langs as (
  select lang, count(*)::hugeint as v, sum(n)::hugeint as total from kept group by all
), pairs as (
  select distinct lang, source from docs
), counts as (
  select said.lang, source, term, count(*)::hugeint as n from said join kept using (lang, term) group by all
), totals as (
  select pairs.lang, pairs.source, coalesce(any_value(v), 0)::hugeint as v, coalesce(sum(counts.n), 0)::hugeint as total
  from pairs left join langs on langs.lang = pairs.lang
    left join counts on counts.lang = pairs.lang and counts.source = pairs.source
  group by all
), shares as (
  select totals.lang, totals.source, kept.term, coalesce(counts.n, 0) as n,
    1 + 1000000000 * (coalesce(counts.n, 0) + 1) // (totals.total + totals.v) as p,
    1 + 1000000000 * (kept.n + 1) // (langs.total + langs.v) as q
  from totals join kept on kept.lang = totals.lang join langs on langs.lang = totals.lang
    left join counts on counts.lang = totals.lang and counts.source = totals.source and counts.term = kept.term
), matched as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), answers as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from pairs a join pairs b on a.lang = b.lang and a.source <> b.source
    left join matched on matched.lang = a.lang and matched.source = a.source and matched.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from shares where n > 0 and p > q
)
select lang, source, part, item, value,
  row_number() over (partition by lang, source, part order by value desc, item)::integer as rank
from answers qualify part = 'pair' or rank <= 200
"""

_OP13 = """
with vectors as (
  select vec_id::bigint as vec_id,
    case when vec_id % 7 = 0 then ((label::bigint + 1) % 10 + 10) % 10 else label::bigint end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same,
    coalesce(list_sum(list_transform(range(1, least(len(a.w), len(v.w)) + 1), lambda i: a.w[i] * v.w[i])), 0)::bigint as score
  from vectors a, vectors v where a.vec_id % 50 = 0 and v.vec_id <> a.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score,
    row_number() over (partition by anchor_id order by score desc, vec_id)::integer as positive_rank
  from scored where same qualify positive_rank <= 5
)
select p.anchor_id, positive_id, positive_rank, positive_score, s.vec_id as negative_id, s.score as negative_score,
  row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::integer as rank
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
  and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
qualify rank <= 3
"""

ORACLES = {
    "op5_topk_search": _OP5,
    "op7_chat_formatting": _OP7,
    "op10_jaccard_join": _OP10,
    "op11_source_divergence": _OP11,
    "op13_hard_negatives": _OP13,
}

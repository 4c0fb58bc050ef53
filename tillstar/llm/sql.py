"""The same results in DuckDB's SQL, where it can express the operator."""

from __future__ import annotations

from tillstar.llm import divergence, line_dedup, mixing, search, secret_scan, url_filter, vector_codes


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_scan() -> str:
    parts = []
    for k, rule in enumerate(secret_scan.RULES):
        pattern = _quoted(rule.pattern)
        parts.append(f"""
select rid, {k} as k, {_quoted(rule.kind)} as kind, s0, s0 + length(m[i]) as s1
from (select rid, m, g, i,
  coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)
  + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as s0
 from (select rid, regexp_extract_all(t, {pattern}, 0) as m,
   regexp_extract_all(t, {pattern}, {rule.group}) as g,
   regexp_split_to_array(t, {pattern}) as p,
   unnest(range(1, len(regexp_extract_all(t, {pattern}, 0)) + 1)) as i
  from d where regexp_matches(t, {pattern})))
where length(g[i]) >= {rule.least}""")
    kinds = len(secret_scan.BASE_RULES)
    counts = ", ".join(
        f"cast(count(*) filter (k = {k}) as bigint) as n_{r.kind}"
        for k, r in enumerate(secret_scan.BASE_RULES))
    one = "kind || ':' || cast(s0 as bigint) || ':' || cast(s1 as bigint)"
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
s as ({" union all ".join(parts)})
select any_value(d.doc_id) as doc_id, {counts},
 sha256(coalesce(string_agg({one}, ',' order by s0, k) filter (k < {kinds}), '')) as base_sha256,
 coalesce(string_agg({one}, ',' order by s0, k), '') as spans
from d left join s using (rid) group by d.rid"""


def _mixing() -> str:
    repeats, block, seed = mixing.MOST_REPEATS, mixing.BLOCK_WORDS, mixing.SEED
    per = mixing.ROWS_PER_BUCKET

    def apportion(parties: str, group: str, party: str) -> str:
        by = f"partition by {group}" if group else ""
        keys = f"{group}, {party}" if group else party
        return f"""
(select {keys}, max(base) + sum(case when ok and place <= open then 1 else 0 end) as seats from (
 select *, sum(ok::int) over ({by} order by votes / (2 * k + 1) desc, {party}) as place from (
  select *, k < most and votes > 0 as ok from (
   select *, unnest(range(base::bigint, (whole + margin + 1)::bigint)) as k from (
    select *, total - sum(base) over ({by}) as open from (
     select *, least(most, greatest(0, whole - margin)) as base from (
      select *, floor(share * total) as whole, ceil(share * parties / 2) + 1 as margin from (
       select *, coalesce(votes::double / nullif(sum(votes) over ({by}), 0), 0.0) as share,
        count(*) over ({by}) as parties from {parties}))))))) group by {keys})"""

    return f"""
with rows as (select doc_id, source, cast(len(list_filter(regexp_split_to_array(
   coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) as bigint) as size,
  md5('{seed}/' || coalesce(cast(doc_id as varchar), 'none')) as o from documents),
sources as (select source, count(*) as n, sum(size)::bigint as source_size,
  row_number() over (order by source nulls last) as r from rows group by source),
capped as (select *, (r - 1) % 3 + 1 as w, source_size * {repeats} as cap from sources),
levels as (select *, (sum(source_size) over () - coalesce(sum(cap) over before, 0))::double
   / (sum(w) over () - coalesce(sum(w) over before, 0))::double as level from capped
  window before as (order by cap / w, r rows between unbounded preceding and 1 preceding)),
targets as (select source, r, n, source_size, least(cap::double,
   (select level from levels where cap / w >= level order by cap / w, r limit 1) * w) as target
  from levels),
placed as (select p.doc_id, p.size, p.o, t.r, t.source_size, t.target,
   ('0x' || substr(o, 25, 8))::bigint % ceil(t.n / {per})::bigint as shard
  from rows p join targets t on p.source is not distinct from t.source),
sizes as (select r, shard, sum(size)::bigint as shard_size from placed group by r, shard),
of_source as (select * from {apportion(f'''(select r, target as votes,
   floor(source_size * {repeats} / {block}) as most,
   floor((select sum(source_size) from targets) / {block}) as total from targets)''', '', 'r')}),
quotas as (select q.*, z.shard_size from {apportion(f'''(select r, shard, shard_size as votes,
   floor(shard_size * {repeats} / {block}) as most, seats as total
   from sizes join of_source using (r))''', 'r', 'shard')} q join sizes z using (r, shard)),
laid as (select p.*, q.seats * {block} as words, q.shard_size,
   coalesce(sum(size) over (partition by r, shard order by o, p.doc_id, size
    rows between unbounded preceding and 1 preceding), 0) as before
  from placed p join quotas q using (r, shard)),
lapped as (select *, coalesce(floor(words / nullif(shard_size, 0)), 0) as laps from laid)
select doc_id, size, source_size, target, cast(laps * size + greatest(0, least(
 words - laps * shard_size - before, size)) as bigint) as taken from lapped"""


_URLS = rf"""
with hosts as (select page_id, url, nullif(regexp_replace(regexp_extract(lower(url),
   '{url_filter.HOST}', 1), '\.+$', ''), '') as host from pages),
captures as (select page_id, host, timestamp '2024-01-01 00:00:00'
   + to_minutes(page_id * 7919 % 525600) as fetched_at from hosts),
entries as (select regexp_replace(host, '^(www|m|blog)\.', '') as domain,
   ['ads', 'spam', 'malware'][page_id % 3 + 1] as category, page_id % 4 <> 0 as listed,
   date '2024-01-01' + cast(page_id * 37 % 366 as int) as day
  from hosts where page_id % 7 = 0 and host is not null),
by_day as (select domain, day, min(listed) as listed,
   min(category) filter (listed) as on_category from entries group by domain, day),
spells as (select * from (select domain, on_category as category, listed, day as valid_from,
   lead(day) over (partition by domain order by day) as valid_to from by_day) where listed),
hits as (select c.page_id, s.*, row_number() over (
   partition by c.page_id order by length(s.domain) desc) as place
  from captures c join spells s
   on (c.host = s.domain or (ends_with(c.host, '.' || s.domain)
   and not regexp_matches(c.host, '{url_filter.ADDRESS}'))) and c.fetched_at >= s.valid_from
   and (s.valid_to is null or c.fetched_at < s.valid_to))
select c.page_id, c.host, c.fetched_at, case when c.host is null then 'invalid'
  when h.domain is not null then 'block' else 'allow' end as verdict,
 h.domain, h.category, cast(h.valid_from as varchar) as valid_from
from captures c left join hits h on c.page_id = h.page_id and h.place = 1"""


def _search() -> str:
    k1, b, digits = search.K1, search.B, search.DIGITS
    return f"""
with d as (select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(
   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words from documents),
n as (select count(*) as n, avg(len(words)) as mean from d),
tf as (select rid, doc_id, term, count(*) as tf, any_value(size) as size from (
   select rid, doc_id, len(words) as size, unnest(words) as term from d) group by all),
df as (select term, count(*) as df, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5))
   as idf from tf, n group by term),
asked as (select distinct doc_id as query_id, term from tf where doc_id % {search.EVERY} = 0),
scored as (select query_id, rid, any_value(doc_id) as doc_id, round(sum(
    idf * tf * {k1 + 1} / (tf + {k1} * (1 - {b} + {b} * size / mean))), {digits}) as score
  from asked join tf using (term) join df using (term), n group by query_id, rid),
ranked as (select query_id, row_number() over (partition by query_id
   order by score desc, doc_id nulls last) as rank, doc_id, score from scored)
select query_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= {search.TOP_K}"""


_LINES = rf"""
with d as (select row_number() over () as rid, doc_id, text, string_split(text, chr(10)) as l
  from documents where text <> ''),
x as (select *, row_number() over (partition by rid order by k) as n from (select rid, doc_id, k,
   line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words from (
    select rid, doc_id, unnest(l) as line, unnest(range(1, len(l) + 1)) as k from d))
  where words > 0),
c as (select *, sum(words) over (partition by rid order by n) as upto from x),
ends as (select a.rid, a.n, min(z.n) as m from c a join c z on a.rid = z.rid
  and z.n between a.n and a.n + {line_dedup.RUN_WORDS - 1}
  and z.upto - a.upto + a.words >= {line_dedup.RUN_WORDS} group by all),
begins as (select z.rid, max(a.n) as n, z.n as m from c a join c z on a.rid = z.rid
  and z.n between a.n and a.n + {line_dedup.RUN_WORDS - 1}
  and z.upto - a.upto + a.words >= {line_dedup.RUN_WORDS} group by z.rid, z.n),
w as (select s.rid, any_value(c.doc_id) as doc_id, min(c.k) as k, max(c.k) as last,
  string_agg(c.line, chr(10) order by c.n) as part
 from (select * from ends union select * from begins) s join c on c.rid = s.rid
  and c.n between s.n and s.m group by s.rid, s.n, s.m),
later as (select rid, k, last from (select *, row_number() over (
  partition by part order by doc_id nulls first, k) as place from w) where place > 1),
gone as (select rid, list(distinct line) as lines from (select rid,
  unnest(range(k, last + 1)) as line from later) group by rid)
select x.doc_id, cast(case when coalesce(x.text, '') = '' then 0
   else len(string_split(x.text, chr(10))) end as bigint) as n_lines,
 cast(coalesce(len(g.lines), 0) as bigint) as n_deleted,
 md5(case when g.lines is null then coalesce(x.text, '') else coalesce(array_to_string(
  list_filter(d.l, lambda v, k: not list_contains(g.lines, k)), chr(10)), '') end) as text_md5
from documents x left join d on x.doc_id is not distinct from d.doc_id
 and x.text is not distinct from d.text left join gone g using (rid)"""


def _divergence() -> str:
    a, whole = divergence.SMOOTHING, divergence.WHOLE
    share = lambda n, size: (
        f"cast(1 + ({whole}::hugeint * ({n} + {a})) // ({size}) as bigint)")
    return f"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang,
  coalesce(source, '') as source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') as t from documents),
w as (select rid, lang, source, unnest(regexp_extract_all(
  t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
c as (select lang, source, term, count(*) as n, count(distinct rid) as docs from w group by all),
kept as (select lang, term, sum(n)::bigint as total from c group by all
 having sum(docs) >= {divergence.LEAST_DOCUMENTS}),
g as (select distinct lang, source from d),
sized as (select lang, count(*) as v, sum(total)::bigint as n from kept group by lang),
dense as (select lang, source, term, coalesce(n, 0) as n, total
 from g join kept using (lang) left join c using (lang, source, term)),
p as (select dense.*, sum(dense.n) over (partition by lang, source) + {a} * v as size,
  sized.n + {a} * v as lang_size from dense join sized using (lang)),
q as (select lang, source, term, n, {share("n", "size")} as p,
  {share("total", "lang_size")} as q from p),
apart as (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p))::bigint as value
 from q x join q y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all),
pairs as (select x.lang, x.source, y.source as item, coalesce(value, 0) as value
 from g x join g y on x.lang = y.lang and x.source <> y.source
 left join apart z on x.lang = z.lang and x.source = z.source and y.source = z.item),
parts as (select lang, source, 'pair' as part, item, value from pairs
 union all select lang, source, 'term', term, p - q from q where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part
  order by value desc, encode(item)) as rank from parts)
select lang, source, part, item, value, cast(rank as int) as rank
from ranked where part = 'pair' or rank <= {divergence.TOP_TERMS}"""


def _vector_codes() -> str:
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    limit = f"{vector_codes.LARGEST}"
    steps = [f"""
with v as (select row_number() over () as rid, vec_id, label, list_transform(embedding, lambda x:
  floor(greatest(-{limit}, least({limit}, x::double * {vector_codes.SCALE})))::bigint) as ints
 from embeddings where embedding is not null
 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
wide as (select coalesce(ceil(max(len(ints)) / {parts})::bigint, 0) as width from v),
x as (select rid, p.part, list_resize(ints, {parts} * width, 0)
   [p.part * width + 1:(p.part + 1) * width] as c
  from v, wide, (select unnest(range({parts})) as part) p),
b0 as (select part, place - 1 as entry, c from x join (select rid, row_number() over (
   order by vec_id nulls last, ints) as place from v) using (rid) where place <= {entries})"""]

    def assigned(k: int) -> str:
        return f"""
a{k} as materialized (select rid, part, (least_of).entry as entry, (least_of).d as d from (
 select rid, x.part, min({{'d': coalesce(list_sum(list_transform(list_zip(x.c, b.c),
  lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0)::bigint, 'entry': entry}}) as least_of
 from x join b{k} b on x.part = b.part group by rid, x.part))"""

    for k in range(vector_codes.ROUNDS):
        steps.append(assigned(k))
        steps.append(f"""
m{k} as (select part, entry, list(value order by place) as c from (
 select part, entry, place, floor(sum(value) / count(*))::bigint as value from (
  select a.part, a.entry, unnest(x.c) as value, unnest(range(len(x.c))) as place
  from a{k} a join x using (rid, part)) group by all) group by all),
b{k + 1} as materialized (select part, entry, coalesce(m.c, b.c) as c
 from b{k} b left join m{k} m using (part, entry))""")
    last = vector_codes.ROUNDS
    steps.append(assigned(last))
    steps.append(f"""
digest as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as sha
 from b{last}),
coded as (select rid, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' order by part) as code,
  sum(d)::bigint as error from a{last} group by rid)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
 sha as codebooks_sha256 from v join coded using (rid), digest""")
    return ",".join(steps)


SQL = {
    "op1_secret_scan": _secret_scan(),
    "op5_mixing": _mixing(),
    "op7_url_filter": _URLS,
    "op8_search": _search(),
    "op10_line_dedup": _LINES,
    "op12_source_divergence": _divergence(),
    "op13_vector_codes": _vector_codes(),
}

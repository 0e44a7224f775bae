"""The operators' results restated for DuckDB."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def url_filter_sql() -> str:
    after = "case when instr({0}, '://') > 0 then substr({0}, instr({0}, '://') + 3) else '' end"

    def parts(url: str) -> str:
        a = after.format(url)
        host = LOWER.format(f"regexp_extract({a}, '^([^/?#]*)', 1)")
        return f"coalesce({host}, '') as host, coalesce(regexp_extract({a}, '^[^/?#]*([^?#]*)', 1), '') as path, regexp_extract({a}, '^[^?#]*(\\?[^#]*)', 1) as query"

    fits = "(s.host = r.rhost or ends_with(s.host, '.' || r.rhost)) and starts_with(s.path, r.rpath)"
    return f"""
with recursive rules(verdict, rhost, rpath) as (values ('allow','com','/'), ('block','example.com','/en/'),
  ('allow','www.example.com','/en/'), ('block','net','/es/'), ('block','net','/fr/')),
p as (select row_number() over () as rid, page_id, html, {parts("url")} from pages),
n as (select *, case when host <> '' then host || path || query end as node from p),
bare as (select node, host, path, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>', '', 'g') as b from n where node is not null),
tags as (select node, host, path, unnest(regexp_extract_all(b, '(?is)<(?:link|meta)\\b[^>]*>')) as tag from bare),
t1 as (select node, host, path, case
   when lower(regexp_extract(tag, '(?is)\\srel\\s*=\\s*["'']?([^"''\\s>]*)', 1)) = 'canonical' then regexp_extract(tag, '(?is)\\shref\\s*=\\s*["'']?([^"''\\s>]*)', 1)
   when lower(regexp_extract(tag, '(?is)\\shttp-equiv\\s*=\\s*["'']?([^"''\\s>]*)', 1)) = 'refresh' then regexp_extract(tag, '(?is)url\\s*=\\s*[''"]?([^''">]*)', 1) end as target from tags),
t1b as (select node, host, path, trim(replace(target, '&amp;', '&')) as target, regexp_extract(replace(target, '&amp;', '&'), '^ *([^?#]*)', 1) as own,
   coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') as folder from t1),
t1c as (select *, string_split(folder || own, '/') as steps from t1b where target <> ''),
t1d as (select *, list_reduce(list_concat([''], steps[2:]), lambda a, x: case when x = '..' then regexp_replace(a, '/[^/]*$', '') when x = '.' then a else a || '/' || x end)
   || case when steps[-1] in ('.', '..') then '/' else '' end as walked from t1c),
t2 as (select node, case when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') then target when starts_with(target, '//') then 'x:' || target
   when starts_with(target, '/') then 'x://' || host || target
   when not regexp_matches(target, '^(#|[A-Za-z][A-Za-z0-9+.-]*:)') then 'x://' || host || case when starts_with(target, '?') then path else walked end || substr(target, length(own) + 1)
   end as u from t1d),
e0 as (select node as src, {parts("u")} from t2),
e as (select distinct src, host || path || query as dst from e0 where host <> '' and host || path || query <> src),
sym as (select src as a, dst as b from e union select dst, src from e),
reach(a, b) as (select a, a from sym union select r.a, s.b from reach r join sym s on r.b = s.a),
s as (select distinct reach.a as node, reach.b as other, {parts("('x://' || reach.b)")} from reach),
grp as (select node, max(case when verdict = 'allow' then 1 else 0 end) as al, max(case when verdict = 'block' then 1 else 0 end) as bl, min(other) as component
  from (select s.node, s.other, arg_max(r.verdict, length(r.rhost || r.rpath)) as verdict from s left join rules r on {fits} group by s.node, s.other) g group by node),
own as (select s.rid, s.page_id, s.host, s.path, s.node, arg_max(r.rhost || r.rpath, length(r.rhost || r.rpath)) as rule, arg_max(r.verdict, length(r.rhost || r.rpath)) as verdict
  from n s left join rules r on {fits} group by all)
select own.page_id, own.host, own.path, own.rule,
  coalesce(own.verdict, case when grp.bl = 1 and grp.al = 0 then 'block' else 'allow' end) as verdict, grp.component
from own left join grp on own.node = grp.node"""


def decontamination_sql(size: int = 10) -> str:
    words = "list_filter(regexp_split_to_array(" + LOWER.format("coalesce({0}, '')") + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    return f"""
with d as (select doc_id, {words.format("text")} as dw from documents),
i as (select item_id, {words.format("text")} as iw from benchmark where item_id is not null),
i1 as (select *, least(len(iw), {size}) as n from i where len(iw) > 0),
w as (select distinct item_id, n, list_slice(iw, k, k + n - 1) as win
      from (select *, unnest(generate_series(1, len(iw) - n + 1)) as k from i1)),
lens as (select distinct n from w),
p as (select doc_id, n, k, list_slice(dw, k, k + n - 1) as win
      from (select doc_id, dw, n, unnest(generate_series(1, len(dw) - n + 1)) as k from d, lens where len(dw) >= n)),
h as (select p.doc_id, p.k, p.n, w.item_id from p join w on p.n = w.n and p.win = w.win),
pos as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(generate_series(k, k + n - 1)) as q from h) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
       from (select distinct doc_id, cast(item_id as varchar) as item from h) group by doc_id)
select d.doc_id, cast(len(dw) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from d left join pos on d.doc_id = pos.doc_id left join it on d.doc_id = it.doc_id"""


def mixing_sql(docs: str = "documents") -> str:
    domain = """case when not regexp_full_match(leaf_source, 'src[0-9]{1,9}') then 'other'
      else case cast(substr(leaf_source, 4) as integer) % 3 when 0 then 'web' when 1 then 'books' else 'code' end end"""
    h = "cast('0x' || substr(md5('mix-1:' || cast(s.full_epochs + 1 as varchar) || ':' || coalesce(cast(t.doc_id as varchar), '')), 1, 15) as bigint)"

    def fill(src: str, parent: str, name: str) -> str:
        order = f"partition by {parent} order by cap / cast(w as double), {name}"
        return f"""(select *, case when lv_w is null then cap else least(cap, cast((cast(budget - lv_c as hugeint) * w) // lv_w as bigint)) end as share
   from (select *, first_value(case when reaches then c0 end ignore nulls) over (partition by {parent} order by cap / cast(w as double), {name} rows between unbounded preceding and unbounded following) as lv_c,
      first_value(case when reaches then w0 end ignore nulls) over (partition by {parent} order by cap / cast(w as double), {name} rows between unbounded preceding and unbounded following) as lv_w
    from (select *, cast(c0 as hugeint) * w + cast(cap as hugeint) * w0 >= cast(budget as hugeint) * w as reaches
      from (select *, coalesce(sum(cap) over ({order} rows between unbounded preceding and 1 preceding), 0) as c0,
        sum(w) over ({order} rows between current row and unbounded following) as w0 from {src}))))"""

    return f"""
with t0 as (select doc_id, coalesce(lang, 'unknown') as language, coalesce(source, 'unknown') as leaf_source,
   cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '')) as bigint) as n_tokens from {docs}),
t as (select *, {domain} as domain from t0 where n_tokens > 0),
leaf as (select domain, language, leaf_source, sum(n_tokens)::bigint as tokens, (sum(n_tokens) * 2)::bigint as cap, 1 as w_s,
   case language when 'en' then 5 when 'de' then 2 when 'fr' then 2 else 1 end as w_l,
   case domain when 'web' then 5 when 'books' then 3 when 'code' then 2 else 1 end as w_d
   from t group by domain, language, leaf_source),
langs as (select domain, language, sum(cap)::bigint as cap, sum(tokens)::bigint as tokens, any_value(w_l) as w, any_value(w_d) as w_d from leaf group by domain, language),
doms as (select 0 as root, domain, sum(cap)::bigint as cap, any_value(w_d) as w, (select sum(tokens) from langs)::bigint // 2 as budget from langs group by domain),
ds as (select domain, share as budget from {fill("doms", "root", "domain")}),
lin as (select l.domain, l.language, l.cap, l.w, ds.budget from langs l join ds on l.domain = ds.domain),
ls as (select domain, language, share as budget from {fill("lin", "domain", "language")}),
sin as (select l.domain, l.language, l.leaf_source, l.tokens, l.cap, l.w_s as w, ls.budget from leaf l join ls on l.domain = ls.domain and l.language = ls.language),
s as (select domain, language, leaf_source, tokens, share, share // tokens as full_epochs, share % tokens as rest
   from {fill("sin", "domain, language", "leaf_source")} where share > 0),
r as (select t.*, s.share, s.full_epochs, s.rest, {h} as h, coalesce(cast(t.doc_id as varchar), '') as k from t join s on t.domain = s.domain and t.language = s.language and t.leaf_source = s.leaf_source),
c as (select *, sum(n_tokens) over (partition by domain, language, leaf_source order by h, k range between unbounded preceding and current row)
      - sum(n_tokens) over (partition by domain, language, leaf_source, h, k) as ahead from r),
ep as (select *, unnest(generate_series(1, 3)) as epoch from c)
select doc_id, domain, language, leaf_source as source, n_tokens, share, cast(epoch as integer) as epoch from ep
where epoch <= full_epochs or (epoch = full_epochs + 1 and ahead < rest)"""


def line_dedup_sql(long_words: int = 50) -> str:
    w = "(partition by rid order by i)"
    return f"""
with d as (select row_number() over () as rid, doc_id, text from documents),
l0 as (select rid, doc_id, unnest(string_split(text, chr(10))) as line, unnest(generate_series(1, len(string_split(text, chr(10))))) as i from d where text is not null),
l1 as (select *, cast('0x' || substr(md5(line), 1, 15) as bigint) % 2147483647 as h,
   len(list_filter(regexp_split_to_array(line, '[ \t-\r]+'), lambda x: x <> '')) >= {long_words} as big from l0),
l2 as (select *, (h * 1000003 + lead(h) over {w}) % 2147483647 as r from l1),
l3 as (select *, lag(r, 2) over {w} as r0, lag(r) over {w} as r1, lag(big) over {w} as pbig from l2),
l4 as (select *, case when i = 1 or big or pbig or coalesce(r0 > r1 and r1 < r, false) then 1 else 0 end as b from l3),
l5 as (select *, sum(b) over (partition by rid order by i rows unbounded preceding) as seq from l4),
c as (select rid, min(i) as a, max(i) as b from l5 group by rid, seq having count(*) > 1 or bool_or(big)),
w0 as (select rid, i, line, len(list_filter(regexp_split_to_array(line, '[ \t-\r]+'), lambda x: x <> '')) as n from l0),
w1 as (select *, sum(n) over (partition by rid order by i rows unbounded preceding) as upto from w0),
w2 as (select rid, i, upto - n + {long_words} as goal from w1),
r as (select w2.rid, w2.i as a, e.i as b from w2 asof join (select * from w1 where n > 0) e on w2.rid = e.rid and w2.goal <= e.upto),
u as (select * from c union select * from r),
t as (select u.rid, a, b, string_agg(line, chr(10) order by i) as piece from u join l0 on u.rid = l0.rid and i between a and b group by u.rid, a, b),
t1 as (select t.rid, a, b, row_number() over (partition by piece order by doc_id nulls first, t.rid, a) as nth from t join d on d.rid = t.rid),
g as (select distinct l0.rid, i from l0 join t1 on t1.rid = l0.rid and i between a and b where nth > 1),
o as (select l0.rid, string_agg(case when g.i is null then line end, chr(10) order by l0.i) as text, count(*) as n_lines, count(g.i) as lines_gone
   from l0 left join g on g.rid = l0.rid and g.i = l0.i group by l0.rid)
select d.doc_id, case when d.text is null then null else coalesce(o.text, '') end as text,
   cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(lines_gone, 0) as bigint) as lines_gone from d left join o on d.rid = o.rid"""


def jaccard_sql(words: int = 3, num: int = 90, den: int = 100) -> str:
    low = LOWER.format("coalesce(text, '')")
    return f"""
with recursive d as (select doc_id, list_filter(regexp_split_to_array({low}, '[ \t-\r]+'), lambda x: x <> '') as w from documents),
sh as (select distinct doc_id, s from (
  select doc_id, list_slice(w, k, k + {words} - 1) as s from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - {words} + 1, 1))) as k from d where len(w) > 0))),
n as (select doc_id, count(*) as n from sh group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as i from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
l as (select x, y, i = n1.n and i = n2.n as same from p join n n1 on n1.doc_id = x join n n2 on n2.doc_id = y where {den} * i >= {num} * (n1.n + n2.n - i)),
sym as (select x as a, y as b from l union select y, x from l),
reach(a, b) as (select doc_id, doc_id from d union select r.a, s.b from reach r join sym s on r.b = s.a),
c as (select a, min(b) as component from reach group by a),
eq as (select y, min(x) as first from l where same group by y)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.component as component_id,
       case when n.n > 0 then least(d.doc_id, coalesce(eq.first, d.doc_id)) end as set_id
from d left join n on n.doc_id = d.doc_id join c on c.a = d.doc_id left join eq on eq.y = d.doc_id"""


def embedding_sql(threshold: float = 0.98) -> str:
    return f"""
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
ok as (select * from v where label is not null and vec_id is not null and len(e) > 0
  and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= {threshold}),
reach(a, b) as (select vec_id, vec_id from v union select r.a, l.b from reach r join l on r.b = l.a),
c as (select a, min(b) as component from reach group by a),
n as (select a, count(*) as n from l group by a)
select v.vec_id, cast(coalesce(n.n, 0) as bigint) as n_links, c.component as component_id, v.vec_id = c.component as kept
from v join c on c.a = v.vec_id left join n on n.a = v.vec_id"""


def hard_negatives_sql(positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> str:
    return f"""
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
   list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q from embeddings
   where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, a.label = b.label as own, b.vec_id as id,
   cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) as bigint) as score
   from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 100 = 0),
p as (select anchor_id, id as positive_id, score as positive_score from s where own
   qualify row_number() over (partition by anchor_id order by score desc, id) <= {positives})
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, id) as int) as rank,
   id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and not own and {low} * positive_score <= 100 * score and 100 * score <= {high} * positive_score
qualify rank <= {negatives}"""


def prefix_tree_sql() -> str:
    # a control string, however often it is escaped, gets one more character
    longer = "length({0}) + len(regexp_extract_all({0}, '<\\\\*/?s>|\\[\\\\*/?(?:INST|SYS|TURN)\\]'))"
    return f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
   union all select * from (values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
t as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k,
   {longer.format("text")} + case role when 'user' then 15 when 'system' then 13 when 'assistant' then 5 else 23 + {longer.format("role")} end as chars from c),
d as (select conv_id, count(*) as n, string_agg(role || chr(10) || text || chr(10), '' order by k) as turns,
   coalesce(string_agg(case when role = 'assistant' then text end, '' order by k), '') as loss, sum(chars) + 3 as chars from t group by conv_id)
select conv_id, n as n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, cast(chars as bigint) as formatted_chars from d"""


ORACLES = {
    "op5_jaccard_join": jaccard_sql(),
    "op7_embedding_dedup": embedding_sql(),
    "op1_line_dedup": line_dedup_sql(),
    "op2_url_filter": url_filter_sql(),
    "op3_mixing": mixing_sql(),
    "op9_decontamination": decontamination_sql(),
    "op11_hard_negatives": hard_negatives_sql(),
    "op13_prefix_tree": prefix_tree_sql(),
}

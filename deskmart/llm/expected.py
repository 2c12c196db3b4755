"""SQL for the results of the operators that SQL can express, over whole tables of moderate size."""

from __future__ import annotations

LINE_FREQUENCY = r"""
with d as (select row_number() over () rid, doc_id, coalesce(source, '') host, coalesce(text, '') body from documents),
w as (select rid, regexp_extract_all(body, '[^\x20\x09-\x0D]+') ws,
             list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls from d),
p as (select rid, unnest(ws) a, unnest(range(1, len(ws) + 1)) i from w),
t as (select rid, i, a, lead(a) over s b, lead(a, 2) over s c from p window s as (partition by rid order by i)),
r as (select rid, i from t where c is not null
      qualify count(*) over (partition by rid, a, b, c) > 1),
covered as (select rid, count(distinct i + j) n from r, (values (0), (1), (2)) v(j) group by rid),
l as (select rid, host, body, raw, trim(regexp_replace(regexp_replace(lower(raw), '[^\p{L}\p{N}]+', ' ', 'g'), '\p{N}', '0', 'g')) line
      from (select rid, unnest(ls) raw from w) join d using (rid)),
texts as (select host, count(distinct body) texts from d group by host),
frequent as (select host, line from l join texts using (host) group by host, line, texts
             having count(distinct body) > 5 and count(distinct body) > 0.02 * texts),
removed as (select rid, sum(len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')))::bigint n from l join frequent using (host, line) group by rid),
base as (
  select doc_id, host, len(ws)::bigint n_words, length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g'))::bigint word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::bigint n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, coalesce(covered.n, 0)::bigint n_repeat_words,
         (len(ws) - coalesce(removed.n, 0))::bigint words_left
  from d join w using (rid) left join covered using (rid) left join removed using (rid)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from base)
select *, not base_failed and words_left >= 0.5 * n_words kept from judged
"""

PASSAGES = r"""
with d as (select doc_id, coalesce(text, '') body from documents),
c as (select body, min(doc_id) class_id, count(*) copies, regexp_extract_all(body, '[^\x20\x09-\x0D]+') ws
      from d group by body having len(ws) >= 50),
w as (select body, class_id, s - 1 as pos, array_to_string(ws[s:s + 49], ' ') passage
      from (select body, class_id, ws, unnest(range(1, len(ws) - 48)) s from c)),
r as (select body, pos, min(class_id) over (partition by passage) first_doc from w
      qualify count(*) over (partition by passage) > 1),
i as (select body, pos, first_doc, pos - row_number() over (partition by body order by pos) run from r),
s as (select body, min(pos) a, max(pos) + 50 e, arg_min(first_doc, pos) f from i group by body, run),
o as (select body, a, e, f, greatest(a, coalesce(max(e) over (partition by body order by a rows between unbounded preceding and 1 preceding), 0)) own from s),
q as (select body, string_agg(a || ':' || e || ':' || coalesce(f::varchar, ''), ',' order by a) passages, sum(e - own)::bigint n from o group by body)
select doc_id, class_id, copies::bigint copies, len(ws)::bigint as words,
       case when copies > 1 then len(ws) else n end::bigint repeated_words,
       case when copies > 1 then '0:' || len(ws) || ':' || class_id else passages end passages
from d join c using (body) left join q using (body) where copies > 1 or passages is not null
"""

NEAR_DUPLICATES = r"""
with recursive
d as (select doc_id, coalesce(text, '') body, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') ws from documents),
c as (select ws, min(doc_id) id from d group by ws),
g as (select id, unnest(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' '))
                             when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) gram from c),
b as (select id, gram, count(*) n from g group by id, gram),
t as (select id, sum(n) total from b group by id),
o as (select x.id p, y.id q, sum(least(x.n, y.n)) common from b x join b y on x.gram = y.gram and x.id < y.id group by all),
e as (select p, q from o join t tp on tp.id = p join t tq on tq.id = q where common >= 0.8 * (tp.total + tq.total - common)),
both_ways as (select p, q from e union select q, p from e),
reach as (select id as node, id as other from c union select node, q from reach join both_ways on other = p),
label as (select node, min(other) class_id from reach group by node),
named as (select d.doc_id, class_id, d.body from d join c using (ws) join label on node = c.id)
select doc_id, class_id, (count(*) over (partition by class_id))::bigint class_docs, doc_id = class_id kept from named
"""


def _found(kind: str, pattern: str, part: int, least: int, rank: int) -> str:
    text = pattern.replace("'", "''")
    return f"""
  select rid, {rank} as rank, '{kind}' as kind, s, s + n as e from (
    select rid, len(parts[k]) as own, len(hits[k]) as n,
           list_sum(list_transform(gaps[1:k], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: len(x))), 0) as s
    from (select rid, hits, parts, gaps, unnest(range(1, len(hits) + 1)) as k from (
      select rid, regexp_extract_all(body, '{text}') as hits, regexp_extract_all(body, '{text}', {part}) as parts,
             string_split_regex(body, '{text}') as gaps from d))) where own >= {least}"""


# Fixed patterns of the contract, then the further kinds
_KINDS = (
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("login", r"[a-z][a-z0-9+.-]{0,31}://[^\s/:@]+:[^\s/:@]+@[^\s/:@]+", 0, 1),
)
SECRETS = f"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') body from documents),
f as ({" union all ".join(_found(*k, rank=i) for i, k in enumerate(_KINDS))}),
j as (select rid, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access, count(*) filter (kind = 'hex') n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 3) base,
             string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) spans from f group by rid)
select doc_id, coalesce(n_assign, 0)::bigint n_assign, coalesce(n_access, 0)::bigint n_access, coalesce(n_hex, 0)::bigint n_hex,
       sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans, sha256(body) as blob
from d left join j using (rid)
"""

_URL_RULES = r"""
with recursive
rules(name, host, path, verdict) as (values ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
tags as (select distinct url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^<>]*>')) tag from pages where url is not null),
declared as (
  select url, replace(regexp_extract(tag, '(?is)[^\w-]href\s*=\s*["'']?\s*([^"''\s>]+)', 1), '&amp;', '&') target from tags
  where regexp_matches(tag, '(?is)^<link\b.*?[^\w-]rel\s*=\s*(?:"[^">]*?\bcanonical\b|''[^''>]*?\bcanonical\b|canonical\b)')
  union select url, replace(regexp_extract(tag, '(?is)[^\w-]content\s*=[^>]{0,100}?\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1), '&amp;', '&') from tags
  where regexp_matches(tag, '(?is)^<meta\b.*?[^\w-]http-equiv\s*=\s*["'']?\s*refresh\b')),
seen as (select url, target, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) origin, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) here,
                regexp_extract(target, '(?s)^([^?#]*)', 1) own from declared),
full_path as (select *, case when starts_with(target, '/') then own else '/' || regexp_extract(here, '(?s)^/(.*/)', 1) || own end whole from seen),
links as (select distinct url src, case
    when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') then target
    when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') or origin = '' or target = '' then null
    when starts_with(target, '//') then regexp_extract(url, '(?s)^(.*?:)//', 1) || target
    when starts_with(target, '#') then regexp_extract(url, '(?s)^([^#]*)', 1) || target
    when starts_with(target, '?') then origin || here || target
    else origin || list_reduce(string_split(whole, '/'), lambda acc, part: case part when '..' then regexp_replace(acc, '/[^/]*$', '')
                                                                                    when '.' then acc else acc || '/' || part end)
                || case when regexp_matches(whole, '/\.\.?$') then '/' else '' end || substr(target, length(own) + 1) end dst from full_path
  EDGES),
urls as (select url from pages where url is not null union select src from links where dst is not null union select dst from links where dst is not null),
parts as (select url, regexp_replace(lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '([^:0-9]):(80|443)$', '\1') host,
                 regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) path, regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1) query from urls),
plain as (select url, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') page,
                 trim(array_to_string(list_filter(string_split(query, '&'), lambda x: not regexp_full_match(x, '(utm_[a-z]+|ref|gclid|fbclid)(=.*)?')), '&'), '&') query
          from parts where url like '%://%'),
e as (select src p, dst q from links where dst is not null
      union select url, 'plain ' || page || case when query <> '' then '?' || query else '' end from plain),
both_ways as (select p, q from e union select q, p from e),
reach as (select url as node, url as other from urls union select node, q from reach join both_ways on other = p),
site as (select url, lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)) host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) path from urls),
own as (select url, arg_max(rules.name, length(rules.name)) rule, arg_max(rules.verdict, length(rules.name)) verdict
        from site join rules on (site.host = rules.host or ends_with(site.host, '.' || rules.host)) and starts_with(site.path, rules.path) group by url),
said as (select node, min(verdict) verdict from reach join own on own.url = other group by node)
select page_id, coalesce(site.host, '') host, coalesce(site.path, '') path, own.rule, coalesce(own.verdict, said.verdict, 'allow') verdict
from pages left join site using (url) left join own using (url) left join said on said.node = pages.url
"""
URL_VERDICTS = _URL_RULES.replace("EDGES", "")
# Addresses that share their path lead to the first of them
MIRROR_VERDICTS = _URL_RULES.replace("EDGES", """union select url, min(url) over (partition by regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1))
  from pages where url like '%://%'""")


FILL_IN_MIDDLE = r"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') body, sha256('7:' || coalesce(doc_id::varchar, '')) h from documents),
u as (select *, regexp_extract_all(body, '[^\n]*\n|[^\n]+') ls,
             list_transform([1, 9, 17, 25], lambda p: ('0x' || substr(h, p, 8))::bigint) hs from d),
c as (select *, len(ls)::bigint n, least(hs[1] % (len(ls) + 1), hs[2] % (len(ls) + 1)) a, greatest(hs[1] % (len(ls) + 1), hs[2] % (len(ls) + 1)) b,
             case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>') or hs[3] % 100 >= 100 then 'plain'
                  when hs[4] % 100 < 50 then 'spm' else 'psm' end form from u),
s as (select *, array_to_string(ls[1:a], '') pre, array_to_string(ls[a + 1:b], '') mid, array_to_string(ls[b + 1:], '') suf from c)
select doc_id, n, form, case when form <> 'plain' then length(pre) end::bigint prefix_chars, case when form <> 'plain' then length(mid) end::bigint middle_chars,
       sha256(case form when 'plain' then body when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                        else '<S>' || suf || '<P>' || pre || '<M>' || mid end) output_sha256,
       sha256(body) restored_sha256 from s
"""


def _personal(name: str, pattern: str, valid: str, value: str, rank: int) -> str:
    return f"""
  select rid, {rank} as rank, '{name}' as kind, s, s + len(hit) as e, '{name} ' || {value} as val from (
    select rid, hits[k] hit, regexp_replace(hits[k], '[^0-9]', '', 'g') digits,
           list_sum(list_transform(gaps[1:k], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: len(x))), 0) as s
    from (select rid, hits, gaps, unnest(range(1, len(hits) + 1)) as k from (
      select rid, regexp_extract_all(body, '{pattern}') as hits, string_split_regex(body, '{pattern}') as gaps from d))) where {valid}"""


_LUHN = """len(digits) between 12 and 19 and list_sum(list_transform(range(0, len(digits)), lambda i:
  case when i % 2 = 0 then substr(digits, len(digits) - i, 1)::int when substr(digits, len(digits) - i, 1)::int > 4 then substr(digits, len(digits) - i, 1)::int * 2 - 9
       else substr(digits, len(digits) - i, 1)::int * 2 end)) % 10 = 0"""
_PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", "lower(hit)"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", r"regexp_full_match(hit, '(0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])')", "hit"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", _LUHN, "digits"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "len(digits) between 9 and 15", "digits"),
)
PERSONAL_DATA = rf"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') body from documents),
total as (select count(*)::double n from d),
b as ({" union all ".join(_personal(*k, rank=i) for i, k in enumerate(_PERSONAL))}),
v as (select distinct rid, val from b),
protected as (select val, count(*) df from v, total group by val, n having count(*) >= 3 and count(*) <= 0.01 * n),
hits as (select rid, regexp_extract_all(body, '[\p{{L}}\p{{N}}]+') hits, string_split_regex(body, '[\p{{L}}\p{{N}}]+') gaps from d),
places as (select rid, hit, (sum(len(gap) + len(hit)) over (partition by rid order by k))::bigint e
           from (select rid, unnest(hits) hit, unnest(gaps[1:len(hits)]) gap, unnest(range(1, len(hits) + 1)) k from hits)),
words as (select rid, lower(hit) term, regexp_replace(left(lower(hit), 3), '\p{{N}}', '0', 'g') || '*' form, e - len(hit) s, e from places),
term_df as (select term, count(distinct rid) df from words group by term),
form_df as (select form, count(distinct rid) df from words group by form),
outside as (select w.* from words w where rid in (select rid from v join protected using (val))
            and not exists (select 1 from b where b.rid = w.rid and b.s < w.e and b.e > w.s)),
pairs as (select val, term, count(distinct rid) co from outside join v using (rid) join protected using (val) group by val, term),
form_pairs as (select val, form, count(distinct rid) co from outside join v using (rid) join protected using (val) group by val, form),
reveals as (select val, term from pairs join protected p using (val) join term_df t using (term), total
            where co >= 3 and 1 - ln(t.df / co) / ln(n / p.df) >= 0.9),
safe as (select val, form from form_pairs join protected p using (val) join form_df f using (form), total
         where 1 - ln(f.df / co) / ln(n / p.df) < 0.9),
added as (select o.rid, o.s, o.e, bool_and(length(o.term) > 3 and safe.form is not null) keeps
          from outside o join v using (rid) join reveals r on r.val = v.val and r.term = o.term
               left join safe on safe.val = v.val and safe.form = o.form group by o.rid, o.s, o.e),
f as (select rid, rank, kind, s, e from b
      union all select rid, case when keeps then 4 else 5 end, case when keeps then 'general' else 'removed' end, s, e from added),
j as (select rid, count(*) filter (kind = 'email') n_email, count(*) filter (kind = 'ip') n_ip, count(*) filter (kind = 'card') n_card,
             count(*) filter (kind = 'phone') n_phone, string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 4) base,
             string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) spans from f group by rid)
select doc_id, coalesce(n_email, 0)::bigint n_email, coalesce(n_ip, 0)::bigint n_ip, coalesce(n_card, 0)::bigint n_card,
       coalesce(n_phone, 0)::bigint n_phone, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from d left join j using (rid)
"""
# Values of any frequency; one in all documents holds no information
COMMON_VALUES = PERSONAL_DATA.replace("count(*) <= 0.01 * n", "count(*) <= n").replace("/ ln(n / p.df)", "/ nullif(ln(n / p.df), 0)")

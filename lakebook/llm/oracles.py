"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lakebook.llm.quality import ENOUGH_DOCS, MAX_LOST, MIN_DOCS, SHARE

_SPACE = r"[\x20\x09-\x0D]"

OP1 = rf"""
with base as (
  select row_number() over () as r, doc_id, coalesce(source, '') as host, coalesce(text, '') as text
  from documents
), words as (
  select r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols
  from base
), windows as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as t
  from (select r, w, unnest(range(1, len(w) - 1)) as i from words where len(w) >= 3)
), repeated as (
  select r, i from (select r, i, count(*) over (partition by r, t) as n from windows) where n > 1
), covered as (
  select r, count(distinct j) as n
  from (select r, unnest([i, i + 1, i + 2]) as j from repeated) group by r
), lines as (
  select r, doc_id, host, line, length(line) as n from (
    select r, doc_id, host,
      lower(trim(regexp_replace(unnest(string_split(text, chr(10))), '[\x20\x09\x0B-\x0D]+', ' ', 'g'))) as line
    from base) where line <> ''
), hosts as (
  select host, count(*) as host_docs from base group by host
), above as (
  select host, line from lines join hosts using (host)
  group by host, line, host_docs
  having count(distinct r) > {MIN_DOCS}
    and (count(distinct r) > {SHARE} * host_docs or count(distinct r) > {ENOUGH_DOCS})
), lost as (
  select r, sum(n) as line_chars, coalesce(sum(n) filter (a.line is not null), 0) as removed_chars,
    count(a.line) as n_removed_lines
  from lines l left join above a on l.host = a.host and l.line = a.line group by r
), joined as (
  select b.doc_id, len(w)::bigint as n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    n_symbols::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words,
    coalesce(n_removed_lines, 0)::bigint as n_removed_lines,
    coalesce(removed_chars, 0)::bigint as removed_chars, coalesce(line_chars, 0)::bigint as line_chars
  from base b join words using (r) left join covered c using (r) left join lost using (r)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
    and not removed_chars > {MAX_LOST} * line_chars as kept
from joined
"""

OP2 = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as d from pages
), g as (select d, min(page_id) as first_id, count(*) as c from p where n >= 100 group by d)
select page_id, n::bigint as payload_bytes, d as payload_digest,
  case when c > 1 and page_id is distinct from first_id and first_id is not null
    then 'revisit' else 'response' end as record_type,
  case when c > 1 and page_id is distinct from first_id then first_id end as refers_to
from p left join g using (d)
"""

OP7 = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id is not distinct from max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""

OP11 = r"""
with given as (
  select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(doc_id::varchar, '')) as h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as line
  from documents
), cut as (
  select *, len(line) as n, ('0x' || substr(h, 1, 8))::ubigint % (len(line) + 1) as a,
    ('0x' || substr(h, 9, 8))::ubigint % (len(line) + 1) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
        or ('0x' || substr(h, 17, 8))::ubigint % 100 >= 100 then 'plain'
      when ('0x' || substr(h, 25, 8))::ubigint % 100 < 50 then 'spm' else 'psm' end as form
  from given
), parts as (
  select *, array_to_string(line[1:least(a, b)::bigint], '') as prefix,
    array_to_string(line[least(a, b)::bigint + 1:greatest(a, b)::bigint], '') as middle,
    array_to_string(line[greatest(a, b)::bigint + 1:n], '') as suffix
  from cut
)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then length(prefix)::bigint end as prefix_chars,
  case when form <> 'plain' then length(middle)::bigint end as middle_chars,
  sha256(case form when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle else text end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""

OP12 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), total as (
  select lang, sum(len(w)) as n from words group by lang
), places as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from words
), sized as (
  select lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) as k from places
), grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f from sized group by all having count(*) >= 100
), longer as (
  select lang, k - 1 as k, phrase[position(' ' in phrase) + 1:] as phrase, f from grams where k > 1
  union all
  select lang, k - 1, array_to_string(string_split(phrase, ' ')[:k - 1], ' '), f from grams where k > 1
), most as (
  select lang, k, phrase, max(f) as f from longer group by all
), cuts as (
  select lang, k, phrase, f as a, unnest(range(1, k)) as cut, string_split(phrase, ' ') as w from grams where k > 1
), scored as (
  select c.lang, c.k, c.phrase, c.a, c.cut, l.f as l, r.f as r, n,
    (1000::hugeint * c.a * n) // (l.f::hugeint * r.f) as score
  from cuts c join total t on t.lang = c.lang
    join grams l on l.lang = c.lang and l.phrase = array_to_string(w[:cut], ' ')
    join grams r on r.lang = c.lang and r.phrase = array_to_string(w[cut + 1:], ' ')
), least_cut as (
  select * from scored
  qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), kept as (
  select s.* from least_cut s left join most m on m.lang = s.lang and m.k = s.k and m.phrase = s.phrase
  where m.f is null or 100 * m.f < 100 * s.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank,
  phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from kept
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op2_warc": OP2,
    "op7_exact_dedup": OP7,
    "op11_fim": OP11,
    "op12_collocations": OP12,
}

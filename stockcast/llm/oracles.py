"""SQL for the registered queries that SQL can express."""

OP8_EXACT_DEDUP = """
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[ \\t-\\r]+', ' ', 'g') as norm from documents
)
select doc_id,
       min(doc_id) over (partition by norm) as keep_id,
       count(*) over (partition by norm) as group_size,
       doc_id = min(doc_id) over (partition by norm) as kept,
       sha256(norm) as text_sha256
from t
"""

OP10_LINE_DEDUP = r"""
with p as (
  select page_id,
         lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)', 1)) as host,
         list_transform(string_split(regexp_replace(coalesce(html, ''),
           '(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>', chr(10), 'g'), chr(10)), lambda x: trim(x)) as lines
  from pages
),
l as (select page_id, host, unnest(lines) as line, generate_subscripts(lines, 1) as k from p),
totals as (select host, count(*) as pages from p group by host),
often as (
  select l.host, line from l join totals using (host) where line <> ''
  group by l.host, line, pages having count(distinct page_id) > 0.1 * pages and count(distinct page_id) >= 3
)
select l.page_id, l.host,
       count(*) filter (l.line <> '') as n_lines,
       count(often.line) as n_dropped,
       coalesce(string_agg(l.line, chr(10) order by k) filter (often.line is null), '') as text
from l left join often on l.host = often.host and l.line = often.line
group by l.page_id, l.host
"""

OP12_TOP_PRODUCTS = """
with v as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, q.row as q_row, c.vec_id, c.row, list_dot_product(q.v, c.v)::bigint as score
  from v q join v c on q.row <> c.row where q.vec_id % 50 = 0
),
placed as (
  select *, row_number() over (partition by q_row order by score desc, vec_id nulls last, row) as place from scored
)
select query_id, place::int as rank, vec_id, score from placed where place <= 5
"""

def _repair_sql() -> str:
    """Cheapest edits row by row: the best way to each state (nothing yet, after s, u, a) as (cost, edits, lines)."""
    way = lambda e, cost, edit, line: (
        f"case when {e} is not null then {{'c': {e}.c + {cost}, 'a': {e}.a || '{edit}', 'r': {e}.r || {line}}} end")
    line = lambda role, text: f"chr(10) || {role} || ':' || {text}"
    best = lambda *ways: f"list_sort(list_filter([{', '.join(ways)}], lambda w: w is not null))[1]"
    insert = lambda e, role: way(e, 3, "I", line(f"'{role}'", "''"))
    delete = lambda e: way(e, 4, "D", "''")
    keep = lambda e, initial: f"case when not gone and initial = '{initial}' then {way(e, 'extra', 'K', line('role', 'text'))} end"
    rerole = lambda e, role: "case when not gone then " + way(e, "extra + 3", "R", line(f"'{role}'", "text")) + " end"
    from_any = [f(e, x) for e in ("y0", "y1", "y3") for f, x in ((keep, "u"), (rerole, "user"))]
    return f"""
with recursive keyed as (
  select coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key, conv_id, turn,
         coalesce(role, ' ') as role, coalesce(text, ' ') as text
  from conversations
),
crc as (
  select *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(key, ''), lambda b: ord(b)::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295::bigint) % 20 as kind
  from keyed
),
damaged as (
  select coalesce(conv_id::varchar, '') as conv, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from crc where kind <> 0
),
numbered as (
  select *, left(role, 1) as initial, row_number() over (partition by conv order by turn nulls first, role, text) as k,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as inner_text
  from damaged
),
judged as (
  select *, case when inner_text = '' then 'blank'
                 when row_number() over (partition by conv, role, text order by k) > 1 then 'duplicate'
                 when right(inner_text, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
         lag(initial) over (partition by conv order by k) as before
  from numbered
),
turns as (select *, fault in ('blank', 'duplicate') as gone, case when fault = 'truncated' then 3 else 0 end as extra from judged),
steps as (
  select conv, 0::bigint as k, {{'c': 0::bigint, 'a': '', 'r': ''}} as y0, null::struct(c bigint, a varchar, r varchar) as y1,
         {{'c': 3::bigint, 'a': 'I', 'r': chr(10) || 'user:'}} as y2,
         {{'c': 6::bigint, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} as y3
  from (select distinct coalesce(conv_id::varchar, '') as conv from conversations)
  union all
  select conv, k, x0, x1, y2, {best("x3", insert("y2", "assistant"))}
  from (select *, {best("x2", insert("x0", "user"), insert("x1", "user"), insert("x3", "user"))} as y2
    from (select steps.conv, turns.k, {delete("y0")} as x0, {best(delete("y1"), keep("y0", "s"))} as x1,
        {best(delete("y2"), *from_any)} as x2,
        {best(delete("y3"), keep("y2", "a"), rerole("y2", "assistant"))} as x3
      from steps join turns on turns.conv = steps.conv and turns.k = steps.k + 1) as moved) as filled
),
ended as (select conv, arg_max({best("y0", "y3")}, k) as way from steps group by conv),
counted as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from turns group by conv
)
select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, way.c as cost, way.a as audit, sha256(substr(way.r, 2)) as repaired_sha256
from (select distinct conv_id, coalesce(conv_id::varchar, '') as conv from conversations) i
join ended using (conv) left join counted using (conv)
"""


OP13_CONVERSATION_REPAIR = _repair_sql()

ORACLES: dict[str, str] = {
    "op8_exact_dedup": OP8_EXACT_DEDUP, "op10_line_dedup": OP10_LINE_DEDUP, "op12_top_products": OP12_TOP_PRODUCTS,
    "op13_conversation_repair": OP13_CONVERSATION_REPAIR,
}

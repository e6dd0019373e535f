"""SQL for DuckDB with the same rows as the corpus queries, where SQL can express them."""

from logweir.llm.quality import RULES, STOP_WORDS

#: Words of the contracts: anything but space and the control characters 9 to 13.
SPACED = r"[^\x20\x09-\x0D]+"
#: Letters of scripts written without spaces are words of their own.
SINGLE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"

DECONTAMINATE = f"""
with texts as (
  select 'd' as side, doc_id as id, coalesce(text, '') as text from documents
  union all select 'b', item_id, coalesce(text, '') from benchmark),
worded as (
  select side, id, regexp_extract_all(regexp_replace(lower(text), '([{SINGLE}])', ' \\1 ', 'g'), '[\\p{{L}}\\p{{N}}]+') as w from texts),
sizes as (select side, id, len(w) as n, least(len(w), 5) as k from worded where len(w) > 0),
spots as (
  select side, id, i, x as x0, {", ".join(f"lead(x, {j}) over (partition by side, id order by i) as x{j}" for j in range(1, 5))}
  from (select side, id, unnest(w) as x, unnest(range(len(w))) as i from worded)),
windows as (
  select side, id, i, k, concat_ws(' ', x0, case when k > 1 then x1 end, case when k > 2 then x2 end,
    case when k > 3 then x3 end, case when k > 4 then x4 end) as gram
  from spots, (select distinct k from (select 5 as k union all select k from sizes where side = 'b'))),
item_grams as (select distinct w.id, gram from windows w join sizes s on s.side = 'b' and w.side = 'b' and s.id = w.id and s.k = w.k and i + w.k <= s.n),
doc_grams as (select distinct w.id, gram from windows w join sizes s on s.side = 'd' and w.side = 'd' and s.id = w.id and i + w.k <= s.n),
counted as (select id, count(*) as n from item_grams group by id),
found as (select d.id as doc_id, g.id as item_id, count(*) as n from doc_grams d join item_grams g using (gram) group by all)
select f.doc_id, f.item_id, c.n::bigint as n_item, f.n::bigint as n_found, f.n::double / c.n as containment
from found f join counted c on c.id = f.item_id where f.n >= 0.8::double * c.n
"""

LINES = """
with split as (
  select doc_id, source, text, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos
  from documents where text is not null),
keyed as (select *, trim(lower(line), ' ') as k from split),
wide as (
  select k, min(struct_pack(d := doc_id, p := pos)) as first from keyed where k <> '' group by k having count(distinct source) >= 5),
kept as (
  select s.doc_id, s.pos, s.line from keyed s left join wide w using (k)
  where w.k is null or (s.doc_id = w.first.d and s.pos = w.first.p)),
again as (select doc_id, string_agg(line, chr(10) order by pos) as text from kept group by doc_id)
select d.doc_id, len(string_split(d.text, chr(10)))::bigint as n_lines,
  len(string_split(case when d.text is not null then coalesce(a.text, '') end, chr(10)))::bigint as n_left,
  sha256(case when d.text is not null then coalesce(a.text, '') end) as text_sha256
from documents d left join again a using (doc_id)
"""

CHAT = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked as (
  select *, replace(replace(role, '\', '\b'), '<|', '\l|') as r, replace(replace(text, '\', '\b'), '<|', '\l|') as t from given),
closed as (
  select conv_id, turn, role, text, '<|im|>' || case when right(r, 1) = '<' then left(r, -1) || '\l' else r end || '<|text|>'
    || case when right(t, 1) = '<' then left(t, -1) || '\l' else t end || '<|end|>' as f from marked)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, f)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, f)) as loss_sha256,
  sum(length(f))::bigint as formatted_chars, 0::bigint as n_attachments, 0::bigint as attachment_tokens
from closed group by conv_id
"""


def bad(figure, low, high):
    tests = [f"{figure} < {low}::double"] * (low is not None) + [f"{figure} > {high}::double"] * (high is not None)
    return " or ".join(tests)


QUALITY = rf"""
with given as (select doc_id, coalesce(text, '') as t from documents),
cut as (
  select doc_id, t, regexp_extract_all(t, '{SPACED}') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from given),
spots as (
  select doc_id, i, x, lead(x, 1) over (partition by doc_id order by i) as y, lead(x, 2) over (partition by doc_id order by i) as z
  from (select doc_id, unnest(w) as x, unnest(range(len(w))) as i from cut)),
windows as (select doc_id, i, count(*) over (partition by doc_id, x, y, z) as n from spots where z is not null),
marked as (select doc_id, least(coalesce(lead(i) over (partition by doc_id order by i) - i, 3), 3) as covers from windows where n > 1),
repeated as (select doc_id, sum(covers) as n from marked group by doc_id),
figures as (
  select c.doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words,
    len(lines) as n_lines, length(regexp_replace(t, '[^!]+', '', 'g')) as n_exclaim,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) as n_upper,
    len(list_filter(w, lambda x: lower(x) in ({", ".join(f"'{s}'" for s in STOP_WORDS)}))) as n_stop
  from cut c left join repeated r using (doc_id)),
ratios as (
  select *, case when n_words > 0 then word_chars / n_words::double else 0 end as mean_word,
    case when n_words > 0 then n_symbols / n_words::double else 0 end as symbol_ratio,
    case when n_words > 0 then n_exclaim / n_words::double else 0 end as exclaim_ratio,
    case when word_chars > 0 then n_upper / word_chars::double else 0 end as capital_ratio,
    case when n_words > 0 then n_stop / n_words::double else 0 end as stop_ratio,
    case when n_lines > 0 then n_dup_lines / n_lines::double else 0 end as dup_line_ratio,
    case when n_words > 0 then n_repeat_words / n_words::double else 0 end as repeat_ratio from figures),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    concat_ws(',', {", ".join(f"case when {bad(figure, low, high)} then '{name}' end" for name, figure, low, high in RULES)}) as failed_rules
  from ratios)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and failed_rules = '' as kept, failed_rules from judged
"""

JACCARD = rf"""
with recursive worded as (
  select doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACED}') as w from documents),
spots as (
  select doc_id, i, n, concat_ws(' ', x, lead(x, 1) over (partition by doc_id order by i), lead(x, 2) over (partition by doc_id order by i)) as s
  from (select doc_id, len(w) as n, unnest(w) as x, unnest(range(len(w))) as i from worded)),
shingles as (select distinct doc_id, s from spots where i = 0 or i + 3 <= n),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select a.doc_id as x, b.doc_id as y from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
    join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id and 100 * least(m.n, n.n) >= 90 * greatest(m.n, n.n)
  group by a.doc_id, b.doc_id, m.n, n.n having 100 * count(*) >= 90 * (m.n + n.n - count(*))),
reach as (select doc_id as x, doc_id as y from documents union select r.x, l.y from reach r join links l on l.x = r.y)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, min(r.y) as component_id
from documents d left join sizes s using (doc_id) join reach r on r.x = d.doc_id group by d.doc_id, s.n
"""


def vector_codes(rounds=6, parts=8, entries=16):
    """Lloyd's rounds written out, one pair of tables each: who is nearest to which entry, and the new entries."""
    steps = [f"""
with whole as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as materialized (
  select vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] as x from whole, (select unnest(range({parts})) as p)),
first as (select vec_id, row_number() over (order by vec_id) - 1 as e from whole),
book0 as materialized (select p, e, x as c from part join first using (vec_id) where e < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""near{r} as materialized (
  select vec_id, p, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, e := e)) as best
  from part join book{r} using (p) group by vec_id, p, x)""")
        if r < rounds:
            steps.append(f"""sums{r} as (
  select p, e, i, (s - ((s % n) + n) % n) // n as c from (
    select p, best.e as e, i, sum(v)::bigint as s, count(*)::bigint as n
    from (select p, best, unnest(x) as v, unnest(range(len(x))) as i from near{r}) group by all)),
book{r + 1} as materialized (
  select b.p, b.e, coalesce(m.c, b.c) as c from book{r} b left join (select p, e, list(c order by i) as c from sums{r} group by p, e) m using (p, e))""")
    steps.append(f"""coded as (
  select vec_id, string_agg(printf('%02x', best.e), '' order by p) as code, sum(best.d)::bigint as error from near{rounds} group by vec_id),
digest as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from book{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join whole using (vec_id), digest""")
    return ",\n".join(steps[:-1]) + ",\n" + steps[-1]


ORACLE = {
    "op1_decontaminate": DECONTAMINATE,
    "op6_line_dedup": LINES,
    "op8_chat_format": CHAT,
    "op9_quality_rules": QUALITY,
    "op11_jaccard_join": JACCARD,
    "op12_vector_codes": vector_codes(),
}

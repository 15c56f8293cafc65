"""SQL for the corpus queries that SQL can express."""

from __future__ import annotations

# Words of the documents and of the items, A-Z lower-cased.
_WORDS = r"""regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP10 = f"""with docs as (select doc_id, {_WORDS} as words from documents),
items as (select cast(item_id as varchar) as item, {_WORDS} as words from benchmark),
item_windows as (
  select distinct item, least(len(words), 13) as size,
    array_to_string(words[i : i + least(len(words), 13) - 1], ' ') as gram
  from (select item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) as i
    from items where len(words) > 0)),
sizes as (select distinct size from item_windows),
doc_windows as (
  select doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') as gram
  from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as i
    from docs cross join sizes where len(words) >= size)),
hits as (select doc_id, d.size, i, item from doc_windows d join item_windows using (gram)),
hit_words as (
  select doc_id, count(distinct w) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as w from hits) group by doc_id),
hit_items as (
  select doc_id, count(distinct item) as n_items,
    string_agg(distinct item, ',' order by item) as names
  from hits group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)"""

OP5 = r"""with lines as (
  select row, doc_id, i, split[i] as line,
    translate(trim(split[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select row, doc_id, split, unnest(range(1, len(split) + 1)) as i
    from (select row_number() over () as row, doc_id,
      string_split(coalesce(text, ''), chr(10)) as split from documents))),
frequent as (
  select key from lines where length(key) >= 1 group by key having count(distinct row) >= 10)
select any_value(doc_id) as doc_id, count(*) as n_lines,
  count(*) filter (key in (from frequent)) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i)
    filter (key not in (from frequent)), '')) as kept_sha256
from lines group by row"""

OP3 = """with vectors as (
  select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
  where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as score
  from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 20 = 0),
ranked as (
  select query_id, vec_id, score,
    row_number() over (partition by query_id order by score desc, vec_id)::int as rank
  from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 20"""

OP11 = r"""with pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words
  from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) as piece from documents)),
totals as (select lang, sum(len(words))::bigint as n from pieces group by lang),
counts as (
  select lang, size, phrase, count(*) as a
  from (select lang, size, array_to_string(words[i : i + size - 1], ' ') as phrase
    from (select lang, words, size, unnest(range(1, len(words) - size + 2)) as i
      from pieces cross join (select unnest(range(1, 6)) as size) where len(words) >= size))
  group by lang, size, phrase having count(*) >= 100),
cuts as (
  select lang, phrase, a, k, string_split(phrase, ' ') as words
  from (select *, unnest(range(1, size)) as k from counts where size > 1)),
scored as (
  select c.lang, c.phrase, c.a, c.k, x.a as l, y.a as r, n,
    ((1000::hugeint * c.a * n) // (x.a::hugeint * y.a))::bigint as score
  from cuts c join totals using (lang)
    join counts x on x.lang = c.lang and x.phrase = array_to_string(words[1:k], ' ')
    join counts y on y.lang = c.lang and y.phrase = array_to_string(words[k + 1 :], ' ')),
lowest as (
  select * from scored
  qualify row_number() over (partition by lang, phrase order by score, k) = 1),
within as (
  select distinct lang, a, unnest([array_to_string(words[1 : size - 1], ' '),
    array_to_string(words[2:size], ' ')]) as phrase
  from (select *, string_split(phrase, ' ') as words from counts where size > 2))
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from lowest anti join within using (lang, phrase, a))
where rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op3_nearest": OP3, "op5_lines": OP5, "op10_decontaminate": OP10, "op11_collocations": OP11}

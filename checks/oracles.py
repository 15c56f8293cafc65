"""The same results in SQL, for a second engine to check."""

from __future__ import annotations

from postpulse.functions import lexicons

ITEM_WORDS = "good great love bad terrible not okay meh how code game news think my"
RECEIVED = "2024-01-01T00:00:00"

WORD = r"\p{L}\p{N}_"
SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
ASCII_SPACE = r"\t-\r\x20"

ITEMS = f"""items as (
  select 'e' || event_id::varchar as id,
    case when event_id % 3 = 0 then 'post' else 'comment' end as type,
    event_type as subreddit,
    case when user_id % 29 = 0 then '[deleted]' else 'user_' || user_id::varchar end as author,
    floor(value)::int as score,
    case when event_id % 3 = 0 then (event_id % 17)::int end as num_comments,
    epoch_us(ts)::double / 1000000.0::double as created_utc,
    list_extract(string_split('{ITEM_WORDS}', ' '), (event_id % 14 + 1)::int) || ' ' ||
    list_extract(string_split('{ITEM_WORDS}', ' '), (event_id * 5 % 14 + 1)::int) || ' ' ||
    case when event_id % 2 = 0 then '/u/user_' || (user_id % 11)::varchar || ' ' else '' end ||
    case when event_id % 5 = 0 then '/r/' || event_type || ' ' else '' end ||
    case when event_id % 7 = 0 then 'https://ex.org/' || (event_id % 50)::varchar || ' '
         else '' end || 'end' as text,
    event_id % 8 as batch_number
  from events)"""

ITEM_COLUMNS = "id, type, subreddit, author, score, num_comments, created_utc, text"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def found(text: str, pattern: str, group: int) -> str:
    return f"regexp_extract_all({text}, '{pattern}', {group})"


def dialect(name: str, text: str = "text") -> dict[str, str]:
    """User, community and URL lists of a text in one dialect."""
    url = rf"https?://[^{ASCII_SPACE}]+"
    if name == "producer":
        return {
            "user": found(text, "(?i)/?u/([A-Za-z0-9_-]+)", 1),
            "subreddit": found(text, "(?i)/?r/([A-Za-z0-9_-]+)", 1),
            "url": found(text, r"https?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!* ,])+", 0),
        }
    tail, group = {
        "token": (rf"[^{ASCII_SPACE}]+", 0),
        "word": (r"[A-Za-z0-9_]+", 0),
        "name": (r"([a-zA-Z0-9_-]+)", 1),
    }[name]
    return {
        "user": found(text, "/u/" + tail, group),
        "subreddit": found(text, "/r/" + tail, group),
        "url": found(text, url, 0),
    }


def clean(text: str) -> str:
    """Clean-up, one replacement after the other."""
    steps = [
        (rf"http[^{SPACE}]+|www[^{SPACE}]+|https[^{SPACE}]+", "[URL]"),
        (rf"@[{WORD}]+", "[USER]"),
        (rf"#[{WORD}]+", "[TAG]"),
        (rf"[^{WORD}{SPACE}\[\]]", " "),
        (rf"[{SPACE}]+", " "),
    ]
    out = f"coalesce({text}, '')"
    for pattern, by in steps:
        out = f"regexp_replace({out}, '{pattern}', '{by}', 'g')"
    return f"lower(trim({out}))"


def count_in(words: str, group) -> str:
    return f"len(list_filter({words}, lambda w: w in ({quoted(group)})))"


def sentiment_sql(words: str) -> str:
    parts = [
        f"{'+' if weight > 0 else '-'} {count_in(words, group)} * {abs(weight)}::double"
        for group, weight in lexicons.SENTIMENT_WEIGHTS
    ]
    glad = quoted(lexicons.POSITIVE + lexicons.STRONG_POSITIVE)
    negated = (
        f"len(list_filter(range(1, len({words})), lambda i: "
        f"{words}[i] in ({quoted(lexicons.NEGATIONS)}) and {words}[i + 1] in ({glad})))"
    )
    return (
        f"(0::double {' '.join(parts)} - {negated} * 1.5::double) / greatest(len({words}), 5)"
    )


def category_sql(score: str) -> str:
    return f"""case when {score} > 0.15::double then 'positive'
      when {score} > 0.05::double then 'slightly_positive'
      when {score} < -0.15::double then 'negative'
      when {score} < -0.05::double then 'slightly_negative' else 'neutral' end"""


def topic_sql(words: str) -> str:
    counts = {
        name: count_in(f"list_distinct({words})", group)
        for name, group in lexicons.TOPICS.items()
    }
    best = f"greatest({', '.join(counts.values())})"
    whens = " ".join(f"when {c} = {best} then '{name}'" for name, c in counts.items())
    return f"case when {best} = 0 then 'general' {whens} end"


def enriched(source: str, keep: str, text: str, original: str = "text", extra: str = "") -> str:
    """Common tables ``tok`` and ``enriched`` over ``source``."""
    return f"""tok as (
  select {keep}, c as text, {original} as original_text, string_split(c, ' ') as words {extra}
  from (select *, {text} as c from {source}) where c <> ''),
scored as (select *, {sentiment_sql('words')} as sentiment from tok),
enriched as (
  select * exclude (words), length(text) as length, len(words) as word_count,
    {category_sql('sentiment')} as sentiment_category, {topic_sql('words')} as topic,
    contains(text, 'how') or contains(text, 'what') or contains(text, 'why')
      or contains(text, 'help') as has_question
  from scored)"""


ENRICHED_ITEMS = (
    ITEMS
    + ",\n"
    + enriched(
        "items",
        "id",
        clean("text"),
        extra=", subreddit, author, score, score + 2 * num_comments as engagement_score",
    )
)
ENRICHED_DOCUMENTS = enriched("documents", "doc_id", clean("text"))

POSTS = """posts as (
  select 'd' || doc_id::varchar as id, source as subreddit,
    split_part(text, chr(10), 1) as title,
    substr(text, length(split_part(text, chr(10), 1)) + 2) as selftext,
    case when doc_id % 10 <> 0 then 'writer_' || (doc_id % 97)::varchar end as author,
    (doc_id % 501 - 50)::int as score,
    case when doc_id % 4 <> 0 then (doc_id % 100)::double / 100 end as upvote_ratio,
    (doc_id % 23)::int as num_comments,
    1700000000::double + doc_id * 37.5::double as created_utc,
    'https://ex.org/d/' || doc_id::varchar as url,
    '/r/' || source || '/' || doc_id::varchar as permalink,
    true as is_self, doc_id % 50 = 0 as over_18, false as spoiler, doc_id % 13 = 0 as locked
  from documents)"""

COMMENTS = """comments as (
  select 'c_' || conv_id::varchar || '_' || turn::varchar as id,
    'd' || conv_id::varchar as post_id, role as subreddit,
    case when (conv_id + turn) % 9 = 8 then '[removed]' else text end as body,
    case when conv_id % 10 <> 0 then role end as author,
    ((conv_id * 7 + turn) % 90 - 10)::int as score,
    1700000000::double + conv_id * 60 + turn * 2.25::double as created_utc,
    '/c/' || conv_id::varchar || '/' || turn::varchar as permalink,
    turn % 2 = 0 as is_submitter, turn as position
  from conversations)"""


def iso(epoch: str, separator: str = "T") -> str:
    us = f"round_even({epoch} * 1000000::double, 0)::bigint"
    day = f"%Y-%m-%d{separator}%H:%M:%S"
    return (
        f"case when {us} % 1000000 = 0 then strftime(make_timestamp({us}), '{day}') "
        f"else strftime(make_timestamp({us}), '{day}.%f') end"
    )


def two_places(value: str) -> str:
    return f"round_even(({value}) * 100::double, 0) / 100::double"


def reference_text(name: str, text: str, separator: str = " ") -> str:
    lists = dialect(name, text)
    return ", ".join(
        f"array_to_string({lists[k]}, '{separator}') as {k}_references"
        for k in ("user", "subreddit", "url")
    )


def mentions(source: str, lists: str, name: str) -> str:
    return f"""select {name}, count(*) as mention_count
from (select unnest({lists}) as {name} from {source}) group by 1"""


SIZES = {
    kind: f"len({expression})" for kind, expression in dialect("token").items()
}

WINDOWS = f"""with {ITEMS},
counted as (
  select (floor(created_utc / 5) * 5)::bigint - 5 * k as window_start,
    {SIZES['user']} as u, {SIZES['subreddit']} as s, {SIZES['url']} as l
  from items, range(12) as r(k))
select window_start, window_start + 60 as window_end, sum(u)::bigint as user_ref_count,
  sum(s)::bigint as subreddit_ref_count, sum(l)::bigint as url_ref_count
from counted group by window_start"""

NAMES = dialect("name")

WINDOW_LISTS = f"""with {ITEMS},
found as (
  select created_utc, {NAMES['user']} as users, {NAMES['subreddit']} as subreddits,
    {NAMES['url']} as urls from items),
fanned as (
  select (floor(created_utc / 5) * 5)::bigint - 5 * k as window_start, users, subreddits, urls
  from found, range(12) as r(k))
select window_start, window_start + 60 as window_end, array_to_string(users, ' ') as users,
  array_to_string(subreddits, ' ') as subreddits, array_to_string(urls, ' ') as urls,
  count(*) as copies
from fanned group by window_start, fanned.users, fanned.subreddits, fanned.urls"""


def each_batch(sql: str) -> str:
    """The result of ``sql`` over the items of each of four batches."""
    parts = [
        f"select {k}::int as batch_number, * from ("
        f"with items as (select * from whole where batch_number % 4 = {k}) {sql})"
        for k in range(4)
    ]
    return f"with {ITEMS}, whole as (from items) " + " union all ".join(parts)


TIME_RANGE = """select min(created_utc) as earliest_post, max(created_utc) as latest_post,
  count(*) as total_items,
  floor(max(created_utc) - min(created_utc))::bigint as time_range_seconds from items"""


USER_SCORES = f"""user_scores as (
  select author, count(score) as score_count, coalesce(sum(score), 0)::bigint as total_score,
    {two_places('avg(score)')} as avg_score,
    {two_places('stddev_samp(score)')} as score_stddev, count(id) as post_count
  from items where author is not null group by author)"""

HISTORY = f"""count(id) as id_count, {two_places('avg(score)')} as score_mean,
    {two_places('median(score)::double')} as score_median,
    {two_places('stddev_samp(score)')} as score_std, min(score) as score_min,
    max(score) as score_max, count(*) filter (type = 'post') as posts,
    count(distinct author) as unique_authors, count(distinct subreddit) as unique_subreddits"""


def histogram_sql(source: str, value: str, n: int, digits: int | None = None) -> str:
    edges = {
        "bin_start": "low + bin * ((high - low) / bins)",
        "bin_end": "low + (bin + 1) * ((high - low) / bins)",
    }
    if digits is not None:
        edges = {k: f"round({v}, {digits})" for k, v in edges.items()}
    return f"""select bin, {edges['bin_start']} as bin_start, {edges['bin_end']} as bin_end,
  count(*) as count, 100::double * count(*) / total as percent
from (
  select least(case when high > low then floor((v - low) / ((high - low) / bins)) else 0 end,
    bins - 1)::int as bin, low, high, total, bins
  from (select {value}::double as v from {source}) cross join
    (select min({value})::double as low, max({value})::double as high, count(*) as total,
      {n}::int as bins from {source}))
group by bin, low, high, total, bins"""


BOX = f"""{ITEMS.replace("event_id % 8", "event_id % 12")},
fences as (
  select batch_number, count(*) as n_items, min(score)::double as min, max(score)::double as max,
    quantile_cont(score, 0.25)::double as q1, quantile_cont(score, 0.5)::double as median,
    quantile_cont(score, 0.75)::double as q3
  from items where batch_number in (
    select distinct batch_number from items order by 1 limit 8) group by 1),
marked as (
  select *, score::double as value,
    score between q1 - 1.5::double * (q3 - q1) and q3 + 1.5::double * (q3 - q1) as inside
  from items join fences using (batch_number))"""

TERM_WORDS = rf"""list_filter(regexp_split_to_array(text, '[ \[\]]+'), lambda w:
  regexp_full_match(w, '[a-zA-Z]{{3,}}') and w not in ({quoted(lexicons.TERM_STOP_WORDS)}))"""

PAIRS = "list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])"

CLEAN_DOCUMENTS = f"cleaned as (select {clean('text')} as text from documents)"

DOCUMENT_TERMS = f"""{CLEAN_DOCUMENTS},
lists as (select {TERM_WORDS} as words from cleaned),
terms as (select unnest(words) as term from lists),
phrases as (select unnest({PAIRS}) as term from lists)"""

ITEM_TERMS = f"""{ENRICHED_ITEMS},
lists as (select {TERM_WORDS} as words from enriched),
terms as (select unnest(words) as term from lists),
phrases as (select unnest({PAIRS}) as term from lists)"""


def tfidf_sql(source: str) -> str:
    return rf"""split as (
  select row_number() over () as id, lower(text) as text from {source} where text is not null),
words as (select id, unnest(regexp_split_to_array(text, '[{ASCII_SPACE}]')) as word from split),
tf as (select id, word, count(*) as tf from words
  where word <> '' and word not in ({quoted(lexicons.ENGLISH_STOP_WORDS)}) group by 1, 2),
scores as (
  select word, round(max(tf) * ln(((select count(*) from split) + 1)::double / (count(*) + 1)), 6)
    as score
  from tf group by word)"""


TOP_WORDS = f"""from (with {tfidf_sql('items')}
select word, score from scores order by score desc, word limit 10)"""


def polarity_sql(source: str, key: str) -> str:
    values = ", ".join(
        f"('{w}', {weight / 2}::double)"
        for group, weight in lexicons.SENTIMENT_WEIGHTS
        for w in group
    )
    return f"""lexicon(word, polarity) as (values {values}),
all_words as (
  select {key}, unnest(string_split({clean('text')}, ' ')) as word from {source}),
polarities as (
  select {key}, coalesce(avg(polarity), 0) as polarity
  from all_words left join lexicon using (word) group by all)"""


def insight_rows() -> str:
    figures = ["id_count", "score_mean", "score_median", "score_std", "score_min"]
    selects = []
    for i, f in enumerate(figures):
        label = f.replace("_", " ").title()
        selects.append(
            f"""select {i} as position, '{f}' as figure, '{label}' as label,
  round(avg({f})::double, 6) as mean, min({f})::double as min, max({f})::double as max,
  case when max_by({f}, batch_number) > min_by({f}, batch_number) then 'increasing'
    else 'decreasing' end as trend from history"""
        )
    return " union all ".join(selects)


COMMUNITY_STATS = """
select subreddit, type, count(*) as item_count, avg(score) as avg_score,
  sum(num_comments)::bigint as total_comments, max(score) as max_score, min(score) as min_score
from items group by 1, 2"""

AUTHOR_STATS = """
select author, count(*) as posts_count, avg(score) as avg_score,
  sum(num_comments)::bigint as total_comments
from items where author <> '[deleted]' group by 1"""

REFS = dialect("name")

METRICS = f"""with {ITEMS},
refs as (select *, {REFS['user']} as us, {REFS['subreddit']} as ss, {REFS['url']} as ls
  from items),
users as (select batch_number, count(distinct r) as n, count(*) as m
  from (select batch_number, unnest(us) as r from refs) group by 1),
subs as (select batch_number, count(distinct r) as n, count(*) as m
  from (select batch_number, unnest(ss) as r from refs) group by 1),
urls as (select batch_number, count(distinct r) as n, count(*) as m
  from (select batch_number, unnest(ls) as r from refs) group by 1),
top_sub as (select batch_number, subreddit from (
  select batch_number, subreddit, type, row_number() over (
    partition by batch_number order by count(*) desc, subreddit, type) as k
  from items group by 1, 2, 3) where k = 1),
top_author as (select batch_number, author from (
  select batch_number, author, row_number() over (
    partition by batch_number order by count(*) desc, author) as k
  from items where author <> '[deleted]' group by 1, 2) where k = 1),
base as (select batch_number, count(*) as total_records, min(created_utc) as first,
  max(created_utc) as last, count(*) filter (type = 'post') as posts_count,
  count(*) filter (type = 'comment') as comments_count,
  count(distinct subreddit) as unique_subreddits,
  count(distinct author) filter (author <> '[deleted]') as unique_authors,
  avg(score) as avg_score, max(score)::bigint as max_score, min(score)::bigint as min_score
  from items group by 1)
select b.batch_number as batch_id, '2024-01-01 00:00:00' as processing_time, total_records,
  floor((round_even(last * 1000000::double, 0) - round_even(first * 1000000::double, 0))
    / 1000000)::bigint as time_range_seconds,
  {iso('first', ' ')} as earliest_post, {iso('last', ' ')} as latest_post,
  posts_count, comments_count, unique_subreddits, unique_authors, avg_score, max_score,
  min_score, coalesce(users.n, 0) as total_user_references,
  coalesce(subs.n, 0) as total_subreddit_references,
  coalesce(urls.n, 0) as total_url_references, top_sub.subreddit as top_subreddit,
  top_author.author as most_active_author, coalesce(users.m, 0) as user_ref_mentions,
  coalesce(subs.m, 0) as subreddit_ref_mentions, coalesce(urls.m, 0) as url_ref_mentions
from base b left join users using (batch_number) left join subs using (batch_number)
  left join urls using (batch_number) left join top_sub using (batch_number)
  left join top_author using (batch_number)"""

PAGES = "pages_text as (select page_id, url || ' ' || html as text from pages)"


def oracle_sql() -> dict[str, str]:
    dialect_columns = ", ".join(
        f"array_to_string({expression}, '|') as {name}_{kind}_references"
        for name in ("producer", "token", "word", "name")
        for kind, expression in dialect(name).items()
    )
    word_refs = dialect("word")
    top_users = "select author, post_count, total_score, avg_score from user_scores"
    return {
        "items_canonical": f"""with {ITEMS}
select {ITEM_COLUMNS}, text as full_text, null::varchar as title, null::varchar as url,
  batch_number from items""",
        "json_roundtrip": f"""with {ITEMS}
select {ITEM_COLUMNS}, {reference_text('name', 'text')} from items""",
        "parse_json_lines": """
select (props::json->>'$.k')::int as k, count(*) as n from events group by 1""",
        "parsed_times": f"""with {POSTS}
select id, round_even(created_utc * 1000000::double, 0)::bigint as created_micros,
  epoch_us(timestamp '2024-01-01 00:00:00') as received_micros from posts""",
        "posts_to_items": f"""with {POSTS},
shaped as (select *, coalesce(title, '') || ' ' || coalesce(selftext, '') as whole from posts)
select id, 'post' as type, subreddit, title, coalesce(selftext, '') as text,
  regexp_replace(whole, '^[{SPACE}]+|[{SPACE}]+$', '', 'g') as full_text, coalesce(author, '[deleted]') as author, score,
  round(coalesce(upvote_ratio, 0), 2) as upvote_ratio, num_comments, created_utc,
  {iso('created_utc')} as created_datetime, url, permalink, null::varchar as post_id, is_self,
  null::boolean as is_submitter, over_18, spoiler, locked,
  {reference_text('producer', 'whole')}, '{RECEIVED}' as timestamp_received
from shaped""",
        "comments_to_items": f"""with {COMMENTS}
select id, 'comment' as type, subreddit, body as text, body as full_text,
  coalesce(author, '[deleted]') as author, score, created_utc,
  {iso('created_utc')} as created_datetime, permalink, post_id, is_submitter,
  {reference_text('producer', 'body')}, '{RECEIVED}' as timestamp_received
from comments where coalesce(body, '') not in ('', '[deleted]', '[removed]')""",
        "lean_items": f"""with {POSTS}, {COMMENTS}
select 'submission' as type, subreddit, id,
  title || case when coalesce(selftext, '') <> '' then ' ' || selftext else '' end as text,
  created_utc, coalesce(author, '[deleted]') as author from posts
union all
select 'comment', subreddit, id, body, created_utc, coalesce(author, '[deleted]')
from comments""",
        "merge_dedupe": f"""with {ITEMS},
both_ as (select * from items union all
  select * replace (score + 1 as score) from items)
select {ITEM_COLUMNS} from (
  select *, row_number() over (partition by type, id order by score desc) as k from both_
  where subreddit in ('click', 'view', 'error')) where k = 1""",
        "newest_per_community": f"""with {ITEMS}
select {ITEM_COLUMNS} from (
  select *, row_number() over (partition by subreddit order by created_utc desc, id) as k
  from items) where k <= 3""",
        "first_comments": f"""with {COMMENTS}
select id, post_id, position, body from (
  select *, row_number() over (partition by post_id order by position, id) as k
  from comments) where k <= 2""",
        "user_mentions": f"with {ITEMS} " + mentions("items", REFS["user"], "user_ref"),
        "community_mentions": f"with {ITEMS} "
        + mentions("items", REFS["subreddit"], "subreddit_ref"),
        "url_mentions": f"with {PAGES} "
        + mentions("pages_text", dialect("token")["url"], "url_ref"),
        "reference_dialects": f"with {PAGES} select page_id, {dialect_columns} from pages_text",
        "reference_totals": f"""with {ITEMS}
select sum(len({word_refs['user']}))::bigint as user_refs,
  sum(len({word_refs['subreddit']}))::bigint as sub_refs,
  sum(len({word_refs['url']}))::bigint as url_refs from items""",
        "windowed_references": WINDOWS,
        "windowed_references_stream": WINDOWS,
        "window_table_stream": WINDOWS,
        "windowed_reference_lists": WINDOW_LISTS,
        "windowed_reference_lists_stream": WINDOW_LISTS,
        "stream_first_copies": f"with {ITEMS} select {ITEM_COLUMNS} from items",
        "stream_dedupe": f"with {ITEMS} select {ITEM_COLUMNS} from items",
        "time_range": f"with {ITEMS} " + TIME_RANGE,
        "community_stats": f"with {ITEMS} " + COMMUNITY_STATS,
        "author_stats": f"with {ITEMS} " + AUTHOR_STATS,
        "top_authors": f"""with {ITEMS}
select author, count(*) as count from items group by 1 order by 2 desc, 1 limit 5""",
        "top_communities": f"""with {ITEMS}
select subreddit, count(*) as count from items group by 1 order by 2 desc, 1 limit 3""",
        "batch_metrics": METRICS,
        "kpi_cards": f"""with {ITEMS}
select count(*) as total_records, count(*) filter (type = 'post') as posts,
  count(*) filter (type = 'comment') as comments, count(distinct subreddit) as communities,
  count(distinct author) as authors, avg(score) as avg_score, min(score) as min_score,
  max(score) as max_score, min(batch_number) as first_batch, max(batch_number) as last_batch,
  count(*) filter (type = 'post') || ':' || count(*) filter (type = 'comment')
    as post_comment_ratio from items""",
        "batch_history": f"with {ITEMS} select batch_number, {HISTORY} from items group by 1",
        "overall_history": f"with {ITEMS} select 'Overall' as label, {HISTORY} from items",
        "batch_insights": f"""with {ITEMS},
history as (select batch_number, {HISTORY} from items group by 1)
{insight_rows()}""",
        "score_histogram": f"with {ITEMS} " + histogram_sql("items", "score", 30),
        "score_box": f"""with {BOX}
select batch_number, any_value(n_items) as n_items, any_value(min) as min, any_value(q1) as q1,
  any_value(median) as median, any_value(q3) as q3, any_value(max) as max,
  min(value) filter (inside) as lower_whisker, max(value) filter (inside) as upper_whisker,
  count(*) filter (not inside) as outliers from marked group by 1""",
        "cumulative_figures": f"""with {ITEMS}, twelve as (
  select * replace (substr(id, 2)::bigint % 12 as batch_number) from items)
select b.batch_number, count(id) as id_count, count(*) filter (type = 'post') as posts,
  {two_places('avg(score)')} as score_mean, min(score)::double as score_min,
  max(score)::double as score_max, count(distinct author) as author,
  count(distinct subreddit) as subreddit, true as close
from (select distinct batch_number from twelve) b join twelve t on t.batch_number <= b.batch_number
group by 1""",
        "score_outliers": f"""with {BOX}
select batch_number, value, count(*) as n from marked where not inside group by 1, 2""",
        "user_scores": f"with {ITEMS}, {USER_SCORES} select * from user_scores",
        "sample_authors": f"""with {ITEMS}, {USER_SCORES} select * from user_scores
order by md5(author || ':0'), author limit 100""",
        "top_users": f"""with {ITEMS}, {USER_SCORES} {top_users}
order by total_score desc, author limit 10""",
        "avg_score_histogram": f"with {ITEMS}, {USER_SCORES} "
        + histogram_sql("user_scores", "avg_score", 25, 6),
        "activity_levels": f"""with {ITEMS}, {USER_SCORES}
select level_order, ['Single Post', 'Low (2-3)', 'Medium (4-10)', 'High (10+)'][level_order]
  as activity_level, count(*) as authors
from (select case when post_count <= 1 then 1 when post_count <= 3 then 2
  when post_count <= 10 then 3 else 4 end as level_order from user_scores where post_count > 0)
group by 1""",
        "user_summary": f"""with {ITEMS}, {USER_SCORES}
select count(*) as authors, round(avg(post_count), 6) as mean_posts,
  round(avg(avg_score), 6) as mean_avg_score,
  (select author from user_scores order by post_count desc, author limit 1) as most_active,
  max(post_count) as most_posts,
  (select author from user_scores order by total_score desc, author limit 1)
    as highest_scoring, max(total_score) as highest_score from user_scores""",
        "top_contributors": f"""with {ENRICHED_ITEMS}
select author, coalesce(sum(engagement_score), 0)::bigint as engagement from enriched
where author is not null and (select count(distinct author) from enriched) > 1
group by 1 order by 2 desc, 1 limit 8""",
        "clean_text": f"select doc_id, {clean('text')} as clean from documents",
        "clean_pages": f"with {PAGES} select page_id, {clean('text')} as clean from pages_text",
        "sentiment": f"""with {ENRICHED_ITEMS}
select id, sentiment, sentiment_category from enriched""",
        "sentiment_documents": f"""with {ENRICHED_DOCUMENTS}
select doc_id, sentiment, sentiment_category from enriched""",
        "sentiment_distribution": f"""with {ENRICHED_ITEMS}
select sentiment_category, count(*) as count,
  round(100::double * count(*) / sum(count(*)) over (), 6) as percent,
  array_to_string(list_transform(string_split(sentiment_category, '_'),
    lambda w: upper(w[1]) || w[2:]), ' ') as label
from enriched group by 1""",
        "sentiment_histogram": f"with {ENRICHED_ITEMS} "
        + histogram_sql("enriched", "sentiment", 30, 6),
        "topics": f"""with {ENRICHED_ITEMS}
select topic, count(*) as count,
  round(100::double * count(*) / sum(count(*)) over (), 6) as percent
from enriched group by 1""",
        "question_ratio": f"""with {ENRICHED_DOCUMENTS}
select count(*) filter (not has_question) as statements,
  count(*) filter (has_question) as questions,
  round(100::double * count(*) filter (has_question) / count(*), 6) as question_percent,
  round(100::double - 100::double * count(*) filter (has_question) / count(*), 6)
    as statement_percent from enriched""",
        "enriched_text": f"""with {ENRICHED_ITEMS}
select id, text, original_text, length::int as length, word_count::int as word_count, subreddit,
  author, score, sentiment, sentiment_category, topic, has_question, engagement_score
from enriched""",
        "enriched_posts": f"""with {POSTS},
shaped as (select *, coalesce(selftext, '') as body,
  trim(coalesce(title, '') || ' ' || coalesce(selftext, '')) as whole from posts),
{enriched("shaped", "id", f"concat_ws(' ', nullif({clean('title')}, ''), nullif({clean('body')}, ''), nullif({clean('whole')}, ''))", "whole",
          ", subreddit, coalesce(author, '[deleted]') as author, score, "
          "score + 2 * num_comments as engagement_score")}
select id, text, length::int as length, word_count::int as word_count, subreddit, author, score,
  sentiment, sentiment_category, topic, has_question, engagement_score from enriched""",
        "text_complexity": f"""with {ENRICHED_DOCUMENTS}
select word_count::int as word_count, length::int as length, sentiment from enriched""",
        "engagement_points": f"""with {ENRICHED_ITEMS}
select sentiment, engagement_score, word_count::int as word_count from enriched""",
        "meaningful_words": f"""with
cleaned as (select doc_id, {clean('text')} as text from documents),
lists as (select doc_id, {TERM_WORDS} as words from cleaned)
select doc_id, array_to_string(words, ' ') as words, array_to_string({PAIRS}, '|') as pairs
from lists""",
        "top_terms": f"""with {DOCUMENT_TERMS}
select term, count(*) as count from terms where length(term) > 3 group by 1
having count(*) > 1 order by 2 desc, 1 limit 12""",
        "top_phrases": f"""with {DOCUMENT_TERMS}
select term, count(*) as count from phrases group by 1 having count(*) > 1
order by 2 desc, 1 limit 8""",
        "top_terms_items": f"""with {ITEM_TERMS}
select term, count(*) as count from terms group by 1 order by 2 desc, 1 limit 5""",
        "top_phrases_items": f"""with {ITEM_TERMS}
select term, count(*) as count from phrases group by 1 order by 2 desc, 1 limit 3""",
        "unique_terms": f"""with {DOCUMENT_TERMS}
select (select count(distinct term) from terms) as unique_terms,
  (select count(distinct term) from phrases) as unique_phrases""",
        "cumulative_terms": f"""with {DOCUMENT_TERMS}
select * from (select 'term' as kind, term, count(*) as count from terms where length(term) > 3
  group by 2 having count(*) > 1 order by 3 desc, 2 limit 12)
union all select * from (select 'phrase' as kind, term, count(*) as count from phrases
  group by 2 having count(*) > 1 order by 3 desc, 2 limit 8)""",
        "job_history_terms": f"""with {ITEM_TERMS}
select * from (select 'term' as kind, term, count(*) as count from terms
  group by 2 order by 3 desc, 2 limit 5)
union all select * from (select 'phrase' as kind, term, count(*) as count from phrases
  group by 2 order by 3 desc, 2 limit 3)""",
        "engagement_correlation": f"""with {ENRICHED_ITEMS},
c as (select corr(sentiment, engagement_score::double) as s,
  corr(word_count::double, engagement_score::double) as l from enriched
  where engagement_score is not null)
select round(s, 6) as sentiment_corr, round(l, 6) as length_corr,
  case when abs(s) <= 0.1 then 'minimal' when abs(s) <= 0.2 then 'weakly'
    when abs(s) <= 0.3 then 'moderately' else 'strongly' end as sentiment_strength,
  case when s > 0.1 then 'positively' when s < -0.1 then 'negatively' end
    as sentiment_direction,
  case when abs(l) <= 0.1 then 'minimal' when abs(l) <= 0.2 then 'slightly'
    when abs(l) <= 0.3 then 'moderately' else 'strongly' end as length_strength,
  case when l > 0.1 then 'longer' when l < -0.1 then 'shorter' end as length_direction
from c""",
        "text_summary": f"""with {ENRICHED_DOCUMENTS}
select count(*) as entries, round(avg(length), 6) as mean_length,
  round(stddev_samp(length), 6) as std_length, round(avg(word_count), 6) as mean_words,
  round(stddev_samp(word_count), 6) as std_words, round(avg(sentiment), 6) as mean_sentiment,
  round(stddev_samp(sentiment), 6) as std_sentiment, round(min(sentiment), 6) as min_sentiment,
  round(max(sentiment), 6) as max_sentiment from enriched""",
        "tfidf_top_words": f"""with {tfidf_sql('documents')}
select word, score from scores order by score desc, word limit 10""",
        "tfidf_words": f"with {tfidf_sql('documents')} select word, score from scores",
        "plain_tokens": rf"""select doc_id, array_to_string(list_filter(
  regexp_split_to_array(lower(text), '[{ASCII_SPACE}]'),
  lambda w: w <> '' and w not in ({quoted(lexicons.ENGLISH_STOP_WORDS)})), ' ') as words
from documents""",
        "polarity": f"""with {ITEMS}, {polarity_sql('items', 'type, id')}
select type, id, round(polarity, 6) as polarity from polarities""",
        "mean_polarity": f"""with {polarity_sql('documents', 'doc_id')}
select round(avg(polarity), 6) as avg_sentiment from polarities""",
        "batch_files": f"""with {ITEMS}
select (batch_number % 2)::int as batch_number, count(distinct subreddit) as files,
  count(*)::bigint as records from items group by 1""",
        "stored_batches_roundtrip": f"""with {ITEMS}
select {ITEM_COLUMNS}, (batch_number % 2)::int as batch_number from items""",
        "merged_batches": f"""with {ITEMS}
select * replace (score::bigint as score),
  case when batch_number = 0 then (score % 7)::double else score / 4.0::double end as weight,
  case when batch_number = 1 then 'f' || author end as flair
from (select {ITEM_COLUMNS}, (batch_number % 2)::int as batch_number from items)""",
        "current_batch": f"""with {ITEMS}
select {ITEM_COLUMNS}, 1::int as batch_number from items where batch_number % 2 = 1""",
        "job_metrics": METRICS.replace("event_id % 8 as batch_number", "event_id % 4 as batch_number")
        .replace("'2024-01-01 00:00:00' as processing_time, ", "")
        .replace(
            """,
  top_author.author as most_active_author, coalesce(users.m, 0) as user_ref_mentions,
  coalesce(subs.m, 0) as subreddit_ref_mentions, coalesce(urls.m, 0) as url_ref_mentions""",
            ", top_author.author as most_active_author",
        ),
        "job_user_refs": each_batch(mentions("items", REFS["user"], "user_ref")),
        "job_subreddit_refs": each_batch(mentions("items", REFS["subreddit"], "subreddit_ref")),
        "job_url_refs": each_batch(mentions("items", REFS["url"], "url_ref")),
        "job_community_stats": each_batch(COMMUNITY_STATS),
        "job_author_stats": each_batch(AUTHOR_STATS),
        "job_top_words": each_batch(TOP_WORDS),
        "job_history_time_range": f"""with {ITEMS}
select {iso('min(created_utc)', ' ')} as earliest_post,
  {iso('max(created_utc)', ' ')} as latest_post, count(*) as total_items from items""",
        "lean_job_references": each_batch(f"""select
  sum(len({word_refs['user']}))::bigint as user_refs,
  sum(len({word_refs['subreddit']}))::bigint as sub_refs,
  sum(len({word_refs['url']}))::bigint as url_refs from items"""),
        "lean_job_time_range": each_batch(TIME_RANGE),
        "lean_job_authors": each_batch(
            "select author, count(*) as count from items group by 1 order by 2 desc, 1 limit 5"
        ),
        "lean_job_top_words": each_batch(TOP_WORDS),
        "lean_history_time_range": f"with {ITEMS} " + TIME_RANGE,
        "lean_history_top_words": f"""with {ITEMS},
{tfidf_sql('items')}
select word, score from scores order by score desc, word limit 10""",
        "job_history_top_words": f"""with {ITEMS},
{tfidf_sql('items')}
select word, score from scores order by score desc, word limit 10""",
    }

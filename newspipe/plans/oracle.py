"""The registered queries as DuckDB SQL, for comparing results.

The SQL works on the simple markup of the given pages and takes other ways than the
operators where it can: it cuts pages with plain patterns and builds JSON by hand.
"""

from __future__ import annotations

from .views import HIDDEN_HTML, HREF_FORMS, LISTING_HTML, SHOWN_HTML, SITE_HTML

# --- inputs -----------------------------------------------------------------

_UNSEEN = r"(?s)<script>.*?</script>|<style>.*?</style>|<title>.*?</title>|<!--.*?-->"

_SITE = f"""site as (
 select url, coalesce(replace(regexp_replace({SITE_HTML}, '{_UNSEEN}', '', 'g'),
  '{HIDDEN_HTML}', '{SHOWN_HTML}'), '') as page from pages)"""
_LISTING = f"""listing as (
 select page_id, url, regexp_replace({LISTING_HTML}, '{_UNSEEN}', '', 'g') as page from pages)"""



def _news(flag: str = "", join: str = "") -> str:
    return f"""news as (
 select cast(d.doc_id as varchar) as article_id, substring(d.text, 1, 80) as title,
  d.text as description, 'https://news.example.org/' || d.doc_id as link, d.lang as language,
  case when d.doc_id % 4 = 0 then null when d.doc_id % 4 = 1 then cast([] as varchar[])
   else [d.lang, d.source] end as keywords,
  [case when d.doc_id % 2 = 0 then 'crime' else 'top' end, d.source] as category,
  [case when d.doc_id % 3 = 0 then 'us' else 'my' end] as country,
  '{{"n": ' || d.n_chars || '}}' as sentiment_stats, {flag}
  d.doc_id // 100 as fetch_seq, d.doc_id % 100 as pos
 from documents d {join})"""


_NEWS = _news()
_LABELLED = _news("l.toxic = 1 as duplicate,", "left join labels l using (doc_id)")

_API = """lines as (
 select doc_id as fetch_seq, lang, source,
  unnest(string_split(text, chr(10))) as line,
  generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos
 from documents where doc_id % 50 <> 49),
api as (
 select fetch_seq, pos, fetch_seq || '-' || pos as article_id, left(line, 80) as title,
  line as description, 'https://news.example.org/' || fetch_seq || '/' || pos as link,
  lang as language,
  concat_ws(', ', case when (fetch_seq + pos) % 2 = 0 then 'crime' else 'top' end, source) as category,
  case when (fetch_seq + pos) % 3 = 0 then 'us' else 'my' end as country
 from lines)"""
_FAILED = "(select max(doc_id) * 8 // 10 from documents)"

_MESSAGES = """messages as (
 select event_id, event_type as title, props as content,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as "pubDate",
  'https://news.example.org/' || event_id as link,
  nullif(concat_ws(', ', event_type, 'user ' || user_id), '') as category,
  to_json([event_type, 'user ' || user_id]) as category_json
 from events)"""


def _joined(column: str) -> str:
    return f"nullif(array_to_string({column}, ', '), '')"


# --- extraction -------------------------------------------------------------


def _text(piece: str) -> str:
    """Text of a piece of HTML without block elements."""
    text = f"regexp_replace({piece}, '\\s+', ' ', 'g')"
    text = f"regexp_replace({text}, '<br>', chr(10), 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', '', 'g')"
    text = f"replace(replace({text}, '&quot;', chr(34)), '&middot;', '·')"
    text = f"regexp_replace(replace({text}, '&copy;', '©'), '&amp;?', '&', 'g')"
    text = f"regexp_replace(regexp_replace({text}, ' +', ' ', 'g'), ' ?\\n ?', chr(10), 'g')"
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def _paragraphs(scope: str) -> str:
    cut = _text("regexp_extract(p, '(?s)^(.*?)(</p>|\\z)', 1)")
    return f"list_transform(string_split({scope}, '<p>')[2:], lambda p: {cut})"


_HEADLINE = _text("regexp_extract(page, '(?s)<h1>(.*?)</h1>', 1)")
_LENIENT = f"""lenient as (
 select url, {_HEADLINE} as headline,
  case when contains(page, 'author-avatar') then ''
   else nullif(regexp_extract(page, 'class="[^"]*author[^"]*">([^<]*)<', 1), '') end as author,
  nullif(regexp_extract(page, 'published_time" content="([^"]*)"', 1), '') as publish_time,
  array_to_string(list_filter({_paragraphs("regexp_extract(page, '(?s)<article>(.*?)</article>', 1)")},
   lambda t: t <> ''), chr(10)) as article_content
 from site where contains(page, '<h1>'))"""

_WRAPPER = """case when contains(page, 'class="dable-content-wrapper"')
   then regexp_extract(page, '(?s)class="dable-content-wrapper">(.*?)</div>', 1)
  when contains(page, 'class="entry-content"')
   then regexp_extract(page, '(?s)class="entry-content">(.*?)</div>', 1)
  else regexp_extract(page, '(?s)class="article-content wide">(.*?)</div>', 1) end"""
_STRICT = f"""fields as (
 select url, contains(page, '<h1>') as has_headline, contains(page, '<time') as has_time,
  {_HEADLINE} as headline,
  nullif(regexp_extract(page, '<time datetime="([^"]*)"', 1), '') as date_published,
  array_to_string({_paragraphs(_WRAPPER)}, ' ') as article_content
 from site),
strict as (
 select url, headline, date_published, article_content from fields
 where has_headline and has_time and article_content <> '')"""


def _links(pattern: str) -> str:
    """Links of all listings by a pattern whose first group is the target."""
    found = f"regexp_extract_all(page, '{pattern}', 1)"
    return f"""select page_id, url, unnest({found}) as href,
  cast(generate_subscripts({found}, 1) - 1 as integer) as pos from listing"""


_CHAIN = _links(r'<section>\s*<article>\s*<a href="([^"]+)"')
_TOKENS = _links('penci-link-post penci-image-holder penci-disable-lazy" href="([^"]+)"')

def _origin(url: str) -> str:
    return f"regexp_extract({url}, '^([a-z]+://[^/?#]+)', 1)"


def _folder(url: str) -> str:
    path = f"regexp_extract({url}, '^[a-z]+://[^/?#]+([^?#]*)', 1)"
    return f"{_origin(url)} || regexp_extract({path}, '^(.*/)', 1)"


_BASE = f"""case page_id % 4 when 1 then 'https://cdn.example.org/b/c'
  when 2 then {_folder('url')} || 'sub/x?y' when 3 then {_origin('url')} || '/one/' else url end"""
_RESOLVED = f"""case when spelled like 'https://%' then spelled
  when spelled like '//%' then split_part(base, ':', 1) || ':' || spelled
  when spelled like '/%' then {_origin('base')} || spelled
  when spelled like '?%' then regexp_extract(base, '^[^?#]*') || spelled
  else {_folder('base')} || spelled end"""

# --- queries ----------------------------------------------------------------

_LISTS = f"""{_joined('keywords')} as keywords, {_joined('category')} as category,
 {_joined('country')} as country"""

_ABSENT = ", ".join(
    f'cast(null as varchar) as "{name}"'
    for name in (
        "creator", "video_url", "content", "pubDate", "pubDateTZ", "image_url", "source_id",
        "source_priority", "source_name", "source_url", "source_icon", "ai_tag",
        "sentiment", "ai_region", "ai_org",
    )
)

_PROJECTED = f"""title, description as content, cast(null as varchar) as "pubDate", link,
 {_joined('category')} as category"""

_DECODED = f"""with {_MESSAGES} select title, content, "pubDate", link, category from messages"""

ORACLE: dict[str, str] = {
    "scan_pages": "select page_id, url, html from pages",
    "section_urls": """with bases as (
 select page_id, regexp_extract(url, '^[^?#]*') as base_url,
  unnest(generate_series(1, greatest(page_id % 4, 1))) as page from pages)
select page_id, base_url, cast(page as integer) as page,
 base_url || case when page = 1 then '' else 'page/' || page || '/' end as section_url
from bases""",
    "counter_source": "select event_id || ' cats' as value from events",
    "links_child_chain": f"with {_LISTING} {_CHAIN}",
    "links_class_tokens": f"with {_LISTING} {_TOKENS}",
    "links_resolved": f"""with {_LISTING}, found as ({_TOKENS}),
forms as (select page_id, url, pos, {HREF_FORMS} as spelled, {_BASE} as base from found)
select page_id, url, pos, {_RESOLVED} as href from forms""",
    "extract_lenient": f"with {_SITE}, {_LENIENT} select * from lenient",
    "extract_strict": f"with {_SITE}, {_STRICT} select * from strict",
    "extract_rejects": f"""with {_SITE}, {_STRICT}
select url, case when not has_headline then 'no_h1' when not has_time then 'no_time'
 else 'no_content' end as reason
from fields where not (has_headline and has_time and article_content <> '')""",
    "extract_judged": f"""with {_SITE}, {_STRICT}, reasons as (
 select *, case when not has_headline then 'no_h1' when not has_time then 'no_time'
  when article_content = '' then 'no_content' end as reason from fields)
select url, reason, case when reason is null then headline end as headline,
 case when reason is null then date_published end as date_published,
 case when reason is null then article_content end as article_content from reasons""",
    "extract_from_bytes": f"with {_SITE}, {_LENIENT} select * from lenient",
    "count_scrape": f"""with {_SITE}, {_LISTING}, {_LENIENT}, {_STRICT}
select 'lenient articles' as what, count(*) as n from lenient
union all select 'lenient links', count(*) from ({_CHAIN})
union all select 'strict articles', count(*) from strict
union all select 'strict links', count(*) from ({_TOKENS})""",
    "api_fetch_all": f"with {_API} select * from api where fetch_seq < {_FAILED}",
    "api_fetch_by_cursor": f"""with {_API}, gap as (
 select min(d.doc_id) as last from documents d left join documents e on e.doc_id = d.doc_id + 1
 where d.doc_id >= 0 and e.doc_id is null)
select * from api where fetch_seq < {_FAILED} and fetch_seq <= (select last from gap)""",
    "api_filter": f"""with {_NEWS} select article_id, title, link, language from news
where list_contains(category, 'crime') and list_contains(country, 'us') and language = 'en'""",
    "api_project": f"with {_NEWS} select {_PROJECTED} from news",
    "publish_limited": f"""with {_NEWS}, first as (select * from news order by fetch_seq, pos limit 12)
select {_PROJECTED} from first""",
    "publish_prefix": f"""with {_NEWS}, first as (select * from news order by fetch_seq, pos
 limit (select count(*) // 3 from documents))
select {_PROJECTED} from first""",
    "sample_news": f"""with {_NEWS} select fetch_seq, pos, article_id, title, link from news
order by fetch_seq, pos limit 5""",
    "count_news": f"with {_API} select count(*) as n from api where fetch_seq < {_FAILED}",
    "key_union": f"""with {_LABELLED} select distinct unnest(json_keys(to_json(n))) as key
from news n""",
    "fill_missing": f"""with {_NEWS}
select article_id, title, fetch_seq, cast(null as varchar) as link,
 cast(null as varchar) as language from news where category[1] = 'crime'
union all select article_id, null, null, link, language from news where category[1] <> 'crime'""",
    "flatten_lists": f"with {_NEWS} select article_id, {_LISTS}, pos from news",
    "flatten_dicts": f"""with {_NEWS} select article_id, sentiment_stats,
 '{{"title": ' || coalesce(to_json(title), 'null') || ', "pos": ' || pos || ', "languages": [' || coalesce(to_json(language), 'null') || ']}}'
 as nested from news""",
    "news_typed": f"""with {_LABELLED} select article_id, title, link, description, language,
 {_LISTS}, sentiment_stats, duplicate, {_ABSENT} from news""",
    "headline_label": """select doc_id, left(text, 60) as saved, left(text, 60) || '...' as sending
from documents""",
    "wire_encode": f"""with {_MESSAGES} select '{{"title":' || coalesce(to_json(title), 'null')
 || ',"content":' || coalesce(to_json(content), 'null') || ',"pubDate":'
 || coalesce(to_json("pubDate"), 'null') || ',"link":' || coalesce(to_json(link), 'null')
 || ',"category":' || category_json || '}}' as value from messages""",
    "wire_decode": f"""with {_MESSAGES} select title, content, "pubDate", link,
 case coalesce((event_id % 3 + 3) % 3, 0) when 0 then category when 1 then title
  else '{{"type":' || coalesce(to_json(title), 'null') || '}}' end as category
from messages""",
    "wire_decode_rejects": "select event_id || ' cats' as value from events where event_id % 3 = 0",
    "csv_roundtrip_article": """select 'https://news.example.org/' || doc_id as url,
 nullif(left(text, 60), '') as headline,
 case when doc_id % 2 = 1 then lang end as date_published,
 nullif(text, '') as article_content from documents""",
    "csv_roundtrip_news": f"""with {_LABELLED} select article_id, nullif(title, '') as title,
 nullif(description, '') as description, link, language,
 {_LISTS}, sentiment_stats,
 case when duplicate then 'True' when not duplicate then 'False' end as duplicate,
 cast(fetch_seq as varchar) as fetch_seq, cast(pos as varchar) as pos from news""",
    "csv_marked": _DECODED,
    "append_csv": _DECODED,
    "stream_append_csv": _DECODED,
    "stream_judged": f"""with {_MESSAGES}, told as (
 select *, coalesce((event_id % 3 + 3) % 3 = 0, false) as plain from messages)
select not plain as readable, case when not plain then title end as title,
 case when not plain then content end as content,
 case when not plain then "pubDate" end as "pubDate", case when not plain then link end as link,
 case when not plain then category end as category,
 case when plain then event_id || ' cats' end as value from told""",
    "stream_consume": _DECODED,
    "stream_consume_csv": _DECODED,
    "stream_extract_strict": f"with {_SITE}, {_STRICT} select * from strict",
    "stream_api_project": f"""with {_API} select title, description as content,
 cast(null as varchar) as "pubDate", link, category from api where fetch_seq <> {_FAILED}""",
}

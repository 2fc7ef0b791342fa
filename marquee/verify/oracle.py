"""The SQL twin of every registered query, over the same driver tables."""

from __future__ import annotations

import re

from marquee.schemas import STAGING_COLUMNS


def _key(prefix: str, number: str) -> str:
    text = f"cast({number} as varchar)"
    return f"concat('{prefix}', lpad({text}, cast(greatest(7, length({text})) as integer), '0'))"


TRANSLATE_FROM, TRANSLATE_TO = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ", "aaaaaaeeeeiiiiooooouuuuncyy"


def _norm(c: str) -> str:
    plain = f"translate(lower({c}), '{TRANSLATE_FROM}', '{TRANSLATE_TO}')"
    return f"concat(' ', trim(regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"


def _tokens(c: str) -> str:
    return f"list_distinct(list_filter(string_split({_norm(c)}, ' '), lambda t: t <> ''))"


def _trigrams(c: str) -> str:
    words = f"list_filter(string_split({_norm(c)}, ' '), lambda t: t <> '')"
    return (
        f"list_distinct(flatten(list_transform({words}, lambda w: "
        "list_transform(range(1, length(w) + 2), lambda i: substr(concat('  ', w, ' '), i, 3)))))"
    )


def _year(c: str) -> str:
    return f"case when regexp_full_match({c}, '[0-9]{{4}}') then cast({c} as bigint) end"


def _digits(c: str) -> str:
    return f"case when regexp_full_match({c}, '[0-9]+') then cast({c} as bigint) end"


def _list(c: str) -> str:
    return f"string_split(nullif({c}, ''), ',')"


def _cents(c: str) -> str:
    return f"cast(floor({c} * 100 + 0.5) as bigint)"


def _title_columns(kind: str, where: str) -> str:
    return f"""select tconst, {kind} as title_type, primarytitle as primary_title, originaltitle as original_title,
      isadult = '1' as is_adult, {_year('startyear')} as start_year, {_year('endyear')} as end_year,
      {_digits('runtimeminutes')} as runtime_minutes
      from titles_raw where tconst > '' and {where}"""


KEPT = "('movie','short','tvseries','tvepisode','video')"
STAMP = "strftime(ts, '%Y-%m-%d_%H-%M-%S')"
LABEL = "strftime(ts, '%Y%m%d-%H%M%S')"
KIND = "case event_type when 'purchase' then 'full' when 'signup' then 'diff' else 'incr' end"
LONG = "case type when 'full' then 'completo' when 'incr' then 'incremental' when 'diff' then 'diferencial' end"
LONG_EVENT = "case event_type when 'purchase' then 'completo' when 'signup' then 'diferencial' else 'incremental' end"

CTES = {
    "titles_raw": f"""select {_key('tt', 'o_orderkey')} as tconst,
      case o_orderpriority when '1-URGENT' then 'movie' when '2-HIGH' then 'tvSeries' when '3-MEDIUM' then 'tvEpisode'
        when '4-NOT SPECIFIED' then 'tvMovie' else 'videoGame' end as titletype,
      concat('The ', monthname(o_orderdate), ' ', lower(substr(o_orderpriority, 3)), ' ', o_custkey) as primarytitle,
      concat(monthname(o_orderdate), ' ', lower(substr(o_orderpriority, 3)), ' ', o_custkey) as originaltitle,
      case when o_totalprice < 10000 then '1' else '0' end as isadult,
      case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then '19x4'
        else cast(year(o_orderdate) as varchar) end as startyear,
      case o_orderkey % 4 when 1 then cast(year(o_orderdate) + 2 as varchar) when 2 then '20' end as endyear,
      case when o_orderkey % 17 = 0 then 'n/a' else cast(60 + o_orderkey % 120 as varchar) end as runtimeminutes,
      case when o_orderkey % 19 = 0 then null when o_orderkey % 23 = 0 then ''
        when o_orderkey % 3 = 0 then concat_ws(',', monthname(o_orderdate), dayname(o_orderdate))
        else monthname(o_orderdate) end as genres from orders""",
    "names_raw": f"""select {_key('nm', 'c_custkey')} as nconst,
      case when c_acctbal < 0 then '  ' else concat(' Person ', cast(c_custkey // 2 as varchar)) end as primaryname,
      case when c_custkey % 7 = 0 then null else cast(1900 + c_custkey % 100 as varchar) end as birthyear,
      case when c_custkey % 5 = 0 then cast(1980 + c_custkey % 40 as varchar) end as deathyear, c_mktsegment as primaryprofession,
      case c_custkey % 3 when 0 then concat({_key('tt', 'c_custkey')}, ',', {_key('tt', '(c_custkey + 1)')})
        when 1 then {_key('tt', 'c_custkey')} end as knownfortitles
      from customer""",
    "ratings_raw": f"""select {_key('tt', 'o_orderkey')} as tconst,
      concat(cast(1 + (o_orderkey * 7) % 9 as varchar), '.', cast(o_orderkey % 10 as varchar)) as averagerating,
      cast(cast(floor(o_totalprice) as bigint) as varchar) as numvotes from orders where o_orderstatus <> 'P'
      union all select {_key('tx', 'c_custkey')}, '5.0', '10' from customer""",
    "crew_raw": f"""select {_key('tt', 'o_orderkey')} as tconst,
      case when o_orderkey % 9 = 0 then null when o_orderkey % 5 = 0
        then concat({_key('nm', 'o_custkey')}, ',', {_key('nm', '(o_custkey + 1)')}) else {_key('nm', 'o_custkey')} end as directors,
      case when o_orderkey % 2 = 0 then null else {_key('nm', '(o_custkey + 3)')} end as writers from orders""",
    "principals_raw": f"""select {_key('tt', 'l_orderkey')} as tconst, cast(l_linenumber as varchar) as ordering,
      {_key('nm', 'l_partkey')} as nconst,
      case l_returnflag when 'A' then 'actor' when 'N' then 'actress' else 'producer' end as category,
      case when l_linestatus = 'O' then 'line' end as job,
      case when l_returnflag in ('A', 'N') then concat('["Role ', l_linenumber, '","Alt"]') end as characters
      from lineitem""",
    "episodes_raw": f"""select {_key('tt', 'o_orderkey')} as tconst, {_key('tt', '(o_orderkey // 2)')} as parenttconst,
      case when o_orderkey % 8 = 0 then null else cast(1 + o_orderkey % 9 as varchar) end as seasonnumber,
      case when o_orderkey % 10 = 0 then 'x1' else cast(o_orderkey % 40 as varchar) end as episodenumber
      from orders where o_orderpriority = '3-MEDIUM'""",
    "akas_raw": f"""select {_key('tt', 'l_orderkey')} as titleid, cast(l_linenumber as varchar) as ordering,
      concat('Aka ', cast(l_partkey as varchar)) as title,
      case l_linenumber % 4 when 0 then 'US' when 1 then 'FR' when 2 then 'NA' end as region,
      case when l_linestatus = 'O' then 'fr' end as language,
      case l_linenumber % 3 when 0 then 'working' when 1 then 'festival,dvd' end as types,
      case when l_linenumber % 2 = 0 and l_linestatus = 'F' then 'short title' end as attributes, case when l_linenumber = 1 then '1' else '0' end as isoriginaltitle
      from lineitem""",
    "titles": _title_columns("lower(titletype)", f"lower(titletype) in {KEPT}"),
    "people": f"""select * from (select nconst, nullif(trim(primaryname), '') as primary_name,
      {_year('birthyear')} as birth_year, {_year('deathyear')} as death_year from names_raw where nconst > '')
      where primary_name is not null""",
    "ratings": """select r.tconst, cast(averagerating as decimal(3,1)) as average_rating, cast(numvotes as bigint) as num_votes
      from ratings_raw r where r.tconst in (select tconst from titles)""",
    "genre_rows": f"""select tconst, unnest({_list('genres')}) as genre_name,
      unnest(range(1, len({_list('genres')}) + 1)) as genre_order from titles_raw where genres is not null""",
    "genres": """select row_number() over (order by genre_name) as genre_id, genre_name
      from (select distinct genre_name from genre_rows)""",
    "title_genres": """select r.tconst, g.genre_id, cast(r.genre_order as bigint) as genre_order from genre_rows r
      join genres g on g.genre_name = r.genre_name where r.tconst in (select tconst from titles)""",
    "categories": """select row_number() over (order by category) as category_id, category as category_name
      from (select distinct category from principals_raw where category is not null and category <> '\\N')""",
    "title_principals": """select p.tconst, cast(p.ordering as bigint) as ordering, p.nconst, c.category_id,
      nullif(p.job, '\\N') as job, nullif(p.characters, '\\N') as characters from principals_raw p
      join categories c on c.category_name = p.category where p.tconst in (select tconst from titles)
      and p.nconst in (select nconst from people)""",
    "crew_rows": f"""select tconst, unnest({_list('directors')}) as nconst, 'director' as crew_type from crew_raw
      where directors is not null
      union all select tconst, unnest({_list('writers')}), 'writer' from crew_raw where writers is not null""",
    "title_crew": """select r.tconst, r.nconst, r.crew_type from crew_rows r
      where r.tconst in (select tconst from titles) and r.nconst in (select nconst from people)""",
    "episodes": f"""select e.tconst as episode_tconst, e.parenttconst as parent_tconst,
      {_digits('seasonnumber')} as season_number, {_digits('episodenumber')} as episode_number from episodes_raw e
      where e.tconst in (select tconst from titles) and e.parenttconst in (select tconst from titles)""",
    "title_doc": f"""select t.tconst, titletype, primarytitle, {_year('startyear')} as startyear,
      {_digits('runtimeminutes')} as runtimeminutes, coalesce(nullif(genres, ''), '') as genres,
      cast(averagerating as double) as average, cast(numvotes as bigint) as votes, directors, writers,
      c.tconst is not null as has_crew
      from titles_raw t left join ratings_raw r on r.tconst = t.tconst left join crew_raw c on c.tconst = t.tconst""",
    "directing": f"select tconst, unnest({_list('directors')}) as nconst, unnest(range(len({_list('directors')}))) as pos from crew_raw where directors is not null",
    "cast_rows": """select tconst, cast(ordering as integer) as ordering, nconst, category, job, characters,
      case when characters is null then '' else concat_ws('/', unnest_1, 'Alt') end as roles from (
        select *, concat('Role ', ordering) as unnest_1 from principals_raw)""",
    "hit": f"select min(tconst) as tconst from titles_raw where contains({_norm('primarytitle')}, ' october urgent ')",
    "old_v": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderdate < timestamp '2000-01-01'",
    "new_v": """select o_orderkey, o_custkey, o_orderstatus,
      case when o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end as o_totalprice
      from orders where not (o_orderstatus = 'F' and o_orderpriority = '5-LOW')""",
    "sparse_v": """select l_orderkey as o_orderkey, case when l_returnflag = 'A' then l_partkey end as o_custkey,
      case when l_returnflag = 'N' then l_linestatus end as o_orderstatus,
      case when l_linestatus = 'O' then l_extendedprice end as o_totalprice, l_linenumber, l_partkey, l_suppkey from lineitem""",
    "snaps": f"""select event_id, user_id as stanza, ts, {KIND} as type, value,
      concat({LABEL}, case event_type when 'purchase' then 'F' when 'signup' then 'D' else 'I' end, '-',
             cast(event_id as varchar)) as label from events""",
    "records": f"""select concat('backup:', {STAMP}) as key, strftime(ts, '%Y-%m-%d') as fecha, strftime(ts, '%H:%M:%S') as hora,
      {LONG} as tipo_backup, concat('/var/lib/backup/', stanza, '/', label) as direccion_almacenamiento,
      'primary' as maestro_usado, 'snapshot' as metodo, cast(stanza as varchar) as stanza, ts, label, event_id from snaps""",
    "log_rows": f"""select user_id as file, event_id * 2 as line_no, 'start' as kind, {LONG_EVENT} as type,
      epoch(date_trunc('second', ts)) as moment from events
      union all select user_id, event_id * 2 + 1, 'end', {LONG_EVENT},
      epoch(date_trunc('second', ts)) + floor(abs(value)) from events where event_type <> 'error'""",
}

NAMES_AGG = """select d.tconst, string_agg(primaryname, ';' order by pos) as names from directing d
  join names_raw n on n.nconst = d.nconst group by d.tconst"""

TOP = "select {cols} from (select nconst, count(*) as cantidad from {src} group by nconst order by cantidad desc, nconst limit {n}) c left join names_raw n on n.nconst = c.nconst"
ACTOR_COLS = "c.nconst, n.primaryname as nombre_actor, cantidad as cantidad_apariciones"
DIRECTOR_COLS = "c.nconst, n.primaryname as nombre_director, cantidad as cantidad_obras"

CHAIN = """select s.stanza, s.event_id, s.label,
  case when s.ts = f.full_ts and type = 'full' then 'full' when s.ts = d.diff_ts and type = 'diff' then 'diff'
       when type = 'incr' and s.ts > coalesce(d.diff_ts, f.full_ts) then 'incr' end as role
  from {src} s join (select stanza, max(ts) as full_ts from {src} where type = 'full' group by stanza) f on f.stanza = s.stanza
  left join (select x.stanza, max(x.ts) as diff_ts from {src} x
    join (select stanza, max(ts) as full_ts from {src} where type = 'full' group by stanza) y on y.stanza = x.stanza
    where x.type = 'diff' and x.ts >= y.full_ts group by x.stanza) d on d.stanza = s.stanza
  where s.ts >= f.full_ts"""

DIFF = """select case when o.o_orderkey is null then 'insert' when n.o_orderkey is null then 'delete' else 'update' end as op,
  coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, n.o_custkey, n.o_orderstatus, {cents} as o_totalprice
  from old_v o full join new_v n on n.o_orderkey = o.o_orderkey
  where o.o_orderkey is null or n.o_orderkey is null or o.o_custkey is distinct from n.o_custkey
    or o.o_orderstatus is distinct from n.o_orderstatus or o.o_totalprice is distinct from n.o_totalprice"""

RANKED_PEOPLE = """select c.nconst, p.primaryname as nombre, c.cantidad from (
    select nconst, count(*) as cantidad from {src} group by nconst order by cantidad desc, nconst limit 25) c
  left join names_raw p on p.nconst = c.nconst"""

NAME_TRIGRAMS = f"select tconst, primarytitle, {_trigrams('primarytitle')} as g from titles_raw"
PART_TRIGRAMS = f"select p_partkey, p_name, {_trigrams('p_name')} as g from part"


def _line(columns: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(replace({c}, ' ', '\\t'), '\\N')" for c in columns) + ")"


TSV_FIELD = "coalesce(replace({c}, ' ', '~'), null) as {c}"
TITLE_FIELDS = ["tconst", "titletype", "primarytitle", "originaltitle", "isadult", "startyear", "endyear", "runtimeminutes", "genres"]
COUNTED = ["titles", "people", "ratings", "genres", "title_genres", "categories", "title_principals", "title_crew", "episodes"]


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(f"select '{n}' as tabla, count(*) as total from {src}" for n, src in tables.items())


def _collapse(src: str, key: str, order: list[str], columns: list[str]) -> str:
    rank = ", ".join(f"'o{i}': {o}" for i, o in enumerate(order))
    picks = [f"(max({{{rank}, 'v': {c}}}) filter ({c} is not null)).v as {c}" for c in columns]
    return f"select {key}, {', '.join(picks)} from {src} group by {key}"


def _paged(size: int) -> str:
    """Cast rows with the page their ordering lies on and their place there."""
    return f"""(select *, (ordering - 1) // {size} as page, row_number() over (partition by tconst, (ordering - 1) // {size}
      order by ordering, nconst, category, job nulls first, roles) - 1 as pos from cast_rows)"""


def _embed_principals(size: int) -> str:
    return f"""select t.tconst, c.page::bigint as page, c.pos::bigint as pos, t.titletype as "titleType", cast(c.ordering as bigint) as ordering,
      c.nconst, c.category, c.job, c.roles as characters from titles_raw t join {_paged(size)} c on c.tconst = t.tconst"""


def _ranked_principals(size: int) -> str:
    """Cast rows without an ordering or with a repeated one, paged by their rank in the title."""
    return f"""select t.tconst, (c.r - 1) // {size} as page, (c.r - 1) % {size} as pos, t.titletype as "titleType", cast(c.place as bigint) as ordering,
      c.nconst, c.category, c.job, c.roles as characters from titles_raw t join (
        select *, row_number() over (partition by tconst order by place nulls first, nconst, category, job nulls first, roles) as r
        from (select *, case ordering % 3 when 0 then null when 1 then 9 else ordering end as place from cast_rows)) c
      on c.tconst = t.tconst"""


def _title_documents(size: int) -> str:
    return f"""select t.tconst, p.page, titletype as "titleType", startyear as "startYear", genres, votes,
      case when has_crew then cast(coalesce(len({_list('directors')}), 0) as bigint) end as directors,
      p.n as principals, e.parenttconst as parent_tconst from title_doc t
      join (select tconst, page, sum(n)::bigint as n from (
          select tconst, ((ordering::bigint) - 1) // {size} as page, 1 as n from principals_raw
          union all select tconst, 0, 0 from titles_raw) group by tconst, page) p on p.tconst = t.tconst
      left join episodes_raw e on e.tconst = t.tconst"""


def _film_card(size: int) -> str:
    return f"""select t.tconst, 0::bigint as page, 'film' as section, unnest(range(4)) as pos,
        unnest([primarytitle, coalesce(cast(startyear as varchar), '?'), coalesce(cast(average as varchar), '?'), genres]) as a,
        unnest([titletype, coalesce(cast(runtimeminutes as varchar), '?'), coalesce(cast(votes as varchar), '?'),
        coalesce(names, '')]) as b from title_doc t left join ({NAMES_AGG}) dn on dn.tconst = t.tconst
        where t.tconst in (select tconst from hit)
      union all select c.tconst, c.page, 'cast', c.pos, n.primaryname, c.roles from {_paged(size)} c
        left join names_raw n on n.nconst = c.nconst where c.tconst in (select tconst from hit)
      union all select titleid, page, 'aka', row_number() over (partition by page order by o, title, region nulls first) - 1, title, region
        from (select *, ordering::bigint as o, (ordering::bigint - 1) // {size} as page from akas_raw
              where titleid in (select tconst from hit))"""


def _film_search(size: int) -> str:
    return f"""select t.tconst, r.page, t.startyear as year, t.average as rating, t.votes, t.genres, t.score, r.kind, r.pos, r.text from (
        select *, cast(len(list_intersect({_tokens('primarytitle')}, ['may', 'specified'])) as bigint) as score from title_doc) t
      join (select d.tconst, 0::bigint as page, 'title' as kind, 0::bigint as pos, concat(d.primarytitle, '/', coalesce(dn.names, '')) as text
          from title_doc d left join ({NAMES_AGG}) dn on dn.tconst = d.tconst
        union all select p.tconst, p.page, 'actor', row_number() over (partition by p.tconst, p.page order by p.pos) - 1, n.primaryname
          from (select tconst, page, nconst, min(pos) as pos from {_paged(size)} group by all) p
          join names_raw n on n.nconst = p.nconst) r on r.tconst = t.tconst where t.score > 0"""


RAW = {"title_basics": "titles_raw", "name_basics": "names_raw", "title_ratings": "ratings_raw", "title_crew": "crew_raw",
       "title_principals": "principals_raw", "title_episode": "episodes_raw", "title_akas": "akas_raw"}
# Every reference of the star schema, over children as they are before cleaning and dimensions with gaps.
LISTED = "(select r.tconst, g.genre_id from genre_rows r join genres g on g.genre_name = r.genre_name)"
BILLED = "(select p.tconst, p.nconst, c.category_id from principals_raw p join categories c on c.category_name = p.category)"
REFERENCES = [
    ("ratings", "tconst", "tconst", "ratings_raw", "titles", "tconst"),
    ("episodes", "episode_tconst", "tconst", "episodes_raw", "titles", "tconst"),
    ("episodes", "parent_tconst", "parenttconst", "episodes_raw", "titles", "tconst"),
    ("title_genres", "tconst", "tconst", LISTED, "titles", "tconst"),
    ("title_genres", "genre_id", "genre_id", LISTED, "(select * from genres where genre_id % 4 <> 0)", "genre_id"),
    ("title_principals", "tconst", "tconst", BILLED, "titles", "tconst"),
    ("title_principals", "nconst", "nconst", BILLED, "people", "nconst"),
    ("title_principals", "category_id", "category_id", BILLED, "(select * from categories where category_id <> 2)", "category_id"),
    ("title_crew", "tconst", "tconst", "crew_rows", "titles", "tconst"),
    ("title_crew", "nconst", "nconst", "crew_rows", "people", "nconst"),
]
GONE_TITLES = "(select tconst from titles where title_type = 'tvseries')"
GONE_PEOPLE = "(select nconst from people where birth_year >= 1990)"

BODIES = {
    "tsv_rows": "select " + ", ".join(TSV_FIELD.format(c=c) for c in TITLE_FIELDS) + " from titles_raw where isadult <> '1' and not ends_with(tconst, '9')",
    "tsv_rejects": f"""select {_line(TITLE_FIELDS[:-1])} as value, cast(8 as bigint) as fields from titles_raw where isadult = '1'
      union all select concat({_line(TITLE_FIELDS)}, '|more'), cast(10 as bigint) from titles_raw
      where isadult <> '1' and ends_with(tconst, '9')""",
    "tsv_extra_na": "select * replace (nullif(region, 'NA') as region) from akas_raw",
    "staging_files": f"""select 'title_basics' as table, count(*) as rows, count(genres) as filled, sum(length(primarytitle))::bigint as letters
        from titles_raw union all
      select 'title_akas', count(*), count(region), sum(length(title) + 5)::bigint from akas_raw union all
      select 'title_ratings', 0, 0, null::bigint""",
    "staging_append": "select cast(2 * count(*) as bigint) as rows, count(distinct tconst) as keys from ratings_raw",
    "literal_regions": """select t.r_name, t.area, count(*) as nations from (values ('AFRICA', 'south'), ('ASIA', 'east'), ('EUROPE', 'north'))
      as t(r_name, area) join region r on r.r_name = t.r_name join nation n on n.n_regionkey = r.r_regionkey group by 1, 2""",
    "key_page": "select nconst from names_raw where nconst > 'nm0000100' order by nconst limit 50",
    "key_range": "select tconst, titletype from titles_raw where tconst > 'tt0000100' and tconst <= 'tt0000900'",
    "titles_clean": "select * from titles",
    "titles_clean_all_types": _title_columns(
        "case lower(titletype) when 'tvmovie' then 'tvMovie' else lower(titletype) end",
        "lower(titletype) in ('movie','short','tvseries','tvepisode','video','tvmovie','tvshort','tvminiseries','tvspecial')"),
    "people_clean": "select * from people",
    "ratings_clean": "select tconst, cast(average_rating as double) as average_rating, num_votes from ratings",
    "genres_dim": "select * from genres",
    "title_genres_bridge": "select * from title_genres",
    "categories_dim": "select * from categories",
    "title_principals_bridge": "select * from title_principals",
    "title_crew_bridge": "select * from title_crew",
    "episodes_clean": "select * from episodes",
    "akas_table": "select titleid, cast(ordering as bigint) as ordering, title, region, language, types, attributes, "
                  "isoriginaltitle = '1' as is_original_title from akas_raw",
    "table_counts": _counts({**{t: t for t in COUNTED}, "akas": "akas_raw"}),
    "director_info": """select p.nconst, p.primary_name, p.birth_year, p.death_year, count(distinct t.tconst) as total_movies
      from people p join title_crew c on c.nconst = p.nconst join titles t on t.tconst = c.tconst
      where p.primary_name = 'Person 10' and c.crew_type = 'director' and t.title_type in ('movie', 'tvMovie')
      group by all""",
    "director_movies": """select t.tconst, t.primary_title, t.start_year, t.runtime_minutes,
      cast(r.average_rating as double) as average_rating, r.num_votes,
      string_agg(g.genre_name, ', ' order by tg.genre_order, g.genre_name) as genres
      from people p join title_crew c on c.nconst = p.nconst join titles t on t.tconst = c.tconst
      left join ratings r on r.tconst = t.tconst left join title_genres tg on tg.tconst = t.tconst
      left join genres g on g.genre_id = tg.genre_id
      where p.primary_name = 'Person 10' and c.crew_type = 'director' and t.title_type in ('movie', 'tvMovie')
      group by t.tconst, t.primary_title, t.start_year, t.runtime_minutes, r.average_rating, r.num_votes
      order by t.start_year desc nulls first, r.average_rating desc nulls first, t.tconst""",
    "embed_rating": "select tconst, average, votes from title_doc",
    "embed_crew": "select tconst, case when has_crew then coalesce(directors, '') end as directors, "
                  "case when has_crew then coalesce(writers, '') end as writers from title_doc",
    "embed_principals": _embed_principals(10_000),
    "embed_principals_paged": _embed_principals(3),
    "embed_principals_ranked": _ranked_principals(3),
    "title_documents": _title_documents(10_000),
    "title_documents_paged": _title_documents(3),
    "documents_loaded_twice": _title_documents(10_000),
    "film_card": _film_card(10_000),
    "film_card_paged": _film_card(3),
    "catalogue_film_card": _film_card(10_000),
    "film_search": _film_search(10_000),
    "film_search_paged": _film_search(3),
    "catalogue_film_search": _film_search(10_000),
    "embed_episode": f"""select t.tconst, e.parenttconst as parent_tconst, {_digits('seasonnumber')} as season_number,
      {_digits('episodenumber')} as episode_number from titles_raw t left join episodes_raw e on e.tconst = t.tconst""",
    "people_documents": f"""select nconst, primaryname as "primaryName", {_year('birthyear')} as "birthYear",
      coalesce(primaryprofession, '') as professions, cast(coalesce(len(string_split(knownfortitles, ',')), 0) as bigint) as known_for from names_raw""",
    "json_records": f"""select concat('{{"nconst":"', nconst, '","primaryName":"', primaryname, '"',
      case when birthyear is null then '' else concat(',"birthYear":', {_year('birthyear')}) end,
      case when deathyear is null then '' else concat(',"deathYear":', {_year('deathyear')}) end,
      ',"primaryProfession":["', primaryprofession, '"],"knownForTitles":[',
      case when knownfortitles is null then '' else concat('"', replace(knownfortitles, ',', '","'), '"') end, ']}}') as value from names_raw""",
    "collapse_last_non_null": _collapse(
        "(select * replace (cast(ordering as bigint) as ordering) from principals_raw)", "tconst", ["ordering", "nconst"],
        ["ordering", "nconst", "category", "job", "characters"]),
    "collapse_akas": _collapse(
        "(select * replace (cast(ordering as bigint) as ordering) from akas_raw)", "titleid", ["ordering", "title"],
        ["ordering", "title", "region", "language", "types", "attributes", "isoriginaltitle"]),
    "character_lists": """select category, roles as as_json, roles as as_split,
      cast(case when roles = '' then 0 else 2 end as bigint) as n, count(*) as rows from cast_rows group by all""",
    "crew_positions": f"""select tconst, cast(len(d) as bigint) as n, d[1] as first, d[2] as second,
      case when len(d) > 1 then cast(list_position(d, d[2]) - 1 as bigint) end as second_at,
      array_to_string(list_transform(d, lambda x: substr(x, 3)), ',') as numbers
      from (select tconst, {_list('directors')} as d from title_doc) where len(d) > 0""",
    "director_works": """select t.primarytitle as titulo, t.startyear as ano, t.titletype as tipo
      from (select distinct tconst, nconst from directing) d join names_raw n on n.nconst = d.nconst
      join title_doc t on t.tconst = d.tconst where n.primaryname = ' Person 10'""",
    "director_works_titles": """select tconst, primarytitle as title, startyear as year, average as rating, genres from title_doc
      where tconst in (select d.tconst from directing d join names_raw n on n.nconst = d.nconst where n.primaryname = ' Person 10')""",
    "top_rated": """select tconst, primarytitle as titulo, average, votes, startyear as ano from title_doc
      where titletype = 'movie' and votes >= 200000 order by average desc, votes desc, tconst limit 10""",
    "top_rated_details": f"""select t.tconst, primarytitle as title, startyear as year, average as rating, votes,
      coalesce(names, '') as directors, genres from (select * from title_doc where titletype = 'movie' and votes >= 100000
      order by average desc, votes desc, tconst limit 10) t left join ({NAMES_AGG}) dn on dn.tconst = t.tconst""",
    "top_directors": TOP.format(cols=DIRECTOR_COLS, src="directing", n=1),
    "top_directors_films": TOP.format(
        cols=DIRECTOR_COLS, n=1, src="(select d.nconst from directing d join titles_raw t on t.tconst = d.tconst where t.titletype = 'movie')"),
    "maintained_directors": RANKED_PEOPLE.format(src="directing"),
    "maintained_actors": RANKED_PEOPLE.format(src="(select p.nconst from principals_raw p join titles_raw t on t.tconst = p.tconst where category in ('actor', 'actress'))"),
    "top_actors": TOP.format(cols=ACTOR_COLS, n=10, src="(select p.nconst from principals_raw p join titles_raw t on t.tconst = p.tconst where category in ('actor', 'actress'))"),
    "top_actors_films": TOP.format(cols=ACTOR_COLS, n=10, src="(select p.nconst from principals_raw p join titles_raw t on t.tconst = p.tconst where category = 'actor' and t.titletype = 'movie')"),
    "top_actors_staging": TOP.format(cols=ACTOR_COLS, n=10, src="(select p.nconst from principals_raw p join titles_raw t on t.tconst = p.tconst where category in ('actor', 'actress'))"),
    "phrase_search": f"select tconst, primarytitle from titles_raw where contains({_norm('primarytitle')}, ' october urgent ')",
    "phrase_search_documents": f"select doc_id, lang from documents where contains({_norm('text')}, ' of the ')",
    "token_search": f"""select tconst, primarytitle, cast(len(list_intersect({_tokens('primarytitle')}, ['may', 'specified'])) as bigint) as score
      from titles_raw where len(list_intersect({_tokens('primarytitle')}, ['may', 'specified'])) > 0""",
    "token_search_documents": f"""select * from (select doc_id,
      cast(len(list_intersect({_tokens('text')}, ['the', 'entre', 'ou'])) as bigint) as score from documents) where score > 0""",
    "index_phrase_search": f"select tconst, primarytitle from titles_raw where contains({_norm('primarytitle')}, ' october urgent ')",
    "index_phrase_after_changes": f"select tconst, primarytitle from titles_raw where contains({_norm('primarytitle')}, ' october urgent ')",
    "index_token_search": f"""select tconst, primarytitle, cast(len(list_intersect({_tokens('primarytitle')}, ['may', 'specified'])) as bigint) as score
      from titles_raw where len(list_intersect({_tokens('primarytitle')}, ['may', 'specified'])) > 0""",
    "index_token_search_documents": f"""select * from (select doc_id,
      cast(len(list_intersect({_tokens('text')}, ['the', 'entre', 'ou'])) as bigint) as score from documents) where score > 0""",
    "index_word_frequencies": f"""select token, cast(count(*) as bigint) as df from (
      select unnest(list_distinct({_tokens('primarytitle')})) as token from titles_raw where tconst is not null)
      where token in ('october', 'urgent', 'may', 'specified', 'nowhere') group by token""",
    "ilike_search": "select tconst, primarytitle from titles_raw where primarytitle ilike '%R URG%'",
    "aka_lookup": """select tconst, primarytitle as "primaryTitle" from titles_raw
      where tconst in (select titleid from akas_raw where title = 'Aka 42')""",
    "trigram_similarity": f"""select * from (select p_partkey, p_name,
      cast(floor(len(list_intersect(g, w)) / (len(g) + len(w) - len(list_intersect(g, w))) * 1000000 + 0.5) as bigint) as similarity
      from ({PART_TRIGRAMS}), (select {_trigrams("'red widgets'")} as w)) where similarity >= 400000""",
    "trigram_terms": f"""select tconst, primarytitle, term,
      cast(floor(len(list_intersect(g, w)) / (len(g) + len(w) - len(list_intersect(g, w))) * 1000000 + 0.5) as bigint) as similarity
      from ({NAME_TRIGRAMS}), (select distinct titulo as term, {_trigrams('titulo')} as w from (
        select primarytitle as titulo from title_doc where titletype = 'movie' and votes >= 200000
        order by average desc, votes desc, tconst limit 10))
      where len(list_intersect(g, w)) / (len(g) + len(w) - len(list_intersect(g, w))) >= 0.7""",
    "upsert_replace": f"""select o_orderkey, o_custkey, o_orderstatus, {_cents('o_totalprice')} as o_totalprice from (
      select * from new_v union all select * from old_v where o_orderkey not in (select o_orderkey from new_v))""",
    "insert_ignore": f"""select o_orderkey, o_custkey, o_orderstatus, {_cents('o_totalprice')} as o_totalprice from (
      select * from old_v union all select l_orderkey, r.a, 'X', r.b from (
        select l_orderkey, min({{'a': l_partkey, 'b': cast(l_suppkey as double)}}) as r from lineitem group by 1)
        where l_orderkey not in (select o_orderkey from old_v))""",
    "upsert_sparse": f"""select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, coalesce(n.o_custkey, o.o_custkey) as o_custkey,
      coalesce(n.o_orderstatus, o.o_orderstatus) as o_orderstatus,
      {_cents('coalesce(n.o_totalprice, o.o_totalprice)')} as o_totalprice from old_v o full join (
      {_collapse('sparse_v', 'o_orderkey', ['l_linenumber', 'l_partkey', 'l_suppkey'], ['o_custkey', 'o_orderstatus', 'o_totalprice'])}
      ) n on n.o_orderkey = o.o_orderkey""",
    "update_matched": f"""select o.o_orderkey, o.o_custkey, o.o_orderstatus,
      {_cents('case when n.o_orderkey is not null then n.o_totalprice else o.o_totalprice end')} as o_totalprice
      from old_v o left join (select * from new_v where o_orderstatus = 'P') n on n.o_orderkey = o.o_orderkey""",
    "batches_fold": """select o.o_orderkey, o.o_custkey, coalesce(u.r.p, cast(floor(o.o_totalprice) as bigint)) as price
      from orders o left join (select o2.o_orderkey, max({'y': year(l_shipdate), 'p': cast(floor(l_extendedprice) as bigint)}) as r
        from lineitem join orders o2 on o2.o_orderkey = l_orderkey
        where l_returnflag <> 'N' and year(l_shipdate) >= year(o2.o_orderdate) group by 1) u on u.o_orderkey = o.o_orderkey""",
    "audit_stamp": """select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, case when n.o_orderkey is null then o.o_orderstatus
        else n.o_orderstatus end as o_orderstatus,
      cast(case when o.o_orderkey is null then 2002 else 2001 end as bigint) as created,
      cast(case when n.o_orderkey is null then 2001 when o.o_orderkey is null then 2002
        when (o.o_custkey, o.o_orderstatus, o.o_totalprice) is distinct from (n.o_custkey, n.o_orderstatus, n.o_totalprice)
        then 2002 else 2001 end as bigint) as updated
      from old_v o full join new_v n on n.o_orderkey = o.o_orderkey""",
    "publish_star": _counts({**{t: t for t in COUNTED}, "akas": "akas_raw"}),
    "layout_partitioned": "select title_type, count(*) as rows, min(tconst) as low, max(tconst) as high from titles group by 1",
    "staging_continued": "select tconst, primarytitle as title, length(primarytitle) as letters from titles_raw",
    "layout_curve": """select 'top' as part, tconst, year, votes from (
        select tconst, startyear as year, votes from title_doc where titletype = 'movie' and votes >= 200000
        order by average desc, votes desc, tconst limit 10)
      union all select 'year', tconst, startyear, votes from title_doc where startyear = 2001
      union all select 'unknown', tconst, startyear, votes from title_doc where startyear is null and votes < 100000""",
    "stream_upsert": _collapse(
        """(select user_id, ts, event_id, case when event_type <> 'error' then event_type end as event_type,
        case when value > 0 then cast(floor(value) as bigint) end as value from events)""",
        "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"]),
    "stream_levels": _collapse(
        """(select user_id, ts, event_id, event_id % 10 as batch, case when event_type <> 'error' then event_type end as event_type,
        case when value > 0 then cast(floor(value) as bigint) end as value from events)""",
        "user_id", ["batch", "ts", "event_id"], ["event_id", "event_type", "value"]),
    "pk_duplicates": "select tconst, ordering, count(*) as rows from principals_raw group by 1, 2 having count(*) > 1",
    "null_violations": " union all ".join(
        f"select '{c}' as column, count(*) filter ({c} is null) as rows from titles_raw" for c in ["tconst", "startyear", "endyear", "genres"]),
    "enum_violations": """select titletype as value, count(*) as rows from titles_raw where titletype not in
      ('movie','short','tvseries','tvepisode','video','tvMovie','tvShort','tvMiniSeries','tvSpecial') group by 1""",
    "length_violations": " union all ".join(
        f"select '{t}' as \"table\", '{c}' as \"column\", cast({n} as bigint) as \"limit\", count(*) filter (length({c}) > {n}) as rows, "
        f"max(length({c})) as longest from {RAW[t]}" for t, columns in STAGING_COLUMNS.items() for c, n in columns if n is not None),
    "fk_violations": " union all ".join(
        f"select '{t}' as table, '{c}' as column, cast({v} as varchar) as value, count(*) as rows from {src} where {v} not in (select {k} from {p}) group by 3"
        for t, c, v, src, p, k in REFERENCES),
    "star_checks": " union all ".join(
        f"select 'reference' as \"check\", '{t}' as table, '{c}' as column, count(*) as rows from {src} where {v} not in (select {k} from {p}) having count(*) > 0"
        for t, c, v, src, p, k in REFERENCES),
    "publish_steps": " union all ".join(f"select '{t}' as tabla, count(*) as total from {src}" for t, src in [
        ("titles", "titles_raw"), ("people", "names_raw"), ("akas", "akas_raw")]),
    "duplicate_batch_keys": """select tconst, ordering, count(*) as rows from principals_raw group by 1, 2 having count(*) > 1""",
    "backup_register": f"""select key, fecha, hora, tipo_backup, direccion_almacenamiento,
      case when type = 'full' then 'second' else maestro_usado end as maestro_usado, metodo, stanza
      from (select r.*, s.type from records r join snaps s on s.event_id = r.event_id)""",
    "change_counts": f"""select 'same' as version, cast(0 as bigint) as changes, false as changed
      union all select 'new', count(*), true from ({DIFF.format(cents=_cents('n.o_totalprice'))})""",
    "cascade_delete": _counts({
        "titles": f"titles where tconst not in {GONE_TITLES}",
        "people": f"people where nconst not in {GONE_PEOPLE}",
        "ratings": f"ratings where tconst not in {GONE_TITLES}",
        "genres": "genres",
        "title_genres": f"title_genres where tconst not in {GONE_TITLES}",
        "categories": "categories",
        "title_principals": f"title_principals where tconst not in {GONE_TITLES} and nconst not in {GONE_PEOPLE}",
        "title_crew": f"title_crew where tconst not in {GONE_TITLES} and nconst not in {GONE_PEOPLE}",
        "episodes": f"episodes where episode_tconst not in {GONE_TITLES} and parent_tconst not in {GONE_TITLES}",
        "akas": "akas_raw",
    }),
    "table_shapes": " union all ".join(
        f"select '{t}' as \"table\", count(*) as rows, cast({n} as bigint) as columns from {t}" for t, n in [
            ("orders", 6), ("lineitem", 11), ("part", 6), ("customer", 5), ("supplier", 4), ("nation", 3), ("region", 2),
            ("events", 6), ("documents", 5), ("pages", 3), ("embeddings", 3), ("benchmark", 2), ("labels", 3), ("conversations", 4)]),
    "table_columns": " union all ".join(
        f"""select '{t}' as "table", '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls,
        {f'cast(min({c}) as double)' if number else 'cast(null as double)'} as low,
        {f'cast(max({c}) as double)' if number else 'cast(null as double)'} as high from {t}"""
        for t, numbers, others in [
            ("orders", "o_orderkey o_custkey o_totalprice", "o_orderstatus o_orderdate o_orderpriority"),
            ("lineitem", "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax",
             "l_returnflag l_linestatus l_shipdate"),
            ("part", "p_partkey p_size p_retailprice", "p_name p_brand p_type"),
            ("customer", "c_custkey c_nationkey c_acctbal", "c_name c_mktsegment"),
            ("supplier", "s_suppkey s_nationkey s_acctbal", "s_name"), ("nation", "n_nationkey n_regionkey", "n_name"),
            ("region", "r_regionkey", "r_name"), ("events", "event_id user_id value", "ts event_type props"),
            ("documents", "doc_id n_chars", "text lang source"), ("pages", "page_id", "url html"),
            ("embeddings", "vec_id label", ""), ("benchmark", "item_id", "text"), ("labels", "doc_id quality toxic", ""),
            ("conversations", "conv_id turn", "role text")]
        for number, names in ((True, numbers), (False, others)) for c in names.split()),
    "snapshot_diff": DIFF.format(cents=_cents("n.o_totalprice")),
    "digest_diff": DIFF.format(cents=_cents("n.o_totalprice")),
    "unchanged_versions": f"""select 'same' as version, false as changed
      union all select 'new', count(*) > 0 from ({DIFF.format(cents=_cents('n.o_totalprice'))})""",
    "apply_changes": f"select o_orderkey, o_custkey, o_orderstatus, {_cents('o_totalprice')} as o_totalprice from new_v",
    "rebuild_chain": f"select o_orderkey, o_custkey, o_orderstatus, {_cents('o_totalprice')} as o_totalprice from new_v where o_orderstatus <> 'O'",
    "restore_as_of": """select user_id, event_type, cast(floor(value) as bigint) as value, event_id from (
      select *, row_number() over (partition by user_id order by ts desc) as r from events where ts <= timestamp '2024-01-16 00:00:00')
      where r = 1 and event_type <> 'error'""",
    "restore_chain": f"select * from ({CHAIN.format(src='snaps')}) where role is not null",
    "restore_chain_as_of": "select * from (" + CHAIN.format(
        src="(select * from snaps where ts <= timestamp '2024-01-16 00:00:00')") + ") where role is not null",
    "backup_records": f"""select key, fecha, hora, tipo_backup, direccion_almacenamiento, maestro_usado, metodo, stanza,
      {LABEL} as etiqueta, strftime(ts, '%Y-%m-%d %H:%M:%S') as legible from records""",
    "backup_list": """select stanza, row_number() over (partition by stanza order by key, direccion_almacenamiento) as n, fecha, hora,
      tipo_backup as tipo, maestro_usado as maestro, concat('...', right(direccion_almacenamiento, 17)) as ubicacion from records""",
    "backup_list_all": """select row_number() over (order by key, stanza, direccion_almacenamiento) as n, fecha, hora,
      tipo_backup as tipo, maestro_usado as maestro, concat('...', right(direccion_almacenamiento, 17)) as ubicacion from records""",
    "backup_type_counts": """select count(*) as total, count(*) filter (type = 'full') as completos,
      count(*) filter (type = 'incr') as incrementales, count(*) filter (type = 'diff') as diferenciales from snaps""",
    "backup_type_counts_by_stanza": """select stanza, count(*) as total, count(*) filter (type = 'full') as completos,
      count(*) filter (type = 'incr') as incrementales, count(*) filter (type = 'diff') as diferenciales from snaps group by stanza""",
    "backup_latest": """select stanza, key, fecha, hora, tipo_backup from (select *, row_number() over (
      partition by stanza order by key desc, direccion_almacenamiento desc) as r from records) where r = 1""",
    "backup_retention": """select stanza, event_id, type, chain > last - 2 or last < 2 as keep from (
      select *, max(chain) over (partition by stanza) as last from (
        select *, count(*) filter (type = 'full') over (partition by stanza order by ts) as chain from snaps))""",
    "backup_bases": """select stanza, event_id, type, case type when 'incr' then prior when 'diff' then full_label end as base from (
      select *, lag(label) over (partition by stanza order by ts) as prior,
        last_value(case when type = 'full' then label end ignore nulls) over (
          partition by stanza order by ts rows between unbounded preceding and 1 preceding) as full_label from snaps)""",
    "backup_orphans": f"""select key, stanza, tipo_backup from records where {LABEL} not in (
      select left(label, 15) from snaps where type <> 'incr')""",
    "backup_fields_pivot": """select direccion_almacenamiento as key, fecha, hora, tipo_backup, direccion_almacenamiento,
      maestro_usado, metodo, stanza from records""",
    "backup_older_form": f"""select {LONG} as tipo, {STAMP} as stamp, strftime(ts, '%Y-%m-%d %H:%M:%S') as fecha_hora,
      concat('/backups/', label) as archivo from snaps""",
    "log_durations": """select file, line_no, type, case when next_kind = 'end' then cast(next_moment - moment as bigint) end as seconds from (
      select *, lead(kind) over w as next_kind, lead(moment) over w as next_moment from log_rows
      window w as (partition by file, type order by line_no)) where kind = 'start'""",
    "report_snapshots": """select stanza, label, type, strftime(ts, '%Y-%m-%d %H:%M:%S') as start,
      cast(floor(abs(value)) as bigint) * 1048576 as database_bytes, cast(floor(abs(value)) as bigint) * 1024 as backup_bytes from snaps""",
    "report_json_labels": "select concat('s', stanza) as stanza, label, type, cast(5 as bigint) as seconds from snaps",
    "size_texts": """select o_orderkey, case when n < 10240 then concat(n, ' bytes')
        when n < 10485760 then concat(cast(round(n / 1024) as bigint), ' kB')
        when n < 10737418240 then concat(cast(round(n / 1048576) as bigint), ' MB')
        else concat(cast(round(n / 1073741824) as bigint), ' GB') end as size,
      cast(round((n // 1000000 + (n % 10) / 10) * 1048576) as bigint) as bytes
      from (select o_orderkey, cast(floor(o_totalprice * o_totalprice / 4) as bigint) as n from orders)""",
}


def _with(body: str) -> str:
    """The body behind the shared subqueries it uses, in dependency order."""
    used: list[str] = []

    def need(text: str) -> None:
        for name, sql in CTES.items():
            if name not in used and re.search(rf"(from|join)\s+{name}\b", text):
                need(sql)
                if name not in used:
                    used.append(name)

    need(body)
    parts = [f"{name} as ({CTES[name]})" for name in used]
    return (f"with {', '.join(parts)} " if parts else "") + body


# The table functions answer like the reports.
BODIES |= {f"{name}_sql": BODIES[name] for name in ("director_info", "director_movies")}
ORACLE = {name: _with(body) for name, body in BODIES.items()}

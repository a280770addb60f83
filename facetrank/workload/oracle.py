"""Plain SQL for each registered query, on the same tables."""

from __future__ import annotations

# The five inputs, from the order tables.
INPUTS = """
line_facts as (
  select cast(l_orderkey as varchar) as "titleId",
         list_sort(list(distinct p_type) filter (where p_type is not null)) as genres,
         list_sort(list(distinct n_name) filter (where n_name is not null)) as country,
         list_sort(list(distinct cast(l_suppkey as varchar))) as directors,
         coalesce(list_sort(list(distinct cast(l_suppkey as varchar))
                            filter (where l_returnflag = 'R')), []) as writers,
         cast(sum(cast(l_quantity as bigint)) as bigint) as "numVotes",
         cast(sum(cast(round(l_discount * 100) as bigint)) as bigint) as points,
         count(*) as n_lines
  from lineitem
  left join part on p_partkey = l_partkey
  left join supplier on s_suppkey = l_suppkey
  left join nation on n_nationkey = s_nationkey
  group by l_orderkey
),
basics as (
  select cast(o_orderkey as varchar) as "titleId", o_orderstatus as "titleType",
         o_orderpriority as "primaryTitle", cast(o_custkey as varchar) as "originalTitle",
         cast(year(o_orderdate) as integer) as "startYear", genres
  from orders left join line_facts on line_facts."titleId" = cast(o_orderkey as varchar)
),
ratings as (
  select "titleId", "numVotes",
         cast((20 * points + n_lines) // (2 * n_lines) as double) / 10 as rating
  from line_facts
),
countries as (select "titleId", country from line_facts where len(country) > 0),
crew as (
  select "titleId", case when cast("titleId" as bigint) % 11 <> 0 then directors end as directors,
         writers
  from line_facts
),
names as (
  select cast(s_suppkey as varchar) as "nameId",
         case when s_suppkey % 13 <> 0 then s_name end as "primaryName"
  from supplier where s_suppkey % 7 <> 0
)
"""

# Eligible titles and their exploded facets; ratings in whole tenths.
FACETS = (
    INPUTS
    + """,
eligible as (
  select "titleId", genres from basics
  where "titleType" = 'F' and "startYear" >= 1998 and genres is not null
),
votes as (
  select "titleId", "numVotes" as w, cast(round(rating * 10) as bigint) * "numVotes" as tenths
  from ratings
),
genre_rows as (
  select "titleId", place as country, genre, w, tenths
  from (select "titleId", unnest(genres) as genre from eligible)
  join (select "titleId", unnest(country) as place from countries) using ("titleId")
  join votes using ("titleId")
),
director_rows as (
  select place as country, genre, director, w, tenths
  from (select "titleId", unnest(genres) as genre from eligible)
  join (select "titleId", unnest(country) as place from countries) using ("titleId")
  join (select "titleId", unnest(directors) as director from crew) using ("titleId")
  join votes using ("titleId")
),
genre_means as (
  select country, genre, cast(sum(tenths) as double) / 10 / nullif(cast(sum(w) as double), 0) as m
  from genre_rows where genre <> 'PROMO' group by country, genre
),
director_means_all as (
  select country, genre, director,
         cast(sum(tenths) as double) / 10 / nullif(cast(sum(w) as double), 0) as m
  from director_rows group by country, genre, director
),
-- Titles with directors only, all genres.
genre_means_all as (
  select country, genre, cast(sum(tenths) as double) / 10 / nullif(cast(sum(w) as double), 0) as m
  from genre_rows join (select "titleId" from crew where directors is not null) using ("titleId")
  group by country, genre
),
director_means as (select * from director_means_all where genre <> 'PROMO')
"""
)

# Winners on the rounded mean, named last.
STAGED = (
    FACETS
    + """,
genre_ranks as (
  select country, genre, m,
         cast(rank() over (partition by country order by m desc) as integer) as place
  from genre_means
),
winners as (
  select country, genre, "primaryName" as director_name, r
  from (select country, genre, director, round(m, 1) as r,
               max(round(m, 1)) over (partition by country, genre) as best
        from director_means) as scored
  join names on "nameId" = director
  where r = best
),
final_ranks as (
  select country, genre, directors_text,
         dense_rank() over (partition by country order by place) as ranking,
         row_number() over (partition by country order by place, genre) as nth
  from genre_ranks
  join (select country, genre,
               coalesce(array_to_string(list_sort(list(director_name)
                                              filter (where director_name is not null)), '|'), '')
                 as directors_text
        from winners group by country, genre) as lists using (country, genre)
)
"""
)

# Named directors on the exact mean, all genres.
EXACT = (
    FACETS
    + """,
named as (
  select country, genre, "primaryName" as director_name, m
  from director_means_all join names on "nameId" = director
  where "primaryName" is not null
),
exact_winners as (
  select country, genre, director_name, m
  from named join (select country, genre, max(m) as m from named group by country, genre) as best
  using (country, genre, m)
),
exact_final as (
  select country, genre, g.m, directors_text,
         row_number() over (partition by country order by g.m desc, genre) as nth
  from genre_means_all as g
  join (select country, genre,
               array_to_string(list_sort(list(director_name)), '|') as directors_text
        from exact_winners group by country, genre) as lists using (country, genre)
)
"""
)

BODIES = """
bodies as (
  select cast(event_id as varchar) as "titleId", event_type,
         case event_type
           when 'purchase' then 'U' || user_id || ', "V' || (props ->> '$.k') || '"'
           when 'view' then 'N/A'
           when 'signup' then ''
         end as raw_country
  from events
)
"""


def _with(ctes: str, body: str) -> str:
    return f"with {ctes.strip()}\n{body.strip()}"


FINAL = _with(
    STAGED,
    """
    select country, genre, cast(ranking as integer) as ranking,
           directors_text as best_directors_text
    from final_ranks where nth <= 3
    """,
)

RANKS = _with(
    STAGED, 'select country, genre, m as "weightedAveRating", place as ranking from genre_ranks'
)

SQL: dict[str, str] = {
    # Sources and sinks
    "scan_tsv_header": _with(
        INPUTS,
        """
        select "titleId", "titleType", "primaryTitle", "originalTitle",
               cast(0 as integer) as "isAdult", "startYear", cast(null as integer) as "endYear",
               array_to_string(genres, '|') as genres_text
        from basics
        """,
    ),
    "scan_tsv_headerless": _with(
        INPUTS,
        """select "titleId", array_to_string(country, '|') as country_text from countries""",
    ),
    "scan_array_column": _with(
        INPUTS,
        """
        select "titleId", cast(len(directors) as integer) as n_directors,
               cast(len(writers) as integer) as n_writers,
               array_to_string(writers, '|') as writers_text
        from crew
        """,
    ),
    "scan_lenient_types": """
        select cast(o_orderkey as varchar) as "titleId",
               case when o_orderstatus = 'F'
                    then cast(split_part(o_orderpriority, '-', 1) as integer) end as priority,
               case when o_orderstatus <> 'O'
                    then cast(year(o_orderdate) as integer) end as "startYear"
        from orders
    """,
    "scan_quoted": """
        select s_suppkey, s_name as name, 'a	"b"' as marked,
               case when s_suppkey % 3 <> 0 then 'last' end as last
        from supplier
    """,
    "scan_blank_lines": """
        select case when s_suppkey % 5 in (1, 2) then '' when s_suppkey % 5 = 3 then ' '
                    else s_name end as name,
               case when s_suppkey % 5 = 2 then '' when s_suppkey % 5 in (0, 4)
                    then cast(s_nationkey as varchar) end as nation
        from supplier
    """,
    "scan_header_override": _with(
        INPUTS, """select "titleId", array_to_string(country, '|') as country_text from countries"""
    ),
    "scan_trimmed_items": _with(
        INPUTS, """select "titleId", array_to_string(country, '|') as country_text from countries"""
    ),
    "null_marker": """
        select c_custkey, c_mktsegment as segment from customer where not c_acctbal < 0
    """,
    "load_overwrite": _with(
        INPUTS,
        """select "titleId", array_to_string(directors, '|') as directors_text from crew""",
    ),
    "insert_overwrite": _with(
        STAGED, "select country, genre, director_name, r as weighted_rating from winners"
    ),
    "store_tsv_array": _with(
        EXACT,
        """
        select country, genre, m as mean_rating, replace(directors_text, '|', ',') as directors_text
        from exact_final where nth <= 3
        """,
    ),
    "append_dedupe": _with(
        INPUTS,
        """select "titleId", array_to_string(country, '|') as country_text from countries""",
    ),
    "append_merge": _with(
        INPUTS,
        """
        select "titleId",
               case when cast("titleId" as bigint) % 3 <> 0 then array_to_string(country, '|')
                    else 'second' end as country_text
        from countries
        """,
    ),
    "store_rejects": _with(
        BODIES,
        """
        select "titleId", 'error ' || props || chr(9) || 'x' || chr(10) || '"y"' as body
        from bodies join events on cast(event_id as varchar) = "titleId"
        where bodies.event_type = 'error'
        """,
    ),
    "replace_view": """
        select cast(o_orderkey as varchar) as "titleId", o_orderstatus as "titleType"
        from orders where o_orderstatus = 'F'
    """,
    # Projections and filters
    "project_rename": """
        select cast(o_orderkey as varchar) as title_id, o_orderstatus as kind,
               cast(year(o_orderdate) as integer) as year
        from orders
    """,
    "filter_star": """
        select cast(o_orderkey as varchar) as "titleId", o_orderstatus as "titleType",
               cast(year(o_orderdate) as integer) as "startYear",
               o_orderpriority as "primaryTitle"
        from orders where o_orderstatus = 'F' and o_orderdate >= timestamp '1998-01-01'
    """,
    "filter_not_null": """
        select cast(o_orderkey as varchar) as "titleId",
               cast(year(o_orderdate) as integer) as "startYear"
        from orders where o_orderkey in (select l_orderkey from lineitem)
    """,
    "filter_nonempty_array": """
        select cast(l_orderkey as varchar) as "titleId",
               cast(count(distinct l_suppkey) as integer) as n_writers
        from lineitem where l_returnflag = 'R' group by l_orderkey
    """,
    "exclude_facet_value": """
        select distinct cast(l_orderkey as varchar) as "titleId", p_type as genre
        from lineitem join part on p_partkey = l_partkey
        where p_type <> 'PROMO' and l_orderkey in (select o_orderkey from orders)
    """,
    # Joins
    "star_join_3": _with(
        INPUTS,
        """
        select b."titleId", "titleType", "startYear", rating, "numVotes",
               array_to_string(genres, '|') as genres_text,
               array_to_string(country, '|') as country_text
        from basics as b, countries as c, ratings as r
        where b."titleId" = c."titleId" and b."titleId" = r."titleId"
        """,
    ),
    "star_join_4": _with(
        INPUTS,
        """
        select b."titleId", rating, "numVotes",
               array_to_string(genres, '|') as genres_text,
               array_to_string(country, '|') as country_text,
               array_to_string(directors, '|') as directors_text
        from basics as b, countries as c, ratings as r, crew as w
        where b."titleId" = c."titleId" and b."titleId" = r."titleId"
          and b."titleId" = w."titleId"
        """,
    ),
    "dim_lookup": _with(
        INPUTS,
        """
        select "titleId", director, "primaryName" as director_name
        from (select "titleId", unnest(directors) as director from crew)
        join names on "nameId" = director
        """,
    ),
    "join_two_keys": _with(
        FACETS,
        """
        select country, genre, g.m as mean_rating, best_mean
        from genre_means as g
        join (select country, genre, max(m) as best_mean from director_means
              group by country, genre) as d using (country, genre)
        """,
    ),
    "argmax_ties": _with(
        FACETS,
        """
        select country, genre, director, m as mean_rating
        from director_means as d
        where m = (select max(m) from director_means as x
                   where x.country = d.country and x.genre = d.genre)
        """,
    ),
    # Generators
    "explode_one": """
        select distinct cast(l_orderkey as varchar) as "titleId", n_name as country
        from lineitem join supplier on s_suppkey = l_suppkey
        join nation on n_nationkey = s_nationkey
    """,
    "explode_two": _with(
        INPUTS,
        """
        select "titleId", genre, place as country
        from (select "titleId", unnest(genres) as genre from basics)
        join (select "titleId", unnest(country) as place from countries) using ("titleId")
        """,
    ),
    "explode_three": _with(
        FACETS,
        """
        select "titleId", genre, place as country, director
        from (select "titleId", unnest(genres) as genre from basics)
        join (select "titleId", unnest(country) as place from countries) using ("titleId")
        join (select "titleId", unnest(directors) as director from crew) using ("titleId")
        """,
    ),
    "tokenize_flatten": """
        select p_partkey, word, brand_word
        from (select p_partkey, p_brand, unnest(string_split(p_name, ' ')) as word from part)
           , lateral (select unnest(string_split(p_brand, '#')) as brand_word)
        where word <> '' and brand_word <> ''
    """,
    # Aggregations
    "sum_product": _with(
        FACETS,
        """
        select country, cast(sum(w) as bigint) as votes,
               cast(sum(tenths) as double) / 10 as rating_votes
        from genre_rows where genre <> 'PROMO' group by country
        """,
    ),
    "weighted_mean": _with(FACETS, "select country, genre, m as mean_rating from genre_means"),
    "weighted_mean_rounded": _with(
        FACETS, "select country, genre, director, round(m, 1) as mean_rating from director_means"
    ),
    "weighted_mean_3keys": _with(
        FACETS, "select country, genre, director, m as mean_rating from director_means"
    ),
    # Whole units of 1e-9 and 1e-8; the exact sums are rounded once each.
    "weighted_mean_fractional": """
        with units as (
          select l_suppkey,
                 (cast(round(l_extendedprice * 100) as bigint) * 20000000 + 3) // 6 as v,
                 cast(round(l_discount * 100) as bigint) * 15625 as w
          from lineitem
        ),
        sums as (
          select l_suppkey, sum(cast(v as hugeint) * w) as vw, sum(w) as w from units group by l_suppkey
        )
        select l_suppkey,
               case when w <> 0 then cast(cast(vw as varchar) || 'E-17' as double)
                                     / cast(cast(w as varchar) || 'E-8' as double) end as mean_value
        from sums
    """,
    "group_max": _with(
        FACETS,
        "select country, genre, max(m) as best_mean from director_means group by country, genre",
    ),
    "director_lists": _with(
        STAGED,
        """
        select country, genre,
               coalesce(array_to_string(list_sort(list(director_name)
                                          filter (where director_name is not null)), '|'), '')
                 as directors_text
        from winners group by country, genre
        """,
    ),
    "distinct_values": _with(
        INPUTS, "select distinct array_to_string(country, ', ') as country_text from countries"
    ),
    "country_values": _with(
        INPUTS, "select distinct unnest(country) as country from countries"
    ),
    # Ranking
    "rank_within": _with(
        STAGED, "select country, genre, m as mean_rating, place as ranking from genre_ranks"
    ),
    "rank_within_large": _with(
        FACETS,
        """
        select country, genre, director, r as mean_rating,
               rank() over (partition by country order by r desc) as ranking,
               dense_rank() over (partition by country order by r desc) as dense_ranking
        from (select country, genre, director, round(m, 1) as r from director_means)
        """,
    ),
    "rank_within_ranges": """
        select cast(l_suppkey % 3 as integer) as third, l_extendedprice,
               rank() over (partition by l_suppkey % 3 order by l_extendedprice desc) as ranking,
               dense_rank() over (partition by l_suppkey % 3 order by l_extendedprice desc)
                 as dense_ranking
        from lineitem
    """,
    "top_ties": _with(
        FACETS,
        """
        select country, genre, director, r as mean_rating
        from (select country, genre, director, round(m, 1) as r from director_means)
        qualify rank() over (partition by country, genre order by r desc) = 1
        """,
    ),
    "rerank_dense": _with(
        FACETS,
        """
        select country, genre, cast(first_rank as integer) as first_rank,
               cast(dense_rank() over (partition by country order by first_rank) as integer)
                 as ranking
        from (select country, genre,
                     rank() over (partition by country order by round(m, 0) desc) as first_rank
              from genre_means)
        """,
    ),
    "top_k_rows": _with(
        STAGED,
        """
        select country, genre, place as ranking from genre_ranks
        qualify row_number() over (partition by country order by place, genre) <= 3
        """,
    ),
    "top_k_by_value": _with(
        FACETS,
        """
        select country, genre, m as mean_rating from genre_means
        qualify row_number() over (partition by country order by m desc, genre) <= 3
        """,
    ),
    "sort_mixed": _with(
        FACETS,
        """
        select country, genre, m as mean_rating from genre_means
        order by country, mean_rating desc, genre
        """,
    ),
    "sort_two_keys": _with(
        STAGED, "select country, genre, place as ranking from genre_ranks order by country, genre"
    ),
    # Landed responses
    "strip_quotes": "select event_id, replace(props, '\"', '') as bare_props from events",
    "split_field": 'select cast(o_orderkey as varchar) as "titleId" from orders',
    "json_field": _with(BODIES, 'select "titleId", raw_country from bodies'),
    "country_enrichment": _with(
        BODIES,
        """
        select "titleId",
               nullif(nullif(replace(raw_country, '"', ''), ''), 'N/A') as "countryText",
               case when event_type = 'purchase' then cast(2 as integer) end as n_countries,
               case when event_type = 'purchase'
                    then replace(split_part(raw_country, ',', 2), '"', '') end as last_country,
               event_type = 'error' as rejected
        from bodies
        """,
    ),
    # Reports
    "top_genre": RANKS,
    "top_genre_credited": _with(
        FACETS,
        """
        select country, genre, m as "weightedAveRating",
               cast(rank() over (partition by country order by m desc) as integer) as ranking
        from genre_means_all
        """,
    ),
    "best_director": _with(
        STAGED, "select country, genre, director_name, r as weighted_rating from winners"
    ),
    "best_director_unrounded": _with(
        EXACT, "select country, genre, director_name, m as weighted_rating from exact_winners"
    ),
    "best_director_for_genres": FINAL,
    "facet_report": FINAL,
    "facet_batch": FINAL,
    "facet_batch_exact": _with(
        EXACT,
        """
        select country, genre, m as "weightedAveRating", directors_text as top_directors_text
        from exact_final where nth <= 3
        """,
    ),
}

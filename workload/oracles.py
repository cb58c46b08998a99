"""The same questions in SQL over the test tables."""

from __future__ import annotations

CENTS = "cast(round(o_totalprice * 100) as bigint)"

_ELEMENTS = """
    select l_orderkey, l_linenumber, try_cast(l_suppkey as integer) as tag_id, l_returnflag as tag_name
    from lineitem where l_linenumber in (1, 2)
    union all
    select l_orderkey, l_linenumber, try_cast(l_partkey as integer), l_linestatus
    from lineitem where l_linenumber = 1
    union all
    select l_orderkey, l_linenumber, try_cast(l_suppkey as integer), null
    from lineitem where l_linenumber = 3
    union all
    select l_orderkey, l_linenumber, null, l_returnflag
    from lineitem where l_linenumber in (4, 5)
    union all
    select l_orderkey, l_linenumber, null, null
    from lineitem where l_linenumber = 5
"""

_MOVIES = f"""
    select try_cast({CENTS} as integer) as budget,
           case when o_orderstatus = 'O' then 'http://o/' || o_orderkey end as homepage,
           try_cast(o_orderkey as integer) as movie_id,
           lower(o_orderstatus) as original_language,
           'Order ' || o_orderkey as original_title,
           'He said "' || o_orderpriority || '",' || chr(10) || 'then left' as overview,
           o_totalprice as popularity,
           strftime(o_orderdate, '%Y-%m-%d') as release_date,
           {CENTS} * 100 as revenue,
           case when day(o_orderdate) < 31 then cast(day(o_orderdate) as integer) end as runtime,
           o_orderstatus as status,
           cast(null as varchar) as tagline,
           'Order ' || o_orderkey as title,
           month(o_orderdate) + cast(0.5 as double) as vote_average,
           cast(year(o_orderdate) as integer) as vote_count
    from orders
"""

_GENRES = """
    select try_cast(o_orderkey as integer) as movie_id,
           try_cast(o_orderkey as integer) as genre_id,
           o_orderpriority as genre_name
    from orders where o_orderpriority not in ('4-NOT SPECIFIED', '5-LOW')
    union all
    select try_cast(o_orderkey as integer), try_cast(o_custkey as integer), o_orderstatus
    from orders where o_orderpriority not in ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
"""

_CAST = """
    select try_cast(l_orderkey as integer) as movie_id, 'Order ' || l_orderkey as title,
           l_linenumber as cast_id, l_linestatus as "character", 'c' || l_partkey as credit_id,
           2 as gender, try_cast(l_suppkey as integer) as person_id,
           'Supplier ' || l_suppkey as person_name, l_linenumber as "order"
    from lineitem
    union all
    select try_cast(l_orderkey as integer), 'Order ' || l_orderkey,
           l_linenumber + 10, l_returnflag, 'd' || l_partkey,
           null, try_cast(l_partkey as integer), 'Part ' || l_partkey, null
    from lineitem
"""

_CREW = """
    select try_cast(l_orderkey as integer) as movie_id, 'Order ' || l_orderkey as title,
           'w' || l_partkey as credit_id, l_linestatus as department, 1 as gender,
           try_cast(l_suppkey as integer) as person_id,
           case when l_returnflag = 'R' then 'Director' else 'Writer' end as job,
           'Supplier ' || l_suppkey as person_name
    from lineitem where l_returnflag <> 'N'
"""


def _array(columns: str) -> str:
    return f"select try_cast(o_orderkey as integer) as movie_id, {columns} from orders"


_LOSSES = (
    [("movies", "rows", "(select count(*) from orders)")]
    + [("movies", "null_key", "(select count(*) from orders where try_cast(o_orderkey as integer) is null)")]
    + [("movies", "corrupt_genres", "(select count(*) from orders where o_orderpriority = '4-NOT SPECIFIED')")]
    + [
        ("movies", f"corrupt_{name}", "0")
        for name in ("keywords", "production_companies", "production_countries", "spoken_languages")
    ]
    + [("credits", "rows", "(select count(*) from lineitem)")]
    + [("credits", "null_key", "(select count(*) from lineitem where try_cast(l_orderkey as integer) is null)")]
    + [("credits", "corrupt_cast", "0"), ("credits", "corrupt_crew", "0")]
    + [
        (
            "credits",
            "orphans",
            "(select count(*) from lineitem where try_cast(l_orderkey as integer) is null"
            " or not exists (select 1 from orders where o_orderkey = l_orderkey))",
        )
    ]
)

_LOST = {
    "lost_budget": f"(select count(*) from orders where try_cast({CENTS} as integer) is null)",
    "lost_runtime": "(select count(*) from orders where day(o_orderdate) = 31)",
    "lost_keywords_id": "(select count(*) from orders where o_orderstatus = 'P')",
}
_CASTS = {
    "movies": "budget movie_id popularity revenue runtime vote_average vote_count".split(),
    "credits": ["movie_id"],
}
_FIELDS = {
    "movies": {
        "genres": "id name",
        "keywords": "id name",
        "production_companies": "id name",
        "production_countries": "iso_3166_1 name",
        "spoken_languages": "iso_639_1 name",
    },
    "credits": {
        "cast": "cast_id character credit_id gender id name order",
        "crew": "credit_id department gender id job name",
    },
}
_LOSSES += [
    (source, f"lost_{name}", _LOST.get(f"lost_{name}", "0"))
    for source, arrays in _FIELDS.items()
    for name in (*_CASTS[source], *(f"{array}_{field}" for array in arrays for field in arrays[array].split()))
]

_REPORT = " union all ".join(
    f"select '{source}' as source, '{check}' as \"check\", cast({rows} as bigint) as \"rows\""
    for source, check, rows in _LOSSES
)

_DOCUMENTS = "select doc_id, text, lang, source, n_chars from documents"

ORACLES = {
    "top_n": f"""
        select o_orderkey, o_orderpriority, {CENTS} as cents
        from orders order by cents desc, o_orderkey limit 10
    """,
    "filter_join_sort": f"""
        select o_orderkey, o_orderpriority, {CENTS} as cents
        from lineitem join orders on l_orderkey = o_orderkey
        where l_suppkey = 7 order by cents desc
    """,
    "filter_join_sort_distinct": f"""
        select o_orderkey, o_orderpriority, {CENTS} as cents
        from orders where o_orderkey in (select l_orderkey from lineitem where l_suppkey = 7)
        order by cents desc
    """,
    "group_count": """
        select p_type, count(*) as part_count from part group by p_type order by part_count desc
    """,
    "filter_join_group_sum": f"""
        select l_suppkey, cast(sum({CENTS}) as bigint) as total_cents, count(o_orderkey) as order_count
        from lineitem join orders on l_orderkey = o_orderkey
        where l_returnflag = 'R' group by l_suppkey order by total_cents desc
    """,
    "join_group_avg": f"""
        select l_returnflag, avg({CENTS}) as avg_cents
        from lineitem join orders on l_orderkey = o_orderkey
        group by l_returnflag order by avg_cents desc
    """,
    "orphan_rows": f"""
        select o_orderkey, {CENTS} as cents from orders
        where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')
    """,
    "json_array_parse": """
        select l_linenumber, count(*) as line_count,
               count(*) filter (where l_linenumber = 7) as corrupt_count,
               cast(sum(case l_linenumber when 1 then 2 when 5 then 2 when 6 then 0 when 7 then null
                        else 1 end) as bigint) as element_count
        from lineitem group by l_linenumber
    """,
    "explode_bridge": _ELEMENTS,
    "json_object_field": "select event_id, cast(props->>'$.k' as integer) as k from events",
    "csv_scan": _DOCUMENTS,
    "csv_scan_in_splits": _DOCUMENTS,
    "csv_scan_whole_files": _DOCUMENTS,
    "csv_scan_single_line": """
        select doc_id, replace(replace(text, chr(13), ' '), chr(10), ' ') as text, lang, source, n_chars
        from documents
    """,
    "csv_scan_irregular": f"""
        {_DOCUMENTS} union all
        select doc_id, '5" disk', lang, source, n_chars from documents where n_chars < 500
    """,
    "lenient_cast": """
        select l_orderkey, l_linenumber,
               try_cast(case l_linenumber when 1 then l_partkey when 2 then l_partkey
                   when 3 then -l_suppkey when 4 then l_partkey end as integer) as as_int,
               case l_linenumber when 1 then l_partkey when 2 then l_partkey
                   when 3 then -l_suppkey when 4 then l_partkey
                   when 5 then 9007199000000000000 + l_partkey end as as_long,
               l_extendedprice as as_double
        from lineitem
    """,
    "fact_select": f"""
        select o_orderkey as order_id, try_cast(o_custkey as integer) as customer_id,
               o_orderstatus as status, o_totalprice as price, {CENTS} as cents
        from orders
    """,
    "table_roundtrip": "select * from orders",
    "overwrite_idempotent": "select * from orders",
    "atomic_replace": "select * from orders",
    "version_set": """
        select l_linenumber, count(*) as line_count from lineitem
        where l_orderkey in (select o_orderkey from orders where o_orderkey % 4 < 3)
        group by l_linenumber
    """,
    "lost_elements": """
        select l_linenumber, cast(sum(case when l_linenumber = 4 then 1 else 0 end) as bigint) as lost_ids,
               cast(0 as bigint) as lost_names
        from lineitem group by l_linenumber
    """,
    "declared_scan": "select o_orderkey, o_custkey, o_orderstatus from orders",
    "missing_inputs": "select 'absent.parquet' as name",
    "preview_n": f"""
        select o_orderkey, {CENTS} as cents from orders order by cents desc, o_orderkey limit 5
    """,
    "literal_rows": """
        select l_linenumber, count(*) as line_count, any_value(text) as text
        from lineitem join (values (1, 'Hello'), (2, 'World')) as listed(number, text)
          on l_linenumber = number
        group by l_linenumber
    """,
    "curate_run": f"""
        select genre_name, cast(sum(revenue) as bigint) as revenue, count(*) as movie_count
        from ({_GENRES}) join ({_MOVIES}) using (movie_id) group by genre_name
    """,
    "curation_report": _REPORT,
    "curated_movies": _MOVIES,
    "curated_genres": _GENRES,
    "curated_keywords": _array(
        "case when o_orderstatus <> 'P' then try_cast(o_custkey as integer) end as keyword_id,"
        " lower(o_orderpriority) as keyword_name"
    ),
    "curated_production_companies": _array(
        "try_cast(o_custkey as integer) as company_id, 'Customer ' || o_custkey as company_name"
    ),
    "curated_production_countries": _array(
        "o_orderstatus as country_code, 'Land of ' || o_orderstatus as country_name"
    ),
    "curated_spoken_languages": _array(
        "lower(o_orderstatus) as language_code, o_orderstatus as language_name"
    ),
    "curated_cast": _CAST,
    "curated_crew": _CREW,
    "answer_tom_cruise_revenue": f"""
        select movie_id, m.title, revenue from ({_CAST}) c join ({_MOVIES}) m using (movie_id)
        where person_name = 'Supplier 7' order by revenue desc
    """,
    "answer_top_revenue_movies": f"""
        select movie_id, title, revenue from ({_MOVIES}) order by revenue desc, movie_id limit 10
    """,
    "answer_genre_popularity": f"""
        select genre_name, count(*) as movie_count from ({_GENRES})
        group by genre_name order by movie_count desc
    """,
    "answer_top_directors": f"""
        select person_name, cast(sum(revenue) as bigint) as total_revenue, count(movie_id) as movie_count
        from ({_CREW}) c join ({_MOVIES}) m using (movie_id)
        where job = 'Director' group by person_name order by total_revenue desc
    """,
    "answer_avg_rating_per_genre": f"""
        select genre_name, avg(vote_average) as avg_rating
        from ({_GENRES}) join ({_MOVIES}) using (movie_id)
        group by genre_name order by avg_rating desc
    """,
}

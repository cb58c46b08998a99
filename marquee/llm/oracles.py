"""DuckDB SQL for the queries that SQL can express.

The others learn models, call a tokenizer, use checksums or hashes that DuckDB lacks, or may miss
some neighbours by design; the tests hold them against plain Python.
"""

from marquee.llm.suffixes import DOUBLE_SUFFIXES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SPACE = r"[\x20\x09-\x0D]+"

OP6 = rf"""
with recursive words as (
    select doc_id,
           [x for x in regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '{_SPACE}') if x <> ''] as w
    from documents
), sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as s
    from words
), shingles as (
    select doc_id, len(s) as n, unnest(s) as shingle from sets
), links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
        and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(a, b) as (
    select a, b from links
    union
    select reach.a, links.b from reach join links on reach.b = links.a
), least_of as (
    select a as doc_id, min(b) as b from reach group by a
)
select doc_id, len(s) as n_shingles, least(doc_id, coalesce(b, doc_id)) as component_id,
       doc_id <= coalesce(b, doc_id) as kept
from sets left join least_of using (doc_id)
"""


def _weight(children: str, parents: str) -> str:
    """Concentration of a level's prior by the moments of the beta-binomial."""
    return f"""
    select coalesce(case when room > 0 and excess <> 0
               then 1 / least(greatest(excess / room, 1e-4), 0.999) - 1 end, 10000.0) as k
    from (
        select sum((bad2 - bad * bad / n) / (bad / n * (1 - bad / n)) - (kids - 1)) as excess,
               sum(n - n2 / n - (kids - 1)) as room
        from (
            select sum(n)::double as n, sum(bad)::double as bad, sum(n * n)::double as n2,
                   sum(bad * bad / n::double) as bad2, count(*) as kids
            from {children} where n > 0 group by {parents}
        ) where bad > 0 and bad < n
    )
    """


_FITS = "(host = '{own}' or ends_with(host, '.{own}')) and starts_with(path, '{path}')"


def _rules(rules: list[tuple[str, str]], column: int) -> str:
    """The longest fitting rule, or its verdict."""
    cases = []
    for rule in sorted(rules, key=lambda r: -len(r[1])):
        own, slash, rest = rule[1].partition("/")
        cases.append(f"when {_FITS.format(own=own, path=slash + rest)} then '{rule[column]}'")
    return f"case {' '.join(cases)} end"


_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

_DOUBLE = ", ".join(f"'{suffix}'" for suffix in DOUBLE_SUFFIXES)

_REST = "substr(url, strpos(url, '://') + 3)"

OP5 = rf"""
with located as (
    select page_id,
           case when coalesce(strpos(url, '://'), 0) = 0 then ''
                else {_LOWER.format(f"regexp_extract({_REST}, '^([^/?#]*)', 1)")} end as host,
           case when coalesce(strpos(url, '://'), 0) = 0 then ''
                else regexp_extract({_REST}, '^[^/?#]*(/[^?#]*)', 1) end as path
    from pages
), marks as (
    select doc_id as page_id, count(*) as n, count(*) filter (toxic = 1 or quality = 0) as bad
    from labels where doc_id is not null and (toxic = 1 or quality = 0) is not null group by doc_id
), named as (
    select host, n, bad, regexp_replace(host, ':[0-9]*$', '') as name from located left join marks using (page_id)
), parted as (
    select *, regexp_full_match(name, '[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}|\[.*\]') as address,
           regexp_extract(name, '([^.]*\.)?[^.]*$', 0) in ({_DOUBLE}) as double
    from named
), hosts as (
    select host,
           case when address then '[ip]' when double then regexp_extract(name, '[^.]*\.[^.]*$', 0)
                else regexp_extract(name, '[^.]*$', 0) end as suffix,
           case when address then name when double then regexp_extract(name, '([^.]*\.)?[^.]*\.[^.]*$', 0)
                else regexp_extract(name, '([^.]*\.)?[^.]*$', 0) end as domain,
           sum(coalesce(n, 0)) as n, sum(coalesce(bad, 0)) as bad
    from parted group by all
), domains as (
    select suffix, domain, sum(n) as n, sum(bad) as bad from hosts group by all
), suffixes as (
    select suffix, 1 as every, sum(n) as n, sum(bad) as bad from domains group by all
), weights as (
    select (select k from ({_weight("suffixes", "every")})) as k1,
           (select k from ({_weight("domains", "suffix")})) as k2,
           (select k from ({_weight("hosts", "suffix, domain")})) as k3,
           (select (sum(bad) + 0.5) / (sum(n) + 1) from suffixes) as overall,
           (select sum(n) + 1.0 from suffixes) as total
), by_suffix as (
    select suffix, (bad + overall * w) / (w + n) as prior, w + n as known
    from (select suffix, n, bad, overall, 1 / (1 / k1 + 1 / total) as w from suffixes, weights)
), by_domain as (
    select domain, (bad + prior * w) / (w + n) as prior, w + n as known
    from (select d.domain, d.n, d.bad, prior, 1 / (1 / k2 + 1 / known) as w
          from domains d join by_suffix using (suffix), weights)
), posterior as (
    select host, bad + prior * w as alpha, n - bad + (1 - prior) * w as beta
    from (select host, h.n, h.bad, prior, 1 / (1 / k3 + 1 / known) as w
          from hosts h join by_domain using (domain), weights)
), bounds as (
    select host, alpha / (alpha + beta)
        - 1.64 * sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1))) as bad_bound
    from posterior
)
select page_id, host, path, {_rules(_RULES, 1)} as rule,
       coalesce({_rules(_RULES, 0)}, case when bad_bound > 0.25 then 'block' else 'allow' end) as verdict
from located join bounds using (host)
"""

_TEXT = _LOWER.format("coalesce(text, '')")

_TERMS = rf"regexp_extract_all({_TEXT}, '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')"

OP11 = f"""
with terms as (
    select doc_id, row_number() over () as r, {_TERMS} as t from documents
), counted as (
    select r, doc_id, t, len(t)::bigint as n from terms where len(t) > 0
), totals as (
    select count(*)::bigint as docs, sum(n)::bigint as length from counted
), held as (
    select r, term, count(*)::bigint as tf from (select r, unnest(t) as term from counted) group by all
), items as (
    select item_id, i, unnest(t) as term
    from (select item_id, row_number() over () as i, {_TERMS} as t
          from (select distinct item_id, text from benchmark))
), weights as (
    select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
    from held, totals where term in (select term from items) group by term, docs
), scores as (
    select i, item_id, doc_id, r,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::bigint as score
    from items join weights using (term) join held using (term) join counted using (r), totals
    group by i, item_id, doc_id, r
), ranked as (
    select item_id, doc_id, score,
           row_number() over (partition by i order by score desc, doc_id nulls last, r) as rank
    from scores where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""

OP12 = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_TEXT}, '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), words as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), starts as (
    select lang, w, unnest(range(1, len(w) + 1)) as p from words
), grams as (
    select lang, k, array_to_string(w[p:p + k - 1], ' ') as gram, count(*) as f
    from starts, range(1, 6) as sizes(k) where p + k - 1 <= len(w) group by all
), totals as (
    select lang, sum(f)::hugeint as n from grams where k = 1 group by lang
), candidates as (
    select * from grams where k > 1 and f >= 100
), free as (
    select * from candidates c where not exists (
        select 1 from candidates d where d.lang = c.lang and d.k > c.k and 100 * d.f >= 100 * c.f
            and contains(' ' || d.gram || ' ', ' ' || c.gram || ' '))
), cuts as (
    select lang, gram, f, unnest(range(1, k)) as cut, string_split(gram, ' ') as w from free
), parts as (
    select *, array_to_string(w[1:cut], ' ') as head, array_to_string(w[cut + 1:], ' ') as rest from cuts
), scored as (
    select lang, parts.gram as phrase, parts.f as a, x.f as l, y.f as r, n, cut,
           (1000 * parts.f::hugeint * n) // (x.f::hugeint * y.f::hugeint) as score
    from parts join totals using (lang)
        join (select lang, gram as head, f from grams) x using (lang, head)
        join (select lang, gram as rest, f from grams) y using (lang, rest)
), least as (
    select *, row_number() over (partition by lang, phrase order by score, cut) as place from scored
)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
      from least where place = 1)
where rank <= 2000
"""

# What is kept is put together as hexadecimal digits, since text cannot be cut inside a character.
OP13 = """
with texts as (
    select row_number() over () as r, doc_id, encode(coalesce(text, '')) as b from documents
), starts as (
    select r, b, unnest(range(1, octet_length(b) - 198)) as s from texts where octet_length(b) >= 200
), windows as (
    select r, s, array_slice(b, s, s + 199) as w from starts
), repeated as (
    select r, s from windows where w in (select w from windows group by w having count(*) > 1)
), jumps as (
    select r, s, lag(s) over (partition by r order by s) as before from repeated
), runs as (
    select r, s, sum(case when before is null or s > before + 200 then 1 else 0 end)
        over (partition by r order by s) as run
    from jumps
), spans as (
    select r, min(s) as first, max(s) + 199 as last from runs group by r, run
), gaps as (
    select r, first, last, coalesce(lag(last) over (partition by r order by first), 0) as before,
           row_number() over (partition by r order by first desc) = 1 as final
    from spans
), kept as (
    select r, sum(last - first + 1) as n_removed, count(*) as n_spans,
           string_agg(hex(array_slice(b, before + 1, first - 1))
               || case when final then hex(array_slice(b, last + 1, octet_length(b))) else '' end,
               '' order by first) as h
    from gaps join texts using (r) group by r
)
select doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans, sha256(coalesce(unhex(h), b)) as kept_sha256
from texts left join kept using (r)
"""

ORACLES: dict[str, str] = {
    "op5_host_reputation": OP5,
    "op6_chosen_path": OP6,
    "op11_bag_search": OP11,
    "op12_phrase_graph": OP12,
    "op13_radix_windows": OP13,
}

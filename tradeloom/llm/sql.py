"""DuckDB SQL of the numbered queries, written apart from the DataFrame code."""

from __future__ import annotations

_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
with lines as (
    select doc_id, line_no, line, {_LOWER.format(f"trim(line, {_SPACES})")} as line_key
    from (
        select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as line_no
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
    )
), shared as (
    select line_key, max(doc_id) as keeper
    from lines where length(line_key) >= 20
    group by line_key having count(distinct doc_id) >= 3
)
select doc_id, count(*) as n_lines,
       count(*) filter (where keeper is not null and doc_id <> keeper) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by line_no) filter (where keeper is null or doc_id = keeper), ''))
           as kept_sha256
from lines left join shared using (line_key)
group by doc_id
"""


EMBEDDINGS = """
with recursive usable as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b
      on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9
), reach as (
    select vec_id as a, vec_id as b from embeddings
    union
    select reach.a, links.b from reach join links on reach.b = links.a
), component as (
    select a as vec_id, min(b) as component_id from reach group by a
), counted as (
    select a as vec_id, count(distinct b) as n from links group by a
)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join component using (vec_id) left join counted using (vec_id)
"""


def _fill(name: str, children: str, parent: str, own: str) -> str:
    """CTEs that split `given` of each parent among its children by weight, up to their cap."""
    by = f"partition by {parent}" if parent else ""
    return f"""
{name}_a as (
    select *, coalesce(sum(cap) over (up rows between unbounded preceding and 1 preceding), 0)::hugeint as before,
           (sum(weight) over (up rows between current row and unbounded following))::hugeint as from_here
    from ({children})
    window up as ({by} order by cap::double / weight::double, {own} nulls first)
), {name}_b as (
    select *, cap * from_here <= weight * (given - before) as is_full from {name}_a
), {name}_c as (
    select *, (sum(case when is_full then cap else 0 end) over ({by}))::hugeint as spent,
           (sum(case when is_full then 0 else weight end) over ({by}))::hugeint as open_weight
    from {name}_b
), {name} as (
    select *, case when is_full then cap else (weight * (given - spent)) // open_weight end as budget from {name}_c
)"""


MIXING = f"""
with tokens as (
    select doc_id, lang, source,
           case when regexp_matches(coalesce(source, ''), '[0369]$') then 'web'
                when regexp_matches(coalesce(source, ''), '[147]$') then 'books'
                when regexp_matches(coalesce(source, ''), '[258]$') then 'forum' else 'other' end as domain,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::hugeint as n
    from documents
), leaves as (
    select domain, lang, source, sum(n)::hugeint as n, (sum(n) * 2)::hugeint as cap from tokens group by all
), {_fill("d", """select domain, sum(cap)::hugeint as cap, (select sum(n)::hugeint from leaves) as given,
    (case domain when 'web' then 5 when 'books' then 3 when 'forum' then 2 else 1 end)::hugeint as weight
    from leaves group by domain""", "", "domain")},
{_fill("l", """select x.domain, x.lang, x.cap, d.budget as given,
    (case x.lang when 'en' then 6 when 'de' then 2 when 'fr' then 2 else 1 end)::hugeint as weight
    from (select domain, lang, sum(cap)::hugeint as cap from leaves group by all) x
    join d on x.domain = d.domain""", "domain", "lang")},
{_fill("s", """select x.domain, x.lang, x.source, x.n, x.cap, l.budget as given, 1::hugeint as weight
    from leaves x join l on x.domain = l.domain and x.lang is not distinct from l.lang""", "domain, lang", "source")},
plan as (
    select domain, lang, source, budget // greatest(n, 1) as epochs, budget % greatest(n, 1) as rest from s
), ordered as (
    select t.doc_id, t.domain, t.lang, t.source, epochs, rest, n,
           md5(concat_ws(':', '17', epochs::varchar, doc_id::varchar)) as h
    from tokens t join plan p
      on t.domain = p.domain and t.lang is not distinct from p.lang and t.source is not distinct from p.source
)
select doc_id, domain, lang, source,
       (epochs + case when rest > 0 and
           sum(n) over (partition by domain, lang, source order by h range unbounded preceding)
           - sum(n) over (partition by domain, lang, source, h) < rest then 1 else 0 end)::bigint as n_copies
from ordered
"""

QUALITY = """
with docs as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
    from documents
), coded as (
    select r, doc_id, list_transform(words, lambda w: substr(md5(w), 1, 4)) as codes from docs
), grams as (
    select r, doc_id, 'a' || unnest(codes) as gram from coded
    union all
    select r, doc_id, 'b' || substr(codes[i], 1, 2) || substr(codes[i + 1], 3, 2)
    from (select r, doc_id, codes, unnest(range(1, len(codes))) as i from coded)
), counted as (
    select gram, count(*) as raw, count(*) filter (where g.doc_id in (
        select doc_id from labels where quality = 1 and doc_id is not null)) as good
    from grams g group by gram
), weights as (
    select gram, case when all_good = 0 then 0 else
               round(ln((good + 16.0::double * (all_good::double / all_raw::double))
                        / ((raw + 16.0::double) * (all_good::double / all_raw::double))) * 1000000.0::double)::bigint end as micro
    from counted join (select left(gram, 1) as kind, sum(raw)::bigint as all_raw, sum(good)::bigint as all_good
                       from counted group by all) on left(gram, 1) = kind
), scores as (
    select r, sum(micro) as micro, count(*) as n_grams from grams join weights using (gram) group by r
), repeats as (
    select r, count(distinct i + k) as n
    from (select r, i, count(*) over (partition by r, said) as times
          from (select r, i, words[i:i + 4] as said
                from (select r, words, unnest(range(1, len(words) - 3)) as i from docs)))
         cross join range(5) t(k)
    where times > 1
    group by r
), lines as (
    select r, count(*) - count(distinct line) as n
    from (select r, unnest(string_split(text, chr(10))) as line from docs)
    where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
    group by r
), facts as (
    select doc_id, len(words) as n_words, coalesce(length(array_to_string(words, '')), 0) as word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(lines.n, 0) as n_dup_lines,
           coalesce(repeats.n, 0) as n_repeat_words, coalesce(micro, 0) as micro, coalesce(n_grams, 0) as n_grams
    from docs left join scores using (r) left join repeats using (r) left join lines using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and micro >= -200000 * n_grams as kept
from facts
"""

CHAT = """
with turns as (
    select conv_id, list({'role': role, 'text': text} order by turn nulls first, role, text) as said
    from (select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations)
    group by conv_id
), whole as (
    select said, min(conv_id) as conv_id, count(*) as n_equal from turns group by said
), inner_ends as (
    select distinct said[1:k] as said from (select said, unnest(range(1, len(said))) as k from turns)
)
select conv_id, len(said) as n_turns, n_equal,
       list_aggregate(list_transform(said, lambda t: '<|im_start|>' || t.role || chr(10)
           || replace(replace(t.text, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')
           || '<|im_end|>' || chr(10)), 'string_agg', '') as text
from whole anti join inner_ends using (said)
"""


def _matches(kind: str, order: int, pattern: str, secret: str, least: int) -> str:
    """Spans of one kind: matches are put between two marks, and the parts before them add up to the start.

    `secret` is the part of a match that must have `least` characters.
    """
    return f"""
    select doc_id, '{kind}' as kind, {order} as kind_order, start, start + length(hit) as stop
    from (
        select doc_id, string_split(part, chr(2))[1] as hit,
               length(parts[1]) + coalesce(list_sum([length(replace(x, chr(2), '')) for x in parts[2:i - 1]]), 0) as start
        from (select doc_id, parts, unnest(range(2, len(parts) + 1)) as i, parts[i] as part
              from (select doc_id, string_split(regexp_replace(coalesce(text, ''), '({pattern})', chr(1) || '\\1' || chr(2), 'g'),
                                                chr(1)) as parts from documents))
    )
    where length({secret}) >= {least}"""


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_KEYWORD = f"(?:{_any_case('password|passwd|secret|token|api_?key')})[\"\'\']?\\x20*[:=]\\x20*[\"\'\']?"
SECRETS = f"""
with spans as (
    {" union all ".join([
        _matches("assign", 1, _KEYWORD + "[A-Za-z0-9+/_.=-]+", f"regexp_replace(hit, '^{_KEYWORD}', '')", 12),
        _matches("access", 2, "AKIA[A-Z0-9]+", "hit", 18),
        _matches("hex", 3, "[0-9a-f]+", "hit", 16),
        _matches("github", 4, "gh[pousr]_[A-Za-z0-9]{36,}", "hit", 0),
        _matches("slack", 5, "xox[abprs]-[A-Za-z0-9-]{10,}", "hit", 0),
        _matches("google", 6, "AIza[A-Za-z0-9_-]{35,}", "hit", 0),
        _matches("stripe", 7, "[rs]k_live_[A-Za-z0-9]{16,}", "hit", 0),
        _matches("jwt", 8, "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}", "hit", 0),
        _matches("pem", 9, "-----BEGIN [A-Z ]*PRIVATE KEY-----", "hit", 0),
        _matches("url", 10, "://[A-Za-z0-9_.-]+:[^\\x20\\x09-\\x0D:@/]+@", "hit", 0),
    ])}
), per_doc as (
    select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
           count(*) filter (where kind = 'hex') as n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' order by start, kind_order) filter (where kind_order <= 3) as base,
           string_agg(kind || ':' || start || ':' || stop, ',' order by start, kind_order) as spans
    from spans group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join per_doc using (doc_id)
"""

_FINITE = "len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0"
HARD_NEGATIVES = f"""
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings where label is not null and embedding is not null and {_FINITE}
), scored as (
    select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
           coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0)::bigint as score
    from usable a join usable b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
), positives as (
    select anchor_id, id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id,
       row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank,
       id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 3
"""


def _assign(round_no: int) -> str:
    """Nearest entries (ties to the lower index) of all parts under the codebooks of a round."""
    return f"""assigned{round_no} as materialized (
    select r, p, x, nearest.d as d, nearest.e as e from (
        select r, p, any_value(parts.x) as x, min({{'d': list_sum(list_transform(list_zip(parts.x, books.x),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, 'e': e}}) as nearest
        from parts join book{round_no} books using (p) group by r, p)
)"""


def _move(round_no: int) -> str:
    """Entries at the floor of the mean of their parts; unused ones stay."""
    return f"""book{round_no + 1} as materialized (
    select p, e, coalesce(moved.x, book{round_no}.x) as x from book{round_no} left join (
        select p, e, list((s - ((s % n) + n) % n) // n order by j) as x
        from (select p, e, j, sum(x[j])::hugeint as s, count(*)::hugeint as n
              from (select p, e, x, unnest(range(1, len(x) + 1)) as j from assigned{round_no}) group by p, e, j)
        group by p, e) moved using (p, e)
)"""


VECTOR_CODES = f"""
with base as materialized (
    select row_number() over () as r, vec_id, label,
           list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
    from embeddings where embedding is not null and {_FINITE}
), parts as materialized (
    select r, vec_id, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] as x from base cross join range(4) t(p)
), book0 as materialized (
    select p, row_number() over (partition by p order by vec_id) - 1 as e, x from parts
    qualify row_number() over (partition by p order by vec_id) <= 256
), {", ".join(f"{_assign(n)}, {_move(n)}" for n in range(4))}, {_assign(4)}, coded as (
    select r, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from assigned4 group by r
), digest as (
    select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as codebooks_sha256 from book4
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from base join coded using (r) cross join digest
"""

ORACLE = {
    "op2_line_dedup": LINE_DEDUP,
    "op3_embedding_dedup": EMBEDDINGS,
    "op4_mix_sources": MIXING,
    "op5_quality_rules": QUALITY,
    "op6_chat_format": CHAT,
    "op10_secret_scan": SECRETS,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_vector_codes": VECTOR_CODES,
}

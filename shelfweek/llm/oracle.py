"""DuckDB SQL of the operators that SQL can express, with the parameters of the modules."""

from __future__ import annotations

from shelfweek.llm import curriculum as mix
from shelfweek.llm import lexical
from shelfweek.llm import line_frequency as lines
from shelfweek.llm import merkle
from shelfweek.llm import secret_scan as scan
from shelfweek.llm import url_rules as urls

W = r"[^\x20\x09-\x0D]+"

LINES = rf"""
with docs as (select doc_id, coalesce(text, '') as text, coalesce('=' || source, '') as host, row_number() over () as r from documents),
words as (select *, regexp_extract_all(text, '{W}') as w from docs),
grams as (select r, i, list_aggregate(w[i:i + {lines.WINDOW - 1}], 'string_agg', chr(1)) as g
          from (select r, w, unnest(range(1, len(w) - {lines.WINDOW - 2})) as i from words where len(w) >= {lines.WINDOW})),
again as (select r, i from (select r, i, count(*) over (partition by r, g) as n from grams) where n > 1),
spots as (select r, count(distinct p) as n from (select r, unnest(range(i, i + {lines.WINDOW})) as p from again) group by r),
dups as (select r, count(*) - count(distinct l) as n from (select r, unnest(string_split(text, chr(10))) as l from docs)
         where regexp_matches(l, '{W}') group by r),
normal as (select r, text, host, trim(l) as l from (
  select r, text, host, unnest(string_split(lower(regexp_replace(text, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10))) as l from docs) where trim(l) <> ''),
sizes as (select host, count(distinct text) as texts from docs group by host),
frequent as (select host, l from (select host, l, count(distinct text) as n from normal group by host, l) join sizes using (host)
             where n > {lines.LIMIT_TEXTS} and 100 * n > {lines.LIMIT_PERCENT} * texts),
gone as (select r, sum(len(regexp_extract_all(l, '{W}'))) as n from normal semi join frequent using (host, l) group by r),
base as (select doc_id, len(w) as n_words, len(list_aggregate(w || [''], 'string_agg', '')) as word_chars,
  len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(dups.n, 0) as n_dup_lines, coalesce(spots.n, 0) as n_repeat_words, coalesce(gone.n, 0) as gone
  from words left join dups using (r) left join spots using (r) left join gone using (r)),
judged as (select *, n_words - gone as n_left_words, n_words < {lines.MIN_WORDS} or 100 * n_repeat_words > {lines.MAX_REPEATED_PERCENT} * n_words as base_failed from base)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, n_left_words::bigint as n_left_words, base_failed,
  not base_failed and not (gone > 0 and n_left_words < {lines.LEFT_WORDS} and 100 * n_left_words < {lines.LEFT_PERCENT} * n_words) as kept
from judged
"""


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _spans(kind: int, pattern: str, accept: str) -> str:
    """Matches alternate with the gaps between them; positions are sums of their lengths."""
    return f"""
select r, {kind} as kind, starts[i] as s, starts[i] + len(found[i]) as e, found[i] as m from (
  select r, found, list_transform(range(1, len(found) + 1), lambda i: list_sum(list_transform(gaps[1:i], lambda x: len(x)))
    + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: len(x))), 0)) as starts, unnest(range(1, len(found) + 1)) as i
  from (select r, regexp_extract_all(text, '{_q(pattern)}') as found, string_split_regex(text, '{_q(pattern)}') as gaps from docs))
where {accept.format(m='found[i]')}"""


_VALUE = _q(r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?""")
_LIMIT = f"""case when regexp_full_match(m, '[0-9a-fA-F]+') then {scan.CLASS_LIMITS['hex']}
  when regexp_full_match(m, '[0-9A-Za-z]+') then {scan.CLASS_LIMITS['alnum']} else {scan.CLASS_LIMITS['mixed']} end"""
_ALLOWED = " or ".join(f"regexp_matches(m, '{p}')" for p in scan.ALLOWED)
_NAMES = "['assign', 'access', 'hex', 'entropy']"

SECRETS = f"""
with docs as (select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
base as ({_spans(0, scan.assign_pattern(), f"len(regexp_replace({{m}}, '{_VALUE}', '')) >= {scan.ASSIGN_LEAST}")}
  union all {_spans(1, scan.ACCESS, f"len({{m}}) >= {scan.ACCESS_LEAST}")}
  union all {_spans(2, scan.HEX, f"len({{m}}) >= {scan.HEX_LEAST}")}),
runs as ({_spans(3, scan.CANDIDATE, "regexp_matches({m}, '[0-9]') and regexp_matches({m}, '[A-Za-z]')")}),
free as (select * from runs where not ({_ALLOWED}) and not exists (select 1 from base where base.r = runs.r and base.s < runs.e and runs.s < base.e)),
windows as (select r, s, m, i, list_aggregate(string_split(m[i:i + {scan.WINDOW - 1}], ''), 'entropy') as h
            from (select r, s, m, unnest(range(1, len(m) - {scan.WINDOW - 2})) as i from free)),
hot as (select r, 3 as kind, s + min(i) - 1 as s, s + max(i) + {scan.WINDOW - 1} as e from windows where h >= {_LIMIT} group by r, s, m),
every as (select r, kind, s, e from base union all select r, kind, s, e from hot),
shown as (select r, count(*) filter (kind = 0) as a, count(*) filter (kind = 1) as b, count(*) filter (kind = 2) as c, count(*) filter (kind = 3) as d,
  coalesce(string_agg({_NAMES}[kind + 1] || ':' || s::bigint || ':' || e::bigint, ',' order by s, kind) filter (kind < 3), '') as base,
  string_agg({_NAMES}[kind + 1] || ':' || s::bigint || ':' || e::bigint, ',' order by s, kind) as spans from every group by r)
select doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(c, 0) as n_hex, coalesce(d, 0) as n_entropy,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join shown using (r)
"""

_WEIGHT = f"{[float(w) for w in mix.WEIGHTS]}[1 + rank % {len(mix.WEIGHTS)}]"

# All built-in ramps are made of pieces whose weights run linearly between knots; SQL spells the pieces out as rows.
_PIECES = "union all ".join(
    f"select {k} as ramp, {i} as piece, {t0} as t0, {w0} as f0, {t1} as t1, {w1} as f1, "
    f"{sum((a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in zip(ramp[:i], ramp[1:i + 1]))} as before, {(w0 + w1) / 2 * (t1 - t0)} as area "
    for k, ramp in enumerate(mix.RAMPS) for i, ((t0, w0), (t1, w1)) in enumerate(zip(ramp, ramp[1:])))

MIX = rf"""
with docs as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{W}')) as size, md5(coalesce(doc_id::varchar, '')) as o from documents),
sizes as (select source, sum(size)::bigint as source_size from docs group by source),
ranked as (select *, row_number() over (order by source nulls last) - 1 as rank, {mix.CAP} * source_size::double as most from sizes),
weighed as (select *, {_WEIGHT} as weight, rank % {len(mix.RAMPS)} as ramp from ranked),
leveled as (select *, most / weight as level from weighed),
shared as (select *, ((sum(source_size) over ())::double - coalesce(sum(most) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as shared
  from leveled window before as (order by level, source nulls last rows between unbounded preceding and 1 preceding)),
targets as (select source, source_size, ramp, least(most, weight * (select coalesce(arg_min(shared, level), 0) from shared where shared <= level)) as target from shared),
placed as (select d.*, t.source_size, t.target, t.ramp, sum(size) over (partition by d.source order by o, doc_id, size rows unbounded preceding) - size as start,
  least(round(target)::bigint, {mix.CAP} * source_size) as words from docs d join targets t on d.source is not distinct from t.source),
took as (select *, case when source_size > 0 then words // source_size else 0 end as passes from placed),
done as (select *, passes * size + greatest(0, least(size, words - passes * source_size - start)) as taken,
  case when target > 0 then least(1.0, start / target) else 0 end as share from took),
pieces as ({_PIECES}),
timed as (select d.*, p.*, row_number() over (partition by d.o, d.doc_id, d.size, d.start, d.source order by p.piece desc) as k
  from done d left join pieces p on p.ramp = d.ramp and p.before <= d.share and p.area > 0)
select doc_id, size::bigint as size, source_size, target, taken::bigint as taken,
  case when taken > 0 then least(t1, t0 + 2 * (share - before) / (f0 + sqrt(greatest(0, f0 * f0 + 2 * (f1 - f0) / (t1 - t0) * (share - before))))) end as position
from timed where k = 1
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)

URLS = rf"""
with pages_ as (select page_id, coalesce(url, '') as url, row_number() over () as r from pages),
split as (select page_id, r, regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1) as h, regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path from pages_),
named as (select page_id, r, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from split),
rules as (select * from (values {_RULES}) as t(rh, rp, v)),
hits as (select r, rh || rp as rule, v from named, rules where (host = rh or suffix(host, '.' || rh)) and prefix(path, rp)),
best as (select r, arg_max(rule, len(rule)) as rule, arg_max(v, len(rule)) as v from hits group by r)
select page_id, host, path, rule, coalesce(v, '{urls.DEFAULT}') as verdict from named left join best using (r)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SEARCH = rf"""
with docs as (select doc_id, row_number() over () as r, regexp_extract_all({_FOLD}, '{_TERM}') as t from documents),
held as (select r, any_value(doc_id) as doc_id, any_value(len(t))::bigint as n from docs where len(t) > 0 group by r),
total as (select count(*)::bigint as docs, sum(n)::bigint as terms from held),
counted as (select r, t, count(*)::bigint as tf from (select r, unnest(t) as t from docs) group by r, t),
weights as (select t, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from counted, total group by t),
asked as (select i, t, count(*)::bigint as c from (
  select i, unnest(regexp_extract_all({_FOLD}, '{_TERM}')) as t from (select text, row_number() over () as i from benchmark)) group by i, t),
items as (select item_id, row_number() over () as i from benchmark),
scored as (select i, r, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::bigint as score
  from asked join counted using (t) join weights using (t) join held using (r), total group by i, r),
placed as (select *, row_number() over (partition by i order by score desc, doc_id) as rank from scored join held using (r) where score > 0)
select item_id, rank::int as rank, doc_id, score from placed join items using (i) where rank <= {lexical.TOP}
"""


def _part(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::varchar))::varchar || ':' || {column}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_part(c if c != "text" else text) for c in merkle.FIELDS) + ")"


# The checksum is spelled out bit by bit, with the reversed polynomial.
_CRC = """(select xor(list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
  lambda crc, byte: list_reduce([xor(crc, byte)] || [0::bigint, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295))"""

MANIFEST = f"""
with recursive docs as (select doc_id, coalesce('=' || source, '') as tree, {_leaf('text')} as leaf,
  case when {_CRC} % {merkle.TAMPERED_EVERY} = 0 then {_leaf("translate(text, '" + merkle.UPPER + "', '" + merkle.LOWER + "')")} end as tampered from documents),
leaves as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, row_number() over () as r from docs),
nodes as (select tree, 0 as level, pos, leaf as digest from leaves
  union all
  select tree, level + 1, pos // {merkle.ARITY}, sha256(string_agg(digest, '' order by pos))
  from (select *, count(*) over (partition by tree) as n from nodes) where n > 1 group by tree, level, pos // {merkle.ARITY}),
heights as (select tree, max(level) as height from nodes group by tree),
subroots as (select tree, digest as subroot, row_number() over (order by tree) - 1 as pos from nodes join heights using (tree) where level = height),
tops as (select 0 as level, pos, subroot as digest from subroots
  union all
  select level + 1, pos // {merkle.ARITY}, sha256(string_agg(digest, '' order by pos)) from (select *, count(*) over () as n from tops) where n > 1 group by level, pos // {merkle.ARITY}),
top as (select max(level) as height, arg_max(digest, level) as root from tops),
every as (select tree, level, pos, digest from nodes union all select null, level, pos, digest from tops),
folds as (select r, tree, pos, 0 as level, 0 as step, coalesce(tampered, leaf) as digest, '' as proof, leaf, false as above from leaves
  union all
  select r, tree, pos, level, step, digest, proof, leaf, above from (
    select f.r, f.tree, case when climb then s.pos else f.pos // {merkle.ARITY} end as pos, case when climb then 0 else f.level + 1 end as level, f.step + 1 as step, f.leaf,
      f.above or climb as above,
      case when climb then f.digest else sha256((select string_agg(case when e.pos = f.pos then f.digest else e.digest end, '' order by e.pos) from every e
        where e.tree is not distinct from (case when f.above then null else f.tree end) and e.level = f.level and e.pos // {merkle.ARITY} = f.pos // {merkle.ARITY})) end as digest,
      case when climb then f.proof else f.proof || (select coalesce(string_agg(e.digest, '' order by e.pos) filter (e.pos <> f.pos), '') from every e
        where e.tree is not distinct from (case when f.above then null else f.tree end) and e.level = f.level and e.pos // {merkle.ARITY} = f.pos // {merkle.ARITY}) end as proof
    from (select folds.*, not above and level = height as climb from folds join heights using (tree) where not (above and level = (select height from top))) f join subroots s using (tree))),
done as (select r, arg_max(digest, step) as folded_root, arg_max(proof, step) as proof from folds where above and level = (select height from top) group by r)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded_root, folded_root = root as verified
from leaves join done using (r) join subroots using (tree), top
"""

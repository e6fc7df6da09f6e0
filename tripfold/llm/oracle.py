"""SQL that another engine runs on the same tables, for the queries that SQL can express."""

from __future__ import annotations

from tripfold.llm.mixing import KEY_RANGE, STEPS, Mix
from tripfold.llm.quality_rules import RULES, STOP_WORDS

ORACLE: dict[str, str] = {}

_BLANK = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"


def _rules_sql() -> str:
    tests = []
    for rule in RULES:
        tests += [f"coalesce({rule.metric} >= {rule.low}, true)"] if rule.low is not None else []
        tests += [f"coalesce({rule.metric} <= {rule.high}, true)"] if rule.high is not None else []
    return " and ".join(tests)


ORACLE["op3_quality_rules"] = rf"""
with texts as (
    select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), parts as (
    select r, doc_id, t,
           list_filter(string_split_regex(t, '{_BLANK}'), lambda w: w <> '') as words,
           list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) as lines
    from texts
), windows as (
    select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w
    from (select r, words, unnest(range(1, len(words) - 1)) as i from parts)
), repeated as (
    select r, i from (select r, i, count(*) over (partition by r, w) as n from windows) where n > 1
), covered as (
    select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from repeated) group by r
), counts as (
    select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
           len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
           len(lines) as n_lines,
           len(list_filter(words, lambda w: w in ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) as n_stop_words,
           len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•]'))) as n_bullet_lines,
           len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) as n_open_lines
    from parts left join covered using (r)
), judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and {_rules_sql()} as kept
from judged
"""


def _bisect_sql(name: str, good: str) -> str:
    return f"""
{name} as (
    select 0 as i, 0::bigint as low, {(1 << STEPS) + 1}::bigint as high
    union all
    select i + 1, case when good then k else low end, case when good then high else k end
    from (
        select i, low, high, k, {good} as good
        from (select i, low, high, k, shares, wanted, weights, list_sum(weights) as z
              from (select i, low, high, k, shares, wanted, list_transform(shares, lambda p: pow(p, k / {1 << STEPS}::double)) as weights
                    from (select i, low, high, (low + high) // 2 as k from {name} where i <= {STEPS}), stats))
    )
)"""


def _key_sql(copy: str) -> str:
    return f"('0x' || substr(md5('{Mix().seed}|' || {copy} || '|' || coalesce(doc_id::varchar, '')), 1, 15))::bigint"


_LIMIT = Mix().max_repeats
_ENTROPY = "list_sum(list_transform(weights, lambda w: -w / z * ln(w / z))) >= wanted"
_REPEATS = f"{Mix().budget} * weights[1] / z / shares[1] > {_LIMIT}"
ORACLE["op8_mixing"] = f"""
with recursive texts as (
    select source, doc_id, len(regexp_extract_all(coalesce(text, ''), '{_WORD}+')) as n from documents
), sources as (
    select source, sum(n)::bigint as tokens, count(*) as n_rows from texts group by source
), totals as (
    select sum(tokens)::bigint as total, list(tokens order by tokens) filter (tokens > 0) as counts from sources
), stats as (
    select total, list_transform(counts, lambda c: c / total::double) as shares, {Mix().entropy} * ln(len(counts)) as wanted from totals
), {_bisect_sql("by_entropy", _ENTROPY)}, {_bisect_sql("too_often", _REPEATS)}, chosen as (
    select greatest((select low from by_entropy where i = {STEPS + 1}),
                    case when {Mix().budget} / len(shares) / shares[1] > {_LIMIT}
                         then least((select low from too_often where i = {STEPS + 1}) + 1, {1 << STEPS}) else 0 end) as k,
           total, shares
    from stats
), norms as (
    select k, total, list_sum(list_transform(shares, lambda p: pow(p, k / {1 << STEPS}::double))) as z from chosen
), plan as (
    select source, tokens, quota, coalesce(quota // nullif(tokens, 0), 0) as passes, mix_blocks
    from (select source, tokens, greatest(ceil(budget / {Mix().block_tokens}::double), 1)::bigint as mix_blocks,
                 floor(budget * case when tokens > 0 then pow(tokens / total::double, k / {1 << STEPS}::double) / z else 0 end)::bigint as quota
          from (select *, floor(total * {Mix().budget}) as budget from sources, norms))
), keyed as (
    select texts.source, doc_id, n, tokens, quota, passes, mix_blocks, {_key_sql("passes")} as key
    from texts join plan on texts.source is not distinct from plan.source
), extra as (
    select *, passes + (tokens > 0 and sum(n) over (partition by source order by key) <= quota - passes * tokens)::int as copies from keyed
), copied as (
    select source, doc_id, tokens, quota, mix_blocks, unnest(range(copies)) as copy from extra
)
select doc_id, source, copy, {_key_sql("copy")} as mix_key,
       coalesce(least(floor((copy + {_key_sql("copy")} / {KEY_RANGE}::double) * tokens / nullif(quota, 0) * mix_blocks)::bigint, mix_blocks - 1), 0) as mix_block
from copied
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE["op11_decontamination"] = rf"""
with docs as (
    select row_number() over () as d, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') as words from documents
), items as (
    select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') as words from benchmark
), windows as (
    select distinct item, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') as w, least(len(words), 10) as size
    from (select item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from items where len(words) > 0)
), runs as (
    select d, i, size, array_to_string(words[i : i + size - 1], ' ') as w
    from (select d, words, size, unnest(range(1, len(words) - size + 2)) as i from docs, (select distinct size from windows) where len(words) >= size)
), found as (
    select d, i, runs.size, item from runs join windows using (w) where runs.size = windows.size
), hits as (
    select d, count(distinct p) as n_hit from (select d, unnest(range(i, i + size)) as p from (select distinct d, i, size from found)) group by d
), named as (
    select d, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct d, item from found) group by d
)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (d) left join named using (d)
"""


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Codebooks round by round: every part against every entry."""
    # the division leaves no rest: rounded down before it, also below zero
    floor_mean = "((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) / count(*))::bigint"
    steps = f"""
with rows as (
    select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, embedding as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), places as (
    select r, unnest(range(len(v))) as spot, unnest(list_transform(v, lambda x: floor(256 * x::double)::bigint)) as x, len(v) // {parts} as width from rows
), cells as (
    select r, floor(spot / width)::bigint as part, spot % width as j, x from places
), book0 as (
    select part, r - 1 as entry, j, x from cells where r <= {entries}
)"""
    for n in range(rounds + 1):
        steps += f""", apart{n} as (
    select r, part, entry, sum((c.x - b.x) * (c.x - b.x))::bigint as distance from cells c join book{n} b using (part, j) group by r, part, entry
), near{n} as (
    select r, part, arg_min(entry, (distance, entry)) as entry, min(distance) as distance from apart{n} group by r, part
)"""
        if n < rounds:
            steps += f""", mean{n} as (
    select part, entry, j, {floor_mean} as x from cells join near{n} using (r, part) group by part, entry, j
), book{n + 1} as (
    select part, entry, j, coalesce(m.x, b.x) as x from book{n} b left join mean{n} m using (part, entry, j)
)"""
    return f"""{steps}, coded as (
    select r, string_agg(lower(printf('%02x', entry::int)), '' order by part) as code, sum(distance)::bigint as error from near{rounds} group by r
), digest as (
    select sha256(string_agg(x::varchar, ',' order by part, entry, j)) as codebooks_sha256 from book{rounds}
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from rows join coded using (r), digest
"""


ORACLE["op13_vector_codes"] = _codes_sql()

"""SQL twin of the language model's query, for order 2."""

from __future__ import annotations

from resonara.llm import katz
from resonara.llm.conversation_sql import crc32


def _discounts(level: int, counts: str) -> str:
    """The discounts by count as a table ``kept<level>`` (r, part), see ``katz.discounts``."""
    most = katz.DISCOUNTED

    def found(r: int, k: int) -> str:
        share = f"({k + 1} * n{k + 1} / n1)"
        return f"(({r + 1} * n{r + 1} / ({r} * n{r}) - {share}) / (1 - {share}))"

    def part(r: int) -> str:
        ways = []
        for k in range(most, 1, -1):
            holds = " and ".join([*(f"n{of} > 0" for of in range(1, k + 2)), *(f"{found(of, k)} > 0 and {found(of, k)} < 1" for of in range(1, k + 1))])
            ways.append(f"when {holds} then {found(r, k) if r <= k else '1.0'}")
        return f"case {' '.join(ways)} else ({r} - case when n1 > 0 and n2 > 0 then n1 / (n1 + 2 * n2) else 0.5 end) / {r} end"

    tallies = ", ".join(f"count(*) filter (c = {r})::double as n{r}" for r in range(1, most + 2))
    rows = " union all ".join(f"select {r} as r, {part(r)} as part from tally{level}" for r in range(1, most + 1))
    return f"tally{level} as (select {tallies} from {counts}), kept{level} as ({rows})"


def katz_sql(share: int, apart: int) -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
        with texts as (
            select row_number() over () as place, doc_id, {crc32("coalesce(doc_id::varchar, '')")} % {share} = {apart} as held_out,
                   list_append(regexp_extract_all(translate(coalesce(text, ''), {letters}), '[^\\x20\\x09-\\x0D]+'), ' ') as words
            from documents),
        tokens as (select place, held_out, unnest(words) as word, generate_subscripts(words, 1) as n from texts),
        pairs as (select *, coalesce(lag(word) over (partition by place order by n), chr(9)) as before from tokens),
        singles as (select word, count(*) as c from tokens where not held_out group by word),
        twos as (select before, word, count(*) as c from pairs where not held_out group by all),
        {_discounts(1, "singles")}, {_discounts(2, "twos")},
        masses as (select word, c, c * coalesce(part, 1.0) as mass from singles left join kept1 on r = c),
        size as (
            select coalesce(sum(c), 0) as n, count(*) as kinds, coalesce(sum(mass), 0) as mass,
                   coalesce(sum(c), 0) + (coalesce(sum(mass), 0) = coalesce(sum(c), 0))::int as total from masses),
        first as (select word, c, m.mass / total as p from masses m, size),
        seen as (select t.before, t.word, t.c, t.c * coalesce(part, 1.0) as mass, p from twos t left join kept2 on r = t.c join first using (word)),
        contexts as (
            select before, sum(c) + (sum(mass) = sum(c))::int as total, (1 - sum(mass) / (sum(c) + (sum(mass) = sum(c))::int)) / (1 - sum(p)) as weight
            from seen group by before),
        scored as (
            select t.place, f.c is not null as known, log10((coalesce(f.c, 0) + 1) / (z.n + z.kinds + 1)) as base,
                   log10(case when s.mass is not null then s.mass / c.total
                         else coalesce(c.weight, 1.0) * coalesce(f.p, 1 - z.mass / z.total) end) as score
            from pairs t cross join size z left join first f on f.word = t.word
            left join seen s on s.before = t.before and s.word = t.word left join contexts c on c.before = t.before),
        sums as (
            select place, count(*) as n_tokens, count(*) filter (known) as n_known, round(sum(base), 6) as base_score, round(sum(score), 6) as score
            from scored group by place)
        select doc_id, held_out, n_tokens, n_known, (select n from size)::bigint as train_tokens, base_score, score
        from texts join sums using (place)"""

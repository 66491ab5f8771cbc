"""SQL twins of the queries on conversations."""

from __future__ import annotations

from resonara.llm import prefix_trie, turn_repair

#: The reversed polynomial of crc32 and its start.
_POLYNOMIAL, _ONES = 3988292384, 4294967295


def crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit, as a DuckDB expression."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::ubigint)"
    byte = f"list_reduce([xor(crc, code), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, (a & 1) * {_POLYNOMIAL}))"
    return f"xor(list_reduce(list_concat([{_ONES}::ubigint], {codes}), lambda crc, code: {byte}), {_ONES}::ubigint)"


_SPACE = r"\x20\x09-\x0D"


def turn_repair_sql() -> str:
    """The least way to each of the four stacks, turn by turn, in a recursive query.

    A way is a text: its cost in eight digits, its audit, the character 1 and the repaired
    text; the least of such texts is the least (cost, audit).
    """
    def step(way: str, cost: str | int, edit: str, line: str | None = None) -> str:
        text = f"split_part({way}, chr(1), 1)"
        rest = f"substr({way}, length({text}) + 2)"
        after = rest if line is None else f"case when length({rest}) = 0 then '' else {rest} || chr(10) end || {line}"
        return f"printf('%08d', cast(left({way}, 8) as bigint) + ({cost})) || substr({text}, 9) || '{edit}' || chr(1) || {after}"

    def least(*ways: str) -> str:
        return f"least({', '.join(ways)})"

    def when(condition: str, way: str) -> str:
        return f"case when {condition} then {way} end"

    def closed(start: str, system: str, asked: str, pairs: str) -> list[str]:
        """The ways with insertions: an asked user after any other stack, then an answer."""
        return [start, system, least(asked, *(step(f"w.{way}", turn_repair.INSERT, "I", "'user:'") for way in ("start", "sys", "pairs"))), pairs]

    kept, rerole = "r.late", f"{turn_repair.REROLE} + r.late"
    user, answer = "'user:' || r.text", "'assistant:' || r.text"
    own = "r.role || ':' || r.text"
    gone = lambda way: step(f"w.{way}", turn_repair.DELETE, "D")
    keep = lambda way, initial: when(f"not r.must and r.initial = '{initial}'", step(f"w.{way}", kept, "K", own))
    turned = lambda way, line: when("not r.must", step(f"w.{way}", rerole, "R", line))
    after = {
        "start": gone("start"),
        "sys": least(gone("sys"), keep("start", "s")),
        "asked": least(gone("asked"), *(keep(way, "u") for way in ("start", "sys", "pairs")), *(turned(way, user) for way in ("start", "sys", "pairs"))),
        "pairs": least(gone("pairs"), keep("asked", "a"), turned("asked", answer)),
    }
    asked = least("w.asked", *(step(f"w.{way}", turn_repair.INSERT, "I", "'user:'") for way in ("start", "sys", "pairs")))
    pairs = least("w.pairs", step("w.asked", turn_repair.INSERT, "I", "'assistant:'"))
    return f"""
        with recursive damaged as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                   {crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as fault
            from conversations),
        rows as (
            select conv_id, turn, case when fault = 4 then 'user' else role end as role,
                   case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
            from damaged, generate_series(1, case fault when 0 then 0 when 3 then 2 else 1 end)),
        numbered as (
            select *, coalesce(conv_id::varchar, 'null') as key,
                   row_number() over (partition by conv_id order by turn nulls first, role, text) as n,
                   regexp_extract(text, '([^{_SPACE}])[{_SPACE}]*$', 1) as final
            from rows),
        turns as (
            select *, left(role, 1) as initial, final = '' as blank, lag(left(role, 1)) over (partition by conv_id order by n) as before,
                   final <> '' and row_number() over (partition by conv_id, role, text order by n) > 1 as duplicate
            from numbered),
        faults as (select *, not blank and not duplicate and final not in ('.', '!', '?') as truncated from turns),
        codes as (select *, blank or duplicate as must, truncated::int as late from faults),
        counts as (
            select key, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
                   count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
                   count(*) filter (n > 1 and before || initial not in ('su', 'ua', 'au')) as illegal, max(n) as size
            from codes group by key),
        ways as (
            select key, 0::bigint as n, '00000000' || chr(1) as start, null::varchar as sys,
                   '00000002I' || chr(1) || 'user:' as asked, '00000004II' || chr(1) || 'user:' || chr(10) || 'assistant:' as pairs
            from counts
            union all
            select key, n, start, sys, asked, {pairs} as pairs
            from (select key, n, start, sys, {asked} as asked, pairs from (
                select w.key, r.n, {after["start"]} as start, {after["sys"]} as sys, {after["asked"]} as asked, {after["pairs"]} as pairs
                from ways w join codes r on r.key = w.key and r.n = w.n + 1) w) w),
        ends as (
            select c.*, least(w.start, w.pairs) as way, split_part(least(w.start, w.pairs), chr(1), 1) as head
            from counts c join ways w on w.key = c.key and w.n = c.size)
        select ids.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
               coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
               coalesce(left(head, 8)::bigint, 0) as cost, coalesce(substr(head, 9), '') as audit,
               sha256(coalesce(substr(way, length(head) + 2), '')) as repaired_sha256
        from (select distinct conv_id, coalesce(conv_id::varchar, 'null') as key from conversations) ids left join ends using (key)"""


def prefix_trie_sql() -> str:
    """Every prefix as a list of turns; sums over subtrees by handing each node to all its ancestors."""
    return f"""
        with placed as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) as place
            from conversations where conv_id is not null),
        sizes as (
            select distinct conv_id, conv_id - conv_id % {prefix_trie.STEP} as base,
                   ({crc32("conv_id::varchar")} % {prefix_trie.BORROWED})::bigint as own from placed),
        lent as (
            select s.conv_id, p.place as n, p.role, p.text from sizes s join placed p on p.conv_id = s.base and p.place <= s.own),
        turns as (
            select * from lent union all
            select p.conv_id, {prefix_trie.BORROWED} + p.place, p.role, p.text from placed p join sizes s using (conv_id) where p.place > s.own),
        lists as (select conv_id, list([role, text] order by n) as turns from turns group by conv_id),
        members as (select s.conv_id, coalesce(l.turns, []) as turns from sizes s left join lists l using (conv_id)),
        prefixes as (select conv_id, len(turns) as size, unnest(generate_series(0, len(turns))) as depth, turns from members),
        nodes as (
            select turns[1:depth] as prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, bool_and(size = depth) as childless,
                   sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (size = depth), '')) as ends_sha256
            from prefixes group by all),
        weighed as (
            select *, case when depth = 0 then 0 else (n_convs - 1) * strlen(prefix[depth][2]) end as saved,
                   unnest(generate_series(0, depth)) as above from nodes),
        sums as (
            select prefix[1:above] as prefix, count(*) filter (childless) as n_leaves, sum(saved)::bigint as saved_tokens,
                   count(*) filter (above = depth - 1) as n_children
            from weighed group by prefix[1:above])
        select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
        from nodes n join sums s on s.prefix = n.prefix left join nodes p on n.depth > 0 and p.prefix = n.prefix[1:n.depth - 1]"""

"""Repair of the order of roles in conversations by a generalised LR parse with weighted edits.

A talk is an optional system turn and then pairs of a user's and an assistant's
turn.  The grammar's LR(0) automaton is built from its rules.  A conversation is
read turn by turn; the graph-structured stack holds every stack that some sequence
of edits leads to, as linked nodes that share what lies below.  Keeping, rerolling,
deleting a turn and inserting one each cost; of two ways to the same stack the one
of the least (cost, audit) stays.  The audit is one letter per edit: K, R, D, I.

Equal cost at the same turn rules out that one audit begins another, since they
could differ by insertions only and these cost; so the least audit of a whole is
made of the least audits of its parts, and a conversation can be read in segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resonara.llm.common import keyed_lookup
from resonara.operators.ordering import with_position
from resonara.workspace import written

#: The role grammar; terminals are the initials of the roles.
GRAMMAR = (("talk", ()), ("talk", ("pairs",)), ("pairs", ("asked", "a")),
           ("asked", ("u",)), ("asked", ("s", "u")), ("asked", ("pairs", "u")))
START = "talk"
ROLES = {"u": "user", "a": "assistant"}  # what a turn may become or be inserted as
INITIALS = "sua"
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Longer conversations are read in segments of so many turns, in separate tasks.
SEGMENT = 4096
FEW_LONG = 100_000

BLANK, REPEATED = " ", "="
RESULT = "struct<blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, cost: bigint, audit: string, repaired_sha256: string>"
_RESULT = pa.struct([(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
                    + [("audit", pa.string()), ("repaired_sha256", pa.string())])


def _closure(items: frozenset) -> frozenset:
    """Items (rule, place) with all rules that may begin at their places."""
    found, left = set(items), list(items)
    while left:
        rule, place = left.pop()
        body = GRAMMAR[rule][1]
        for other, (head, _) in enumerate(GRAMMAR):
            if place < len(body) and body[place] == head and (other, 0) not in found:
                found.add((other, 0))
                left.append((other, 0))
    return frozenset(found)


@cache
def _goto(state: frozenset, symbol: str) -> frozenset:
    return _closure(frozenset((rule, place + 1) for rule, place in state
                              if place < len(GRAMMAR[rule][1]) and GRAMMAR[rule][1][place] == symbol))


def _complete(state: frozenset) -> list[int]:
    return [rule for rule, place in state if place == len(GRAMMAR[rule][1])]


#: A stack is (state, stack below); the first one has nothing below.
FIRST = (_closure(frozenset((rule, 0) for rule, (head, _) in enumerate(GRAMMAR) if head == START)), None)


def _reduced(stack: tuple, rule: int) -> tuple | None:
    """The stack after reducing by a rule; None where the automaton has no such way on."""
    for _ in GRAMMAR[rule][1]:
        stack = stack[1]
    state = _goto(stack[0], GRAMMAR[rule][0])
    return (state, stack) if state else None


def _settled(stacks: list[tuple]) -> tuple:
    """Stacks on which nothing can be reduced without knowing what follows."""
    found = []
    while stacks:
        stack = stacks.pop()
        done = _complete(stack[0])
        if len(done) == len(stack[0]):
            stacks.extend(filter(None, (_reduced(stack, rule) for rule in done)))
        else:
            found.append(stack)
    return tuple(found)


@cache
def shifted(stack: tuple, terminal: str) -> tuple:
    """Every stack after ``terminal``, by all reductions that may come before it."""
    ways, left, found = [], [stack], {stack}
    while left:
        at = left.pop()
        if state := _goto(at[0], terminal):
            ways.append((state, at))
        for rule in _complete(at[0]):
            after = _reduced(at, rule)
            if after is not None and after not in found:
                found.add(after)
                left.append(after)
    return _settled(ways)


@cache
def accepted(stack: tuple) -> bool:
    """Whether the turns read so far are a whole talk."""
    for rule in _complete(stack[0]):
        head, body = GRAMMAR[rule]
        if head == START:
            below = stack
            for _ in body:
                below = below[1]
            if below == FIRST:
                return True
        elif (after := _reduced(stack, rule)) is not None and accepted(after):
            return True
    return False


@cache
def stacks() -> tuple:
    """All stacks that turns can lead to: few, as the grammar only recurses to the left."""
    found, left = [FIRST], [FIRST]
    while left:
        at = left.pop()
        for terminal in INITIALS:
            for after in shifted(at, terminal):
                if after not in found:
                    found.append(after)
                    left.append(after)
    return tuple(found)


@cache
def _moves() -> tuple[list[list[int]], list[list[list[int]]]]:
    """By number of a stack: where insertions lead, and where each initial leads."""
    number = {stack: n for n, stack in enumerate(stacks())}
    to = [[[number[after] for after in shifted(stack, terminal)] for terminal in INITIALS] for stack in stacks()]
    return [[after for role in ROLES for after in ways[INITIALS.index(role)]] for ways in to], to


def _offer(ways: dict, stack: int, cost: int, audit: str) -> bool:
    held = ways.get(stack)
    if held is None or cost < held[0] or (cost == held[0] and audit < held[1]):
        ways[stack] = (cost, audit)
        return True
    return False


def read(codes: str, ways: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
    """The least (cost, audit) to every stack after the turns ``codes``, from those before them.

    A code is the role's initial, or ``?`` for other roles; a capital, or ``!``, for a
    truncated turn; ``BLANK`` and ``REPEATED`` for turns that must go.
    """
    inserted, to = _moves()

    def with_insertions(ways):
        left = list(ways)
        while left:
            at = left.pop()
            cost, audit = ways[at]
            for after in inserted[at]:
                if _offer(ways, after, cost + INSERT, audit + "I"):
                    left.append(after)
        return ways

    ways = with_insertions(dict(ways))
    for code in codes:
        after: dict[int, tuple[int, str]] = {}
        kept = code.lower() if code != "!" else "?"
        penalty = TRUNCATED if code == "!" or code.isupper() else 0
        for at, (cost, audit) in ways.items():
            _offer(after, at, cost + DELETE, audit + "D")
            if code in (BLANK, REPEATED):
                continue
            if kept in INITIALS:
                for stack in to[at][INITIALS.index(kept)]:
                    _offer(after, stack, cost + penalty, audit + "K")
            for stack in inserted[at]:
                _offer(after, stack, cost + REROLE + penalty, audit + "R")
        ways = with_insertions(after)
    return ways


def best(ways: dict[int, tuple[int, str]]) -> tuple[int, str]:
    return min(way for stack, way in ways.items() if accepted(stacks()[stack]))


def repaired(audit: str, roles: list[str], texts: list[str], stack: int = 0) -> tuple[list[str], int]:
    """The lines ``role:text`` that an audit leaves, and the stack after them; the stack tells what R and I made."""
    _, to = _moves()
    rows, lines = iter(zip(roles, texts)), []
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = next(ROLES[of] for of in ROLES if to[stack][INITIALS.index(of)])
        stack = to[stack][INITIALS.index(role[:1])][0]
        lines.append(f"{role}:{text}")
    return lines, stack


def _illegal(initials: Sequence[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _whole(roles: list[str], texts: list[str], shapes: list[str]) -> dict:
    """All results for the turns of one conversation; ``shapes`` are codes that do not yet know repeated turns."""
    seen, codes = set(), []
    for role, text, shape in zip(roles, texts, shapes):
        codes.append(REPEATED if shape != BLANK and (role, text) in seen else shape)
        seen.add((role, text))
    audit_cost, audit = best(read("".join(codes), {0: (0, "")}))
    text = "\n".join(repaired(audit, roles, texts)[0])
    return {**_counts("".join(codes)), "illegal": _illegal([role[:1] for role in roles]), "cost": audit_cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def _counts(codes: str) -> dict:
    return {"blank": codes.count(BLANK), "duplicate": codes.count(REPEATED), "truncated": sum(code == "!" or code.isupper() for code in codes)}


def _whole_repair():
    @F.arrow_udf(RESULT)
    def repair(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = ((row["role"], row["text"], row["shape"]) for row in (_columns(rows.as_py()) for rows in batch))
            yield pa.array([_whole(*row) for row in found], _RESULT)

    return repair


def _columns(rows: list[dict]) -> dict:
    return {name: [row[name] for row in rows] for name in ("role", "text", "shape")}


def shape(role: Column, text: Column) -> Column:
    """The code of a turn by itself, see ``read``."""
    last = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    initial = F.substring(role, 1, 1)
    known = F.when(initial.isin(*INITIALS), initial).otherwise("?")
    return (F.when(last == "", BLANK).when(last.isin(".", "!", "?"), known)
            .otherwise(F.when(known == "?", "!").otherwise(F.upper(known))))


def repair(turns: DataFrame, key_col: str = "key", segment: int = SEGMENT) -> DataFrame:
    """For each key: ``gaps`` and the fields of ``RESULT``.

    ``turns`` has the key (not null), ``turn``, ``role``, ``text`` (not null) and
    ``copies``, how often the row stands there; rows of 0 copies only make their key
    appear.  Turns are read by number, null first, then by role and text.  Keys of
    at most ``segment`` turns are read whole; longer ones in segments by separate
    tasks, whose ways between all stacks are then joined.  Starts Spark jobs.
    """
    key = F.col(key_col)
    rows = turns.select(key.alias("key"), "turn", "role", "text", "copies")
    long = rows.groupBy("key").agg(F.sum("copies").alias("rows")).where(F.col("rows") > segment)
    long = written(long, "long")
    few = long.limit(FEW_LONG + 1).count()
    short = rows if not few else rows.join(F.broadcast(long) if few <= FEW_LONG else long, "key", "left_anti")
    here = short.withColumn("text", F.when(F.col("copies") > 0, F.col("text")))
    lists = here.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "copies"))).alias("rows"))
    lists = lists.withColumn("rows", F.expr("flatten(transform(rows, r -> array_repeat(r, cast(r.copies as int))))"))
    shaped = F.transform("rows", lambda row: F.struct(row["role"].alias("role"), row["text"].alias("text"), shape(row["role"], row["text"]).alias("shape")))
    known = F.filter(F.col("rows.turn"), lambda turn: turn.isNotNull())
    found = lists.select("key", _gaps(F.array_min(known), F.array_max(known), F.size(F.array_distinct(known))).alias("gaps"),
                         _whole_repair()(shaped).alias("found")).select("key", "gaps", "found.*")
    if few:
        found = found.unionByName(_by_segments(keyed_lookup(rows, long, ["key"], "rows").drop("rows"), segment))
    return found.withColumnRenamed("key", key_col)


def _gaps(least: Column, most: Column, distinct: Column) -> Column:
    return F.coalesce(most - least + 1 - distinct, F.lit(0)).cast("long")


def _segment_ways():
    @F.arrow_udf("array<struct<first: int, last: int, cost: bigint, audit: string>>")
    def ways(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
        for batch in batches:
            yield pa.array([[{"first": first, "last": last, "cost": cost, "audit": audit} for first in range(len(stacks()))
                             for last, (cost, audit) in read(codes.as_py(), {first: (0, "")}).items()] for codes in batch], kind)

    return ways


def _joined_ways():
    """Counts, cost, and for each segment its audit and the stack it starts on."""
    kind = pa.struct([*((name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "cost")),
                      ("parts", pa.list_(pa.struct([("audit", pa.string()), ("stack", pa.int32())])))])

    def joined(segments: list[dict]) -> dict:
        ways = {0: (0, "", ())}
        for segment in segments:
            after: dict[int, tuple[int, str, tuple]] = {}
            for step in segment["ways"]:
                if step["first"] in ways:
                    cost, audit, path = ways[step["first"]]
                    way = (cost + step["cost"], audit + step["audit"], (path, step["audit"], step["first"]))
                    if step["last"] not in after or way[:2] < after[step["last"]][:2]:
                        after[step["last"]] = way
            ways = after
        cost, _, path = min((way for stack, way in ways.items() if accepted(stacks()[stack])), key=lambda way: way[:2])
        parts = []
        while path:
            path, audit, first = path
            parts.append({"audit": audit, "stack": first})
        return {**_counts("".join(segment["codes"] for segment in segments)), "illegal": _illegal("".join(s["initials"] for s in segments)),
                "cost": cost, "parts": parts[::-1]}

    @F.arrow_udf("struct<blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, cost: bigint, "
                 "parts: array<struct<audit: string, stack: int>>>")
    def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([joined(segments.as_py()) for segments in batch], kind)

    return join


def _segment_text():
    @F.arrow_udf("string")
    def text(audits: pa.Array, stacks_before: pa.Array, rows: pa.Array) -> pa.Array:
        found = []
        for audit, stack, own in zip(audits.to_pylist(), stacks_before.to_pylist(), rows.to_pylist()):
            lines, _ = repaired(audit, [row["role"] for row in own], [row["text"] for row in own], stack)
            found.append("\n".join(lines) if lines else None)
        return pa.array(found, pa.string())

    return text


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key`` and the digest of its pieces joined by newlines; rows come ordered, and only one hash is held."""
    key, digest, begun = None, None, False
    for batch in batches:
        done = []
        for of, piece in zip(batch["key"].to_pylist(), batch["piece"].to_pylist()):
            if of != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest, begun = of, hashlib.sha256(), False
            if piece is not None:
                digest.update(("\n" + piece if begun else piece).encode())
                begun = True
        yield pa.RecordBatch.from_arrays([pa.array([d[n] for d in done], pa.string()) for n in (0, 1)], ["key", "repaired_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "repaired_sha256"])


def _by_segments(rows: DataFrame, segment: int) -> DataFrame:
    """``repair`` of conversations too long for one task.

    What a conversation needs in one place is one letter per turn, as long as its
    audit, and the running digest of its repaired text.
    """
    rows = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    placed = written(with_position(rows.drop("copies"), [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "position")
                     .withColumn("name", F.unhex(F.md5(F.concat_ws(":", F.char_length("role"), "role", "text")))), "placed")
    sizes = written(placed.groupBy("key").agg(F.min("position").alias("start"), F.count("*").alias("rows"), F.min("turn").alias("least"),
                                              F.max("turn").alias("most")), "sizes")
    turns = placed.select("key", "turn").distinct().groupBy("key").agg(F.count("turn").alias("distinct"))
    first = written(placed.groupBy("key", "name").agg(F.min("position").alias("first"), F.count("*").alias("rows")), "first")
    known = keyed_lookup(placed, first, ["key", "name"], "rows").drop("rows", "name")
    own = shape(F.col("role"), F.col("text"))
    coded = keyed_lookup(known, sizes.select("key", "start", "rows"), ["key"], "rows").select(
        "key", F.floor((F.col("position") - F.col("start")) / segment).alias("segment"), "position", "role", "text",
        F.when((own != BLANK) & (F.col("first") < F.col("position")), REPEATED).otherwise(own).alias("code"))
    fields = F.struct("position", "role", "text", "code")
    parts = written(coded.groupBy("key", "segment").agg(F.sort_array(F.collect_list(fields)).alias("rows")), "segments")
    read_parts = parts.select("key", "segment", F.array_join("rows.code", "").alias("codes"),
                              F.array_join(F.transform("rows.role", lambda role: F.when(role == "", "?").otherwise(F.substring(role, 1, 1))), "").alias("initials"))
    ways = read_parts.withColumn("ways", _segment_ways()("codes"))
    joined = ways.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("segment", "codes", "initials", "ways"))).alias("segments"))
    joined = written(joined.select("key", _joined_ways()("segments").alias("found")).select("key", "found.*"), "joined")
    audits = joined.select("key", F.posexplode("parts").alias("segment", "part")).select("key", F.col("segment").cast("long"), "part.*")
    pieces = (parts.join(audits, ["key", "segment"]).select("key", "segment", _segment_text()("audit", "stack", "rows").alias("piece"))
              .repartition("key").sortWithinPartitions("key", "segment").select("key", "piece"))
    digests = pieces.mapInArrow(_digests, "key string, repaired_sha256 string")
    return (joined.join(digests, "key").join(sizes, "key").join(turns, "key")
            .select("key", _gaps(F.col("least"), F.col("most"), F.col("distinct")).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                    "cost", F.array_join("parts.audit", "").alias("audit"), "repaired_sha256"))


def damaged(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Turns with faults planted by crc32 of ``conv_id:turn`` modulo 20; nulls of texts count as one space.

    0 drops the row, 1 empties the text, 2 takes its sentence marks, 3 repeats the
    row, 4 makes it the user's.  Columns ``key`` (``=`` and the id, or ``null``),
    ``turn``, ``role``, ``text``, ``copies``.
    """
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", spaced(conv_col), spaced("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("null")).alias("key"), "turn",
        F.when(fault == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def repair_conversations(conversations: DataFrame, conv_col: str = "conv_id", segment: int = SEGMENT) -> DataFrame:
    """``conv_id`` and the results of ``repair`` on the damaged turns; one row per id, null included.

    Rows of one turn are read by role, then text; repeated rows are duplicates.  An
    id all of whose rows are dropped has zeros and an empty audit.  An empty table
    gives no rows; other columns are not read.
    """
    rows = damaged(conversations, conv_col)
    kind = conversations.schema[conv_col].dataType
    return repair(rows, segment=segment).select(
        F.when(F.col("key") != "null", F.substring("key", 2, 1 << 30).cast(kind)).alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal",
        "cost", "audit", "repaired_sha256")

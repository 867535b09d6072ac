"""Faults in conversations and the cheapest edits that mend them.

A conversation is well formed when it is empty, or an optional system turn and then user and assistant turns in
alternation that end with the assistant. The edits of a row are K (keep), R (rerole) and D (delete); I inserts an empty
turn before a row or at the end. The search for the cheapest edits is iterative-deepening A*: a depth-first search tries
the edits in ASCII order and gives up a path whose cost, with a bound from below for what is still to pay, passes a
limit; the limit then rises to the least cost that was given up. A table of failed states keeps, for each place and
state, the greatest budget that wasn't enough there (a state met again with less would give up at higher costs only). The first path that ends well formed is the cheapest and, of these,
the least in ASCII order.

Conversations are cut into segments of ``SEGMENT`` rows, so a conversation of any length is searched by many tasks. A
segment in a longer conversation is searched from each state it can be entered in to each state it can be left in, and
the segments' answers are strung together by cost, then by text. That loses nothing: a segment is left right after a
row, so of two answers from the same state none is the beginning of the other, and the order of whole audits is the
order of their first segment that differs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.ranks import ranked
from tierline.session import materialise

#: Rows that one search looks at.
SEGMENT = 64
#: What edits cost, and what a truncated row costs that isn't deleted.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLANKS = "\t\n\x0b\x0c\r "
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn; and the end, well formed.
START, SYSTEM, USER, ASSISTANT, END = range(5)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that inserting or reroling gives, by state.
WANTED = ("u", "u", "a", "u")
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
ANSWER = "array<struct<entered:int,left:int,cost:int,audit:string>>"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv`` (the id as text, empty for null), ``turn``, ``role`` and ``text`` after damage that the crc32 of id and turn decides.

    Null counts as one space, in the key of the damage as well as in role and text. Other columns are left behind.
    """
    space = F.lit(" ")
    told = {c: F.coalesce(F.col(c).cast("bigint").cast("string"), space) for c in ("conv_id", "turn")}
    fate = F.crc32(F.concat(told["conv_id"], F.lit(":"), told["turn"]).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        _conv(F.col("conv_id")).alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).when(fate != 0, F.array(F.lit(0)))).alias("copy"),
    )


def _conv(conv_id: Column) -> Column:
    return F.coalesce(conv_id.cast("bigint").cast("string"), F.lit(""))


def _identity() -> Column:
    """The same for rows of one conversation with the same role and text, and for no others."""
    told = F.concat("conv", F.lit(":"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return F.sha2(told, 256)


def faulty_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without texts, with ``rank`` in their conversation, ``initial`` and ``fault``; and the conversations' ``size``.

    Rows go by turn, nulls first; rows of one turn by role, then by a digest of the text. ``fault`` is b (blank), d (a
    role and text seen earlier), t (truncated) or a dot. ``initial`` is x where a role begins with none of s, u and a.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    looked = rows.select(
        "conv", "turn", "role", _identity().alias("what"), "copy",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        F.when(bare == "", "b").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "t").otherwise(".").alias("fault"),
    )
    placed, sizes = ranked(materialise(looked, "turns"), "conv", ["turn", "role", "what", "copy"], "turn-order")
    placed = materialise(placed, "placed-turns")
    first = placed.groupBy("what").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = (F.col("fault") != "b") & (F.col("rank") > F.col("first"))
    return placed.join(first, "what", "left").withColumn("fault", F.when(again, "d").otherwise(F.col("fault"))).drop("first", "n"), sizes


def _still_to_pay(roles: str, faults: str) -> tuple[list[int], list[str]]:
    """From below, the cost of the rows from each place on by themselves, and the initial of the first row there that may stay.

    Forced deletions cost 3, other truncated rows 1. A role that fits nowhere costs 2 and parts its neighbours. Each
    other pair of neighbours that can't follow each other costs 1, as an edit costs at least 2 and mends two pairs.
    """
    cost, front = [0] * (len(roles) + 1), [""] * (len(roles) + 1)
    for i in range(len(roles) - 1, -1, -1):
        cost[i], front[i] = cost[i + 1], front[i + 1]
        if faults[i] in "bd":
            cost[i] += DELETE
            continue
        cost[i] += TRUNCATED * (faults[i] == "t")
        if roles[i] == "x":
            cost[i] += REROLE
        elif front[i + 1] not in ("", "x") and roles[i] + front[i + 1] not in LEGAL:
            cost[i] += 1
        front[i] = roles[i]
    return cost, front


def _reachable(roles: str, faults: str, entered: int, left: int) -> bool:
    if left in (USER, ASSISTANT, END):
        return True
    kept = any(r == "s" and f not in "bd" for r, f in zip(roles, faults))
    return left == entered or (left == SYSTEM and entered == START and kept)


def cheapest_edits(roles: str, faults: str, entered: int = START, left: int = END) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits that lead from one state to another; None where none does.

    Only a way to ``END`` may insert behind the last row.
    """
    if not _reachable(roles, faults, entered, left):
        return None
    n = len(roles)
    base, front = _still_to_pay(roles, faults)

    def bound(place: int, state: int) -> int:
        if left in (START, SYSTEM):  # all rows go, but for the system turn that was not met yet
            return DELETE * (n - place - (left != state)) if state in (left, START) else DELETE * (n + 1) * 2
        first = front[place]
        return base[place] + (first not in ("", "x") and (state, first) not in NEXT)

    def edits(place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Each possible edit in ASCII order, its cost and where it leads."""
        if place < n:
            yield "D", DELETE, place + 1, state
        if place < n or left == END:
            yield "I", INSERT, place, NEXT[state, WANTED[state]]
        if place < n and faults[place] not in "bd":
            more = TRUNCATED * (faults[place] == "t")
            if (state, roles[place]) in NEXT:
                yield "K", more, place + 1, NEXT[state, roles[place]]
            yield "R", REROLE + more, place + 1, NEXT[state, WANTED[state]]

    def accepts(place: int, state: int) -> bool:
        return place == n and (state in (START, ASSISTANT) if left == END else state == left)

    limit = bound(0, entered)
    while True:
        least, failed = None, {}
        path, trail = [(0, entered, 0, edits(0, entered))], []
        while path:
            place, state, spent, more = path[-1]
            if accepts(place, state):
                return spent, "".join(trail)
            for edit, cost, to_place, to_state in more:
                total = spent + cost
                needed = total + bound(to_place, to_state)
                if needed > limit:
                    least = needed if least is None else min(least, needed)
                elif failed.get((to_place, to_state), -1) < limit - total:
                    path.append((to_place, to_state, total, edits(to_place, to_state)))
                    trail.append(edit)
                    break
            else:
                failed[place, state] = max(failed.get((place, state), -1), limit - spent)
                path.pop()
                if trail:
                    trail.pop()
        if least is None:
            return None
        limit = least


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the answers for each segment: one for a whole conversation, else one for each pair of states."""
    kind = pa.list_(pa.struct([("entered", pa.int32()), ("left", pa.int32()), ("cost", pa.int32()), ("audit", pa.string())]))
    for batch in batches:
        answers = []
        for seg, last, roles, faults in zip(*(batch.column(c).to_pylist() for c in ("seg", "last", "roles", "faults"))):
            found = []
            for entered in (START,) if seg == 0 else (START, SYSTEM, USER, ASSISTANT):
                for left in (END,) if last else (START, SYSTEM, USER, ASSISTANT):
                    way = cheapest_edits(roles, faults, entered, left)
                    if way is not None:
                        found.append({"entered": entered, "left": left, "cost": way[0], "audit": way[1]})
            answers.append(found)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, kind)], [*batch.schema.names, "answers"])


def _strung(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which answer of each segment belongs to the cheapest whole; segments come in order, conversations one by one.

    What is kept of a conversation is a few small numbers for each of its segments.
    """
    names = ["conv", "seg", "entered", "left"]

    def chosen(conv: str, back: list[dict[int, int]]) -> pa.RecordBatch:
        ways, state = [], END
        for seg in range(len(back) - 1, -1, -1):
            ways.append((conv, seg, back[seg][state], state))
            state = back[seg][state]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*ways), kinds)], names)

    now, best, back = None, {}, []
    for batch in batches:
        for conv, answers in zip(batch.column("conv").to_pylist(), batch.column("answers").to_pylist()):
            if conv != now:
                if back:
                    yield chosen(now, back)
                now, best, back = conv, {START: (0, 0)}, []
            ways = {}
            for a in answers:
                if a["entered"] in best:
                    cost, place = best[a["entered"]]
                    way = (cost + a["cost"], place, a["audit"], a["entered"])
                    ways[a["left"]] = min(way, ways.get(a["left"], way))
            # audits so far are compared by the order of what came before, then by this segment's
            order = {left: i for i, (left, _) in enumerate(sorted(ways.items(), key=lambda w: w[1][1:3]))}
            best = {left: (way[0], order[left]) for left, way in ways.items()}
            back.append({left: way[3] for left, way in ways.items()})
    if back:
        yield chosen(now, back)


def repairs(faulty: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each segment (``conv``, ``seg``, ``last``, ``rows``) with ``cost`` and ``audit`` of its part in the cheapest repair."""
    seg = F.floor(F.col("rank") / SEGMENT).alias("seg")
    row = F.struct("rank", "initial", "fault", "turn", "role", "what")
    segments = faulty.groupBy("conv", seg).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    segments = segments.join(sizes, "conv").select(
        "conv", "seg", (F.col("seg") == F.floor((F.col("size") - 1) / SEGMENT)).alias("last"), "rows",
        F.array_join("rows.initial", "").alias("roles"), F.array_join("rows.fault", "").alias("faults"),
    )
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in segments.schema)}, answers {ANSWER}"
    solved = materialise(segments.mapInArrow(_searched, schema), "segments")
    whole = (F.col("seg") == 0) & F.col("last")
    told = ("conv", "seg", "last", "rows", "roles", "faults")
    alone = solved.where(whole).select(*told, F.col("answers")[0].alias("answer"))
    parts = solved.where(~whole)
    line = parts.select("conv", "seg", "answers").repartition("conv").sortWithinPartitions("conv", "seg")
    ways = line.mapInArrow(_strung, "conv string, seg bigint, entered int, left int")
    fitting = F.filter("answers", lambda a: (a["entered"] == F.col("entered")) & (a["left"] == F.col("left")))
    joint = parts.join(ways, ["conv", "seg"]).select(*told, fitting[0].alias("answer"))
    out = alone.unionByName(joint).select(*told, "answer.cost", "answer.audit")
    return materialise(out, "repairs")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sha256 of each repaired conversation, from its edits and texts in order; a text follows its edit.

    One text is held at a time, however long the conversation is.
    """
    now, total, state, pending, key, begun = None, None, START, None, None, False
    done: list[tuple[str, str]] = []

    def add(line: str) -> None:
        nonlocal begun
        total.update(("\n" if begun else "").encode() + line.encode())
        begun = True

    def put(edits: str, text: str | None, role: str | None) -> None:
        nonlocal state
        for edit in edits:
            initial = role[:1] if edit == "K" else WANTED[state]
            state = state if edit == "D" else NEXT[state, initial]
            if edit == "I":
                add(f"{NAMES[initial]}:")
            elif edit != "D":
                add(f"{role if edit == 'K' else NAMES[initial]}:{text}")

    for batch in batches:
        for conv, turn, role, what, edits, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "what", "edits", "text"))):
            if conv != now:
                if now is not None:
                    done.append((now, total.hexdigest()))
                now, total, state, pending, begun = conv, hashlib.sha256(), START, None, False
            if edits is None:  # a text
                if pending is not None and key == (turn, role, what):
                    put(pending, text, role)
                    pending = None
            elif edits.endswith(("K", "R")):
                pending, key = edits, (turn, role, what)
            else:
                put(edits, None, None)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*done)], ["conv", "repaired_sha256"])
            done = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([total.hexdigest()])], ["conv", "repaired_sha256"])


def repaired_digests(rows: DataFrame, mended: DataFrame) -> DataFrame:
    """``conv`` and ``repaired_sha256`` of ``role:text`` of what is left, joined by line ends.

    Texts are sent once, to where their conversation is hashed. A digest runs over a whole conversation in order, so
    the texts of one conversation pass through one task, one after the other.
    """
    # each row's edit with the inserts before it; inserts behind the last row stand at the end
    steps = F.regexp_extract_all("audit", F.lit("I*[DKR]|I+$"), F.lit(0))
    each = mended.select("conv", F.posexplode(steps).alias("at", "edits"), "rows").where("edits != 'D'")
    row = F.get("rows", F.col("at"))
    edits = each.select(
        "conv", row.isNull().alias("end"), row["turn"].alias("turn"), row["role"].alias("role"), row["what"].alias("what"),
        F.lit(0).alias("kind"), "edits", F.lit(None).cast("string").alias("text"),
    )
    given = rows.where((F.col("copy") == 0) & (F.rtrim(F.col("text"), F.lit(BLANKS)) != "")).select(
        "conv", F.lit(False).alias("end"), "turn", "role", _identity().alias("what"), F.lit(1).alias("kind"),
        F.lit(None).cast("string").alias("edits"), "text",
    )
    order = ("conv", "end", F.col("turn").asc_nulls_first(), "role", "what", "kind")
    both = edits.unionByName(given).repartition("conv").sortWithinPartitions(*order)
    return both.drop("end", "kind").mapInArrow(_digests, "conv string, repaired_sha256 string")


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations``, with the faults of its ``rows`` and the cheapest repair.

    ``rows`` (conv, turn, role, text, copy) is as ``damaged`` gives them. Null ids are one conversation. A conversation
    that has no rows left has no faults and an empty audit; an empty table gives no rows.
    """
    faulty, sizes = faulty_rows(rows)
    mended = repairs(faulty, sizes)
    # pairs of neighbours: inside segments, and from the last row of each to the first of the next
    inside = F.size(F.filter(
        F.sequence(F.lit(1), F.char_length("roles")), lambda i: ~F.substring(F.col("roles"), i, F.lit(2)).isin(*LEGAL)
    )) - 1
    count = lambda fault: F.char_length(F.regexp_replace("faults", f"[^{fault}]", ""))
    bounds = mended.select("conv", "seg", F.left("roles", F.lit(1)).alias("head"), F.right("roles", F.lit(1)).alias("tail"))
    meeting = bounds.alias("b").join(
        bounds.select("conv", (F.col("seg") - 1).alias("seg"), F.col("head").alias("after")), ["conv", "seg"]
    )
    crossing = meeting.where(~F.concat("tail", "after").isin(*LEGAL)).groupBy("conv").agg(F.count(F.lit(1)).alias("crossing"))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda s: s["audit"]), "")
    summed = mended.groupBy("conv").agg(
        F.sum(count("b")).alias("blank"), F.sum(count("d")).alias("duplicate"), F.sum(count("t")).alias("truncated"),
        F.sum(inside).alias("inside"), F.sum("cost").alias("cost"), audit.alias("audit"),
    )
    turns = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    gaps = faulty.groupBy("conv").agg(F.coalesce(turns, F.lit(0)).alias("gaps"))
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct().withColumn("conv", _conv(F.col("conv_id")))
    all_of = every
    for part in (summed, gaps, crossing, repaired_digests(rows, mended)):
        all_of = all_of.join(part, "conv", "left")
    number = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint")
    return all_of.select(
        "conv_id", number("gaps").alias("gaps"), *[number(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (number("inside") + number("crossing")).alias("illegal"), number("cost").alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

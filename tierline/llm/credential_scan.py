"""Secrets in texts: three base kinds wherever they stand, and weaker parts of a credential where they belong together.

An access identifier, a secret and an endpoint make a credential. A base span is reported as it is. A weak span, which
looks like one of the three but is common by itself, is reported only when a part of another role lies in its scope:
at most ``SCOPE`` characters before or after it in the same text.

Only DataFrame functions are used. Positions come from splitting a text at the matches: the pieces between them and
the matches themselves, in turn, add up to the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.arrays import let, piece, running, text_blocks
from tierline.llm.common import texts
from tierline.session import materialise

ACCESS, SECRET, ENDPOINT = "access", "secret", "endpoint"
#: How far apart the parts of one credential may stand, in characters.
SCOPE = 400


@dataclass(frozen=True)
class Kind:
    """A pattern with the role of what it finds. A match counts when its ``group`` has ``least`` characters and holds all of ``also``.

    No pattern repeats a group but possessively: the matcher keeps a frame of its stack for each turn it may go back to.
    """

    name: str
    pattern: str
    role: str
    group: int = 0
    least: int = 1
    weak: bool = False
    also: tuple[str, ...] = ()


#: The base kinds, in the order in which spans at the same place are listed.
BASE = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", SECRET, 1, 6),
    Kind("access", r"AKIA[A-Z0-9]+", ACCESS, 0, 20),
    Kind("hex", r"[0-9a-f]{24,}", SECRET, 0, 24),
)
#: Parts that are reported only in company. A user name or key id, a long mixed token, an address of a service.
WEAK = (
    Kind("login", r"""(?i:user(?:name)?|login|client_?id|access_?key_?id|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", ACCESS, 1, 3, True),
    Kind("blob", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}", SECRET, 0, 32, True, ("[0-9]", "[A-Z]")),
    Kind("url", r"(?i:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|amqps?|mongodb(?:\+srv)?)://[A-Za-z0-9._~:@%/?&=+-]+", ENDPOINT, 0, 8, True),
    Kind("host", r"""(?i:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++(?::[0-9]+)?)""", ENDPOINT, 1, 4, True),
)
SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def matches(text: Column, kind: Kind, rank: int) -> Column:
    """The spans of one kind: leftmost matches that don't overlap, without those that are too short. ``end`` is exclusive."""
    pattern = F.lit(kind.pattern)
    gaps = F.transform(F.split(text, kind.pattern, -1), F.char_length)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = found if kind.group == 0 else F.regexp_extract_all(text, pattern, F.lit(kind.group))

    def judge(hit: Column, part: Column) -> Column:
        counts = F.char_length(part) >= kind.least
        for other in kind.also:
            counts &= part.rlike(other)
        return F.struct(F.char_length(hit).alias("size"), counts.alias("counts"))

    # gap and match in turn; behind the last gap there is none
    turns = F.zip_with(gaps, F.zip_with(found, judged, judge), lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))

    def place(at: Column, turn: Column) -> Column:
        begin = at + turn["gap"]
        end = begin + F.coalesce(turn["hit"]["size"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"))
        return F.struct(end.alias("state"), F.struct(span.alias("span"), F.coalesce(turn["hit"]["counts"], F.lit(False)).alias("counts")).alias("out"))

    placed = running(turns, F.lit(0), place, f"struct<span:{SPAN},counts:boolean>")
    spans = F.transform(F.filter(placed, lambda p: p["counts"]), lambda p: p["span"])
    return F.when(text.rlike(kind.pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, *more: Column) -> DataFrame:
    """Per row the sorted base and weak spans of its whole text (null: empty). No shuffle."""
    found = texts(docs, *more)
    for group, kinds, first in (("base", BASE, 0), ("weak", WEAK, len(BASE))):
        parts = [matches(F.col("text"), kind, first + i) for i, kind in enumerate(kinds)]
        found = found.withColumn(group, F.array_sort(F.concat(*parts)))
    return found


def _roles(kinds: tuple[Kind, ...], kind: Column) -> Column:
    cases = F.lit(None).cast("string")
    for k in kinds:
        cases = F.when(kind == k.name, k.role).otherwise(cases)
    return cases


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``row`` and the weak spans of it that have a part of another role in their scope.

    The interval join is made on cells of ``scope`` characters: all that lies within reach of a span begins in its own
    cell, the next, or one that a span before it reaches. Parts are summed up per (row, cell, role) before the join, by
    the first start and the last end, which is all that reach needs to know. So a cell sends three rows at most,
    however many parts it holds, and no pair of parts is ever made.
    """
    parts = found.select("row", F.explode(F.concat("base", "weak")).alias("span")).select(
        "row", "span.*", _roles(BASE + WEAK, F.col("span.kind")).alias("role")
    )
    # a long part lies in several cells and counts in each of them
    cells = parts.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope)))
    )
    begin = F.greatest("start", F.col("cell") * scope)
    end = F.least("end", (F.col("cell") + 1) * scope)
    held = cells.groupBy("row", "cell", "role").agg(F.min(begin).alias("first"), F.max(end).alias("last"))
    weak = found.select("row", F.explode("weak").alias("span")).select(
        "row", "span.*", _roles(WEAK, F.col("span.kind")).alias("own_role")
    )
    reach = F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") - 1 + scope) / scope))
    wanted = weak.withColumn("cell", F.explode(reach))
    near = (
        (F.col("role") != F.col("own_role"))
        & (F.col("first") <= F.col("end") + scope)
        & (F.col("last") >= F.col("start") - scope)
    )
    hits = wanted.join(held, ["row", "cell"]).where(near)
    return (
        hits.select("row", F.struct("start", "rank", "end", "kind").alias("span"))
        .distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("span")).alias("linked"))
    )


def secret_spans(docs: DataFrame, *more: Column) -> DataFrame:
    """Every row with ``base`` spans and ``spans``: base and linked ones, sorted by place, then by kind as listed.

    The scan is written once without the texts; what follows moves spans only. Rows are told apart by a number given
    when they are written, so ids may repeat or be null.
    """
    scanned = scan(docs, *more).drop("text").withColumn("row", F.monotonically_increasing_id())
    found = materialise(scanned, "spans")
    none = F.array().cast(f"array<{SPAN}>")
    return (
        found.join(linked(found), "row", "left")
        .withColumn("spans", F.array_sort(F.concat("base", F.coalesce("linked", none))))
        .drop("weak", "linked")
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans in every whole text; null text counts as empty, rows are told one by one."""
    count = lambda name: F.size(F.filter("base", lambda s: s["kind"] == name)).cast("bigint")
    return secret_spans(docs).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def _with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` and ``secret__spans``. Equal texts have equal spans, so rows find theirs by the text's sha256."""
    key = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("secret__key")
    found = secret_spans(docs, key).where(F.size("spans") > 0)
    by_text = found.groupBy("secret__key").agg(F.any_value("spans").alias("secret__spans"))
    return docs.select("*", key).join(by_text, "secret__key", "left")


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark`` and ``n_chars``, where there is one, counted anew.

    Overlapping spans are replaced once. Rows without spans, and all other columns, stay as they are.
    """
    text, spans = F.col("text"), F.col("secret__spans")

    def cut(blocks: Column) -> Column:
        def step(at: Column, span: Column) -> Column:
            before = F.concat(piece(blocks, at, span["start"] - at), F.lit(mark))
            return F.struct(F.greatest(at, span["end"]).alias("state"), F.when(span["start"] >= at, before).otherwise("").alias("out"))

        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(running(spans, F.lit(0), step, "string"), ""), piece(blocks, last, F.char_length(text) - last))

    hit = F.col("secret__spans").isNotNull()
    out = _with_spans(docs).withColumn("text", F.when(hit, let(text_blocks(text), cut)).otherwise(text))
    if "n_chars" in docs.columns:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(hit, counted).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)

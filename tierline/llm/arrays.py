"""Expressions on long arrays and texts whose cost does not grow with the square of their length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points in a block of a text that is cut into pieces.
BLOCK = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(items: Column, zero: Column, step: Callable[[Column, Column], Column], out: str) -> Column:
    """One element of type ``out`` for each of ``items``: a fold that keeps what it passes.

    ``step`` gives a struct of ``state`` and ``out`` from the state and the next item. An array can only grow by being
    copied, so the items are taken in as many blocks as a block has items, and the blocks are joined at the end.
    """

    def take(held: Column, item: Column) -> Column:
        return let(step(held["state"], item), lambda s: F.struct(s["state"].alias("state"), F.array_append(held["out"], s["out"]).alias("out")))

    def take_block(held: Column, block: Column) -> Column:
        begun = F.struct(held["state"].alias("state"), F.array().cast(f"array<{out}>").alias("out"))
        return let(
            F.aggregate(block, begun, take),
            lambda s: F.struct(s["state"].alias("state"), F.array_append(held["out"], s["out"]).alias("out")),
        )

    def whole(every: Column) -> Column:
        n = F.ceil(F.sqrt(F.size(every))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.size(every) - 1, n), lambda at: F.slice(every, at + 1, n))
        begun = F.struct(zero.alias("state"), F.array().cast(f"array<array<{out}>>").alias("out"))
        folded = F.flatten(F.aggregate(blocks, begun, take_block, lambda held: held["out"]))
        return F.when(F.size(every) > 0, folded).otherwise(F.array().cast(f"array<{out}>"))

    return let(items, whole)


def text_blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points, for ``piece``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def piece(blocks: Column, at: Column, length: Column) -> Column:
    """``length`` code points from ``at`` (from 0). A place in a text is found by counting from its start; here, from its block's."""
    first, last = F.floor(at / BLOCK).cast("int"), F.floor((at + length) / BLOCK).cast("int")
    held = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.substring(held, at % BLOCK + 1, length)

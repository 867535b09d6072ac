"""A manifest of a dataset as a tree of digests, with proofs that a row belongs to it.

Every row is a leaf. Leaves of one source, in ascending order of their ids, are grouped in runs of ``FAN``; a run's
digest stands for it, and so on until one digest of the source is left. The sources' digests give the root in the same
way. The tree is stored as what it is, a graph of content: records of a digest and the digests that it was made of.

A proof is found by descent. From the root, the digits of a leaf's rank to the base ``FAN`` name the child to go to;
the children not taken are what a proof needs. They are gathered on the way down and reversed at the end, as a proof is
folded from the leaf up. Requests below one node descend together as one row, so the root is looked up once and not by
every leaf.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import id_bucket, lower_ascii
from tierline.llm.ranks import ranked
from tierline.session import fresh_path, materialise

#: How many nodes of one level make a node of the next.
FAN = 16
#: The columns a leaf is made of, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
RECORD = "digest string, children array<string>"
STEP = "struct<digit:int,others:array<string>>"
RESULT = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf(columns: dict[str, Column]) -> Column:
    """The digest of a row: each column as its bytes' count, a colon and its bytes, or ``-`` where it is null."""

    def told(value: Column) -> Column:
        written = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))

    return digest(F.concat(*[told(columns[c]) for c in LEAF_COLUMNS]))


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """``doc_id``, ``source`` and ``leaf`` of each row, and ``claim``, the leaf with ``claimed`` as its text, where that is another.

    All other columns are left behind. ``row`` tells equal rows apart.
    """
    given = {c: F.col(c) for c in LEAF_COLUMNS}
    given["doc_id"] = F.col("doc_id").cast("bigint")
    made = leaf(given)
    claim = F.lit(None).cast("string") if claimed is None else F.when(~claimed.eqNullSafe(F.col("text")), leaf({**given, "text": claimed}))
    return docs.select(
        given["doc_id"].alias("doc_id"), "source", made.alias("leaf"), claim.alias("claim"), F.monotonically_increasing_id().alias("row")
    )


def _height(nodes: int) -> int:
    """How many levels stand above so many nodes."""
    height = 0
    while nodes > 1:
        nodes, height = -(-nodes // FAN), height + 1
    return height


def _grown(nodes: DataFrame, most: int, path: str) -> DataFrame:
    """The last node of each tree: ``tree``, ``digest`` and ``height``.

    ``nodes`` (tree, rank, digest, size) are the leaves of all trees, of which the biggest has ``most``. The records of
    each level are written below ``path`` and read again for the next one; a level is one grouping into runs.
    """
    spark, tops = nodes.sparkSession, []
    for height in range(1, _height(most) + 1):
        tops.append(nodes.where("size = 1").select("tree", "digest", F.lit(height - 1).alias("height")))
        runs = nodes.where("size > 1").groupBy("tree", F.floor(F.col("rank") / FAN).alias("up")).agg(
            F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("run"), F.any_value("size").alias("size")
        )
        level = runs.select(
            "tree", F.col("up").alias("rank"), F.col("run.digest").alias("children"), F.ceil(F.col("size") / FAN).alias("size")
        ).withColumn("digest", digest(F.array_join("children", "")))
        level.write.parquet(f"{path}/height={height}")
        nodes = spark.read.schema("tree bigint, rank bigint, digest string, size bigint").parquet(f"{path}/height={height}")
    tops.append(nodes.select("tree", "digest", F.lit(_height(most)).alias("height")))
    return reduce(DataFrame.unionByName, tops)


@dataclass
class Manifest:
    """A stored tree.

    ``leaves`` (row, doc_id, leaf, claim, tree, rank) are the rows with their places, ``sources`` (source, tree, size,
    subroot, height) the trees of the sources, where ``tree`` is the source's place in order. Records of the levels lie
    in folders below ``source_records`` and ``top_records``. ``root`` is None for an empty table.
    """

    leaves: DataFrame
    sources: DataFrame
    source_records: str
    top_records: str
    root: str | None
    source_height: int
    top_height: int

    def records(self, path: str, height: int) -> DataFrame:
        """Digest to children, on one level. Equal subtrees are one record."""
        stored = self.leaves.sparkSession.read.schema(RECORD).parquet(f"{path}/height={height}")
        return _dealt(stored.groupBy("digest").agg(F.any_value("children").alias("children")))

    def _descended(self, at: DataFrame, path: str, height: int) -> DataFrame:
        """From nodes (tree, rank, digest, path) of one level to their children; ``path`` grows by those not taken."""
        down = at.join(self.records(path, height), "digest")
        taken = down.select("tree", "rank", "path", "children", F.posexplode("children").alias("digit", "child"))
        return taken.select(
            "tree", (F.col("rank") * FAN + F.col("digit")).alias("rank"), F.col("child").alias("digest"),
            F.array_append("path", _step(F.col("digit"), F.col("children"))).alias("path"),
        )

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """The leaves with ``steps``, from the leaf to the root: at each level the place in the run, and the run's others.

        ``requests`` (row) names the leaves that are wanted; None wants all. At each level only nodes above a wanted
        leaf are descended into. Leaves of one run travel as one row, with one path to their common node.
        """
        wanted = self.leaves if requests is None else self.leaves.join(requests.select("row").distinct(), "row", "left_semi")
        runs = wanted.groupBy("tree", F.floor(F.col("rank") / FAN).alias("up")).agg(
            F.collect_list(F.struct((F.col("rank") % FAN).cast("int").alias("digit"), "row", "doc_id", "leaf", "claim")).alias("asked")
        )
        some = None if requests is None else materialise(runs.select("tree", "up"), "asked")
        none = F.array().cast(f"array<{STEP}>")
        at = self.leaves.sparkSession.createDataFrame([(0, 0, self.root)], "tree bigint, rank bigint, digest string").withColumn("path", none)
        for height in range(self.top_height, 0, -1):
            at = self._descended(at, self.top_records, height)
        # the place in the top tree is the source's number
        starts = _dealt(self.sources.select("tree", "subroot", "height")).join(at.select(F.col("rank").alias("tree"), "path"), "tree")
        if some is not None:
            starts = starts.join(_dealt(some.select("tree").distinct()), "tree", "left_semi")
        starts = materialise(starts, "subroots")
        at = None
        for height in range(self.source_height, 0, -1):
            fresh = starts.where(F.col("height") == height).select("tree", F.lit(0).cast("bigint").alias("rank"), F.col("subroot").alias("digest"), "path")
            at = fresh if at is None else at.unionByName(fresh)
            if some is not None:
                asked = some.select("tree", F.floor(F.col("up") / FAN ** (height - 1)).alias("rank")).distinct()
                at = at.join(_dealt(asked), ["tree", "rank"], "left_semi")
            if height > 1:
                at = self._descended(at, self.source_records, height)
        lone = starts.where("height = 0").select("tree", F.lit(0).cast("bigint").alias("up"), "path", F.lit(None).cast("array<string>").alias("children"))
        if at is not None:
            last = at.join(self.records(self.source_records, 1), "digest")
            lone = lone.unionByName(last.select("tree", F.col("rank").alias("up"), "path", "children"))
        asked = F.col("ask.digit")
        up = F.reverse("path")
        steps = F.when(F.col("children").isNull(), up).otherwise(F.concat(F.array(_step(asked, F.col("children"))), up))
        found = _dealt(runs).join(lone, ["tree", "up"]).select("tree", "path", "children", F.explode("asked").alias("ask"))
        return found.select(
            "tree", "ask.row", "ask.doc_id", "ask.claim", steps.alias("steps"),
            # what the descent arrived at
            F.coalesce(F.element_at("children", asked + 1), F.col("ask.leaf")).alias("leaf"),
        )


def _dealt(df: DataFrame) -> DataFrame:
    """``df`` for a join that deals out both sides.

    Spark takes a join with distinct keys for as small as its other side and doesn't know how many rows an explode makes.
    So what a descent has come to is taken for as small as its start, and would be sent whole to the driver and all tasks.
    """
    return df.hint("merge")


def _step(digit: Column, children: Column) -> Column:
    # slices of an array of which one element is left out
    before, after = F.slice(children, 1, digit), F.slice(children, digit + 2, FAN)
    return F.struct(digit.cast("int").alias("digit"), F.concat(before, after).alias("others"))


def proof_digest(steps: Column) -> Column:
    """One digest for all siblings of a proof, from the leaf's to the root's children."""
    return digest(F.array_join(F.flatten(F.transform(steps, lambda s: s["others"])), ""))


def folded(claimed: Column, steps: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""

    def up(here: Column, step: Column) -> Column:
        before = F.array_join(F.slice(step["others"], 1, step["digit"]), "")
        return digest(F.concat(before, here, F.array_join(F.slice(step["others"], step["digit"] + 1, FAN), "")))

    return F.aggregate(steps, claimed, up)


def manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """The stored tree over ``docs`` (doc_id, source, lang, n_chars, text).

    Leaves of one source go by id, nulls first; rows with the same id go by their digest. A null source is a source,
    the first one. Rows that are equal in all five columns are leaves of their own.
    """
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "merkle")
    made = materialise(leaves(docs, claimed), "leaves")
    placed, groups = ranked(made, "source", ["doc_id", "leaf", "row"], "leaf-order")
    numbered, _ = ranked(groups.withColumn("all", F.lit(0)), "all", ["source"], "source-order")
    numbered = materialise(numbered.select("source", F.col("rank").alias("tree"), "size"), "sources")
    of = numbered.select(F.col("source").alias("_source"), "tree", "size")
    placed = placed.join(of, F.col("source").eqNullSafe(F.col("_source"))).select("row", "doc_id", "leaf", "claim", "tree", "rank", "size")
    placed = materialise(placed, "placed")
    most, sources = numbered.agg(F.coalesce(F.max("size"), F.lit(0)), F.count(F.lit(1))).first()
    below = f"{path}/sources"
    tops = _grown(placed.select("tree", "rank", F.col("leaf").alias("digest"), "size"), most, below)
    trees = materialise(numbered.join(tops.withColumnRenamed("digest", "subroot"), "tree"), "trees")
    above = f"{path}/top"
    top = trees.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("rank"), F.col("subroot").alias("digest"), F.lit(sources).alias("size"))
    root = _grown(top, sources, above).first() if sources else None
    return Manifest(placed.drop("size"), trees, below, above, root and root.digest, _height(most), _height(sources))


def tampered_text() -> Column:
    """The text with A-Z lower-cased where 5 divides the crc32 of the id, else as it is; a null id counts as empty text."""
    return F.when(id_bucket(5) == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))


def audited(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """Every row with its leaf, its proof's digest, and whether the row as ``claimed`` still folds to the root.

    ``claimed`` is the text to be verified against the manifest of ``docs``; None verifies the rows as they are. Null
    and empty values are different leaves, very long texts are hashed whole, other columns are not looked at. An empty
    table gives no rows.
    """
    tree = manifest(docs, claimed)
    if tree.root is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    subroots = tree.sources.select("tree", "subroot")
    back = folded(F.coalesce("claim", "leaf"), F.col("steps"))
    return tree.proofs().join(subroots, "tree").select(
        "doc_id", "leaf", "subroot", F.lit(tree.root).alias("root"), proof_digest(F.col("steps")).alias("proof_sha256"),
        back.alias("folded_root"), (back == tree.root).alias("verified"),
    )

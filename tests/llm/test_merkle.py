"""The stored tree and its proofs against a tree that plain Python builds in memory."""

from __future__ import annotations

import hashlib
import string
import zlib

from pyspark.sql import functions as F

from tierline.llm import merkle

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, row int, tree int, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    told = [None if v is None else str(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in told))


def grown(nodes):
    """The root, and for each node the place and the others of its run on every level."""
    steps, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(at, min(at + 16, len(nodes))) for at in range(0, len(nodes), 16)]
        for run in runs:
            for place, node in enumerate(run):
                for i in below[node]:
                    steps[i].append((place, [nodes[n] for n in run if n != node]))
        below = [[i for node in run for i in below[node]] for run in runs]
        nodes = [sha("".join(nodes[n] for n in run)) for run in runs]
    return nodes[0], steps


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        ordered = sorted(by_source[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees.append((ordered, *grown([leaf(r, r["text"]) for r in ordered])))
    root, above = grown([subroot for _, subroot, _ in trees])
    out = []
    for (ordered, subroot, steps), top in zip(trees, above):
        for row, own in zip(ordered, steps):
            text, path = row["text"], own + top
            if text is not None and zlib.crc32(("" if row["doc_id"] is None else str(row["doc_id"])).encode()) % 5 == 0:
                text = text.translate(LOWER)
            here = leaf(row, text)
            for place, others in path:
                here = sha("".join([*others[:place], here, *others[place:]]))
            others = "".join(d for _, run in path for d in run)
            out.append((row["doc_id"], leaf(row, row["text"]), subroot, root, sha(others), here, here == root))
    return out


def table(spark, rows):
    made = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", 1, 2, "y") for r in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(5)


def row(doc_id, source="a", text="Some Text", lang="en", n_chars=9):
    return {"doc_id": doc_id, "source": source, "text": text, "lang": lang, "n_chars": n_chars}


ODD = [
    *[row(i, "hot") for i in range(700, 0, -1)], *[row(3, "hot") for _ in range(40)], *[row(i, "sixteen") for i in range(16)],
    *[row(i, "seventeen", text=None) for i in range(17)], row(1, "lone"), row(None, None), row(None, None, None, None, None), row(5, None),
    row(5, "", ""), row(7, "\u00e9\u65e5", "\U0001f600" * 100_000), row(-9, "neg", "LONG " * 200_000), *[row(i, f"s{i:03}") for i in range(300)],
]


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_leaf_folds_to_the_root_and_a_changed_one_does_not(spark):
    got = found(merkle.audited(table(spark, ODD), merkle.tampered_text()))
    assert got == sorted(expected(ODD), key=repr)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_unchanged_rows_are_verified(spark):
    got = merkle.audited(table(spark, ODD[-330:]))
    assert got.where("not verified").isEmpty() and got.select("root").distinct().count() == 1


def test_small_trees(spark):
    for rows in ([], [row(1)], [row(1), row(2)], [row(1, "a"), row(1, "b")]):
        assert found(merkle.audited(table(spark, rows), merkle.tampered_text())) == sorted(expected(rows) if rows else [], key=repr)


def test_a_request_descends_only_to_its_leaves(spark):
    tree = merkle.manifest(table(spark, ODD))
    asked = tree.leaves.where("doc_id in (3, 650) or tree = 0")
    got = tree.proofs(asked.select("row")).select("row", "leaf", merkle.folded(F.col("leaf"), F.col("steps")).alias("root")).collect()
    assert sorted((r.row, r.leaf) for r in got) == sorted((r.row, r.leaf) for r in asked.collect())
    assert {r.root for r in got} == {tree.root}


def test_records_are_named_by_their_content(spark):
    tree = merkle.manifest(table(spark, ODD))
    records = tree.records(tree.source_records, 1).collect()
    assert records and all(sha("".join(r.children)) == r.digest and len(r.children) <= merkle.FAN for r in records)


def test_no_descent_is_sent_whole_to_all_tasks(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}", 6) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 0  # small tables would be
    tree = merkle.manifest(docs)
    for proofs in (tree.proofs(), tree.proofs(tree.leaves.where("doc_id % 7 = 0"))):
        plan = proofs._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line and "JoinHint" not in line]
        assert joins and all("strategy=merge" in line for line in joins if "Inner" in line)
        physical = proofs._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [digest" not in physical and "BroadcastHashJoin [tree" not in physical

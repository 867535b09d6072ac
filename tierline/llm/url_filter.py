"""Block and allow decisions on addresses, shared by all addresses that lead to the same page.

A rule names a host and the beginning of a path. It decides for its host, all hosts below it, and all paths that begin
so; the longest rule that fits an address wins. What no rule fits takes the decision of its aliases. Aliases are found
from pages that redirect (a refresh in the page, or redirects seen while fetching) and from canonical links: these are
the edges of a graph whose connected components are classes of addresses that stand for the same page. An allow rule on
any address of a class counts for the class before a block rule does; a class without rules is allowed.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import lower_ascii
from tierline.llm.components import components
from tierline.session import materialise

ALLOW, BLOCK = "allow", "block"
RULE_COLUMNS = ("verdict", "host", "path")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


#: The rules of the registered query.
RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)


def rule_table(spark: SparkSession, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    told = [F.struct(*[F.lit(v).alias(c) for c, v in zip(RULE_COLUMNS, (r.verdict, r.host, r.path))]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*told)))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z in lower case. Empty without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, to the next ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """What tells addresses apart: host, path (an empty one is ``/``) and query, but not scheme or fragment. Null without a host."""
    path, query = path_of(url), F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query))


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute in a tag, quoted or bare; empty when it has none."""
    pattern = rf"""(?i)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])
    return F.trim(F.replace(value, F.lit("&amp;"), F.lit("&")))


def link_targets(html: Column) -> Column:
    """The addresses, as written, that a page names as its canonical one or sends its reader to.

    Tags end at the first ``<`` or ``>``, so a page of tags that never close is still read once.
    """
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\b[^<>]*>"), F.lit(0))

    def target(tag: Column) -> Column:
        canonical = F.concat(F.lit(" "), F.lower(_attribute(tag, "rel")), F.lit(" ")).rlike(r"\scanonical\s")
        refresh = F.lower(_attribute(tag, "http-equiv")) == "refresh"
        sent = F.regexp_extract(_attribute(tag, "content"), r"""(?i)^[0-9.\s]*[;,]\s*url\s*=\s*["']?([^"']*)""", 1)
        return F.when(canonical, _attribute(tag, "href")).when(refresh, F.trim(sent)).otherwise("")

    named = F.filter(F.transform(tags, target), lambda t: t != "")
    return F.when(html.rlike("(?i)canonical|refresh"), named).otherwise(F.array().cast("array<string>"))


def resolved(target: Column, url: Column) -> Column:
    """``target`` as a whole address, seen from the page at ``url``; null where it is none. Dot segments stay as written."""
    scheme, path = F.substring_index(url, "://", 1), path_of(url)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, "^(.*/)?", 0))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(host_of(url) == "", None)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(site, path, target))
        .when(target.startswith("#"), None)
        .otherwise(F.concat(site, folder, target))
    )


def matched_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``decision`` of the distinct addresses that a rule fits: of the longest rule, allow first.

    No address meets all rules of its host: it looks for its host and the hosts above it, and there for the beginnings
    of its path that are as long as some rule's. A host is looked up with at most as many labels as any rule has.
    """
    named = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("decision"),
        F.concat("host", "path").alias("rule"),
    )
    # the same rule given with both verdicts allows
    named = named.groupBy("rule_host", "rule_path", "rule").agg(F.min("decision").alias("decision"))
    labels = F.size(F.split("rule_host", r"\."))
    depth = named.agg(F.coalesce(F.max(labels), F.lit(0))).first()[0]
    lengths = named.groupBy("rule_host").agg(F.collect_set(F.char_length("rule_path")).alias("lengths"))
    above = F.expr(f"transform(sequence(1, {max(depth, 1)}), n -> substring_index(host, '.', -n))")
    looked = addresses.select("host", "path").where("host != ''").distinct()
    looked = looked.select("host", "path", F.explode(F.array_distinct(above)).alias("rule_host")).join(lengths, "rule_host")
    looked = looked.select("*", F.explode("lengths").alias("length")).where(F.char_length("path") >= F.col("length"))
    begins = F.substring(F.col("path"), F.lit(1), F.col("length"))
    fits = looked.withColumn("rule_path", begins).join(named, ["rule_host", "rule_path"])
    # rules of the same length: allow before block, then the greater text
    best = F.max(F.struct(F.char_length("rule"), F.col("decision") == ALLOW, "rule", "decision")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.decision")


def judge(pages: DataFrame, rules: DataFrame | None = None, redirects: DataFrame | None = None) -> DataFrame:
    """Every row of ``pages`` (page_id, url, html) with ``host``, ``path``, ``rule``, ``verdict``, ``address`` and ``class``.

    ``rules`` has verdict, host and path (None: ``RULES``), ``redirects`` has ``from_url`` and ``to_url``. ``class`` is
    the least address of those that stand for the same page. A url that is null or has no ``://`` has no host, no path
    and no class, and is allowed. Rows with the same url are judged alike; a null page has no links. Other columns are
    left behind, and an empty table gives no rows.
    """
    url = F.col("url")
    rules = rule_table(pages.sparkSession) if rules is None else rules
    if redirects is None:
        redirects = pages.select(F.col("url").alias("from_url"), F.col("url").alias("to_url")).where(F.lit(False))
    targets = F.transform(link_targets(F.coalesce("html", F.lit(""))), lambda t: resolved(t, url))
    seen = materialise(
        pages.select(
            "page_id", host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("address"),
            F.filter(targets, lambda t: t.isNotNull()).alias("targets"),
        ),
        "pages",
    )
    to = F.col("to")
    fetched = redirects.select(address_of(F.col("from_url")).alias("address"), F.col("to_url").alias("to"))
    links = seen.select("address", F.explode("targets").alias("to")).unionByName(fetched)
    links = links.select("address", address_of(to).alias("target"), host_of(to).alias("host"), path_of(to).alias("path"))
    links = materialise(links.distinct(), "links")
    origin = F.col("from_url")
    origins = redirects.select(address_of(origin).alias("address"), host_of(origin).alias("host"), path_of(origin).alias("path"))
    known = seen.select("address", "host", "path").unionByName(origins)
    known = known.unionByName(links.select(F.col("target").alias("address"), "host", "path"))
    known = known.where("address is not null").distinct()
    edges = links.selectExpr("address as a", "target as b").where("a is not null and b is not null and a != b")
    members = components(edges).select(F.col("node").alias("address"), "root")
    classed = materialise(
        known.join(members, "address", "left")
        .withColumn("class", F.coalesce("root", "address")).drop("root")
        .join(matched_rules(known, rules), ["host", "path"], "left"),
        "addresses",
    )
    shared = classed.where("decision is not null").groupBy("class").agg(F.min("decision").alias("shared"))  # allow before block
    judged = classed.join(shared, "class", "left").withColumn("verdict", F.coalesce("decision", "shared", F.lit(ALLOW)))
    # addresses differ in the empty path and "/", so the path belongs to the key
    return (
        seen.drop("targets").join(judged.select("address", "path", "rule", "class", "verdict"), ["address", "path"], "left")
        .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"), "address", "class")
    )

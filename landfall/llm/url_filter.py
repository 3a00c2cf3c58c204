"""URL filtering in which pages share the fate of the addresses they stand for.

Rules of a host and a path prefix judge every address; the longest that fits wins. Pages
that redirect to another address or name one as canonical are aliases of it. Connected
components over these links carry block decisions to all aliases, and an address that a
rule allows stays allowed, whatever its aliases are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored
from landfall.llm.components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Comments, scripts and styles are matched whole, so that tags inside them do not count.
_TAGS = r"(?is)<!--.*?(?:-->|\z)|<(?:script|style)\b.*?(?:</(?:script|style)|\z)|<(?:link|meta)\b[^>]*+>"
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")
_REFRESH = re.compile(r"\s*[\d.]+\s*[;,]?\s*(?:url\s*=)?\s*(?:'([^']+)|\"([^\"]+)|(\S+))", re.I)


@dataclass(frozen=True)
class Rule:
    host: str  # in lower case; fits its subdomains as well
    path: str  # the address's path must start with it
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("com", "/", True),
    Rule("example.com", "/en/", False),
    Rule("www.example.com", "/en/", True),
    Rule("net", "/es/", False),
    Rule("net", "/fr/", False),
)
#: So many rules are tried one by one on every address; more are joined by host.
INLINE_RULES = 200


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """The URL that aliases are compared by: scheme and host in lower case, no fragment; null without a host."""
    parts = r"^[ \t\n\r\f]*([^:/?#]+://[^/?#]*)([^#]*)"
    head = F.translate(F.regexp_extract(url, parts, 1), _UPPER, _LOWER)
    return F.when(head != "", F.concat(head, F.rtrim(F.regexp_extract(url, parts, 2))))


def _inline(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    longest_first = sorted(rules, key=lambda r: (len(r.name), len(r.host)), reverse=True)
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(longest_first):
        host = F.lit(r.host)
        fits = ((F.col("host") == host) | F.col("host").endswith(F.concat(F.lit("."), host))) & F.col("path").startswith(r.path)
        rule = F.when(fits, F.lit(r.name)).otherwise(rule)
        verdict = F.when(fits, F.lit("allow" if r.allow else "block")).otherwise(verdict)
    return urls.withColumns({"rule": rule, "ruled": verdict})


def _joined(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for rules in a table (host, path, allow) of any size.

    Every distinct address meets the rules of its host and of the domains above it by an
    equi-join; the longest that fits is kept by a partial aggregation, so a host with many
    addresses or rules is spread over tasks.
    """
    distinct = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    own = rules.select(F.col("host").alias("domain"), F.col("path").alias("start"), "allow").distinct()
    name = F.concat("domain", "start")
    found = (
        distinct.withColumn("domain", F.explode(domains))
        .join(own, "domain")
        .where(F.col("path").startswith(F.col("start")))
        .groupBy("host", "path")
        # Of one rule listed both ways, allow wins.
        .agg(F.max(F.struct(F.length(name).alias("n"), F.length("domain").alias("d"), "allow", name.alias("rule"))).alias("best"))
        .select(
            "host", "path", F.col("best.rule").alias("rule"),
            F.when(F.col("best.allow"), F.lit("allow")).otherwise(F.lit("block")).alias("ruled"),
        )
    )
    return urls.join(found, ["host", "path"], "left")


def ruled(urls: DataFrame, rules: tuple[Rule, ...] | DataFrame) -> DataFrame:
    """Add host, path, rule (its host and path) and ruled (allow or block; null if no rule fits) by ``url``.

    The longest rule wins, of equally long ones that with the longer host.
    """
    parts = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    if isinstance(rules, DataFrame):
        return _joined(parts, rules)
    if len(rules) <= INLINE_RULES:
        return _inline(parts, rules)
    rows = [(r.host, r.path, r.allow) for r in rules]
    return _joined(parts, urls.sparkSession.createDataFrame(rows, "host string, path string, allow boolean"))


def _target(tag: str, base: str) -> str | None:
    """The address that a canonical link or a redirecting meta tag of the page ``base`` names."""
    values: dict[str, str] = {}
    for name, *found in _ATTRIBUTE.findall(tag):
        values.setdefault(name.lower(), html.unescape(next((x for x in found if x), "")))
    named = None
    if tag[:5].lower() == "<link":
        if "canonical" in values.get("rel", "").lower().split():
            named = values.get("href", "").strip()
    elif values.get("http-equiv", "").strip().lower() == "refresh":
        if match := _REFRESH.match(values.get("content", "")):
            named = next(x for x in match.groups() if x).strip()
    if not named:
        return None
    try:
        return urljoin(base, named)
    except ValueError:  # not an address
        return None


def alias_links(pages: DataFrame) -> DataFrame:
    """(url, target) of every redirect and canonical link that the html of ``pages`` declares.

    Relative targets are resolved against the page's url. Tags inside comments, scripts
    and styles do not count. Rows with a null url or html have no links.
    """
    tags = F.filter(
        F.regexp_extract_all("html", F.lit(_TAGS), F.lit(0)),
        lambda t: t.rlike(r"(?is)^<link\b.*canonical") | t.rlike(r"(?is)^<meta\b.*refresh"),
    )
    rows = pages.where("url is not null and html is not null").select("url", F.explode(tags).alias("tag"))

    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch["url"].to_pylist()
            found = [_target(t, u) for u, t in zip(urls, batch["tag"].to_pylist())]
            yield pa.RecordBatch.from_pydict({"url": pa.array(urls, pa.string()), "target": pa.array(found, pa.string())})

    return rows.mapInArrow(targets, "url string, target string").where("target is not null")


def blocked_aliases(links: DataFrame, rules: tuple[Rule, ...] | DataFrame) -> DataFrame:
    """Distinct addresses (``address``) in a component of ``links`` (url, target) that holds a blocked address.

    Components are found over hashes of 256 bits by Spark jobs alone. Every address of a
    component counts, also one that is no page. Links without an address are left out.
    """
    key = lambda c: F.unhex(F.sha2(c, 256))
    edges = links.select(address(F.col("url")).alias("u"), address(F.col("target")).alias("t"))
    edges = stored(edges.where("u is not null and t is not null and u <> t").distinct(), "alias-links")
    nodes = edges.select(F.col("u").alias("url")).unionAll(edges.select(F.col("t").alias("url"))).distinct()
    if edges.isEmpty():
        return nodes.select(F.col("url").alias("address"))
    roots = connected_components(edges.select(key("u").alias("a"), key("t").alias("b")))
    members = stored(
        ruled(nodes, rules)
        .select(F.col("url").alias("address"), key("url").alias("node"), "ruled")
        .join(roots, "node")
        .select("address", "ruled", "root"),
        "alias-members",
    )
    blocked = members.where("ruled = 'block'").select("root").distinct()
    return members.join(blocked, "root", "left_semi").select("address")


def judge_urls(
    pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = RULES, links: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url, html).

    The verdict is the rule's if one fits. Else a page is blocked if it is an alias of an
    address that a rule blocks, over any number of redirects and canonical links, and
    allowed if not. ``links`` (url, target) adds redirects seen elsewhere, for example by
    a crawler.

    Repeated rows are judged each; a null page_id stays null. A null url, or one without
    ``://``, has an empty host and path, fits no rule, has no alias and is allowed. A null
    or empty html declares nothing. An empty table gives an empty one, and other columns
    take no part.
    """
    declared = alias_links(pages.select("url", "html"))
    if links is not None:
        declared = declared.unionAll(links.select("url", "target"))
    blocked = blocked_aliases(declared, rules).select("address", F.lit(True).alias("aliased"))
    judged = ruled(pages.select("page_id", "url"), rules)
    return judged.withColumn("address", address(F.col("url"))).join(blocked, "address", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("aliased"), F.lit("block")), F.lit("allow")).alias("verdict"),
    )

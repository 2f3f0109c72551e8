"""URL filters over redirect equivalence classes.

Rules (host, path) fit a url whose host is the rule's or one of its
subdomains and whose path starts with the rule's; the longest rule wins, of
equally long ones an allowing one. Urls that redirects or canonical links
connect are aliases: the connected components over those links. A url without
a rule of its own is blocked if an alias is blocked and no alias is explicitly
allowed; a url's own rule always stands.

Only DataFrame functions are used. Defined results: a null url, or one without
``://``, has an empty host and path, fits no rule, and is an alias of nothing;
null html has no links; all canonical and refresh tags count, relative targets
are taken from the page's url, those of other schemes ignored; repeated rows and urls are judged each; rules with a
null host, path or verdict are ignored; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .kernels import materialise, pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tags that may link a page to the url it stands for, what says that they do, and where the url is.
LINK, CANONICAL, HREF = r"(?is)<link\b[^>]*>", r"(?is)\brel\s*=\s*[\"']?canonical\b", r"(?is)\bhref\s*=\s*[\"']?([^\s\"'>]+)"
META, REFRESH, TARGET = (r"(?is)<meta\b[^>]*>", r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b",
                         r"(?is)\burl\s*=\s*['\"]?([^\s\"'>]+)")


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A url as a node: without its fragment, the host in lower case; null without ``://``."""
    rest = F.regexp_extract(after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    scheme = F.lower(F.substring_index(url, "://", 1))
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host_of(url), rest))


def without_dots(path: Column) -> Column:
    """A path from the root with its ``.`` and ``..`` segments resolved."""
    parts = F.slice(F.split(path, "/"), 2, F.size(F.split(path, "/")))
    # A last segment of dots names a folder.
    parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.array_append(parts, "")).otherwise(parts)
    empty = F.array().cast("array<string>")
    kept = F.aggregate(parts, empty, lambda acc, x: F.when(
        x == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(empty))
        .when(x == ".", acc).otherwise(F.array_append(acc, x)))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def absolute(target: Column, url: Column) -> Column:
    """A link's target, relative ones taken from the page's url; null for other
    schemes and for places in the page itself."""
    scheme = F.substring_index(url, "://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    own, rest = F.regexp_extract(target, "^[^?#]*", 0), F.regexp_extract(target, "^[^?#]*(.*)$", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path_of(url), "^(.*/)", 1), F.lit("")), F.lit("/"))
    return (F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
             .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | F.startswith(target, F.lit("#")), F.lit(None))
             .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
             .when(F.startswith(target, F.lit("/")), F.concat(root, without_dots(own), rest))
             .when(F.startswith(target, F.lit("?")), F.concat(root, path_of(url), target))
             .otherwise(F.concat(root, without_dots(F.concat(folder, own)), rest)))


def page_links(pages: DataFrame) -> DataFrame:
    """Links (a, b) between url nodes from all canonical tags and refresh redirects."""
    url, html = F.col("url").cast("string"), F.col("html").cast("string")

    def targets(tag: str, says: str, where: str) -> Column:
        tags = F.filter(F.regexp_extract_all(html, F.lit(tag), 0), lambda x: F.rlike(x, F.lit(says)))
        return F.transform(tags, lambda x: F.regexp_extract(x, where, 1))
    # Most pages have neither: one search for the words comes first.
    likely = F.lower(html).rlike("canonical|refresh")
    found = F.array_distinct(F.concat(targets(LINK, CANONICAL, HREF), targets(META, REFRESH, TARGET)))
    links = pages.where(likely & F.col("url").isNotNull()).select(url.alias("url"), F.explode(found).alias("target"))
    links = links.where("target <> ''").withColumn("target", F.regexp_replace("target", "&amp;", "&"))
    return links.select(node_of(F.col("url")).alias("a"), node_of(absolute(F.col("target"), F.col("url"))).alias("b")) \
                .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, decision) of the distinct host and path pairs that
    fit a rule. ``rules``: host, path, verdict."""
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')")
    r = rules.select(F.translate("host", UPPER, LOWER).alias("_rule_host"), F.col("path").alias("_rule_path"),
                     F.col("verdict").alias("_verdict"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    # A rule host's path lengths are as many as a path may have characters, however many rules it has.
    sizes = r.groupBy("_rule_host").agg(F.collect_set(F.length("_rule_path")).alias("_sizes"))
    hosts = (urls.where("host <> ''").select("host").distinct().withColumn("_rule_host", F.explode(suffixes))
                 .join(sizes, "_rule_host").select("host", "_rule_host", F.explode("_sizes").alias("_size")))
    tried = (urls.where("host <> ''").select("host", "path").distinct().join(hosts, "host")
                 .where(F.col("_size") <= F.length("path"))
                 .select("host", "path", "_rule_host", F.substring("path", F.lit(1), F.col("_size")).alias("_rule_path")))
    best = F.max(F.struct(F.length(F.concat("_rule_host", "_rule_path")).alias("size"),
                          (F.col("_verdict") == "allow").alias("allow"), F.concat("_rule_host", "_rule_path").alias("rule")))
    return (tried.join(r, ["_rule_host", "_rule_path"]).groupBy("host", "path").agg(best.alias("_best"))
                 .select("host", "path", F.col("_best.rule").alias("rule"),
                         F.when(F.col("_best.allow"), "allow").otherwise("block").alias("decision")))


def url_filter(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and component (url of the class, if
    any) of every page. ``redirects``: further links (source, target) of urls."""
    url = F.col("url").cast("string")
    pages = pick(pages, "page_id", "url", "html")
    urls = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    found = materialise(match_rules(urls, rules), "url-rules")
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select(node_of(F.col("source")).alias("a"),
                                                   node_of(F.col("target")).alias("b")))
    classes = components(links, name="url-classes")
    # Each class's decision from the rules of all its urls, pages or not.
    members = classes.select("node", "component", host_of(F.col("node")).alias("host"),
                             F.regexp_extract(path_of(F.col("node")), "^[^?]*", 0).alias("path"))
    decided = match_rules(members, rules)
    votes = (members.join(decided, ["host", "path"]).groupBy("component")
                    .agg(F.max(F.col("decision") == "allow").alias("allowed")))
    aliases = (classes.join(votes, "component")
                      .select("node", "component", F.when(F.col("allowed"), "allow").otherwise("block").alias("inherited")))
    out = urls.join(found, ["host", "path"], "left").join(aliases, "node", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("decision", "inherited", F.lit("allow")).alias("verdict"), "component")

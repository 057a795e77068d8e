"""URL filters: host and path rules, and block decisions that follow redirects and canonical links.

DataFrame operations only. Rules are a short list (a parameter), the links and components are distributed tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: More rules than this belong in a table; they would make the expression too long.
MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """``block`` or ``allow`` for a host with its subdomains and the paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used. Else every use repeats all that the value is made of, and so large an
    expression takes the driver's memory at each planning."""
    return F.transform(F.array(value), body)[0]


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; without ``://``: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; without ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_scheme(url: Column) -> Column:
    """Scheme before the first ``://`` in lower case; without one: empty."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?s)\A([A-Za-z][A-Za-z0-9+.-]*)://", 1), F.lit("")))


def _query(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)\A[^?#]*(\?[^#]*)", 1)


def url_node(url: Column) -> Column:
    """The address as a node: scheme and host in lower case, default port and fragment away, an empty path as ``/``. Without host: null.

    Only spellings that are one address by definition share a node; all else takes an edge.
    """
    def node(u: Column) -> Column:
        host = F.regexp_replace(url_host(u), r":(80|443)?\z", "")
        path = url_path(u)
        return F.when(host != "", F.concat(url_scheme(u), F.lit("://"), host, F.when(path == "", F.lit("/")).otherwise(path), _query(u)))

    return _once(url, node)


def plain_spelling(url: Column) -> Column:
    """The address to which servers commonly redirect: https, no ``www.``, no index page, ``.html`` or slash at the end, no tracking parameters (utm_*, ref), others in order."""
    return _once(url, _plain)


def _plain(url: Column) -> Column:
    host = F.regexp_replace(url_host(url), r"\Awww\.|:(80|443)?\z", "")
    path = F.regexp_replace(url_path(url), r"(/index)?(\.html)?/*\z", "")
    kept = F.array_sort(F.filter(F.split(F.substring(_query(url), F.lit(2), F.length(url)), "&"), lambda q: ~q.rlike(r"\A(utm_[^=]*|ref)(=|\z)") & (q != "")))
    return F.when(host != "", F.concat(F.lit("https://"), host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def spelling_redirects(pages: DataFrame) -> DataFrame:
    """from_url, to_url: the redirects that the urls of ``pages`` would be answered with by servers that keep one spelling (``plain_spelling``).

    For crawls that kept no redirect table; where there is one, use that. Urls without host give no row.
    """
    r = pages.select(F.col("url").alias("from_url"), plain_spelling(F.col("url")).alias("to_url"))
    return r.where(F.col("to_url").isNotNull() & (F.col("from_url") != F.col("to_url")))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (n, name, verdict) of the longest rule that fits, or null. Of equal rules ``allow`` wins."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES}")
    if not rules:
        return F.lit(None).cast("struct<n:int,name:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict))
    out = None
    for r in ordered:
        fits = (host.endswith(F.lit("." + r.host)) | (host == F.lit(r.host))) & path.startswith(F.lit(r.path))
        value = F.struct(F.lit(len(r.name)).alias("n"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def absolute_url(target: Column, url: Column) -> Column:
    """A link's target as an address: resolved against the page's ``url`` by scheme, host, path or query, dot segments removed."""
    return _once(F.named_struct(F.lit("target"), target, F.lit("url"), url), lambda x: _resolved(x["target"], x["url"]))


def _resolved(target: Column, url: Column) -> Column:
    scheme = F.concat(url_scheme(url), F.lit(":"))
    root = F.concat(scheme, F.lit("//"), url_host(url))
    rest = F.regexp_extract(target, r"(?s)\A[^?#]*(.*)\z", 1)
    own = F.regexp_extract(target, r"(?s)\A([^?#]*)", 1)
    folder = F.regexp_replace(url_path(url), r"[^/]*\z", "")
    joined = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), own))
    joined = F.regexp_replace(joined, r"(/\.\.?)\z", "$1/")  # a last dot segment names a folder
    steps = F.aggregate(
        F.split(joined, "/"), F.array().cast("array<string>"),
        lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(x))),
    )
    return (
        F.when(target.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("#"), url)
        .when(target.startswith("?"), F.concat(root, url_path(url), target))
        .otherwise(F.concat(root, F.array_join(steps, "/"), rest))
    )


#: A tag's name and what follows it; quoted values may hold ">".
_BODY = r"""(?:"[^"]*+"|'[^']*+'|[^'">]++)*+>"""
#: What a page is made of as far as tags matter: comments, elements whose content is text, and tags.
_MARKUP = rf"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|xmp|iframe|noembed|noframes)\b{_BODY}.*?(?:</\1|\z)|</?[a-z]{_BODY}"
_ATTRIBUTE = r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name, without quotes and with ``&amp;`` read as ``&``; null where there is none."""
    names, values = (F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(i)) for i in (1, 2))

    def at(place: Column) -> Column:
        value = F.regexp_replace(F.get(values, place.cast("int") - 1), r"(?s)\A([\"'])(.*)\1\z", "$2")
        return F.when(place > 0, F.regexp_replace(value, r"(?i)&(amp|#38|#x26);", "&"))

    return _once(F.array_position(F.transform(names, lambda x: F.lower(x)), name), at)


def _address(text: Column) -> Column:
    """An address as browsers read it from markup: no white space around it, no line breaks in it, spaces as ``%20``."""
    return F.replace(F.regexp_replace(F.regexp_replace(text, r"\A[\x00-\x20]+|[\x00-\x20]+\z", ""), r"[\t\r\n]", ""), F.lit(" "), F.lit("%20"))


def page_links(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between url nodes: all canonical links and refresh redirects in the whole html of pages.

    Html is cut into tags first: quoted values are whole, and what stands in comments, scripts and other elements of mere text is none.
    Relative targets are resolved against the page's address, or its first ``<base href>``. Null url or html, and links to nowhere,
    give no edge.
    """
    url = F.col("url")
    # neither word, no such link: most pages are not cut up at all
    d = pages.where(url.isNotNull() & F.col("html").rlike(r"(?i)canonical|refresh")).select("url", F.regexp_extract_all("html", F.lit(_MARKUP), F.lit(0)).alias("markup"))
    named = lambda x, word: F.lower(F.substring(x, 1, len(word) + 2)).rlike(rf"\A<{word}[\s/>]")
    bases = F.filter(F.transform(F.filter("markup", lambda x: named(x, "base")), lambda x: _address(_attribute(x, "href"))), lambda x: x.isNotNull())
    d = d.select("url", F.coalesce(absolute_url(F.get(bases, F.lit(0)), url), url).alias("base"), F.explode(F.filter("markup", lambda x: named(x, "link") | named(x, "meta"))).alias("tag"))
    tag = F.col("tag")
    # canonical may be any word of a list
    canonical = named(tag, "link") & F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"[\t\n\f\r ]+"), "canonical")
    refresh = named(tag, "meta") & (F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh")
    told = F.regexp_extract(_attribute(tag, "content"), r"(?is)\burl\s*=\s*(.*)\z", 1)
    told = F.regexp_replace(told, r"(?s)\A([\"'])([^\"']*).*\z", "$2")
    d = d.select("url", "base", F.when(canonical, _attribute(tag, "href")).when(refresh, told).alias("to"))
    d = d.withColumn("to", _address(F.col("to"))).where(F.col("to") != "")
    edges = d.select(url_node(url).alias("a"), url_node(absolute_url(F.col("to"), F.col("base"))).alias("b"))
    return edges.where("a is not null and b is not null and a <> b").distinct()


def judge_urls(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """page_id, url, host, path, rule, verdict, component for every row of ``pages`` (page_id, url, html).

    The longest rule that fits decides. Without one, a page is blocked if an alias of it, crawled or not, is blocked by a rule: aliases
    share a component of url nodes under canonical links, refresh redirects and the ``redirects`` table (from_url,
    to_url). A rule that allows a page is explicit and stands against its blocked aliases; it does not clear them.
    Otherwise ``default``. Null urls and urls without ``://`` have empty host and path, no component and the default.
    Repeated rows give repeated rows; empty pages give no rows; extra columns are ignored.
    """
    edges = page_links(pages)
    if redirects is not None:
        more = redirects.select(url_node(F.col("from_url")).alias("a"), url_node(F.col("to_url")).alias("b"))
        edges = edges.unionByName(more.where("a is not null and b is not null and a <> b")).distinct()
    component = connected_components(edges)
    # edges grow with the pages, so the join is never a broadcast
    p = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), url_node(F.col("url")).alias("node"))
    p = p.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
    p = p.join(component.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    # addresses that only links or redirects name count too; only components with a blocked member are kept, one row each
    named = component.where(matching_rule(url_host(F.col("node")), url_path(F.col("node")), rules)["verdict"] == "block").select("component")
    blocked = p.where(F.col("hit.verdict") == "block").select("component").unionByName(named).distinct().withColumn("blocked", F.lit(True))
    p = p.join(blocked, "component", "left")
    verdict = F.coalesce(F.col("hit.verdict"), F.when(F.col("blocked"), F.lit("block")), F.lit(default))
    return p.select("page_id", "url", "host", "path", F.col("hit.name").alias("rule"), verdict.alias("verdict"), "component")

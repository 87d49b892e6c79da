"""URL rules, and block decisions that follow redirects and canonical links.

A rule is a host with a path; it fits that host and its subdomains, for paths that
begin with its own. The longest rule that fits decides. Addresses that pages name as
their canonical address or redirect to are equivalent to the page's own: connected
components over these links are the classes. A page without a rule is blocked if its
class has a blocked address and no explicitly allowed one; otherwise it is allowed.

Edge cases: a null url, or one without ://, has empty host and path and belongs to no
class; null html has no links, and what is inside comments, scripts, styles, titles and
text areas is no link; relative links are resolved against the page's first base address,
else its own, dot segments removed; in links, &amp; and numeric references are decoded (one
that names no character becomes U+FFFD); addresses are equal that differ in scheme, case of
the host, fragment, dot segments, or an empty path for a root path; links of schemes without
:// are ignored; repeated rows give repeated results; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, stored

#: (rule, verdict), fixed by the contract.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

_TAGS = {
    "canonical": r"""(?is)<link\b[^>]*?\brel\s*=\s*["']?canonical\b[^>]*>""",
    "refresh": r"""(?is)<meta\b[^>]*?\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""",
    "base": r"""(?is)<base\b[^>]*?\bhref\s*=[^>]*>""",
}
_TARGETS = {
    "canonical": r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)""",
    "refresh": r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)""",
    "base": r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)""",
}
LINKS = ("canonical", "refresh")
#: Where tags are not markup; an open comment lasts to the end.
UNREAD = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(rf"<{t}\b.*?</{t}\b" for t in ("script", "style", "title", "textarea"))
#: A link in pieces: references, and what is between them.
PIECES, DECIMAL, HEX = "&amp;|&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&|[^&]+", "^&#([0-9]+);$", "^&#[xX]([0-9a-fA-F]+);$"
DOTS, LAST_DOTS = r"/\.\.?(/|$)", r"/\.\.?$"
ORIGIN, QUERY = "(?s)^(.*?://[^/?#]*)", r"(?s)^.*?://[^?#]*(\?[^#]*)"
#: What an absolute link begins with; a :// further on is part of a query.
ABSOLUTE, SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://", "^[A-Za-z][A-Za-z0-9+.-]*:"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` evaluated once, and once in the plan."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def without_dots(path: Column) -> Column:
    """``path`` without its . and .. segments."""

    def step(got: Column, x: Column) -> Column:
        back = F.when(F.size(got) > 1, F.slice(got, F.lit(1), F.size(got) - 1)).otherwise(got)
        return F.when(x == ".", got).when(x == "..", back).otherwise(F.concat(got, F.array(x)))

    def plain(path: Column) -> Column:
        whole = F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")
        return F.when(path.rlike(DOTS), F.concat(whole, F.when(path.rlike(LAST_DOTS), "/").otherwise(""))).otherwise(path)

    return bound(path, plain)


def query_of(url: Column) -> Column:
    return F.regexp_extract(url, QUERY, 1)


def address_of(url: Column) -> Column:
    """What spellings of an address share: no scheme, no fragment, lower-case host, a plain path. Null without ://."""
    path = bound(path_of(url), lambda p: F.when(p == "", "/").otherwise(without_dots(p)))
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path, query_of(url)))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, say in sorted(rules, key=lambda r: len(r[0])):
        at, _, below = name.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{below}")
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def decoded(link: Column) -> Column:
    """``link`` with its character references decoded, each once."""

    def character(code: Column, x: Column) -> Column:
        named = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
        return F.when(x == "&amp;", "&").when(code.isNull(), x).when(named, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")

    def read(x: Column) -> Column:
        digits = lambda pattern: F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))
        return bound(F.coalesce(digits(DECIMAL), F.conv(digits(HEX), 16, 10)).cast("bigint"), lambda code: character(code, x))

    pieces = F.regexp_extract_all(link, F.lit(PIECES), F.lit(0))
    return F.array_join(F.transform(pieces, read), "")


def link_targets(html: Column, kind: str) -> Column:
    tags = F.regexp_extract_all(html, F.lit(_TAGS[kind]), F.lit(0))
    return F.transform(tags, lambda t: decoded(F.regexp_extract(t, _TARGETS[kind], 1)))


def resolved(base: Column, to: Column) -> Column:
    """The address that the link ``to`` names on a page of address ``base``; null if none."""
    own, path = F.regexp_extract(base, ORIGIN, 1), path_of(base)
    folder = bound(F.regexp_replace(path, "[^/]*$", ""), lambda f: F.when(f == "", "/").otherwise(f))
    full = F.when(to.rlike(ABSOLUTE), to).when(to.startswith("//"), F.concat(F.lit("http:"), to))
    full = full.when(to.startswith("/"), F.concat(own, to)).when(to.startswith("?"), F.concat(own, path, to))
    full = full.when(~to.rlike(SCHEME) & (to != "") & ~to.startswith("#"), F.concat(own, folder, to))
    return bound(full, lambda u: F.when(u.isNotNull(), F.concat(F.regexp_extract(u, ORIGIN, 1), without_dots(path_of(u)), query_of(u))))


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst): absolute addresses of a page and of what it redirects or points to."""
    read = pages.where("instr(url, '://') > 0").select("url", F.regexp_replace(F.coalesce("html", F.lit("")), UNREAD, " ").alias("html"))
    to = F.concat(*[link_targets(F.col("html"), k) for k in LINKS])
    each = read.select("url", F.get(link_targets(F.col("html"), "base"), F.lit(0)).alias("base"), F.explode(to).alias("to"))
    base = F.coalesce(resolved(F.col("url"), F.col("base")), F.col("url"))
    return each.select(F.col("url").alias("src"), bound(base, lambda b: resolved(b, F.col("to"))).alias("dst")).where("dst is not null")


def class_verdicts(links: DataFrame, rules=RULES) -> DataFrame:
    """(address, class_verdict) for each address that a link touches."""
    ends = links.select(F.col("src").alias("url")).union(links.select(F.col("dst").alias("url")))
    _, say = rule_for(host_of(F.col("url")), path_of(F.col("url")), rules)
    nodes = ends.select(F.xxhash64(address_of(F.col("url"))).alias("node"), say.alias("say"))
    nodes = nodes.groupBy("node").agg(F.max((F.col("say") == "block").cast("int")).alias("blocks"), F.max((F.col("say") == "allow").cast("int")).alias("allows"))
    pairs = links.select(F.xxhash64(address_of(F.col("src"))).alias("src"), F.xxhash64(address_of(F.col("dst"))).alias("dst"))
    named = stored(nodes, "url-nodes").join(connected_components(pairs, "url-links", native=True), "node")
    named = stored(named, "url-named")  # as below, so that a hot class is split where it is joined
    whole = named.groupBy("component").agg(F.max("blocks").alias("blocks"), F.max("allows").alias("allows"))
    whole = stored(whole, "url-classes")
    verdict = F.when(F.coalesce("allows", F.lit(0)) == 1, F.lit("allow")).when(F.col("blocks") == 1, F.lit("block")).otherwise(F.lit("allow"))
    return named.select("node", "component").join(whole, "component").select("node", verdict.alias("class_verdict"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict."""
    links = stored(page_links(pages).distinct(), "url-edges")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, say = rule_for(F.col("host"), F.col("path"), rules)
    own = pages.select("page_id", host.alias("host"), path.alias("path"), F.when(F.instr("url", "://") > 0, F.xxhash64(address_of(F.col("url")))).alias("node"))
    own = own.withColumn("rule", rule).withColumn("say", say)
    verdict = F.coalesce("say", "class_verdict", F.lit("allow"))
    return own.join(class_verdicts(links, rules), "node", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def judge_sql(rules=RULES) -> str:
    """``judge`` in DuckDB SQL, with a recursive closure over the links."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rest = lambda u, tail: f"regexp_extract(coalesce({u}, ''), '(?s)^.*?://{tail}', 1)"
    host = lambda u: f"translate({rest(u, '([^/?#]*)')}, '{UPPER}', '{LOWER}')"
    path, query = lambda u: rest(u, "[^/?#]*([^?#]*)"), lambda u: f"regexp_extract({u}, {quote(QUERY)}, 1)"
    step = "case when b = ['.'] then a when b = ['..'] then case when len(a) > 1 then a[1:len(a) - 1] else a end else list_concat(a, b) end"
    plain = lambda p: (
        f"case when regexp_matches({p}, {quote(DOTS)}) then array_to_string(list_reduce(list_transform(string_split({p}, '/'), lambda x: [x]), lambda a, b: {step}), '/')"
        f" || case when regexp_matches({p}, {quote(LAST_DOTS)}) then '/' else '' end else {p} end"
    )
    address = lambda u: f"case when contains({u}, '://') then {host(u)} || case when {path(u)} = '' then '/' else {plain(path(u))} end || {query(u)} end"
    fits = " ".join(f"when (h = '{r.partition('/')[0]}' or ends_with(h, '.{r.partition('/')[0]}')) and starts_with(p, '/{r.partition('/')[2]}') then '{r}'" for r, _ in sorted(rules, key=lambda r: -len(r[0])))
    say = "case rule " + " ".join(f"when '{r}' then '{v}'" for r, v in rules) + " end"
    found = lambda p, pre: f"try_cast(nullif({pre} || regexp_extract(x, {quote(p)}, 1), {pre}) as bigint)"
    code = f"coalesce({found(DECIMAL, chr(39) * 2)}, {found(HEX, quote('0x'))})"
    read = f"case when x = '&amp;' then '&' when {code} is null then x when {code} between 1 and 55295 or {code} between 57344 and 1114111 then chr(cast({code} as integer)) else chr(65533) end"
    decode = lambda t: f"array_to_string(list_transform(regexp_extract_all({t}, {quote(PIECES)}), lambda x: {read}), '')"
    target = lambda k, t: decode(f"regexp_extract({t}, {quote(_TARGETS[k])}, 1)")
    tags = " union all ".join(f"select url, base, {target(k, 't')} as \"to\" from (select url, base, unnest(regexp_extract_all(html, {quote(_TAGS[k])})) as t from based)" for k in LINKS)

    def resolve(base: str, to: str) -> str:
        own, folder = f"regexp_extract({base}, '{ORIGIN}', 1)", f"regexp_replace({path(base)}, '[^/]*$', '')"
        return f"""case when regexp_matches({to}, '{ABSOLUTE}') then {to} when starts_with({to}, '//') then 'http:' || {to}
    when starts_with({to}, '/') then {own} || {to} when starts_with({to}, '?') then {own} || {path(base)} || {to}
    when not regexp_matches({to}, '{SCHEME}') and {to} <> '' and not starts_with({to}, '#') then {own} || case when {folder} = '' then '/' else {folder} end || {to} end"""

    whole = lambda u: f"case when {u} is not null then regexp_extract({u}, '{ORIGIN}', 1) || {plain(path(u))} || {query(u)} end"
    first = target("base", f"regexp_extract(html, {quote(_TAGS['base'])}, 0)")
    return f"""
with recursive readable as (select url, regexp_replace(coalesce(html, ''), {quote(UNREAD)}, ' ', 'g') as html from pages where contains(url, '://')),
named_base as (select url, html, {first} as b from readable),
full_base as (select url, html, {resolve('url', 'b')} as f from named_base),
based as (select url, html, coalesce({whole('f')}, url) as base from full_base),
raw as ({tags}),
met as (select url, {resolve('base', '"to"')} as f from raw),
links as (select url as src, {whole('f')} as dst from met),
ends as (select src as url from links where dst is not null union select dst from links where dst is not null),
named as (select {address('url')} as a, {host('url')} as h, {path('url')} as p from ends),
said as (select a, {say} as say from (select a, case {fits} end as rule from named)),
e as (select {address('src')} as a, {address('dst')} as b from links where dst is not null
      union select {address('dst')}, {address('src')} from links where dst is not null),
reach(a, b) as (select a, a from e union select r.a, e.b from reach r join e on r.b = e.a),
whole as (select r.a, case when bool_or(say = 'allow') then 'allow' when bool_or(say = 'block') then 'block' else 'allow' end as v
      from reach r join said on said.a = r.b group by r.a),
own as (select page_id, h as host, p as path, a, case {fits} end as rule from (select page_id, {host('url')} as h, {path('url')} as p, {address('url')} as a from pages))
select page_id, host, path, rule, coalesce({say}, whole.v, 'allow') as verdict from own left join whole using (a)"""

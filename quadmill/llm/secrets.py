"""Secret scans with a trigram index.

Each rule's regular expression is turned into a Boolean query of trigrams that every
match must contain. The index holds, for each trigram that a rule asks for, a posting
for each document whose lower-cased text contains it. Postings are kept as bits beside
the document they belong to (a bitmap index of the input split), so that intersecting
the posting lists of a query is bitwise AND over the split and candidates are found
where their text is: nothing is shuffled. Candidates are verified with the regular
expression; a rule without mandatory trigrams takes every document.

Edge cases: null text is empty; offsets are code points; a text without findings has
empty spans and the digest of the empty string; repeated rows give repeated results;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re._constants as kinds
import re._parser as parser
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

MOST_STRINGS = 64


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str  # in the syntax that Java, RE2 and Python share
    least: int = 0  # code points that ``group`` needs
    group: int = 0
    base: bool = False


_KEYWORDS = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")

#: The first three are fixed by the contract; the others are token formats that their
#: issuers publish.
RULES = (
    Rule("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16, 0, True),
    Rule("hex", r"[0-9a-f]+", 32, 0, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,250}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@"),
)

#: A query is a conjunction of clauses; a clause is a disjunction of trigram sets.
Clause = frozenset[frozenset[str]]


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def absorbed(sets: set[frozenset[str]]) -> Clause:
    """Without sets that another one implies."""
    return frozenset(s for s in sets if not any(o < s for o in sets))


def trigram_query(regex: str) -> list[Clause]:
    """The clauses that the lower-cased text of any match satisfies; [] if there is none."""
    strings, clauses = _walk(parser.parse(regex))
    return [*clauses, *_closed(strings)]


def _closed(strings: set[str]) -> list[Clause]:
    sets = {trigrams(s) for s in strings}
    return [] if frozenset() in sets else [absorbed(sets)]


def _walk(items) -> tuple[set[str], list[Clause]]:
    """The strings that may end the match so far, and the clauses gathered before.

    Strings are exact as long as all of them are known; where the next element is
    open, they are closed into a clause and begin anew.
    """
    strings, clauses = {""}, []

    def open_end() -> None:
        nonlocal strings
        clauses.extend(_closed(strings))
        strings = {""}

    def follow(options: set[str] | None) -> None:
        nonlocal strings
        if options is None:
            open_end()
        elif len(options) * len(strings) > MOST_STRINGS:
            open_end()
            strings = options if len(options) <= MOST_STRINGS else {""}
        else:
            strings = {a + b for a, b in product(strings, options)}

    for kind, value in items:
        if kind is kinds.LITERAL:
            follow({chr(value).lower()})
        elif kind is kinds.IN:
            follow(_class(value))
        elif kind is kinds.SUBPATTERN:
            inner, more = _walk(value[-1])
            clauses.extend(more)
            open_end() if more else None
            follow(inner)
        elif kind is kinds.BRANCH:
            parts = [_walk(part) for part in value[1]]
            if any(more for _, more in parts):
                open_end()
                whole = [[*more, *_closed(inner)] for inner, more in parts]
                if all(whole):  # of each alternative, its first clause stands for it
                    clauses.append(absorbed(set().union(*(w[0] for w in whole))))
            else:
                follow(set().union(*(inner for inner, _ in parts)))
        elif kind is kinds.MAX_REPEAT:
            least, most, body = value
            inner, more = _walk(body)
            if most == 1 and not more:
                follow(inner | {""} if least == 0 else inner)
            elif least == most and not more and len(inner) == 1:
                follow({next(iter(inner)) * least})
            else:
                if least and not more:
                    follow(inner)
                if least:
                    clauses.extend(more)
                open_end()
        elif kind is not kinds.AT:
            open_end()
    return strings, clauses


def _class(items) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            found.add(chr(value).lower())
        elif kind is kinds.RANGE and value[1] - value[0] < 8:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def vocabulary(rules: tuple[Rule, ...] = RULES) -> list[str]:
    return sorted({t for r in rules for clause in trigram_query(r.regex) for s in clause for t in s})


WORD = 62  # postings in a long


def indexed(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and text with _qm_bits, the postings of the document."""
    terms = vocabulary(rules)
    words = []
    for at in range(0, len(terms), WORD):
        bits = [F.when(F.contains("_qm_low", F.lit(t)), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, t in enumerate(terms[at : at + WORD])]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), bits))
    low = docs.select("doc_id", text_or_empty().alias("_qm_text"), F.lower(text_or_empty()).alias("_qm_low"))
    return low.select("doc_id", "_qm_text", *[w.alias(f"_qm_bits{k}") for k, w in enumerate(words)])


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The index the other way round: (trigram, doc_id), to be stored and joined."""
    terms = vocabulary(rules)
    has = [F.when(F.col(f"_qm_bits{i // WORD}").bitwiseAND(F.lit(1 << i % WORD)) != 0, F.lit(t)) for i, t in enumerate(terms)]
    return indexed(docs, rules).select(F.explode(F.array_compact(F.array(*has))).alias("trigram"), "doc_id")


def candidate(rule: Rule, terms: list[str]) -> Column:
    """Whether the postings satisfy the rule's query."""

    def holds(needed: frozenset[str]) -> Column:
        masks: dict[int, int] = {}
        for t in needed:
            i = terms.index(t)
            masks[i // WORD] = masks.get(i // WORD, 0) | 1 << i % WORD
        return reduce(lambda a, b: a & b, [F.col(f"_qm_bits{k}").bitwiseAND(F.lit(m)) == F.lit(m) for k, m in sorted(masks.items())])

    clauses = [reduce(lambda a, b: a | b, map(holds, sorted(c, key=sorted))) for c in trigram_query(rule.regex)]
    return reduce(lambda a, b: a & b, clauses, F.lit(True))


SPAN = "struct<start:int,kind:int,end:int>"


def found(rule: Rule, number: int) -> Column:
    """All spans of a rule in _qm_text, as (start, kind, end).

    What lies between matches and the matches themselves alternate, so their lengths
    add up to the offsets.
    """
    text, regex = F.col("_qm_text"), F.lit(rule.regex)
    between = F.transform(F.split(text, rule.regex, -1), F.length)
    matches = F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.length)
    counted = matches if not rule.group else F.transform(F.regexp_extract_all(text, regex, F.lit(rule.group)), F.length)
    steps = F.zip_with(
        F.slice(between, F.lit(1), F.size(matches)),
        F.arrays_zip(matches.alias("length"), counted.alias("counted")),
        lambda gap, m: F.struct(gap.alias("gap"), m["length"].alias("length"), m["counted"].alias("counted")),
    )

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["length"]
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        more = F.when(step["counted"] >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    return F.aggregate(steps, first, add, lambda s: s["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans, an array of (start, kind, end) by start, then kind."""
    terms, none = vocabulary(rules), F.array().cast(f"array<{SPAN}>")
    parts = [F.when(candidate(r, terms), found(r, k)).otherwise(none) for k, r in enumerate(rules)]
    return indexed(docs, rules).select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    base = F.filter("spans", lambda s: s["kind"].isin(*[k for k, r in enumerate(rules) if r.base]))

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(rules) if r.base]
    return scan(docs, rules).select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def report_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """``report`` in DuckDB SQL, without the index."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    made, lists = [], []
    for k, r in enumerate(rules):
        made.append(f"list_transform(regexp_split_to_array(t, {quote(r.regex)}), lambda x: length(x)) as g{k}, list_transform(regexp_extract_all(t, {quote(r.regex)}, 0), lambda x: length(x)) as m{k}, list_transform(regexp_extract_all(t, {quote(r.regex)}, {r.group}), lambda x: length(x)) as c{k}")
        at = f"coalesce(list_sum(list_slice(g{k}, 1, i)), 0) + coalesce(list_sum(list_slice(m{k}, 1, i - 1)), 0)"
        lists.append(f"list_transform(list_filter(range(1, len(m{k}) + 1), lambda i: c{k}[i] >= {r.least}), lambda i: {{'s': cast({at} as bigint), 'k': {k}, 'e': cast({at} + m{k}[i] as bigint)}})")
    names = "[" + ", ".join(quote(r.kind) for r in rules) + "]"
    said = lambda x: f"list_aggregate(list_transform({x}, lambda x: {names}[x.k + 1] || ':' || x.s || ':' || x.e), 'string_agg', ',')"
    base = [k for k, r in enumerate(rules) if r.base]
    counts = ", ".join(f"cast(len(list_filter(v, lambda y: y.k = {k})) as bigint) as n_{rules[k].kind}" for k in base)
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
f as (select doc_id, {', '.join(made)} from d),
s as (select doc_id, list_sort(flatten([{', '.join(lists)}])) as v from f)
select doc_id, {counts}, sha256(coalesce({said(f"list_filter(v, lambda y: y.k in ({', '.join(map(str, base))}))")}, '')) as base_sha256,
  coalesce({said('v')}, '') as spans from s"""

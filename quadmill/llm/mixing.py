"""Mixing sources to target weights by Poisson replication.

A source's rate is its target size over its own size (code points of text), so that
the expected size of the mixture is the size of the input. Each document draws a
uniform number from a hash of a seed and its doc_id, which the inverse Poisson
distribution with that rate turns into a number of copies. Copies are exploded and
dealt out by a hash of seed, doc_id and copy: a global shuffle that costs one exchange
and gives the same order again after a lost executor.

A rate above ``RATE_A_DRAW`` is dealt out evenly to several draws with hashes of their own,
whose sum has the Poisson distribution of the whole rate: so a distribution has about a
hundred steps at most, whatever the rate.

Rates are known for the sources of the configuration and for the rest taken together,
so that what the driver holds is bounded by the configuration, not by the data.

Edge cases: a null or unlisted source belongs to the rest; null text has size zero; a
source of size zero has rate one; repeated rows
draw the same number; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

SEED = "quadmill-mix-1"
#: Target shares of the mixture; sources that aren't listed share what is left.
WEIGHTS = {"src0": 0.15, "src1": 0.08, "src2": 0.08, "src3": 0.02}
REST = ""
RATE_A_DRAW = 32.0


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of an MD5."""
    key = F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def distribution(rate: float) -> list[float]:
    """P(copies <= k) for k from 0, until the rest is below the draw's resolution."""
    out, total, k = [], 0.0, 0
    while rate > 0 and (1 - total > 1e-13 or k <= rate) and k < rate + 40 * math.sqrt(rate) + 60:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        out.append(min(total, 1.0))
        k += 1
    return out


def draws_of(rate: float) -> int:
    return max(1, math.ceil(rate / RATE_A_DRAW))


def group_of(weights: dict[str, float]) -> Column:
    listed = F.col("source").isin(*weights) if weights else F.lit(False)
    return F.when(listed, F.col("source")).otherwise(F.lit(REST))


def rates(docs: DataFrame, weights: dict[str, float]) -> dict[str, float]:
    """Mean copies of a document by group; at most one row a listed source is read."""
    sizes = docs.groupBy(group_of(weights).alias("g")).agg(F.sum(F.length(text_or_empty())).alias("size"))
    size = {r["g"]: r["size"] or 0 for r in sizes.collect()}
    total = sum(size.values())
    share = {**weights, REST: max(0.0, 1.0 - math.fsum(weights.values()))}
    return {g: share[g] * total / n if n else 1.0 for g, n in size.items()}


def draw(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with _qm_rate and _qm_copies."""
    weights = WEIGHTS if weights is None else weights
    rate = rates(docs, weights)
    u = uniform(seed, F.col("doc_id"))
    copies, mean = F.lit(0).cast("int"), F.lit(0.0)
    for g, r in rate.items():
        # The inverse: copies is the number of k whose P(copies <= k) is at most the draw.
        draws = draws_of(r)
        steps = F.array(*[F.lit(x) for x in distribution(r / draws)]) if r > 0 else F.array().cast("array<double>")
        one = lambda u, steps=steps: F.size(F.filter(steps, lambda x: x <= u))
        number = one(F.col("_qm_u"))
        if draws > 1:
            more = F.sequence(F.lit(1), F.lit(draws - 1))
            number = F.aggregate(more, number, lambda n, j: n + one(uniform(seed, F.col("doc_id"), j)))
        here = group_of(weights) == F.lit(g)
        copies = F.when(here, number).otherwise(copies)
        mean = F.when(here, F.lit(r)).otherwise(mean)
    return docs.withColumn("_qm_u", u).withColumn("_qm_copies", copies).withColumn("_qm_rate", mean).drop("_qm_u")


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED) -> DataFrame:
    """Each document as often as drawn, with _qm_copy from 0, in a global random order."""
    drawn = draw(docs, weights, seed).where("_qm_copies > 0")
    each = drawn.withColumn("_qm_copy", F.explode(F.sequence(F.lit(0), F.col("_qm_copies") - 1)))
    key = uniform(f"{seed}:order", F.col("doc_id"), F.col("_qm_copy"))
    return each.withColumn("_qm_order", key).repartition("_qm_order").sortWithinPartitions("_qm_order")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED) -> DataFrame:
    """The mixture, with the columns of ``docs``."""
    return replicate(docs, weights, seed).select(*docs.columns)


def report(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED) -> DataFrame:
    """The mixture without texts: doc_id, source, rate, n_copies, copy, order_key.

    Rates and draws need no text, so texts stay out of the exchange.
    """
    weights = WEIGHTS if weights is None else weights
    out = replicate(docs, weights, seed)
    return out.select(
        "doc_id", "source", F.round("_qm_rate", 6).alias("rate"), F.col("_qm_copies").alias("n_copies"),
        F.col("_qm_copy").alias("copy"), F.col("_qm_order").alias("order_key"),
    )


def report_sql(weights: dict[str, float] | None = None, seed: str = SEED) -> str:
    """``report`` in DuckDB SQL."""
    weights = WEIGHTS if weights is None else weights
    listed = ", ".join(f"('{s}', {w!r}::double)" for s, w in weights.items())
    rest = max(0.0, 1.0 - math.fsum(weights.values()))
    part = lambda x: f"coalesce(cast({x} as varchar), 'null')"
    unit = lambda s, *p: f"cast(('0x' || substr(md5(concat_ws(':', '{s}', {', '.join(map(part, p))})), 1, 13)) as bigint) / {float(1 << 52)!r}"
    below = lambda u: f"len(list_filter(cdf, lambda x: x <= least({u}, 0.9999999999999)))"
    return f"""
with w(s, share) as (values {listed}),
d as (select doc_id, source, length(coalesce(text, '')) as n, coalesce(w.s, '{REST}') as g, coalesce(w.share, {rest!r}) as share
      from documents left join w on w.s = source),
r as (select g, case when sum(n) > 0 then any_value(share) * (select sum(n) from d) / sum(n) else 1.0 end as rate from d group by g),
m as (select g, rate, greatest(1, cast(ceil(rate / {RATE_A_DRAW!r}) as bigint)) as draws, rate / greatest(1, ceil(rate / {RATE_A_DRAW!r})) as a from r),
p as (select g, rate, draws, list_transform(range(0, cast(a + 40 * sqrt(a) + 60 as bigint)), lambda k:
        list_sum(list_transform(range(0, k + 1), lambda j: exp(j * ln(a) - a - lgamma(j + 1))))) as cdf from m where rate > 0),
c as (select doc_id, source, rate, cast({below(unit(seed, 'doc_id'))} + coalesce(list_sum(list_transform(range(1, draws), lambda i: {below(unit(seed, 'doc_id', 'i'))})), 0) as integer) as k
      from d join p using (g))
select doc_id, source, round(rate, 6) as rate, k as n_copies, cast(i as integer) as copy, {unit(seed + ':order', 'doc_id', 'i')} as order_key
from c, unnest(range(0, k)) as t(i)"""

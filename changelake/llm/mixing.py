"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its share of the target mixture times the target
size, over the size it has. Each document draws its number of copies by inverting the
Poisson distribution of that rate at a uniform number hashed from the seed, its id and its
text (so rows without an id, or of one id, draw apart), is exploded into that many copies, and the copies are shuffled globally by a hash. A rerun or
a retried task draws the same.

A document's size is its characters, at least 1. Only one row per source leaves the
tasks. The rate table is broadcast if its checked size is small, else joined (the skew of
a hot source is then split by adaptive execution).

Edge cases: a null source is a source of its own; a source without a weight has weight 0
and gives no rows; weights of sources that do not occur are ignored, and if no weight is
left the result is empty; rows equal in id and text draw alike; null and empty texts count
as size 1 and draw alike; where the documents have a column of the name of an added one, the
added one ends in an underscore; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import fresh, stable, uniform

#: Numbers in a rate table that may be broadcast (8 bytes each).
BROADCAST_NUMBERS = 1_000_000
#: Standard deviations of a Poisson distribution that its table covers on either side.
SPREAD = 12


def _first_count(rate: Column) -> Column:
    """The smallest count with a probability worth listing."""
    return F.greatest(F.lit(0.0), F.floor(rate - SPREAD * F.sqrt(rate) - 24)).cast("int")


def poisson_table(rate: Column) -> Column:
    """Cumulative probabilities of the counts from ``_first_count`` on."""
    first = _first_count(rate)
    x = F.greatest(first, F.lit(1)).cast("double")
    # ln(first!) by Stirling's series; first is 0 or large here.
    log_factorial = F.when(first == 0, 0.0).otherwise(
        x * F.log(x) - x + 0.5 * F.log(F.lit(2) * F.pi() * x) + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))))
    start = -rate + F.when(first == 0, 0.0).otherwise(first * F.log(rate)) - log_factorial
    last = F.ceil(rate + SPREAD * F.sqrt(rate) + 24).cast("int")

    def step(acc, k):
        log_p = acc["log_p"] + F.log(rate) - F.log(k.cast("double"))
        total = acc["total"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("total"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    begin = F.struct(start.alias("log_p"), F.exp(start).alias("total"), F.array(F.exp(start)).alias("cdf"))
    return F.aggregate(F.sequence(first + 1, last), begin, step, lambda acc: acc["cdf"])


def repetition_rates(docs: DataFrame, weights: dict | None = None, source_col: str = "source", text_col: str = "text",
                     total: float | None = None) -> DataFrame:
    """(source, size, rate): mean copies per document of each source. ``weights``: target
    share by source, equal shares if none are given; ``total``: target size in characters,
    the present size if none is given."""
    size = F.greatest(F.coalesce(F.length(text_col), F.lit(0)), F.lit(1)).cast("bigint")
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("size"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, share in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(share))).otherwise(weight)
    sizes = stable(sizes.withColumn("weight", weight))
    all_size, all_weight = sizes.agg(F.sum("size"), F.sum("weight")).first()
    target = float(total if total is not None else all_size or 0)
    return sizes.where("weight > 0") \
        .select("source", "size", (F.lit(target) * F.col("weight") / F.lit(all_weight or 1.0) / F.col("size")).alias("rate"))


def mix(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", total: float | None = None, seed: int = 42,
        copy_col: str = "copy", key_col: str = "shuffle_key") -> DataFrame:
    """The mixture: ``docs`` with ``copy_col`` (0, 1, ... within a document) and ``key_col``,
    the random place in [0, 1); partitions are dealt by it and sorted by it. Both come last,
    under a fresh name if ``docs`` has theirs."""
    copy_col = fresh(docs, copy_col)
    key_col = fresh(docs.withColumn(copy_col, F.lit(0)), key_col)
    rates = repetition_rates(docs, weights, source_col, text_col, total)
    rates = stable(rates.select(F.col("source").alias(fresh(docs, "mix_source")), _first_count(F.col("rate")).alias(
        fresh(docs, "mix_first")), poisson_table(F.col("rate")).alias(fresh(docs, "mix_cdf"))))
    source, first, cdf = rates.columns
    numbers = rates.agg(F.sum(F.size(cdf) + 4)).first()[0] or 0
    table = F.broadcast(rates) if numbers <= BROADCAST_NUMBERS else rates
    joined = docs.join(table, docs[source_col].eqNullSafe(table[source]))
    times, mark = fresh(docs, "mix_times"), fresh(docs, "mix_text")
    draw = uniform(docs[id_col], F.col(mark), seed=seed)

    def above(acc, p):
        return F.struct((acc["n"] + (p <= acc["u"]).cast("int")).alias("n"), acc["u"].alias("u"))
    # The draw is the walk's starting value: inside the step it would be hashed once a probability.
    count = F.col(first) + F.aggregate(cdf, F.struct(F.lit(0).alias("n"), draw.alias("u")), above, lambda acc: acc["n"])
    text = F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary"))
    copies = joined.withColumn(mark, text).withColumn(times, count).where(F.col(times) > 0) \
        .select(*(docs[c] for c in docs.columns), mark, F.explode(F.sequence(F.lit(0), F.col(times) - 1)).alias(copy_col))
    keyed = copies.withColumn(key_col, uniform(F.col(id_col), F.col(mark), F.col(copy_col), seed=seed + 1)).drop(mark)
    return keyed.repartition(key_col).sortWithinPartitions(key_col)


def oracle(table: str, columns: str, seed: int = 42) -> str:
    """The same mixture, equal weights, as DuckDB SQL."""
    def draw(seed, parts):
        return f"(('0x' || substr(md5('{seed}:' || {parts}), 1, 13))::BIGINT / 4503599627370496.0)"
    key = "coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))"
    return f"""
    WITH sizes AS (SELECT source, sum(greatest(coalesce(length(text), 0), 1)) AS size FROM {table} GROUP BY source),
    rates AS (SELECT source, (SELECT sum(size) FROM sizes)::DOUBLE / (SELECT count(*) FROM sizes) / size AS rate FROM sizes),
    cdf AS (SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1)))
                              OVER (PARTITION BY source ORDER BY k) AS p
            FROM rates, unnest(range(0, (rate + {SPREAD} * sqrt(rate) + 25)::BIGINT)) AS r(k)),
    drawn AS (SELECT d.*, {draw(seed, key)} AS u FROM {table} d),
    counted AS (SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.p <= d.u)
                AS times FROM drawn d)
    SELECT {columns}, c::INTEGER AS "copy", {draw(seed + 1, key + " || ':' || c")} AS shuffle_key
    FROM (SELECT *, unnest(range(0, times)) AS c FROM counted)"""

"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import common as c

SEED = 20


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, total: float = 1.0, source_col: str = "source") -> DataFrame:
    """(source, n_docs, rate, cdf): the mean repetitions of a row, and the Poisson distribution of that mean.

    ``weights`` gives the share of each source in the result, up to a factor; a source without one
    gets none. With no weights all sources get the same. ``total`` is the expected size of
    the result as a multiple of the input. A null source is a source of its own.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        listed = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]).cast("map<string,double>")
        weight = F.coalesce(F.element_at(listed, F.col("source").cast("string")), F.lit(0.0))
    sizes = c.stored(sizes.withColumn("weight", weight), "mix-sizes")
    sums = sizes.agg(F.sum("n_docs").alias("rows"), F.sum("weight").alias("weights")).first()
    if not sums["rows"] or not sums["weights"]:
        rate = F.lit(0.0)
    else:
        rate = F.col("weight") / F.lit(float(sums["weights"])) * F.lit(float(total * sums["rows"])) / F.col("n_docs")
    # probabilities by their logarithms: exp(-rate) alone is 0 for large rates
    terms = F.sequence(F.lit(1), F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int"))
    start = F.struct((-F.col("rate")).alias("log"), F.exp(-F.col("rate")).alias("sum"), F.array(F.exp(-F.col("rate"))).alias("cdf"))

    def step(state, k):
        log = state["log"] + F.log(F.col("rate")) - F.log(k.cast("double"))
        return F.struct(log.alias("log"), (state["sum"] + F.exp(log)).alias("sum"), F.concat(state["cdf"], F.array(state["sum"] + F.exp(log))).alias("cdf"))

    rated = sizes.withColumn("rate", rate)
    cdf = F.when(F.col("rate") > 0, F.aggregate(terms, start, step, lambda s: s["cdf"])).otherwise(F.array(F.lit(2.0)))
    return c.stored(rated.select("source", "n_docs", "rate", cdf.alias("cdf")), "mix-rates")


def mix_sources(
    docs: DataFrame, weights: dict[str, float] | None = None, total: float = 1.0, seed: int = SEED,
    id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """The columns of ``docs`` with mix_copy, mix_copies, mix_rate and mix_place: each row as often as its Poisson draw says.

    The draw inverts the distribution at a number hashed from seed, source and id, so it is the
    same in any order and on any cluster; rows with equal id and source are drawn alike and all
    kept. A draw of 0 leaves the row out: that is the operator. Null ids hash as empty text, null
    texts are rows as any other. ``mix_place`` is a hashed place in the global order: the result is
    dealt to tasks by it and sorted by it inside each, so every task holds an even mixture.
    Columns of the input with these four names, or ``_source``, are replaced.

    The table of rates has one row per source; it is stored, so that its measured size decides
    whether it is broadcast, and a hot source is never dealt to one task by a forced choice.
    """
    added = ["mix_copy", "mix_copies", "mix_rate", "mix_place"]
    docs = docs.drop(*added, "_source", "_cdf")
    rates = source_rates(docs, weights, total, source_col).select(
        F.col("source").alias("_source"), F.col("rate").alias("mix_rate"), F.col("cdf").alias("_cdf"))
    drawn = docs.join(rates, F.col(source_col).eqNullSafe(F.col("_source")))
    unit = c.seeded_unit(seed, source_col, id_col)
    drawn = drawn.withColumn("mix_copies", F.size(F.filter("_cdf", lambda p: p <= unit)))
    copies = drawn.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    place = F.floor(c.seeded_unit(seed + 1, source_col, id_col, "mix_copy") * F.lit(float(1 << 52))).cast("long")
    placed = copies.withColumn("mix_place", place).drop("_source", "_cdf")
    return placed.repartition("mix_place").sortWithinPartitions("mix_place").select(*docs.columns, *added)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with every source at the same weight, as many rows as before on average."""
    return mix_sources(c.documents(spark, sf_dir))


OP5_SQL = f"""
WITH sizes AS (SELECT source, count(*) AS n_docs FROM documents GROUP BY source),
sums AS (SELECT sum(n_docs)::DOUBLE AS n_rows, sum(1.0::DOUBLE) AS n_weights FROM sizes),
rates AS (SELECT source, 1.0::DOUBLE / n_weights * n_rows / n_docs AS rate FROM sizes, sums),
terms AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM rates),
logs AS (SELECT *, -rate + sum(CASE WHEN k = 0 THEN 0 ELSE ln(rate) - ln(k) END)
           OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS lg FROM terms),
cdf AS (SELECT source, rate, k, sum(exp(lg)) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS p FROM logs),
drawn AS (SELECT d.*, ('0x' || substr(md5('{SEED}:' || coalesce(d.source, '') || ':' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {1 << 52}::DOUBLE AS u FROM documents d),
counted AS (SELECT d.doc_id, d.source, c.rate, count(*) FILTER (WHERE c.p <= d.u)::INTEGER AS copies
            FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source GROUP BY d.doc_id, d.source, c.rate),
copied AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, n.copies, n.rate, unnest(range(1, n.copies + 1))::INTEGER AS copy
           FROM documents d JOIN counted n ON d.doc_id IS NOT DISTINCT FROM n.doc_id AND d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, text, lang, source, n_chars, copy AS mix_copy, copies AS mix_copies, rate AS mix_rate,
       ('0x' || substr(md5('{SEED + 1}:' || coalesce(source, '') || ':' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR), 1, 13))::BIGINT AS mix_place
FROM copied
"""

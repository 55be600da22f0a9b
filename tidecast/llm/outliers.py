"""Quality rules by robust multivariate outliers, in SQL functions only.

Each text is reduced to counts, and the counts to a vector of transformed statistics. For every language
and source the minimum covariance determinant is estimated: the mean and covariance of those 75 % of the
vectors whose covariance has the least determinant. Concentration steps find it from two starts (medians
and median deviations; mean and covariance of all), and the smaller determinant wins. A text is rejected
if its Mahalanobis distance from the estimate is beyond a quantile of the chi-squared distribution.

A step reads the staged vectors once: sums and products are counted by group and bin of the distance, so
the subset's size is found on bins, a large group is pre-aggregated like any other, and no group is
collected. Variances have a floor, so a statistic that hardly varies rejects nobody for a small change.
Groups of fewer than ``least_rows`` vectors are pooled by language, then all together; a pool that is
still too small to estimate from rejects nobody beyond the fixed rules.

Null text has no words and fails the fixed rules. Null language or source is a group of its own. Repeated
rows are judged alike. An empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.mixing import WORD
from tidecast.llm.staging import small, stage

SYMBOL = "[#*$%&|<>]"
#: Words in a window for repeats; fewest words; most repeated words, in percent.
WINDOW, LEAST_WORDS, MOST_REPEATS = 5, 10, 20
#: Transformed statistics and the floor of the standard deviation of each.
STATISTICS = {"x0": 0.5, "x1": 0.05, "x2": 0.03, "x3": 0.15, "x4": 0.12}
SIZE = len(STATISTICS)
#: Share of a group's vectors in the subset, and the chi-squared quantile (5 degrees) of that share.
KEPT, KEPT_QUANTILE = 0.75, 6.6257
#: Chi-squared quantile (5 degrees) beyond which a vector is an outlier: a chance of 1e-9.
CUTOFF = 50.7
STEPS = 4
#: Rows up to which the table of estimates is broadcast.
BROADCAST_GROUPS = 20_000
#: Bins for each doubling of 1 + distance.
BINS = 32


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(tokens: Column) -> Column:
    """Words in windows of five that occur twice or more, all occurrences included."""

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda total, x: total + x)

    def places(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda s, j: s["h"].eqNullSafe(F.get(ordered, j - 1)["h"]) | s["h"].eqNullSafe(F.get(ordered, j + 1)["h"]))
        return F.array_sort(F.transform(twice, lambda s: s["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(let(pairs, places), covered))

    windows = F.transform(F.sequence(F.lit(1), F.size(tokens) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(tokens, i, WINDOW)))
    return F.when(F.size(tokens) > WINDOW, let(windows, count)).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts of every text, whether the fixed rules reject it, and the transformed statistics."""
    body = F.coalesce(F.col(text), F.lit(""))

    def facts(tokens: Column) -> Column:
        lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            F.regexp_count(body, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).alias("all"))).alias("lines"),
            repeated_words(tokens).alias("n_repeat_words"),
        )

    found = let(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), facts)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), found.alias("f"))
    rows = rows.select(
        "doc_id", "lang", "source", "f.n_words", "f.word_chars", "f.n_symbols", F.col("f.lines.dup").alias("n_dup_lines"),
        "f.n_repeat_words", F.col("f.lines.all").alias("n_lines"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))

    def share(part: str, of: str) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / F.greatest(F.col(of), F.lit(1)))))

    return rows.select(
        "*", failed.alias("base_failed"),
        F.log1p("n_words").alias("x0"), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))).alias("x1"),
        share("n_symbols", "word_chars").alias("x2"), share("n_dup_lines", "n_lines").alias("x3"), share("n_repeat_words", "n_words").alias("x4"),
    )


def attach(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Join a table with one row per group: broadcast if it is small, else by a shuffle that splits hot keys."""
    return rows.join(F.broadcast(side) if small(side, BROADCAST_GROUPS) else side, key)


def grouped(stats: DataFrame, least_rows: int) -> DataFrame:
    """Add ``group``: language and source, or a pool of small groups."""
    fine = F.to_json(F.struct("lang", "source"))
    sizes = stats.where("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("_fine", F.to_json(F.struct("lang", "source"))).withColumn("_small", F.col("n") < least_rows)
    pool = F.sum(F.when(F.col("_small"), F.col("n"))).over(Window.partitionBy("lang"))
    by_lang = F.to_json(F.struct(F.lit("pool").alias("pool"), "lang"))
    name = F.when(~F.col("_small"), F.col("_fine")).when(pool >= least_rows, by_lang).otherwise(F.lit("rest"))
    sizes = stage(sizes.select("_fine", name.alias("group")), "groups")
    side = F.broadcast(sizes) if small(sizes, BROADCAST_GROUPS) else sizes
    return stats.withColumn("_fine", fine).join(side, "_fine", "left").drop("_fine")


def distance(x: list[Column], prefix: str = "") -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor ``l_ij``."""

    def solve(i: int, z: list[Column], total: Column) -> Column:
        if i == SIZE:
            return total
        value = x[i] - F.col(f"{prefix}m_{i}")
        for j in range(i):
            value = value - F.col(f"{prefix}l_{i}_{j}") * z[j]
        return let(value / F.col(f"{prefix}l_{i}_{i}"), lambda v: solve(i + 1, [*z, v], total + v * v))

    return solve(0, [], F.lit(0.0))


def factors(sums: DataFrame, n: Column, keys: list[str]) -> DataFrame:
    """Means ``m_i``, Cholesky factor ``l_ij`` and log determinant from sums ``s_i`` and products ``p_ij``."""
    floors = list(STATISTICS.values())
    df = sums.select(*keys, n.alias("_n"), *[F.col(c) for c in sums.columns if c[:2] in ("s_", "p_")])
    df = df.withColumns({f"m_{i}": F.col(f"s_{i}") / F.col("_n") for i in range(SIZE)})
    for i in range(SIZE):
        for j in range(i + 1):
            value = F.col(f"p_{j}_{i}") / F.col("_n") - F.col(f"m_{i}") * F.col(f"m_{j}")
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(0.0)) + floors[i] ** 2)
            else:
                value = value / F.col(f"l_{j}_{j}")
            df = df.withColumn(f"l_{i}_{j}", value)
    det = sum((F.log(F.col(f"l_{i}_{i}")) for i in range(SIZE)), F.lit(0.0))
    return df.select(*keys, F.col("_n").alias("n"), *[f"m_{i}" for i in range(SIZE)], *[f"l_{i}_{j}" for i in range(SIZE) for j in range(i + 1)], det.alias("det"))


def totals() -> list[Column]:
    x = [F.col(c) for c in STATISTICS]
    return [
        F.count("*").alias("n"),
        *[F.sum(x[i]).alias(f"s_{i}") for i in range(SIZE)],
        *[F.sum(x[i] * x[j]).alias(f"p_{i}_{j}") for i in range(SIZE) for j in range(i, SIZE)],
    ]


def estimates(vectors: DataFrame, least_rows: int, steps: int = STEPS) -> DataFrame:
    """Minimum covariance determinant of every group: ``group, m_i, l_ij, scale``.

    ``scale`` makes the subset's largest distance that quantile of the chi-squared distribution.
    """
    rows = vectors.select("group", *STATISTICS)
    sums = rows.groupBy("group").agg(*totals())
    wide = factors(sums, F.col("n"), ["group"]).withColumn("start", F.lit(1))
    names = list(STATISTICS)
    middle = rows.groupBy("group").agg(F.count("*").alias("n"), *[F.percentile_approx(c, 0.5).alias(f"m_{i}") for i, c in enumerate(names)])
    middle = stage(middle, "medians")
    spread = attach(rows, middle, "group").groupBy("group").agg(
        *[F.percentile_approx(F.abs(F.col(c) - F.col(f"m_{i}")), 0.5).alias(f"d_{i}") for i, c in enumerate(names)]
    )
    diagonal = {f"l_{i}_{j}": F.sqrt((1.4826 * F.col(f"d_{i}")) ** 2 + f**2) if i == j else F.lit(0.0) for i, f in enumerate(STATISTICS.values()) for j in range(i + 1)}
    robust = middle.join(spread, "group").withColumns(diagonal).withColumn("det", F.lit(0.0)).withColumn("start", F.lit(0))
    current = stage(robust.select(wide.columns).unionByName(wide).where(F.col("n") >= least_rows), "estimates")
    bin_of = F.floor(F.log2(1 + distance([F.col(c) for c in names])) * BINS)
    by = Window.partitionBy("group", "start")
    for _ in range(steps):
        near = attach(rows, current.drop("n"), "group").withColumn("bin", bin_of)
        binned = near.groupBy("group", "start", "bin").agg(*totals())
        before = F.coalesce(F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        binned = binned.withColumn("_all", F.sum("n").over(by)).withColumn("_before", before).where(F.col("_before") < KEPT * F.col("_all"))
        keep = binned.groupBy("group", "start").agg(F.first("_all").alias("_all"), *[F.sum(c).alias(c) for c in binned.columns if c == "n" or c[:2] in ("s_", "p_")])
        current = stage(factors(keep, F.col("n"), ["group", "start"]), "estimates")
    best = current.withColumn("_nth", F.row_number().over(Window.partitionBy("group").orderBy("det", "start"))).where("_nth = 1").drop("_nth", "n")
    best = stage(best, "estimates")
    near = attach(rows, best, "group").withColumn("bin", bin_of).groupBy("group", "bin").agg(F.count("*").alias("n"))
    every = Window.partitionBy("group")
    upto = F.sum("n").over(every.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("_all", F.sum("n").over(every)).withColumn("_upto", upto).where(F.col("_upto") >= KEPT * F.col("_all"))
    edge = near.groupBy("group").agg(F.min("bin").alias("bin"))
    scale = F.greatest(F.lit(1.0), (F.pow(F.lit(2.0), (F.col("bin") + 1) / BINS) - 1) / KEPT_QUANTILE)
    return stage(best.join(edge.select("group", scale.alias("scale")), "group"), "estimates")


def judge(docs: DataFrame, least_rows: int = 100, cutoff: float = CUTOFF, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts of every text, ``base_failed``, its ``distance`` (null without an estimate) and ``kept``."""
    stats = stage(grouped(stage(statistics(docs, doc_id, text, lang, source), "statistics"), least_rows), "vectors")
    found = estimates(stats.where("not base_failed"), least_rows).drop("det", "start")
    side = F.broadcast(found) if small(found, BROADCAST_GROUPS) else found
    far = distance([F.col(c) for c in STATISTICS]) / F.col("scale")
    rows = stats.join(side, "group", "left").withColumn("distance", F.when(F.col("scale").isNotNull(), far))
    kept = ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= cutoff))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance", *STATISTICS)

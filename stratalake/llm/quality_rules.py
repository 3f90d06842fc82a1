"""Quality rules: plain limits, then robust multivariate outliers per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.sources import stage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5

# The transformed statistics, and the smallest standard deviation assumed of each.
SPREAD = {"v_length": 0.35, "v_symbols": 0.06, "v_upper": 0.06, "v_lines": 0.1, "v_repeats": 0.08}
# The 0.99999 and 0.5 quantiles of chi-square with five degrees of freedom.
LIMIT, MIDDLE = 30.86, 4.351


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, also where a lambda inside reads it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated_words(hashes: Column) -> Column:
    """Words inside 5-word windows that occur twice or more."""

    def windows(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0)))
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))

    def covered(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def starts(order: Column) -> Column:
            again = F.filter(
                order,
                lambda x, j: (x["g"] == F.get(order, j - 1)["g"]) | (x["g"] == F.get(order, j + 1)["g"]),
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        def reach(s: Column) -> Column:
            new = F.transform(
                s, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - i, F.lit(WINDOW)))
            )
            return F.aggregate(new, F.lit(0), lambda a, b: a + b)

        return _with(_with(placed, starts), reach)

    def count(grams: Column) -> Column:
        # Most texts repeat no window; only the others are sorted.
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(covered(grams))

    return F.when(F.size(hashes) <= WINDOW, 0).otherwise(_with(hashes, lambda h: _with(windows(h), count)))


def text_statistics(documents: DataFrame) -> DataFrame:
    """Counts of every whole text, one row per document; all 0 for null and empty texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    def per_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _repeated_words(F.transform(w, lambda x: F.xxhash64(x))).cast("bigint").alias("n_repeat_words"),
        )

    def per_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("bigint").alias("n_dup_lines"),
        )

    return documents.select(
        "doc_id",
        "lang",
        "source",
        _with(words, per_words).alias("w"),
        _with(lines, per_lines).alias("l"),
        F.size(F.regexp_extract_all(text, F.lit(f"({SYMBOL})"), 1)).cast("bigint").alias("n_symbols"),
        F.size(F.regexp_extract_all(text, F.lit(r"(\p{Lu})"), 1)).cast("bigint").alias("n_upper"),
    ).select("doc_id", "lang", "source", "w.*", "l.*", "n_symbols", "n_upper")


def _transformed() -> dict[str, Column]:
    """Means and shares, drawn towards the ordinary for short texts."""
    words = F.col("n_words").cast("double")
    return {
        "v_length": (F.col("word_chars") + 250) / (words + 50),
        "v_symbols": F.col("n_symbols") / (F.col("n_symbols") + words + 10),
        "v_upper": F.col("n_upper") / (F.col("word_chars") + 40),
        "v_lines": F.col("n_dup_lines") / (F.col("n_lines") + 5),
        "v_repeats": F.col("n_repeat_words") / (words + 10),
    }


NAMES = tuple(SPREAD)
_PAIRS = [(a, b) for a in range(len(NAMES)) for b in range(a + 1)]


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Mean, Cholesky factor and determinant of each group's covariance, the least spread added to it."""
    values = [F.col(n) for n in NAMES]
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(v).alias(f"m{a}") for a, v in enumerate(values)),
        *(F.avg(values[a] * values[b]).alias(f"q{a}{b}") for a, b in _PAIRS),
    )
    made: DataFrame = sums
    for a, b in _PAIRS:  # row by row; a column may use those before it
        spread = SPREAD[NAMES[a]] ** 2 if a == b else 0.0
        left = F.col(f"q{a}{b}") - F.col(f"m{a}") * F.col(f"m{b}") + spread
        for k in range(b):
            left = left - F.col(f"l{a}{k}") * F.col(f"l{b}{k}")
        factor = F.sqrt(F.greatest(left, F.lit(1e-12))) if a == b else left / F.col(f"l{b}{b}")
        made = made.withColumn(f"l{a}{b}", F.round(factor, 9))
    log_size = sum((F.log(F.col(f"l{a}{a}")) for a in range(len(NAMES))), F.lit(0.0))
    return made.select(
        *by, "n", *(f"m{a}" for a in range(len(NAMES))), *(f"l{a}{b}" for a, b in _PAIRS), log_size.alias("log_size")
    )


def _distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance by the estimate joined to each row."""
    total = F.lit(0.0)
    for a in range(len(NAMES)):
        left = F.col(NAMES[a]) - F.col(f"m{a}")
        for k in range(a):
            left = left - F.col(f"l{a}{k}") * F.col(f"z{k}")
        rows = rows.withColumn(f"z{a}", left / F.col(f"l{a}{a}"))
        total = total + F.col(f"z{a}") * F.col(f"z{a}")
    return rows.withColumn("d2", total)


def _bin(d2: Column) -> Column:
    """Steps of 1/32 of a doubling, so that counts per step give any quantile."""
    return F.floor(F.log2(d2 + 1e-6) * 32).cast("int")


def _nearest(rows: DataFrame, by: list[str], share: float) -> DataFrame:
    """The least step that holds ``share`` of each group's rows: a window over counts, not rows."""
    counts = rows.groupBy(*by, _bin(F.col("d2")).alias("step")).agg(F.count(F.lit(1)).alias("rows"))
    up_to = Window.partitionBy(*by).orderBy("step")
    reached = counts.select(
        *by,
        "step",
        F.sum("rows").over(up_to).alias("reached"),
        F.sum("rows").over(Window.partitionBy(*by)).alias("all_rows"),
    )
    return reached.filter(F.col("reached") >= share * F.col("all_rows")).groupBy(*by).agg(F.min("step").alias("limit_step"))


def robust_estimates(values: DataFrame, share: float = 0.75, steps: int = 4) -> DataFrame:
    """Minimum covariance determinant estimates of each ``grp``, by concentration steps.

    Two starts, the classical estimate and one around the medians, each followed
    by ``steps`` rounds that estimate anew from the ``share`` of rows nearest to
    the last estimate; per group the smaller determinant is taken. A round is two
    aggregations with partial sums per task, so a group's share of the rows does
    not matter. Written estimates keep each round's plan short.
    """
    medians = values.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.percentile_approx(n, 0.5, 1000).alias(f"m{a}") for a, n in enumerate(NAMES)),
    )
    around = medians.select(
        "grp",
        F.lit(1).alias("start"),
        "n",
        *(f"m{a}" for a in range(len(NAMES))),
        *(F.lit(SPREAD[NAMES[a]] if a == b else 0.0).alias(f"l{a}{b}") for a, b in _PAIRS),
        F.lit(0.0).alias("log_size"),
    )
    classical = _moments(values.withColumn("start", F.lit(0)), ["grp", "start"])
    estimates = stage(classical.unionByName(around), "mcd-start")
    for _ in range(steps):
        near = _distance(values.join(estimates, "grp"))
        limits = stage(_nearest(near, ["grp", "start"], share), "mcd-limits")
        inside = near.join(limits, ["grp", "start"]).filter(_bin(F.col("d2")) <= F.col("limit_step"))
        estimates = stage(
            _moments(inside.select("grp", "start", *NAMES), ["grp", "start"]), "mcd-step"
        )
    best = estimates.groupBy("grp").agg(F.min_by("start", F.struct("log_size", "start")).alias("start"))
    estimates = stage(estimates.join(best, ["grp", "start"]).drop("start"), "mcd-best")
    # Half of all rows shall lie within the median distance of a normal distribution, or more do.
    middle = _nearest(_distance(values.join(estimates, "grp")), ["grp"], 0.5)
    scale = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("limit_step") + 1) / 32) / MIDDLE)
    return stage(estimates.join(middle.select("grp", scale.alias("scale")), "grp"), "mcd")


def quality_rules(documents: DataFrame, min_group: int = 40) -> DataFrame:
    """Counts of every document, whether it fails the plain limits, and whether it is kept.

    Plain limits: fewer than 10 words, or over a fifth of the words inside
    repeated 5-word windows. The rest are compared with the robust mean and
    covariance of their language and source: kept up to a squared Mahalanobis
    distance of the 0.99999 quantile. Languages' sources with fewer than
    ``min_group`` such documents are compared with their whole language, large
    sources included, and languages with fewer with all documents, however few.

    Null languages and sources are values of their own. Null and empty texts have
    no words and fail. Repeated rows count as often as they occur; an empty table
    gives no rows; other columns are not looked at.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance (null where the plain limits fail), kept.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = stage(
        text_statistics(documents).withColumns(
            {
                "base_failed": failed,
                **_transformed(),
                "own_grp": F.xxhash64(F.lit("own"), F.col("lang").isNull(), "lang", F.col("source").isNull(), "source"),
                "pool_grp": F.xxhash64(F.lit("pool"), F.col("lang").isNull(), "lang"),
            }
        ),
        "quality-counts",
    )
    compared = counted.filter(~F.col("base_failed"))
    sizes = stage(compared.groupBy("own_grp", "pool_grp").agg(F.count(F.lit(1)).alias("rows")), "quality-sizes")
    languages = sizes.groupBy("pool_grp").agg(F.sum("rows").alias("pool_rows"), F.min("rows").alias("least_rows"))
    own, pooled = F.col("rows") >= min_group, F.col("pool_rows") >= min_group
    everything = F.xxhash64(F.lit("all"))
    # A language or all documents are estimated only where a smaller group looks to them.
    of_language = F.when(pooled & (F.col("least_rows") < min_group), F.col("pool_grp"))
    some_tiny = not languages.filter(~pooled).isEmpty()
    member = F.array(F.when(own, F.col("own_grp")), of_language, everything if some_tiny else F.lit(None).cast("long"))
    assigned = stage(
        sizes.join(languages, "pool_grp").select(
            "own_grp",
            F.when(own, F.col("own_grp")).when(pooled, F.col("pool_grp")).otherwise(everything).alias("grp"),
            F.array_compact(member).alias("member_of"),
        ),
        "quality-groups",
    )
    values = stage(
        compared.join(assigned, "own_grp").select(F.explode("member_of").alias("grp"), *NAMES), "quality-values"
    )
    estimates = robust_estimates(values)
    judged = _distance(counted.join(assigned.drop("member_of"), "own_grp", "left").join(estimates.drop("n"), "grp", "left"))
    distance = F.when(~F.col("base_failed"), F.col("d2") / F.col("scale"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & (distance <= LIMIT)).alias("kept"),
    )

"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

`statistics` counts, in one pass over the whole texts and with built-in functions only. `robust`
estimates location and scatter of a transformed statistic vector for every (language, source) by the
minimum covariance determinant: concentration steps that keep the half of the rows with the smallest
Mahalanobis distances. `quality_rules` rejects documents that break a base rule or lie beyond the cutoff.

At scale: a concentration step is one scan of the stored statistics and one aggregation with a map-side
part, keyed by (language, source, bucket of the distance) and carrying moment sums, so no group is
gathered anywhere, however large. Few groups' parameters are joined back under the planner's size limit.

Cases: a null text has no words and fails the base rules; null languages and sources are groups of their
own; repeated rows are judged one by one and alike; groups of few rows lean on their language's estimate;
an empty table gives an empty result. Repeats are found by 64-bit hashes of the five words.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.shared import packed, store, table, whole_text, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
DIMENSIONS = 4
#: Least standard deviation of each vector component: most texts have no symbol and no repeat at all,
#: and a variance of zero would make every other text an outlier.
FLOORS = (0.05, 0.05, 0.05, 0.10)
#: Rows of its language's estimate that are mixed into each group's estimate.
PRIOR_ROWS = 50
PRIOR_WORDS = 50
#: The 0.9995 quantile of chi-squared with as many degrees of freedom as components.
CUTOFF = 20.0
STEPS = 3
CHI2_MEDIAN = 3.3567
GROUP = ["g_lang", "g_source"]


def statistics(rows: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """Counts of each text beside the columns `keep`.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, base_failed.
    """
    blank = F.regexp_replace("q_text", r"[\x20\x09-\x0D]+", "")
    step = rows.select(*keep, text.alias("q_text")).select(
        *keep,
        "q_text",
        words(F.col("q_text")).alias("q_words"),
        F.filter(F.split("q_text", "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\x0b\x0c\r", "    "))) > 0).alias("q_lines"),
        F.length(blank).cast("bigint").alias("word_chars"),
        (F.length("q_text") - F.length(F.translate("q_text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.length("q_text") - F.length(F.regexp_replace("q_text", r"\p{Lu}+", ""))).cast("bigint").alias("n_upper"),
    )
    counted = ["n_words", "word_chars", "n_symbols", "n_upper", "n_dup_lines"]
    step = step.select(
        *keep,
        F.size("q_words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_upper",
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("q_words", lambda w: F.xxhash64(w)).alias("q_hashes"),
    )
    step = step.select(
        *keep,
        *counted,
        F.transform(
            F.slice("q_hashes", F.lit(1), F.greatest(F.size("q_hashes") - (WINDOW - 1), F.lit(0))),
            lambda h, i: F.xxhash64(h, *[F.get("q_hashes", i + k) for k in range(1, WINDOW)]),
        ).alias("q_windows"),
    )
    # Only texts with a repeated window pay for the sort.
    step = step.select(
        *keep,
        *counted,
        F.when(
            F.size(F.array_distinct("q_windows")) < F.size("q_windows"),
            F.array_sort(F.transform("q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("q_sorted"),
    )
    same = lambda s, k: F.get("q_sorted", k)["h"] == s["h"]
    step = step.select(
        *keep,
        *counted,
        F.array_sort(
            F.filter(
                F.transform(
                    "q_sorted",
                    lambda s, k: F.when(F.coalesce(same(s, k - 1), F.lit(False)) | F.coalesce(same(s, k + 1), F.lit(False)), s["i"]),
                ),
                lambda i: i.isNotNull(),
            )
        ).alias("q_starts"),
    )
    covered = F.aggregate(
        F.transform("q_starts", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("q_starts", k + 1) - i, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    step = step.select(*keep, *counted, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))
    return step.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def vector() -> list[Column]:
    """The transformed statistics: log mean word length, and roots of the symbol, capital and repeat shares.

    Shares are of the text and a fixed number of plain words, so that very short texts vary no more than long ones.
    """
    chars, n = F.col("word_chars"), F.col("n_words")
    share = lambda a, b: F.sqrt(a / (b + F.lit(float(PRIOR_WORDS))))
    return [
        F.log((chars + F.lit(6.0 * PRIOR_WORDS)) / (n + F.lit(float(PRIOR_WORDS)))).alias("x0"),
        share(F.col("n_symbols"), chars).alias("x1"),
        share(F.col("n_upper"), chars).alias("x2"),
        share(F.col("n_repeat_words"), n).alias("x3"),
    ]


X = [f"x{i}" for i in range(DIMENSIONS)]
PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]
MOMENTS = ["n", *[f"s{i}" for i in range(DIMENSIONS)], *[f"s{i}_{j}" for i, j in PAIRS]]


def first_parameters(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges of each group: the start of the concentration steps."""
    quartiles = rows.groupBy(*GROUP).agg(*[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(x) for x in X])
    spread = lambda i: (F.get(X[i], 2) - F.get(X[i], 0)) / 1.349 + FLOORS[i]
    return quartiles.select(
        *GROUP,
        *[F.get(X[i], 1).alias(f"m{i}") for i in range(DIMENSIONS)],
        *[((1 / spread(i)) if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i, j in PAIRS],
    )


def distances(rows: DataFrame, parameters: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance `d2` by the group's mean and inverse Cholesky factor; null without a group."""
    joined = rows.join(parameters, GROUP, "left")
    parts = [
        sum((F.col(f"l{i}_{j}") * (F.col(X[j]) - F.col(f"m{j}")) for j in range(1, i + 1)), F.col(f"l{i}_0") * (F.col("x0") - F.col("m0")))
        for i in range(DIMENSIONS)
    ]
    total = sum((p * p for p in parts[1:]), parts[0] * parts[0])
    return joined.withColumn("d2", total).drop(*[c for c in parameters.columns if c not in GROUP])


def by_bucket(rows: DataFrame) -> DataFrame:
    """Moment sums by group and bucket of the distance; eight buckets for each doubling."""
    bucket = F.least(F.floor(8 * F.log2(F.col("d2") + F.lit(2.0**-10))), F.lit(400)).alias("bucket")
    return rows.groupBy(*GROUP, bucket).agg(
        F.count("*").alias("n"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
        *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i, j in PAIRS],
    )


def concentrated(buckets: DataFrame) -> DataFrame:
    """Moment sums of the nearest half of each group, whole buckets."""
    group = Window.partitionBy(*GROUP)
    before = F.sum("n").over(group.orderBy("bucket")) - F.col("n")
    half = (F.sum("n").over(group) + DIMENSIONS + 2) / 2
    inside = buckets.withColumn("before", before).withColumn("half", half).where("before < half")
    return inside.groupBy(*GROUP).agg(*[F.sum(m).alias(m) for m in MOMENTS])


def parameters_of(moments: DataFrame) -> DataFrame:
    """Means and inverse Cholesky factors; each group's moments with PRIOR_ROWS average rows of its language."""
    language = Window.partitionBy("g_lang")
    mixed = moments.select(*GROUP, *[(F.col(m) + PRIOR_ROWS * F.sum(m).over(language) / F.sum("n").over(language)).alias(m) for m in MOMENTS])
    mixed = mixed.select(
        *GROUP,
        *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(DIMENSIONS)],
        *[
            (F.greatest(F.col(f"s{i}_{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / (F.col("n") * F.col("n")), F.lit(0.0)) + FLOORS[i] ** 2
             if i == j else F.col(f"s{i}_{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / (F.col("n") * F.col("n"))).alias(f"c{i}_{j}")
            for i, j in PAIRS
        ],
    )
    for j in range(DIMENSIONS):  # Cholesky, column by column
        inner = sum((F.col(f"k{j}_{t}") ** 2 for t in range(j)), F.lit(0.0))
        mixed = mixed.withColumn(f"k{j}_{j}", F.sqrt(F.greatest(F.col(f"c{j}_{j}") - inner, F.lit(1e-6))))
        for i in range(j + 1, DIMENSIONS):
            inner = sum((F.col(f"k{i}_{t}") * F.col(f"k{j}_{t}") for t in range(j)), F.lit(0.0))
            mixed = mixed.withColumn(f"k{i}_{j}", (F.col(f"c{i}_{j}") - inner) / F.col(f"k{j}_{j}"))
    for j in range(DIMENSIONS):  # and its inverse
        mixed = mixed.withColumn(f"l{j}_{j}", 1 / F.col(f"k{j}_{j}"))
        for i in range(j + 1, DIMENSIONS):
            inner = sum((F.col(f"k{i}_{t}") * F.col(f"l{t}_{j}") for t in range(j, i)), F.lit(0.0))
            mixed = mixed.withColumn(f"l{i}_{j}", -inner / F.col(f"k{i}_{i}"))
    return mixed.select(*GROUP, *[f"m{i}" for i in range(DIMENSIONS)], *[f"l{i}_{j}" for i, j in PAIRS])


def scales(buckets: DataFrame) -> DataFrame:
    """By language: how far the median squared distance lies above that of a normal sample, 1 at least."""
    counts = buckets.groupBy("g_lang", "bucket").agg(F.sum("n").alias("n"))
    language = Window.partitionBy("g_lang")
    ranked = counts.withColumn("upto", F.sum("n").over(language.orderBy("bucket"))).withColumn("total", F.sum("n").over(language))
    median = ranked.where("2 * upto >= total").groupBy("g_lang").agg(F.min("bucket").alias("bucket"))
    return median.select("g_lang", F.greatest(F.pow(F.lit(2.0), (F.col("bucket") + 1) / 8.0) / CHI2_MEDIAN, F.lit(1.0)).alias("scale"))


def robust(rows: DataFrame) -> DataFrame:
    """Parameters of every group, with the scale of its language."""
    usable = rows.where(~F.col("base_failed")).select(*GROUP, *X)
    parameters = store(first_parameters(usable), "quality-start")
    for _ in range(STEPS):
        buckets = store(by_bucket(distances(usable, parameters)), "quality-buckets")
        parameters = store(parameters_of(concentrated(buckets)), "quality-step")
    scale = scales(store(by_bucket(distances(usable, parameters)), "quality-buckets"))
    return store(parameters.join(scale, "g_lang", "left"), "quality-model")


def group_key(column: str) -> Column:
    """Never null: null and empty values stay apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def quality_rules(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """`row` (all columns of a document, or those in `carry`), its counts, `base_failed`, `distance` and `kept`."""
    row = packed(docs if carry is None else docs.select(*carry))
    rows = docs.select(row, whole_text().alias("q_text"), group_key("lang").alias("g_lang"), group_key("source").alias("g_source"))
    rows = statistics(rows, F.col("q_text"), ["row", *GROUP])
    rows = store(rows.select("*", *vector()), "quality-rows")
    model = robust(rows)
    scale = model.select(*GROUP, "scale")
    judged = distances(rows.join(scale, GROUP, "left"), model.drop("scale"))
    distance = F.col("d2") / F.col("scale")
    return judged.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & F.coalesce(distance <= CUTOFF, F.lit(True))).alias("kept"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), *[c for c in judged.columns if c != "row"])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that pass."""
    return quality_rules(docs).where("kept").select("row.*")

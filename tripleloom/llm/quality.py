"""Quality rules: base limits, then robust multivariate outliers per language and source.

Everything is DataFrame and SQL functions. Each (lang, source) gets a minimum-covariance-determinant
estimate of centre and scatter of the transformed statistics. Four starts are taken from medians
and median absolute deviations: these alone, the correlations of bounded scores (tanh) and of spatial
signs, and the half of rows nearest to the medians. Concentration steps refit mean and covariance
on the fraction of rows with the smallest distances; after FIRST_STEPS of them the two starts of the
least determinant go on until it falls no more, and the lesser one is taken. Steps are aggregations
by group and start over all rows, combined map-side, so a group may hold any share of rows.
Groups of few rows are judged by the estimate of their language, or of all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEATURES = ["f_words", "f_length", "f_symbols", "f_lines", "f_repeats"]
#: Spread of the length of words, as a share of their mean.
WORD_SPREAD = 0.5
#: Groups of estimates: by language and source, by language (level 1), of all rows (level 2).
KEY = ["level", "lang", "source"]
#: Entries of a scatter matrix, the lower half.
PAIRS = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[: i + 1]]
#: Rows that a group needs for an estimate of its own, and the fraction that estimates rest on.
LEAST_ROWS, KEPT_SHARE = 40, 0.75
#: Concentration steps of all starts; further ones of the two best at most, and the fall of the log determinant that ends them.
FIRST_STEPS, MOST_STEPS, FALL = 2, 30, 1e-4
#: Quantile 0.99999 of chi-square with 1 to 5 degrees of freedom, and its median.
CUTOFFS, MEDIANS = [19.511, 23.026, 25.902, 28.473, 30.856], [0.455, 1.386, 2.366, 3.357, 4.351]


def let(value: Column, use) -> Column:
    """use(value), with value computed once even where ``use`` reads it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _repeats(words: Column) -> Column:
    """Words in windows of eight that are found twice or more in the text."""
    count = F.size(words) - WINDOW + 1
    names = lambda w: F.transform(w, lambda x: F.xxhash64(x))
    window = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
    numbered = lambda w: F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    twin = lambda s, e, k: (F.get(s, k - 1).x == e.x) | (F.get(s, k + 1).x == e.x)
    again = lambda s: F.array_sort(F.transform(F.filter(s, lambda e, k: F.coalesce(twin(s, e, k), F.get(s, F.when(k > 0, k - 1).otherwise(k + 1)).x == e.x, F.lit(False))), lambda e: e.i))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total"))
    add = lambda s, i: F.struct((i + WINDOW).alias("end"), (s.total + F.least(F.lit(WINDOW), i + WINDOW - s.end)).cast("bigint").alias("total"))
    covered = lambda w: let(numbered(w), lambda s: F.aggregate(again(s), start, add).total)
    of = lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(covered(w))
    return F.when(count < 2, F.lit(0).cast("bigint")).otherwise(let(names(words), lambda h: let(window(h), of)))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    pair = let(split, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeats(w).alias("n_repeat_words")))
    rows = docs.select(
        "doc_id",
        "lang",
        "source",
        pair.alias("words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("doc_id", "lang", "source", "words.n_words", "word_chars", "n_symbols", "n_dup_lines", "words.n_repeat_words").withColumn("base_failed", failed)


def _transformed(stats: DataFrame) -> DataFrame:
    """The statistics on scales on which they are roughly symmetric and don't grow with the text."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return stats.withColumns(
        {
            "f_words": F.log1p("n_words"),
            "f_length": F.log(chars / words),
            "f_symbols": F.sqrt(F.col("n_symbols") / chars),
            "f_lines": F.log1p("n_dup_lines"),
            "f_repeats": F.sqrt(F.col("n_repeat_words") / words),
        }
    )


def _with(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with the columns of their group of a level; null keys are a group of their own."""
    g = groups.withColumnsRenamed({k: f"__{k}" for k in KEY})
    return rows.join(g, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEY])).drop(*[f"__{k}" for k in KEY])


def _resolution(words: Column, length: Column) -> dict[str, Column]:
    """What one unit of measurement makes of each feature in a text of ``words`` words of mean log length ``length``.

    Twice the words; the sampling error of the mean length; one symbol; one repeated line; one repeated window.
    """
    n = F.greatest(words, F.lit(1.0))
    return {"f_words": F.log(F.lit(2.0)), "f_length": WORD_SPREAD / F.sqrt(n), "f_symbols": 1 / F.sqrt(F.greatest(n * F.exp(length), F.lit(1.0))), "f_lines": F.log(F.lit(2.0)), "f_repeats": F.sqrt(WINDOW / n)}


def _factor(scatter: DataFrame) -> DataFrame:
    """Centre m_i, inverse-ready Cholesky factor l_i_j of the scatter, and its effective degrees of freedom.

    Conditional deviations are held above the resolution of measurement at the group's centre; a
    feature that varies less than that counts as the share of a degree that its variance is of it.
    """
    least = _resolution(F.expm1("m_f_words"), F.col("m_f_length"))
    dof = sum((F.least(F.lit(1.0), F.col(f"c_{a}_{a}") / (least[a] * least[a])) for a in FEATURES), F.lit(0.0))
    out = scatter.withColumn("dof", dof)
    for i, a in enumerate(FEATURES):
        for j, b in enumerate(FEATURES[: i + 1]):
            inner = reduce(lambda s, k: s - F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}"), FEATURES[:j], F.col(f"c_{a}_{b}"))
            value = F.sqrt(F.greatest(inner, least[a] * least[a])) if i == j else inner / F.col(f"l_{b}_{b}")
            out = out.withColumn(f"l_{a}_{b}", value)
    keep = [f"m_{a}" for a in FEATURES] + [f"l_{a}_{b}" for a, b in PAIRS]
    logdet = 2 * sum((F.log(F.col(f"l_{a}_{a}")) for a in FEATURES), F.lit(0.0))
    return out.select(*KEY, "start", *keep, "dof", logdet.alias("logdet"))


def _squared(wide: DataFrame) -> DataFrame:
    """wide with ``d``, the squared Mahalanobis distance, by forward substitution; no deviation is below the row's own resolution."""
    own = _resolution(F.expm1("f_words"), F.col("f_length"))
    own["f_symbols"] = own["f_symbols"] / 2  # the square root of a count deviates by a half
    out = wide
    for i, a in enumerate(FEATURES):
        inner = reduce(lambda s, b: s - F.col(f"l_{a}_{b}") * F.col(f"y_{b}"), FEATURES[:i], F.col(a) - F.col(f"m_{a}"))
        out = out.withColumn(f"y_{a}", inner / F.greatest(F.col(f"l_{a}_{a}"), own[a]))
    return out.withColumn("d", sum((F.col(f"y_{a}") * F.col(f"y_{a}") for a in FEATURES), F.lit(0.0)))


def _distances(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """rows with their squared distance ``d`` for every start."""
    return _squared(_with(rows, fit)).select(*rows.columns, "start", "d")


def _by_dof(values: list[float]) -> Column:
    """The value for the degrees of freedom, 1 at least, linear between whole ones."""
    dof = F.greatest(F.lit(1.0), F.least(F.col("dof"), F.lit(float(len(values)))))
    low = F.floor(dof).cast("int")
    at = lambda i: F.get(F.array(*map(F.lit, values)), i)
    return at(low - 1) + (dof - low) * (F.coalesce(at(low), at(low - 1)) - at(low - 1))


def _quantile(column, share: float) -> Column:
    return F.percentile_approx(column, F.lit(share), F.lit(10000))


def _pooled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows with those that stand for small groups, and (lang, source, __level, __key_lang, __key_source).

    A group of under LEAST_ROWS rows is judged by the estimate of its language (level 1), and if that
    has as few, of all rows (level 2); the rows of a level are added once, under keys of their own.
    """
    n = stage(rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "sizes")
    langs = n.groupBy(F.col("lang").alias("__l")).agg(F.sum("n").alias("of_lang"))
    sized = n.join(langs, F.col("lang").eqNullSafe(F.col("__l")))
    level = F.when(F.col("n") >= LEAST_ROWS, 0).when(F.col("of_lang") >= LEAST_ROWS, 1).otherwise(2)
    null = F.lit(None).cast("string")
    uses = stage(sized.select("lang", "source", level.alias("__level")), "uses").select("lang", "source", "__level", F.when(F.col("__level") < 2, F.col("lang")).otherwise(null).alias("__key_lang"), F.when(F.col("__level") < 1, F.col("source")).otherwise(null).alias("__key_source"))
    out = rows.withColumn("level", F.lit(0))
    needed = uses.filter("__level = 1").select(F.col("lang").alias("__l")).distinct()
    out = out.unionByName(rows.join(needed, F.col("lang").eqNullSafe(F.col("__l")), "left_semi").withColumns({"source": null, "level": F.lit(1)}))
    if not uses.filter("__level = 2").isEmpty():
        out = out.unionByName(rows.withColumns({"lang": null, "source": null, "level": F.lit(2)}))
    return stage(out, "levels"), uses


def _moments(prefix: str = "") -> list[Column]:
    return [F.avg(prefix + a).alias(f"m_{a}") for a in FEATURES] + [F.covar_pop(prefix + a, prefix + b).alias(f"c_{a}_{b}") for a, b in PAIRS]


def _starts(rows: DataFrame) -> DataFrame:
    """Centre and scatter of the four starts of every group that gets an estimate."""
    enough = (F.col("level") == 2) | (F.col("n") >= LEAST_ROWS)
    centre = stage(rows.groupBy(*KEY).agg(F.count("*").alias("n"), *[_quantile(a, 0.5).alias(f"m_{a}") for a in FEATURES]).filter(enough), "centre")
    spread = _with(rows, centre).groupBy(*KEY).agg(*[F.first(f"m_{a}").alias(f"m_{a}") for a in FEATURES], *[_quantile(F.abs(F.col(a) - F.col(f"m_{a}")), 0.5).alias(f"s_{a}") for a in FEATURES])
    least = _resolution(F.expm1("m_f_words"), F.col("m_f_length"))
    units = stage(spread.withColumns({f"u_{a}": F.greatest(1.4826 * F.col(f"s_{a}"), least[a]) for a in FEATURES}), "units")
    scored = _with(rows, units).withColumns({f"z_{a}": (F.col(a) - F.col(f"m_{a}")) / F.col(f"u_{a}") for a in FEATURES})
    scored = scored.withColumn("far", sum((F.col(f"z_{a}") * F.col(f"z_{a}") for a in FEATURES), F.lit(0.0)))
    signs = {f"g_{a}": F.when(F.col("far") > 0, F.col(f"z_{a}") / F.sqrt("far")).otherwise(0.0) for a in FEATURES}
    bounded = {f"t_{a}": F.tanh(f"z_{a}") for a in FEATURES}
    both = [F.avg(F.col(f"{x}_{a}") * F.col(f"{x}_{b}")).alias(f"{x}_{a}_{b}") for x in "tg" for a, b in PAIRS]
    sums = stage(scored.withColumns({**signs, **bounded}).groupBy(*KEY).agg(_quantile("far", 0.5).alias("edge"), *both), "scores")
    known = _with(units, sums)
    keep = [*KEY, *[F.col(f"m_{a}") for a in FEATURES]]

    def like(x: str, start: int) -> DataFrame:
        """Correlations of the scores x with the features' units."""
        made = []
        for a, b in PAIRS:
            root = F.sqrt(F.col(f"{x}_{a}_{a}") * F.col(f"{x}_{b}_{b}"))
            made.append((F.when(root > 0, F.col(f"{x}_{a}_{b}") / root).otherwise(0.0) * F.col(f"u_{a}") * F.col(f"u_{b}")).alias(f"c_{a}_{b}"))
        return known.select(*keep, F.lit(start).alias("start"), *made)

    alone = [(F.pow(1.4826 * F.col(f"s_{a}"), F.lit(2)) if a == b else F.lit(0.0)).alias(f"c_{a}_{b}") for a, b in PAIRS]
    near = _with(scored.select(*KEY, *FEATURES, "far"), sums.select(*KEY, "edge")).filter("far <= edge").groupBy(*KEY).agg(*_moments())
    return known.select(*keep, F.lit(0).alias("start"), *alone).unionByName(like("t", 1)).unionByName(like("g", 2)).unionByName(near.withColumn("start", F.lit(3)))


def _concentrated(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """The fit to the rows that are nearest by ``fit``, for every start."""
    far, by = _distances(rows, fit), [*KEY, "start"]
    edge = stage(far.groupBy(*by).agg(_quantile("d", KEPT_SHARE).alias("edge")), "edge")
    both = fit.join(edge.withColumnsRenamed({k: f"__{k}" for k in by}), reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by])).drop(*[f"__{k}" for k in by])
    near = _squared(_with(rows, both)).filter("d <= edge")
    return stage(_factor(near.groupBy(*by).agg(*_moments())), "fit")


def _least(fits: DataFrame, number: int) -> DataFrame:
    """The fits of the least determinant of every group; of equal ones the first start's."""
    place = F.row_number().over(W.partitionBy(*KEY).orderBy("logdet", "start"))
    return fits.withColumn("place", place).filter(F.col("place") <= number).drop("place")


def minimum_determinant(rows: DataFrame) -> DataFrame:
    """The fit of the least determinant of rows(level, lang, source, features), for groups of enough rows."""
    fit = stage(_factor(_starts(rows)), "fit")
    for _ in range(FIRST_STEPS):
        fit = _concentrated(rows, fit)
    live, ended = stage(_least(fit, 2), "fit"), []
    for _ in range(MOST_STEPS):
        old = live.select(*[F.col(k).alias(f"__{k}") for k in [*KEY, "start"]], F.col("logdet").alias("before"))
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in [*KEY, "start"]])
        moved = stage(_concentrated(rows, live).join(old, same).drop(*[f"__{k}" for k in [*KEY, "start"]]), "fit")
        falls = F.col("logdet") < F.col("before") - FALL
        ended.append(live)
        live = moved.filter(falls).drop("before")
        if live.isEmpty():
            break
    return stage(_least(reduce(DataFrame.unionByName, ended, live), 1).drop("start"), "fit")


def estimate(rows: DataFrame) -> DataFrame:
    """Centre, factor and consistency ``scale`` for every (lang, source): its own, its language's or that of all rows."""
    rows, uses = _pooled(rows)
    fit = minimum_determinant(rows)
    median = _distances(rows, fit.withColumn("start", F.lit(0))).groupBy(*KEY).agg(_quantile("d", 0.5).alias("median"))
    # where nothing varies beyond its resolution, the resolution is the scale
    scale = F.when((F.col("dof") >= 1) & (F.col("median") > 0), F.col("median") / _by_dof(MEDIANS)).otherwise(1.0)
    found = stage(_with(fit, median).withColumn("scale", scale).drop("median"), "estimate").withColumnsRenamed({"level": "__l", "lang": "__lang", "source": "__source"})
    same = (F.col("__level") == F.col("__l")) & F.col("__key_lang").eqNullSafe(F.col("__lang")) & F.col("__key_source").eqNullSafe(F.col("__source"))
    return uses.join(found, same).drop("__level", "__key_lang", "__key_source", "__l", "__lang", "__source")


def quality(docs: DataFrame, cutoff: float | None = None) -> DataFrame:
    """(doc_id, n_words, the four statistics, base_failed, kept) for every row of docs(doc_id, text, lang, source).

    Null and empty texts have no words and fail the base rules. Null languages and sources are
    groups of their own; a group of under LEAST_ROWS rows that pass the base rules is judged by the
    estimate of its language, and if that has as few, by that of all rows. Repeated rows count as often as they occur. Statistics that don't vary in
    a group are measured by their resolution; without ``cutoff`` the limit is the 0.99999 quantile for
    the group's effective degrees of freedom. An empty table gives an empty result; other columns are ignored.
    """
    stats = stage(statistics(docs), "stats")
    rows = _transformed(stats)
    fit = estimate(rows.filter(~F.col("base_failed")).select("lang", "source", *FEATURES))
    wide = fit.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    out = rows.join(wide, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    out = _squared(out)
    distance = F.col("d") / F.col("scale")
    limit = _by_dof(CUTOFFS) if cutoff is None else F.lit(cutoff)
    kept = ~F.col("base_failed") & (distance <= limit)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), distance.alias("distance"))

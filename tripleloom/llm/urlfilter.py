"""URL filter: host and path rules, else logistic regression on hashed character n-grams.

Everything is DataFrame and SQL functions. The training table is small and labelled; it becomes
one row of arrays, and gradient descent is a fold over the iterations in one expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Weights, n-gram sizes, iterations of gradient descent, its step and penalty.
BUCKETS, SIZES, ITERATIONS, STEP, PENALTY = 2048, (3, 4), 150, 4.0, 2e-4
#: Rows of the labelled table at most: they are held in one row.
MOST_LABELLED = 2000
#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

# fixed values: words of addresses in the labelled table, by subject
BLOCKED = """
casino poker roulette jackpot betting gambling lottery blackjack bookmaker wager baccarat bingo sportsbook
adult porn xxx escort erotic nude webcamgirls hentai fetish stripper hookups
viagra cialis pills steroids slimming painkiller tramadol
malware phishing warez keygen trojan spyware torrent cracked botnet exploitkit
spam adserver clickbait popunder adtracker bannerads doubleads leadgen spambot scam
payday fastcash replica counterfeit pyramid
""".split()
ALLOWED = """
news weather magazine journal gazette library museum archive
university school college science mathematics physics history geography
garden cooking recipes bakery travel hotel railway airport maps
music theatre cinema orchestra gallery painting poetry
football cycling athletics hiking health hospital dentist
council ministry parliament court police weatherstation
software developer compiler kernel forum wiki encyclopedia
family parish village harbour mountain river birdwatching
""".split()


#: Words that addresses of either kind are made longer with.
NEUTRAL = "online best my the hub world site shop top portal 24 click".split()


def labelled(spark: SparkSession) -> DataFrame:
    """(url, blocked): the small labelled table that the registered query is trained on, four addresses a word."""
    rows = []
    for words, blocked in ((BLOCKED, 1), (ALLOWED, 0)):
        for i, word in enumerate(words):
            other, (one, two) = words[(7 * i + 3) % len(words)], (NEUTRAL[(i + k) % len(NEUTRAL)] for k in (0, 5))
            dash, ends = ("-", "")[i % 2], ("com", "net", "org", "info")
            for k, host in enumerate((word, f"{one}{dash}{word}", f"{word}{dash}{two}", f"{word}{dash}{other}s")):
                rows.append((f"http{'s' * (k % 2)}://{'www.' * (k // 2)}{host}.{ends[(i + k) % 4]}/{one[: k + 1]}", blocked))
    return spark.createDataFrame(rows, "url string, blocked int")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of an address; both empty if it is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def grams(host: Column, path: Column) -> Column:
    """Buckets of the n-grams of host and path, digits alike; each bucket once."""
    text = F.translate(F.concat(F.lit("^"), host, F.lit("$"), path, F.lit(" ")), "123456789", "000000000")
    hashed = lambda c, n: lambda i: F.pmod(F.xxhash64(*[F.get(c, i + k) for k in range(n)]), F.lit(BUCKETS)).cast("int")
    cut = lambda c, n: F.when(F.size(c) >= n, F.transform(F.sequence(F.lit(0), F.size(c) - n), hashed(c, n))).otherwise(F.array().cast("array<int>"))
    # characters as an array: a substring of a long address would be looked for from its start each time
    return F.transform(F.array(F.split(text, "")), lambda c: F.array_distinct(F.concat(*[cut(c, n) for n in SIZES])))[0]


def _margin(x: Column, w: Column) -> Column:
    """Mean weight of the buckets of x, times the root of their number, and the bias, which is last."""
    total = F.aggregate(x, F.lit(0.0), lambda s, j: s + F.get(w, j))
    return total / F.sqrt(F.greatest(F.size(x), F.lit(1))) + F.get(w, F.lit(BUCKETS))


def train(table: DataFrame) -> list[float]:
    """Weights, and the bias last, from ``table(url, blocked)``; rows with a null are left out."""
    host, path = parts(F.col("url"))
    rows = table.filter("url is not null and blocked is not null").select(F.col("blocked").cast("double").alias("y"), grams(host, path).alias("x"))
    if rows.limit(MOST_LABELLED + 1).count() > MOST_LABELLED:
        raise ValueError(f"more than {MOST_LABELLED} labelled addresses")
    one = rows.agg(F.array_sort(F.collect_list(F.struct("x", "y"))).alias("rows"))
    # bound by a lambda, so that the arrays are made once and not inside the inner ones
    entry = lambda r, i: F.struct(i.alias("i"), (1 / F.sqrt(F.size(r.x))).alias("v"), r.x.alias("x"))
    having = lambda rows, j: F.transform(F.filter(rows, lambda r: F.array_contains(r.x, j)), lambda r: F.struct(r.i, r.v))
    lists = F.transform(F.array(F.transform("rows", entry)), lambda rows: F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda j: having(rows, j)))[0]
    held = F.struct(lists.alias("lists"), "rows")
    start = F.array_repeat(F.lit(0.0), BUCKETS + 1)

    def fold(data: Column) -> Column:
        count = F.greatest(F.size(data.rows), F.lit(1))

        def moved(w: Column, error: Column) -> Column:
            slope = lambda j: F.aggregate(F.get(data.lists, j), F.lit(0.0), lambda s, x: s + x.v * F.get(error, x.i))
            weights = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda j: F.get(w, j) * (1 - STEP * PENALTY) + STEP / count * slope(j))
            return F.concat(weights, F.array(F.get(w, F.lit(BUCKETS)) + STEP / count * F.aggregate(error, F.lit(0.0), lambda s, x: s + x)))

        def step(w: Column, _: Column) -> Column:
            error = F.transform(data.rows, lambda r: r.y - 1 / (1 + F.exp(-_margin(r.x, w))))
            return F.transform(F.array(error), lambda e: moved(w, e))[0]

        return F.aggregate(F.sequence(F.lit(1), F.lit(ITERATIONS)), start, step)

    got = one.select(F.transform(F.array(held), fold)[0].alias("w")).first()["w"]
    return list(got or [0.0] * (BUCKETS + 1))


def judge(pages: DataFrame, table: DataFrame | None = None, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages(page_id, url)``.

    The longest rule that fits decides, the earlier of equally long ones; else the score, the
    probability of ``block``, does at one half. An address that is null or has no ``://`` has an empty
    host and path, and is judged by them like any other. Repeated rows are judged alike; an empty table
    gives an empty result; other columns are ignored. There is no shuffle.
    """
    spark = pages.sparkSession
    weights = train(labelled(spark) if table is None else table)
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    ordered = sorted(RULES if rules is None else rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p) for _, h, p in ordered]
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    for (kind, h, p), fit in reversed(list(zip(ordered, fits, strict=True))):
        rule = F.when(fit, h + p).otherwise(rule)
        verdict = F.when(fit, kind).otherwise(verdict)
    margin = _margin(grams(F.col("host"), F.col("path")), F.lit(weights))
    score = 1 / (1 + F.exp(-margin))
    return rows.withColumn("score", score).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "score")

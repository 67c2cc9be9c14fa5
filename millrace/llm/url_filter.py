"""URL filters: exact rules first, else logistic regression on hashed character n-grams.

The model is trained from a small labelled URL table (DataFrame-based logistic regression) on the
counts of hashed n-grams of host and path, over the root of their number. Its weights, ``BUCKETS`` numbers whatever the
corpus, become a constant of the scoring expression, so judging urls is one projection: no shuffle, no
join, no Python.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.common import lower_ascii, named, require

BUCKETS = 2048
SIZES = (3, 4)
ITERATIONS, REGULARIZATION = 100, 3e-5

# The small labelled table is put together from these words: a host is a name, or two words joined, under a
# domain; a path is one or two words. Callers with a better table pass their own.
BLOCK_WORDS = """
    casino poker jackpot roulette slots betting bets gambling lottery porn xxx sexy nude adult escort viagra cialis
    pills pharmacy meds replica warez torrent keygen crack malware phishing spam clickbait adserver tracker payday
""".split()
ALLOW_WORDS = """
    library university museum weather news history science cooking railway mathematics garden theatre music travel
    health school hospital council climate astronomy physics biology language grammar dictionary encyclopedia forum
    research journal article recipe football cycling bank insurance software code docs help support wiki blog photo
""".split()
ALLOW_NAMES = """
    wikipedia github nytimes bestbuy bbc guardian reuters nature sciencemag arxiv python debian mozilla apache gnu
    stackoverflow openstreetmap archive gutenberg nasa noaa who unesco europa lemonde elpais spiegel corriere zeit
    walmart target costco ikea lego toyota siemens bosch nokia sony samsung intel amd ibm oracle adobe spotify
    britannica coursera khanacademy mit stanford harvard oxford cambridge sorbonne tudelft ethz kyoto toronto sydney
    allthingsd nextdoor yelp tripadvisor booking airbnb expedia lufthansa amtrak sncf renfe imdb goodreads etsy
""".split()
NEUTRAL_WORDS = """
    page item login search user index about contact login list view files team product order archive story topic
""".split()
# Names that mean nothing are made of these; they are to be allowed, whatever page is asked for.
SYLLABLES = """
    mar ber lin don vil sen ost wal nor gar del fen hol kar mon pel ros sta tur ver dor zel bri cam hen lou mil ned
    oak pam qui rud sol tam und vor wes yar zan ack eld ith ough ness ster ly wick ford ham bury ley den
""".split()
LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "nl", "sv")
DOMAINS = ("com", "org", "net", "de", "fr", "co.uk", "io", "info", "edu", "eu", "example.com", "example.org", "example.net")
PREFIXES = ("", "www.", "m.", "", "blog.", "en.")


def labelled_rows() -> list[tuple[str, int]]:
    """(url, 1 to block or 0) of the table that comes with the operator.

    A url is to be blocked for its host or for its path. Words of either kind take turns with prefixes, domains and
    other words, and those before and after them with both kinds, so that only they tell the labels apart. One mention of a blocked word in the path of a
    well-known name is fine (an article about it). Two rows in three are to be allowed.
    """
    pick = lambda words, i, step=7: words[i * step % len(words)]
    before, after = ("best", "free", "hot", "win", "cheap", "top", "online"), ("online", "club", "world", "royal", "deals", "24", "now")
    rows = []

    def add(host: str, path: str, label: int) -> None:
        i = len(rows)
        # Steps that share no factor with the loops below, so that each kind of row meets each prefix and domain.
        rows.append((f"http{'s' * (i // 13 % 2)}://{pick(PREFIXES, i // 11 + i, 1)}{host}.{pick(DOMAINS, i // 17 + i, 3)}{path}", label))

    for i, word in enumerate(BLOCK_WORDS):
        other, plain = pick(BLOCK_WORDS, i + 5), pick(NEUTRAL_WORDS, i)
        add(f"{word}-{other}", f"/{plain}/{i}", 1)
        add(f"{pick(before, i, 1)}{word}", "/", 1)
        add(f"{word}{pick(after, i, 1)}", f"/{plain}", 1)
        add(f"{pick(NEUTRAL_WORDS, i, 5)}-{word}", "/", 1)
        add(f"{word}-{pick(NEUTRAL_WORDS, i, 3)}", f"/{pick(ALLOW_WORDS, i)}/{plain}", 1)
        add(f"{pick(ALLOW_WORDS, i, 5)}{word}", f"/{plain}/{pick(ALLOW_WORDS, i)}", 1)
        add(f"{word}s-{pick(ALLOW_WORDS, i, 3)}", "" if i % 2 else "/", 1)
        add(f"{pick(ALLOW_WORDS, i)}{pick(NEUTRAL_WORDS, i, 5)}", f"/{word}/{other}", 1)
        add(pick(ALLOW_WORDS, i, 11), f"/{word}-{other}/{plain}-{word}", 1)
        add(pick(ALLOW_NAMES, i, 3), f"/{word}-{plain}/{other}-{pick(before, i, 1)}", 1)
        add(f"{plain}{pick(NEUTRAL_WORDS, i, 11)}", f"/{pick(before, i, 1)}-{word}/{word}-{other}", 1)
        add(pick(ALLOW_NAMES, i), f"/{plain}/{word}", 0)
    for i, name in enumerate([*ALLOW_NAMES, *ALLOW_WORDS]):
        add(name, f"/{pick(NEUTRAL_WORDS, i)}/{i}", 0)
        add(f"{name}-{pick(ALLOW_WORDS, i + 3)}" if i % 2 else name, f"/{pick(ALLOW_WORDS, i, 11)}/{pick(NEUTRAL_WORDS, i, 5)}", 0)
        add(f"{pick(NEUTRAL_WORDS, i, 5)}{name}", "/" if i % 3 else "", 0)
        add(f"{pick(before, i, 1)}{name}" if i % 2 else f"{name}{pick(after, i, 1)}", "/", 0)
    for i in range(240):
        name = "".join(pick(SYLLABLES, i + i // 8 + 17 * k, 5 + 2 * k) for k in range(2 + i % 2))
        page = pick((f"/{pick(LANGUAGES, i)}/{i * 37 % 9973}", f"/{i * 53 % 9973}.html", f"/{pick(NEUTRAL_WORDS, i)}/", "/", ""), i // 3, 1)
        add(name, page, 0)
    return rows


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def buckets_of(host: Column, path: Column) -> Column:
    """Hash buckets of all character n-grams of host and path, each within its own marks."""

    def grams(text: Column, kind: str, size: int) -> Column:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - size + 1, F.lit(1)))
        return F.transform(
            starts, lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(marked, i, F.lit(size))), F.lit(BUCKETS)).cast("int")
        )

    return F.concat(*[grams(t, kind, n) for kind, t in (("h", host), ("p", path)) for n in SIZES])


def train(labelled: DataFrame, url: str = "url", label: str = "label") -> tuple[list[float], float]:
    """Weights and intercept. ``labelled`` is a small table; rows without a label are left out."""
    rows = labelled.where(named(label).isNotNull()).select(
        named(label).cast("double").alias("label"), buckets_of(host_of(named(url)), path_of(named(url))).alias("grams")
    )
    frequency = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS - 1)),
        lambda j: F.size(F.filter("grams", lambda g: g == j)) / F.sqrt(F.size("grams")),
    )
    # One partition: sums in one order, so the weights are the same in every run.
    vectors = rows.select("label", array_to_vector(frequency).alias("features")).coalesce(1)
    # Standardizing would blow up buckets seen once.
    model = LogisticRegression(maxIter=ITERATIONS, regParam=REGULARIZATION, standardization=False).fit(vectors)
    return [float(w) for w in model.coefficients.toArray()], float(model.intercept)


def score(host: Column, path: Column, weights: list[float], intercept: float) -> Column:
    """Probability that a url is to be blocked."""
    table, grams = F.lit([round(w, 6) for w in weights]), buckets_of(host, path)
    total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(table, g))
    return 1 / (1 + F.exp(-(F.lit(intercept) + total / F.sqrt(F.size(grams)))))


def judge_urls(
    df: DataFrame, rules: list[tuple[str, str, str]] = (), labelled: DataFrame | None = None,
    url: str = "url", threshold: float = 0.5,
) -> DataFrame:
    """``df``'s rows with ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``block_score``.

    ``rules`` is a short list of (verdict, host, path): a rule fits its host and all subdomains if the
    path starts with the rule's; the longest fitting rule decides (the first listed of equal length),
    else the model: block from ``threshold`` on. Null urls and urls without ``://`` have empty host and
    path; there is nothing to judge, so they are allowed, with a score of 0. All rows stay, repeated ones too. Columns of ``df``
    that have the name of a result column give way to it; others pass through. An empty table gives an
    empty table.
    """
    require(df, url)
    spark = df.sparkSession
    labelled = labelled if labelled is not None else labelled_urls(spark)
    weights, intercept = train(labelled)
    results = ["host", "path", "rule", "verdict", "block_score"]
    kept = [named(c) for c in df.columns if c.lower() not in results]
    host, path = host_of(named(url)), path_of(named(url))
    found = df.select(*kept, host.alias("host"), path.alias("path"))
    rule = F.lit(None).cast("string")
    verdict = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    for what, at, start in sorted(reversed(list(rules)), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == at) | F.endswith("host", F.lit("." + at))) & F.startswith("path", F.lit(start))
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    nothing = (F.col("host") == "") & (F.col("path") == "")
    judged = score(F.col("host"), F.col("path"), weights, intercept)
    scored = found.withColumn("block_score", F.when(nothing, F.lit(0.0)).otherwise(judged))
    names = [c for c in df.columns if c.lower() not in results]
    return scored.select(
        *map(named, names), "host", "path", rule.alias("rule"), verdict.alias("verdict"), "block_score"
    )


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small table that comes with the operator."""
    return spark.createDataFrame(labelled_rows(), "url string, label int")

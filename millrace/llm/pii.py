r"""Personal data: base patterns, and bootstrapped contextual extraction on top.

Base matches (email, ip, card, phone) are found by regular expressions, leftmost and non-overlapping per
kind; their places come from the lengths of matches and of the pieces between them, by a running sum.
Matches that fail their check (parts of an ip, Luhn, number of digits) are dropped.

The valid base spans are the seeds, and credentials: quoted values with a digit that a key word and ``=`` or ``:``
introduce (``token = "..."``), spans of kind ``id``. An instance is a run of identifier-like words (with a digit, or an ``@``):
all words of one seed, or else such words in a row that no seed overlaps. Its lexical patterns are the word
before it, the two words before it, the word after it, and the word before it with its shape. Spark scores the graph of patterns and instances in rounds: a pattern's
score is the mean score of its distinct instances (smoothed), an instance's is the noisy-or of its patterns
with enough trusted instances, which are the seeds and what earlier rounds found. Instances beyond the seeds that reach ``ADDED`` are unseen identifiers, spans of kind ``id``.

Only built-in expressions are used. Patterns have possessive loops, and may start at the edge of a run
only, so very long runs cost no more than a pass. The tables after the scan hold matches, not texts; hot
patterns are pre-aggregated over distinct instances.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import broadcast_if_small, free_name, named, require, row_hashes
from millrace.workspace import cut_lineage

LOCAL, LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# A match begins at the edge of a run of its characters, or where the match before ended.
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[{LABEL}]++(?:\.[{LABEL}]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
ADDED_KIND = "id"
GAP = r"\x20\x09-\x0D"
# A whole word with an @ inside or a digit.
CANDIDATE = rf"(?<![^{GAP}])(?=[^{GAP}@]++@[^{GAP}]|[^{GAP}0-9]*+[0-9])[^{GAP}]++"
# A key word, = or :, and a quoted value; the value is what stands between the quotes.
CREDENTIAL = (
    r"""(?i:token|secret|passwd|password|passphrase|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?+["']?+"""
    r"""[\x20\t]{0,4}+[:=][\x20\t]{0,4}+["'][^\s"']{8,256}+["']"""
)
VALUE = r"""["']([^\s"']++)["']$"""
ROUNDS = 3
SUPPORT = 5  # distinct trusted instances a pattern needs
PATTERNS_BROADCAST = 100_000
TRUSTED = 0.8  # score a pattern needs
ADDED = 0.95  # score an instance needs


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(back, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    """Whether a match of a kind passes its check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    parts = F.forall(F.split(match, r"\."), lambda p: F.rlike(p, F.lit(r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})$")))
    return (
        F.when(kind == "email", True).when(kind == "ip", parts)
        .when(kind == "card", F.when(count.between(13, 19), luhn(digits)).otherwise(False))
        .otherwise(count.between(9, 15))
    )


def matches_of(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(_d1, _d2, kind, nth, before, match, after, start, end) of all matches in ``_text``.

    ``before`` and ``after`` are the pieces of text between matches; places are code points.
    """
    text = F.col("_text")
    kinds = list(patterns)
    found = rows.select("_d1", "_d2", "_text", *[F.regexp_extract_all(text, F.lit(patterns[k]), F.lit(0)).alias(f"_m{i}") for i, k in enumerate(kinds)])
    each = found.select(
        "_d1", "_d2",
        F.explode_outer(
            F.array(*[
                F.when(
                    F.size(f"_m{i}") > 0,
                    F.struct(F.lit(k).alias("kind"), F.col(f"_m{i}").alias("matches"), F.split(text, patterns[k], -1).alias("pieces")),
                )
                for i, k in enumerate(kinds)
            ])
        ).alias("_kind"),
    ).where(F.col("_kind").isNotNull())
    single = each.select(
        "_d1", "_d2", F.col("_kind.kind").alias("kind"), F.col("_kind.pieces").alias("_pieces"),
        F.posexplode_outer("_kind.matches").alias("nth", "match"),
    ).select(
        "_d1", "_d2", "kind", "nth", "match", F.get("_pieces", F.col("nth")).alias("before"),
        F.get("_pieces", F.col("nth") + 1).alias("after"),
    )
    return single


def placed(matches: DataFrame) -> DataFrame:
    """Adds ``start`` and ``end``; rows that repeat a text count once."""
    once = matches.dropDuplicates(["_d1", "_d2", "kind", "nth"])
    upto = Window.partitionBy("_d1", "_d2", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("chars")).over(upto)
    sized = once.withColumn("chars", F.length("match").cast("long"))
    return sized.withColumn("end", end).withColumn("start", F.col("end") - F.col("chars")).drop("gap", "chars")


def base_spans(rows: DataFrame) -> DataFrame:
    """(_d1, _d2, kind, match, start, end) of the valid base matches."""
    found = matches_of(rows, PATTERNS).select(
        "_d1", "_d2", "kind", "nth", "match", F.length("before").cast("long").alias("gap")
    )
    spans = placed(found).where(valid(F.col("kind"), F.col("match")))
    return cut_lineage(spans.select("_d1", "_d2", "kind", "match", "start", "end"), "base")


def credential_spans(rows: DataFrame) -> DataFrame:
    """(_d1, _d2, kind, match, start, end) of the values of credentials, those without a digit left out."""
    value = F.regexp_extract("match", VALUE, 1)
    found = matches_of(rows, {ADDED_KIND: CREDENTIAL}).select(
        "_d1", "_d2", "kind", "nth", "match", F.length("before").cast("long").alias("gap")
    )
    spans = placed(found).where(F.rlike(value, F.lit("[0-9]")))
    return spans.select(
        "_d1", "_d2", "kind", value.alias("match"), (F.col("end") - 1 - F.length(value)).alias("start"), (F.col("end") - 1).alias("end")
    )


def shape(instance: Column) -> Column:
    """Runs of digits, letters and other characters, hexadecimal runs as such; only the kinds of characters stay."""
    plain = F.regexp_replace(F.regexp_replace(instance, "[A-Za-z]+", "a"), "[0-9]+", "9")
    return F.when(F.rlike(instance, F.lit("^(?:[0-9a-f]{16,}+|[0-9A-F]{16,}+)$")), "hex").otherwise(F.substring(plain, 1, 24))


def candidates(rows: DataFrame) -> DataFrame:
    """(_d1, _d2, nth, match, near, left, right, start, end) of identifier-like words.

    ``near`` says that nothing but white space stands between a word and the one before it here.
    """
    blank = rf"^[{GAP}]*+$"
    # The piece may end in the quote or bracket that opens the instance.
    left = F.regexp_extract("before", rf"(?<![^{GAP}])([^{GAP}]++)[{GAP}]++$", 1)
    two = F.regexp_extract("before", rf"(?<![^{GAP}])([^{GAP}]++[{GAP}]++[^{GAP}]++)[{GAP}]++$", 1)
    right = F.regexp_extract("after", rf"^[{GAP}]++([^{GAP}]++)", 1)
    found = matches_of(rows, {"": CANDIDATE}).select(
        "_d1", "_d2", "kind", "nth", "match", F.length("before").cast("long").alias("gap"),
        ((F.col("nth") > 0) & F.rlike("before", F.lit(blank))).alias("near"),
        F.when(left != "", F.lower(left)).when(F.col("nth") == 0, "^").alias("left"),
        F.when(two != "", F.lower(F.regexp_replace(two, rf"[{GAP}]++", " "))).alias("two"),
        F.when(right != "", F.lower(right)).alias("right"),
    )
    where = placed(found)
    order = Window.partitionBy("_d1", "_d2").orderBy("nth")
    # Where the next word is such a word too, it is not in the pieces between.
    return where.select(
        "_d1", "_d2", "nth", "match", "near", "two",
        F.coalesce("left", F.lower(F.lag("match").over(order)), F.lit("#")).alias("left"),
        F.coalesce("right", F.lower(F.lead("match").over(order)), F.lit("#")).alias("right"), "start", "end",
    )


def with_seeds(found: DataFrame, base: DataFrame) -> DataFrame:
    """Candidates with ``seed``, whether a base span overlaps them, and ``joined``, whether one that began
    before them does. One pass in order of place."""
    none = F.lit(None)
    rows = found.select(
        "*", none.cast("long").alias("base_start"), none.cast("long").alias("base_end"), F.lit(1).alias("_turn")
    ).unionByName(
        base.select(
            "_d1", "_d2", none.cast("int").alias("nth"), none.cast("string").alias("match"),
            none.cast("boolean").alias("near"), none.cast("string").alias("two"),
            none.cast("string").alias("left"), none.cast("string").alias("right"), "start", "end",
            F.col("start").alias("base_start"), F.col("end").alias("base_end"), F.lit(0).alias("_turn"),
        )
    )
    # A span that starts where a word does is among those to come.
    order = Window.partitionBy("_d1", "_d2").orderBy("start", F.desc("_turn"), "end")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("_d1", "_d2").orderBy(F.desc("start"), "_turn", F.desc("end"))
    onward = back.rowsBetween(Window.unboundedPreceding, 0)
    open_end, next_start = F.max("base_end").over(upto), F.min("base_start").over(onward)
    joined = F.coalesce(open_end > F.col("start"), F.lit(False))
    seed = joined | F.coalesce(next_start < F.col("end"), F.lit(False))
    return rows.withColumn("joined", joined).withColumn("seed", seed).where("_turn = 1").drop("base_start", "base_end", "_turn")


def runs_of(words: DataFrame) -> DataFrame:
    """(_d1, _d2, instance, left, right, seed, start, end): words of one base span, or other words in a row."""
    order = Window.partitionBy("_d1", "_d2").orderBy("nth")
    plain = ~F.col("seed") & ~F.coalesce(F.lag("seed").over(order), F.lit(False))
    goes_on = F.col("joined") | (plain & F.col("near"))
    run = F.sum((~goes_on).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = words.withColumn("_run", run).groupBy("_d1", "_d2", "_run").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("nth", "match")))["match"], " ").alias("_whole"),
        F.min_by("left", "nth").alias("left"), F.max_by("right", "nth").alias("right"), F.max("seed").alias("seed"),
        F.min_by("two", "nth").alias("two"),
        F.min("start").alias("start"), F.max("end").alias("end"),
    )
    lead = F.length(F.regexp_extract("_whole", r"^[^A-Za-z0-9+(]*+", 0))
    core = F.regexp_replace(F.substring("_whole", lead + 1, F.length("_whole")), r"[^A-Za-z0-9]++$", "")
    tail = F.length("_whole") - lead - F.length(core)
    # A run of nothing but marks has an empty instance and is never added.
    return runs.select(
        "_d1", "_d2", core.alias("instance"), "left", "right", "two", "seed",
        (F.col("start") + lead).alias("start"), (F.col("end") - tail).alias("end"),
    )


def scored_instances(found: DataFrame) -> DataFrame:
    """(instance, score) of the instances beyond the seeds that reach ``ADDED``."""
    left, right = F.concat(F.lit("<"), F.col("left")), F.concat(F.lit(">"), F.col("right"))
    forms = [(left, left), (F.concat(F.lit("<<"), F.col("two")), left), (F.concat(left, F.lit(" #"), shape(F.col("instance"))), left), (right, right)]
    sides = F.explode(F.array(*[F.struct(p.alias("pattern"), w.alias("word")) for p, w in forms])).alias("side")
    edges = (
        found.where("instance != ''").select("instance", "seed", sides).select("instance", "seed", "side.*")
        .where("pattern IS NOT NULL").groupBy("pattern", "word", "instance").agg(F.max("seed").alias("seed"))
    )
    edges = cut_lineage(edges, "edges")
    instances = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    now = cut_lineage(instances.withColumn("score", F.col("seed").cast("double")), "scores")
    for _ in range(ROUNDS):
        # Seeds and the instances that earlier rounds found support a pattern alike.
        patterns = (
            edges.select("pattern", "instance").join(now, "instance").groupBy("pattern")
            .agg((F.sum("score") / (F.count("*") + 1)).alias("trust"), F.count_if(F.col("score") >= ADDED).alias("support"))
            .where((F.col("support") >= SUPPORT) & (F.col("trust") >= TRUSTED))
        )
        # Trusted patterns are few; behind a check of their number they go to the edges, however many one has.
        patterns = broadcast_if_small(cut_lineage(patterns, "patterns"), PATTERNS_BROADCAST)
        # A smoothed mean is below one, so the logarithm is finite.
        # The forms around one word are one piece of evidence, that of the best of them.
        best = edges.select("pattern", "word", "instance").join(patterns, "pattern").groupBy("instance", "word").agg(F.max("trust").alias("trust"))
        spread = best.groupBy("instance").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("found"))
        updated = now.select("instance", "seed").join(spread, "instance", "left").select(
            "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("found", F.lit(0.0))).alias("score")
        )
        now = cut_lineage(updated, "scores")
    return now.where(~F.col("seed") & (F.col("score") >= ADDED)).select("instance", "score")


def find_personal_data(df: DataFrame, doc_id: str = "doc_id", text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with ``spans``: array of (kind, start, end), kinds in order email, ip, card, phone, id.

    Places are code points, end exclusive, sorted by kind, then start. A null or empty text has no
    spans. All rows stay; rows with equal id and text have the same spans and count once as evidence.
    Other columns pass through; one named like ``spans`` gives way to it. Empty table: empty table.
    """
    require(df, doc_id, text)
    hashes = row_hashes(named(doc_id), named(text))
    rows = df.select(*[h.alias(n) for h, n in zip(hashes, ("_d1", "_d2"))], F.coalesce(named(text), F.lit("")).alias("_text"))
    base = base_spans(rows)
    credentials = cut_lineage(credential_spans(rows), "credentials")
    found = cut_lineage(runs_of(with_seeds(candidates(rows), base.unionByName(credentials))), "candidates")
    added = found.where(~F.col("seed")).join(scored_instances(found), "instance")
    all_kinds = base.unionByName(credentials).select("_d1", "_d2", "kind", "start", "end").unionByName(
        added.select("_d1", "_d2", F.lit(ADDED_KIND).alias("kind"), "start", "end")
    )
    order = reduce(lambda acc, k: F.when(F.col("kind") == k[1], k[0]).otherwise(acc), enumerate(KINDS), F.lit(len(KINDS)))
    # Names that no column of ``df`` has, in any case.
    d1, d2, held = (free_name(df, n) for n in ("_d1", "_d2", "_spans"))
    listed = all_kinds.groupBy(F.col("_d1").alias(d1), F.col("_d2").alias(d2)).agg(
        F.sort_array(F.collect_list(F.struct(order.alias("rank"), "start", "end", "kind"))).alias(held)
    )
    kept = [c for c in df.columns if c.lower() != spans.lower()]
    empty = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    shown = F.transform(named(held), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return df.select(*map(named, kept), *[h.alias(n) for h, n in zip(hashes, (d1, d2))]).join(listed, [d1, d2], "left").select(
        *map(named, kept), F.coalesce(shown, empty).alias(spans)
    )

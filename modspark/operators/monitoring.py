"""Reports over the prediction log: counts, means, latency, drift, rolling F1, retraining set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from modspark.functions.numbers import at_least, f1, parse_number
from modspark.operators.order_stats import count_values, exact_percentiles, value_cell

NO_ACTION = "UNKNOWN"
NO_LANGUAGE = "unknown"


def _overall() -> Column:
    """The logged score: missing counts as 0, text that is no number is dropped."""
    return parse_number(F.coalesce(F.col("overall_score").cast("string"), F.lit("0")))


def action_counts(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    action = F.coalesce("action", F.lit(NO_ACTION)).alias("action")
    return log.groupBy(*keys, action).agg(F.count("*").alias("n"))


def language_counts(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    language = F.coalesce("language", F.lit(NO_LANGUAGE)).alias("language")
    return log.groupBy(*keys, language).agg(F.count("*").alias("n"))


def mean_overall_score(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return log.groupBy(*keys).agg(F.coalesce(F.avg(_overall()), F.lit(0.0)).alias("mean_score"))


def mean_label_scores(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean per label over the rows that have a readable score for it."""
    rows = log.select(*keys, F.explode_outer("label_scores").alias("label", "value"))
    value = parse_number(F.col("value").cast("string"))
    return rows.filter(value.isNotNull()).groupBy(*keys, "label").agg(F.avg(value).alias("mean_score"))


def report(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The whole report as ``keys, section, name, n, mean`` from one pass over the log.

    Every log row turns into facts (one for the row, its action, its language, its overall
    score and each label score); partial aggregation reduces them before the shuffle.
    """
    facts = [
        _fact("rows", F.lit(""), F.lit(None)),
        _fact("action", F.coalesce("action", F.lit(NO_ACTION)), F.lit(None)),
        _fact("language", F.coalesce("language", F.lit(NO_LANGUAGE)), F.lit(None)),
        _fact("overall_score", F.lit(""), _overall()),
    ]
    per_label = F.transform(
        F.coalesce(F.map_entries("label_scores"), F.array()),
        lambda e: _fact("label_score", e["key"], parse_number(e["value"].cast("string"))),
    )
    all_facts = F.concat(F.array(*facts), per_label)
    measured = F.col("section").isin("overall_score", "label_score")
    out = (
        log.select(*keys, F.inline_outer(all_facts))
        .groupBy(*keys, "section", "name")
        .agg(
            F.when(F.first(measured), F.count("value")).otherwise(F.count("*")).alias("n"),
            F.avg("value").alias("mean"),
        )
    )
    out = out.filter((F.col("section") != "label_score") | (F.col("n") > 0))
    if not keys:
        # an empty log still reports zero rows and a zero mean
        always = log.sparkSession.createDataFrame(
            [("rows", ""), ("overall_score", "")], "section string, name string"
        )
        out = out.join(always, ["section", "name"], "full").select(
            "section", "name", F.coalesce("n", F.lit(0)).alias("n"), "mean"
        )
    zero = F.when(F.col("section") == "overall_score", F.lit(0.0))
    return out.withColumn("mean", F.coalesce("mean", zero))


def _fact(section: str, name: Column, value: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        name.cast("string").alias("name"),
        value.cast("double").alias("value"),
    )


def latency_summary(df: DataFrame, millis: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, n, p50_ms, p95_ms, p99_ms, mean_ms``; an empty input gives one row of zeros."""
    points = [0.5, 0.95, 0.99]
    grouping = list(keys) or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(1))
    counts = count_values(rows, grouping, millis)
    stats = exact_percentiles(counts, grouping, millis, "w", points)
    named = [F.get("p", F.lit(i)).alias(f"p{round(q * 100)}_ms") for i, q in enumerate(points)]
    out = stats.select(*grouping, "n", *named, F.col("mean").alias("mean_ms"))
    if keys:
        return out
    one = df.sparkSession.createDataFrame([(1,)], "_all int").join(out, "_all", "left").drop("_all")
    return one.select(
        F.coalesce("n", F.lit(0)).alias("n"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms", "mean_ms")],
    )


def latency_sketches(df: DataFrame, millis: str, keys: Sequence[str], k: int = 400) -> DataFrame:
    """``keys, n, total, sketch``: one small row per key, which can be stored and merged later.

    The sketch is a KLL quantile sketch; a larger ``k`` makes it larger and closer. Nulls and
    NaN are no measurements and are left out.
    """
    rows = df.select(*keys, F.col(millis).cast("double").alias("_v")).filter("_v IS NOT NULL AND NOT isnan(_v)")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("_v").alias("total"), F.kll_sketch_agg_double("_v", k).alias("sketch")
    )


def sketch_rank_error(k: int = 400) -> float:
    """By how much the rank of an estimated percentile may be off, as a share of all rows.

    The published bound of a KLL sketch for single queries at 99% confidence.
    """
    return 2.296 / k**0.9021


def sketched_latency(sketches: DataFrame, keys: Sequence[str] = (), points: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """``keys, n, mean_ms, p50_ms, ...`` over any groups of stored rows; n and the mean are exact."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean_ms"), F.kll_merge_agg_double("sketch").alias("_s")
    )
    at = [F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(f"p{round(q * 100)}_ms") for q in points]
    return merged.select(*keys, "n", "mean_ms", *at)


def log_signals(length: str = "n_chars", score: str = "overall_score") -> Column:
    """Binned drift signals of a log row: length, language, score and action."""
    # powers of two for lengths (number of binary digits), tenths for scores
    size = F.length(F.bin(F.col(length))).cast("string")
    tenth = F.floor(F.col(score) * 10).cast("string")
    bins = {"length": size, "language": F.col("language"), "score": tenth, "action": F.col("action")}
    return F.array(
        *[F.struct(F.lit(k).alias("signal"), F.coalesce(v, F.lit("")).alias("bin")) for k, v in bins.items()]
    )


def signal_counts(df: DataFrame, day: str, signals: Column) -> DataFrame:
    """``day, signal, bin, n`` from one pass."""
    return df.select(day, F.inline(signals)).groupBy(day, "signal", "bin").agg(F.count("*").alias("n"))


def drift(counts: DataFrame, day: str, in_reference: Column, floor: float = 1e-6) -> DataFrame:
    """``day, signal, n, psi``: population stability index of each day against a reference window.

    A bin absent on one side gets the share ``floor``. The sum over bins of a day is the
    reference-only total plus a correction for each bin the day has, so days and bins are
    never paired up in full.
    """
    low = F.lit(floor)

    def term(a: Column, b: Column) -> Column:
        a, b = F.greatest(a, low), F.greatest(b, low)
        return (a - b) * F.ln(a / b)

    # bins are few, so windows over the counts stand in for joins with their totals
    of_signal = Window.partitionBy("signal")
    reference = (
        counts.groupBy("signal", "bin")
        .agg(F.sum(F.when(in_reference, F.col("n"))).alias("rn"))
        .withColumn("b", F.col("rn") / F.sum("rn").over(of_signal))
        .withColumn("base", F.sum(F.when(F.col("rn") > 0, term(low, F.col("b")))).over(of_signal))
        .select("signal", "bin", F.coalesce("b", low).alias("b"), "base")
    )
    of_day = Window.partitionBy(day, "signal")
    found = counts.withColumn("a", F.col("n") / F.sum("n").over(of_day)).join(reference, ["signal", "bin"])
    shift = term(F.col("a"), F.col("b")) - term(low, F.col("b"))
    return found.groupBy(day, "signal").agg(
        F.sum("n").alias("n"), (F.max("base") + F.sum(shift)).alias("psi")
    )


def sample_distances(df: DataFrame, day: str, value: str, in_reference: Column) -> DataFrame:
    """``day, n, ks, wasserstein``: how far each day's values are from those of a reference window.

    Kolmogorov-Smirnov is the largest gap between the two distribution functions, Wasserstein
    the area between them; neither needs bins. Values are counted first; then each day's counts are
    laid over those of the reference. Running totals come in two steps, over cells of the
    value range and inside one cell, so a day is never ordered in one task. Nulls
    and NaN are left out, as are rows without a day; a reference without values gives null distances.
    """
    counted = (
        df.select(F.col(day).alias("_day"), F.col(value).cast("double").alias("_v"), in_reference.alias("_ref"))
        .filter("_v IS NOT NULL AND NOT isnan(_v)")
        .groupBy("_day", "_v", "_ref")
        .agg(F.count("*").alias("w"))
    )
    own = counted.groupBy("_day", "_v").agg(F.sum("w").alias("a"))
    reference = counted.filter("_ref").groupBy("_v").agg(F.sum("w").alias("b"))
    # one number per day is all that the driver sees
    sizes = {r["_day"]: r["n"] for r in own.filter("_day IS NOT NULL").groupBy("_day").agg(F.sum("a").alias("n")).collect()}
    size = reference.agg(F.sum("b")).first()[0]
    kind = df.schema[day].dataType
    listed = F.array(*[F.lit(d).cast(kind) for d in sorted(sizes)]).cast(ArrayType(kind))
    # the reference once per day: a row per distinct value of it and day
    theirs = reference.select(F.explode(listed).alias("_day"), "_v", F.lit(0).cast("long").alias("a"), "b")
    both = own.filter("_day IS NOT NULL").select("_day", "_v", "a", F.lit(0).cast("long").alias("b")).unionByName(theirs)
    merged = both.groupBy("_day", "_v").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn("_cell", value_cell(F.col("_v")))
    cells = merged.groupBy("_day", "_cell").agg(F.sum("a").alias("ca"), F.sum("b").alias("cb"), F.min("_v").alias("_least"))
    ahead = Window.partitionBy("_day").orderBy("_cell")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "_day", "_cell", F.coalesce(F.sum("ca").over(before), F.lit(0)).alias("ca"),
        F.coalesce(F.sum("cb").over(before), F.lit(0)).alias("cb"), F.lead("_least").over(ahead).alias("_after"),
    )
    inside = Window.partitionBy("_day", "_cell").orderBy("_v")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    na = F.coalesce(*[F.when(F.col("_day") == F.lit(d), n) for d, n in sizes.items()], F.lit(0)).cast("long")
    rows = merged.join(cells, ["_day", "_cell"]).select(
        "_day", na.alias("_na"), F.lit(size).cast("long").alias("_nb"),
        (F.col("ca") + F.sum("a").over(upto)).alias("ta"), (F.col("cb") + F.sum("b").over(upto)).alias("tb"),
        (F.coalesce(F.lead("_v").over(inside), "_after") - F.col("_v")).alias("width"),
    )
    rows = rows.withColumn("gap", F.abs(F.col("ta") / F.col("_na") - F.col("tb") / F.col("_nb")))
    return rows.groupBy(F.col("_day").alias(day)).agg(
        F.max("_na").alias("n"), F.max("gap").alias("ks"),
        F.when(F.max("gap").isNotNull(), F.coalesce(F.sum(F.col("gap") * F.col("width")), F.lit(0.0))).alias("wasserstein"),
    )


def rolling_f1(
    log: DataFrame,
    truth: DataFrame,
    day: str,
    label_fields: Sequence[str],
    threshold: float = 0.5,
    days: int = 7,
    key: str = "text_sha256",
) -> DataFrame:
    """``day, label, n, f1`` over the last ``days`` days that have labelled rows.

    Copies of a text collapse to one row per day and score before the join, and the truth
    has one row per hash, so a text that makes up much of the log does not skew the join.
    """
    hits = [f"hit{i}" for i in range(len(label_fields))]
    seen = log.select(day, key, *label_hits(label_fields, threshold)).groupBy(day, key, *hits).agg(F.count("*").alias("w"))
    return rolling(hit_counts(seen.join(truth, key), day, label_fields), day, days)


def label_hits(label_fields: Sequence[str], threshold: float) -> list[Column]:
    """``hit0, hit1, ...``: whether the logged score of each label reaches the threshold."""
    return [
        at_least(F.try_element_at("label_scores", F.lit(x)).cast("float"), threshold).alias(f"hit{i}")
        for i, x in enumerate(label_fields)
    ]


def hit_counts(joined: DataFrame, day: str, label_fields: Sequence[str]) -> DataFrame:
    """``day, label, n, tp, fp, fn`` of rows with ``w``, hits and labels; parts of a day can be added."""
    cells = F.array(
        *[
            F.struct(
                F.lit(x).alias("label"),
                F.get("labels", F.lit(i)).cast("int").alias("y"),
                F.coalesce(F.col(f"hit{i}"), F.lit(False)).alias("hit"),
            )
            for i, x in enumerate(label_fields)
        ]
    )
    rows = joined.select(day, "w", F.inline(cells))

    def total(case: Column, name: str) -> Column:
        return F.sum(F.when(case, F.col("w")).otherwise(0)).alias(name)

    return rows.groupBy(day, "label").agg(
        F.sum("w").alias("n"),
        total((F.col("y") == 1) & F.col("hit"), "tp"),
        total((F.col("y") == 0) & F.col("hit"), "fp"),
        total((F.col("y") == 1) & ~F.col("hit"), "fn"),
    )


def rolling(daily: DataFrame, day: str, days: int = 7) -> DataFrame:
    """``day, label, n, f1`` from the daily counts, over the last ``days`` days that have some."""
    w = Window.partitionBy("label").orderBy(day).rowsBetween(1 - days, 0)
    sums = {c: F.sum(c).over(w) for c in ("n", "tp", "fp", "fn")}
    return daily.select(day, "label", *[v.alias(k) for k, v in sums.items()]).select(
        day, "label", "n", f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1")
    )


def retraining_set(
    queue: DataFrame, reviewed: DataFrame, train: DataFrame, key: str = "text_sha256"
) -> DataFrame:
    """Reviewed queue items that are new, plus the previous training set, one row per text.

    ``reviewed`` and ``train`` carry ``key, text, labels``. One aggregate by hash brings the
    three inputs together: copies shrink before the shuffle and each text moves once.
    """
    source = "_source"

    def tagged(df: DataFrame, rank: int) -> DataFrame:
        content = F.struct("text", "labels") if rank else F.lit(None).cast(kind)
        return df.select(key, content.alias("content"), F.lit(rank).alias(source))

    kind = train.select(F.struct("text", "labels").alias("c")).schema["c"].dataType
    rows = tagged(queue, 0).unionByName(tagged(reviewed, 1)).unionByName(tagged(train, 2))
    per_text = rows.groupBy(key).agg(
        *[F.max(F.col(source) == i).alias(f"in{i}") for i in range(3)],
        # of several labellings of one text the greatest counts, whatever the order of rows
        F.max_by("content", F.struct(F.col(source), F.col("content.labels"))).alias("content"),
    )
    kept = per_text.filter("in2 OR (in0 AND in1)")
    origin = F.when(F.col("in2"), F.lit("train")).otherwise(F.lit("review"))
    return kept.select(key, "content.text", "content.labels", origin.alias("origin"))

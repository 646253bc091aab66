"""Document quality by hierarchical empirical Bayes.

A document's own evidence is the log-likelihood ratio of a naive Bayes classifier over binned text statistics, counted
over all labelled documents. Its site adds a prior: the share of good documents of its path shrinks toward the share of
its host, and that toward the share of the corpus, the more the fewer documents speak for it. How much is estimated
from how much hosts, and paths within hosts, really differ (moments of the beta-binomial).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.layout import join_small
from shelfcast.session import settle

SYMBOLS, CAPITALS = "[#$%&*!|]", "[A-Z]"
#: Upper bin edges in thousandths (words: in words).
EDGES = {
    "symbols": (0, 5, 20, 60, 150),
    "capitals": (5, 10, 20, 40, 80, 160, 320),
    "words": (50, 200, 1000, 5000),
    "variety": (50, 100, 200, 300, 400, 500, 600, 700, 800, 900),
    "lines": (300, 500, 800, 950),
}
#: The classifier's features; words and variety count together, because long texts repeat more words.
FEATURES = ("symbols", "capitals", "repeats", "lines")
LABELLED, UNLABELLED = 1000, 500
MILLI = 1000
NO_EVIDENCE = -1
LEAST, MOST = 1.0, 1.0e6
CLIP = 0.02


def _bin(value: Column, edges: tuple[int, ...]) -> Column:
    return reduce(lambda out, e: out + F.when(value > e, 1).otherwise(0), edges, F.lit(0))


def _thousandths(part: Column, whole: Column) -> Column:
    return F.floor(part * 1000 / whole)


def _measured(text: Column) -> list[Column]:
    """What the features are made of, in columns of their own so that each is computed once."""
    words, lines = F.split(text, " "), F.split(text, "\n")
    return [
        F.length(text).alias("_chars"), F.regexp_count(text, F.lit(SYMBOLS)).alias("_symbols"),
        F.regexp_count(text, F.lit(CAPITALS)).alias("_capitals"), F.size(words).alias("_words"),
        F.size(F.array_distinct(words)).alias("_kinds"), F.size(lines).alias("_lines"),
        F.size(F.array_distinct(lines)).alias("_line_kinds"),
    ]


def _features() -> list[Column]:
    """Bin of each feature from the measured columns; NO_EVIDENCE for an empty text."""
    out = {
        "symbols": _bin(_thousandths(F.col("_symbols"), F.col("_chars")), EDGES["symbols"]),
        "capitals": _bin(_thousandths(F.col("_capitals"), F.col("_chars")), EDGES["capitals"]),
        "repeats": _bin(F.col("_words"), EDGES["words"]) * 100
        + _bin(_thousandths(F.col("_kinds"), F.col("_words")), EDGES["variety"]),
        "lines": _bin(_thousandths(F.col("_line_kinds"), F.col("_lines")), EDGES["lines"]),
    }
    return [F.when(F.col("_chars") > 0, v).otherwise(NO_EVIDENCE).cast("int").alias(k) for k, v in out.items()]


def _bins_of(feature: str) -> int:
    if feature == "repeats":
        return (len(EDGES["words"]) + 1) * (len(EDGES["variety"]) + 1)
    return len(EDGES[feature]) + 1


def _log_ratios(labelled: DataFrame) -> dict[str, dict[int, float]]:
    """Log-likelihood ratio of each bin, good against bad, add-one smoothed. At most one entry per bin."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES]))
    counts = (
        labelled.select("quality", pairs.alias("b")).where(f"b.bin != {NO_EVIDENCE}")
        .groupBy("b.feature", "b.bin").agg(F.sum("quality").alias("good"), F.count("*").alias("n")).collect()
    )
    out: dict[str, dict[int, float]] = {f: {} for f in FEATURES}
    for feature in FEATURES:
        rows = [r for r in counts if r.feature == feature]
        good, bad, bins = sum(r.good for r in rows), sum(r.n - r.good for r in rows), _bins_of(feature)
        if good and bad:
            for r in rows:
                out[feature][r.bin] = math.log((r.good + 1) / (good + bins)) - math.log((r.n - r.good + 1) / (bad + bins))
            out[feature][-2] = math.log(1 / (good + bins)) - math.log(1 / (bad + bins))  # a bin never met
    return out


def _evidence(ratios: dict[str, dict[int, float]]) -> Column:
    total = F.lit(0.0)
    for feature in FEATURES:
        table = ratios[feature]
        if table:
            seen = [x for b, r in sorted(table.items()) if b >= 0 for x in (F.lit(b), F.lit(r))]
            value = F.coalesce(F.create_map(*seen)[F.col(feature)], F.lit(table[-2]))
            total = total + F.when(F.col(feature) == NO_EVIDENCE, 0.0).otherwise(value)
    return total


def strength(mean: Column, spread: Column, groups: Column, n: Column, squares: Column) -> Column:
    """Prior documents that a group's parent counts for: beta-binomial moments, between LEAST and MOST."""
    within = mean * (1 - mean)
    between = (spread - within * groups / n) / (1 - squares / (n * n))
    return F.when(between <= 0, MOST).otherwise(F.least(F.lit(MOST), F.greatest(F.lit(LEAST), within / between - 1)))


def _posteriors(outcomes: DataFrame) -> DataFrame:
    """(host, path, host_posterior, path_posterior) from rows (host, path, weight, good) in integer thousandths."""
    paths = settle(
        outcomes.groupBy("host", "path").agg(F.sum("weight").alias("w"), F.sum("good").alias("g"))
        .select("host", "path", (F.col("w") / MILLI).alias("n"), (F.col("g") / MILLI).alias("k"))
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n_host"), F.sum("k").alias("k_host"))
    mean = F.col("k") / F.col("n")
    whole = paths.agg(F.sum("k").alias("k"), F.sum("n").alias("n")).first()
    mu = min(1 - 1e-6, max(1e-6, whole.k / whole.n)) if whole.n else 0.5
    apart = F.pow(F.col("k_host") / F.col("n_host") - F.lit(mu), 2)
    n = F.sum("n_host")
    top = hosts.agg(
        strength(F.lit(mu), F.sum(F.col("n_host") * apart) / n, F.count("*") - 1, n, F.sum(F.pow("n_host", F.lit(2.0))))
        .alias("s")
    ).first().s
    top = MOST if top is None else top
    known = hosts.withColumn("host_posterior", (F.col("k_host") + top * mu) / (F.col("n_host") + top))
    joined = settle(paths.join(known, "host"))
    n = F.sum("n")
    low = joined.agg(
        strength(
            F.lit(mu), F.sum(F.col("n") * F.pow(mean - F.col("k_host") / F.col("n_host"), 2)) / n,
            F.count("*") - F.count_distinct("host"), n, F.sum(F.pow("n", F.lit(2.0))),
        ).alias("s")
    ).first().s
    low = MOST if low is None else low
    return joined.select(
        "host", "path", "host_posterior",
        ((F.col("k") + low * F.col("host_posterior")) / (F.col("n") + low)).alias("path_posterior"),
    )


def score_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, carry: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (doc_id, text, ``carry``) with host, path, evidence, host_posterior, path_posterior and score.

    ``labels`` has (doc_id, quality 0 or 1); rows with another or no quality are ignored, and a document labelled both
    ways counts as bad. ``score`` is the posterior probability of good quality: the site's prior, kept between CLIP and
    1 - CLIP, times the document's evidence. Unlabelled documents speak for their site with half weight, by the
    classifier's probability.

    Null or empty text: no evidence, the score is the site's. Null host or path: one site of that name. A class without
    labels: evidence 0 for all. Repeated rows count and are scored as often as they come. Empty table: empty result.
    """
    empty = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *carry, F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"), *_measured(empty),
    ).select("doc_id", *carry, "host", "path", *_features())
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality")
    )
    slim = settle(rows.drop(*carry).join(known, "doc_id", "left"))
    ratios = _log_ratios(slim.where("quality IS NOT NULL"))
    p = 1 / (1 + F.exp(-F.col("evidence")))
    outcomes = slim.withColumn("evidence", _evidence(ratios)).select(
        "host", "path", F.when(F.col("quality").isNull(), UNLABELLED).otherwise(LABELLED).cast("long").alias("weight"),
        F.when(F.col("quality").isNull(), F.round(p * UNLABELLED)).otherwise(F.col("quality") * LABELLED)
        .cast("long").alias("good"),
    )
    sites = settle(_posteriors(outcomes))
    scored = join_small((rows if carry else slim).withColumn("evidence", _evidence(ratios)), sites, ["host", "path"])
    prior = F.least(F.lit(1 - CLIP), F.greatest(F.lit(CLIP), F.col("path_posterior")))
    return scored.withColumn("score", 1 / (1 + F.exp(-F.col("evidence")) * (1 - prior) / prior)).select(
        "doc_id", *carry, "host", "path", "evidence", "host_posterior", "path_posterior", "score"
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with source and lang) whose score is 0.5 or more, in the same columns."""
    names = docs.columns
    packed = docs.select("doc_id", "text", "source", "lang", F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    scored = score_quality(packed, labels, *site(), carry=("row",))
    return scored.where("score >= 0.5").select(*[F.col(f"row.`{c}`").alias(c) for c in names])


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``; the host is the source and the path its language section."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(docs, labels, *site())
    six = [F.round(c, 6).alias(c) for c in ("evidence", "host_posterior", "path_posterior", "score")]
    return scored.select("doc_id", "host", "path", *six, (F.col("score") >= 0.5).alias("kept"))


def site() -> tuple[Column, Column]:
    return F.coalesce(F.col("source"), F.lit("")), F.coalesce(F.col("lang"), F.lit(""))


def _sql_bin(value: str, feature: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {value} > {e} THEN 1 ELSE 0 END" for e in EDGES[feature]) + ")"


def _sql_share(part: str, whole: str) -> str:
    return f"floor({part} * 1000.0::DOUBLE / {whole})"


def _sql_ratio(chars: str) -> str:
    return _sql_share(f"(length(t) - length(regexp_replace(t, '{chars}', '', 'g')))", "length(t)")


def _sql_strength(mean: str, spread: str, groups: str, n: str, squares: str) -> str:
    between = f"(({spread}) - {mean} * (1 - {mean}) * ({groups}) / ({n})) / (1 - ({squares}) / (({n}) * ({n})))"
    return (
        f"CASE WHEN {between} <= 0 THEN {MOST} "
        f"ELSE least({MOST}, greatest({LEAST}, {mean} * (1 - {mean}) / ({between}) - 1)) END"
    )


_VARIETY = _sql_bin(_sql_share("len(list_distinct(w))", "len(w)"), "variety")
_LLR = " + ".join(f"coalesce(CASE WHEN d.{f} = -1 THEN 0 ELSE coalesce(m_{f}.r, u_{f}.r) END, 0)" for f in FEATURES)
_JOINS = " ".join(
    f"LEFT JOIN ratio m_{f} ON m_{f}.feature = '{f}' AND m_{f}.bin = d.{f} "
    f"LEFT JOIN unseen u_{f} ON u_{f}.feature = '{f}'"
    for f in FEATURES
)
_BINS = " ".join(f"WHEN '{f}' THEN {_bins_of(f)}" for f in FEATURES)
SQL = f"""
WITH base AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(lang, '') AS path, coalesce(text, '') AS t,
    string_split(coalesce(text, ''), ' ') AS w, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
feat AS MATERIALIZED (SELECT doc_id, host, path,
    CASE WHEN t = '' THEN -1 ELSE {_sql_bin(_sql_ratio(SYMBOLS), "symbols")} END AS symbols,
    CASE WHEN t = '' THEN -1 ELSE {_sql_bin(_sql_ratio(CAPITALS), "capitals")} END AS capitals,
    CASE WHEN t = '' THEN -1 ELSE {_sql_bin("len(w)", "words")} * 100 + {_VARIETY} END AS repeats,
    CASE WHEN t = '' THEN -1 ELSE {_sql_bin(_sql_share("len(list_distinct(l))", "len(l)"), "lines")} END AS lines
    FROM base),
known AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY 1),
docs AS MATERIALIZED (SELECT f.*, k.quality FROM feat f LEFT JOIN known k USING (doc_id)),
tall AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS bin, quality FROM docs" for f in FEATURES)}),
cnt AS (SELECT feature, bin, sum(quality)::DOUBLE AS good, count(*)::DOUBLE AS n FROM tall
    WHERE quality IS NOT NULL AND bin != -1 GROUP BY 1, 2),
tot AS (SELECT feature, sum(good) AS good, sum(n - good) AS bad, CASE feature {_BINS} END AS bins FROM cnt GROUP BY 1
    HAVING sum(good) > 0 AND sum(n - good) > 0),
ratio AS MATERIALIZED (SELECT c.feature, c.bin,
    ln((c.good + 1) / (t.good + t.bins)) - ln((c.n - c.good + 1) / (t.bad + t.bins)) AS r
    FROM cnt c JOIN tot t USING (feature)),
unseen AS MATERIALIZED (SELECT feature, ln(1 / (good + bins)) - ln(1 / (bad + bins)) AS r FROM tot),
ev AS MATERIALIZED (SELECT d.*, {_LLR} AS evidence FROM docs d {_JOINS}),
outcome AS (SELECT host, path, CASE WHEN quality IS NULL THEN {UNLABELLED} ELSE {LABELLED} END AS weight,
    CASE WHEN quality IS NULL THEN round({UNLABELLED} / (1 + exp(-evidence))) ELSE quality * {LABELLED} END AS good FROM ev),
paths AS MATERIALIZED (SELECT host, path, sum(weight)::DOUBLE / {MILLI} AS n, sum(good)::DOUBLE / {MILLI} AS k
    FROM outcome GROUP BY 1, 2),
mu AS (SELECT least(1 - 1e-6, greatest(1e-6, sum(k) / sum(n))) AS mu FROM paths),
hosts AS (SELECT host, sum(n) AS n_host, sum(k) AS k_host FROM paths GROUP BY 1),
top AS (SELECT mu.mu, {_sql_strength("mu.mu", "sum(n_host * (k_host / n_host - mu.mu) ** 2) / sum(n_host)", "count(*) - 1",
    "sum(n_host)", "sum(n_host ** 2)")} AS s FROM hosts, mu GROUP BY mu.mu),
known_hosts AS (SELECT host, n_host, k_host, (k_host + top.s * top.mu) / (n_host + top.s) AS host_posterior FROM hosts, top),
both_levels AS (SELECT p.*, h.n_host, h.k_host, h.host_posterior FROM paths p JOIN known_hosts h USING (host)),
low AS (SELECT {_sql_strength("mu.mu", "sum(n * (k / n - k_host / n_host) ** 2) / sum(n)", "count(*) - count(DISTINCT host)",
    "sum(n)", "sum(n ** 2)")} AS s FROM both_levels, mu GROUP BY mu.mu),
sites AS (SELECT host, path, host_posterior, (k + low.s * host_posterior) / (n + low.s) AS path_posterior
    FROM both_levels, low),
scored AS (SELECT doc_id, host, path, evidence, host_posterior, path_posterior,
    1 / (1 + exp(-evidence) * (1 - least({1 - CLIP}, greatest({CLIP}, path_posterior)))
        / least({1 - CLIP}, greatest({CLIP}, path_posterior))) AS score FROM ev JOIN sites USING (host, path))
SELECT doc_id, host, path, round(evidence, 6) AS evidence, round(host_posterior, 6) AS host_posterior,
    round(path_posterior, 6) AS path_posterior, round(score, 6) AS score, score >= 0.5 AS kept FROM scored
"""

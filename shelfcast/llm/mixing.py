"""Mixing sources to target weights by iterative proportional fitting, then sampling whole documents.

Tokens are summed per cell (source group, language group, topic). The caller's targets bound the number of cells: what
they do not name falls into the group OTHER. Raking scales the cells until every marginal has its target share; each
cell's ratio of target to present tokens gives its documents' probability, scaled to the token budget and at most 1.
A document is taken when the hash of its id falls below that.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OTHER = "*"
WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 25
HASH_DIGITS = 12
#: Production targets, as shares of tokens.
SOURCES = {"src0": 0.20, "src1": 0.06, "src2": 0.06, OTHER: 0.68}
LANGUAGES = {"en": 0.60, "fr": 0.14, "de": 0.14, "es": 0.10, OTHER: 0.02}
TOPICS = {"contact": 0.04, "legal": 0.03, "table": 0.02, OTHER: 0.91}
BUDGET = 0.8
#: Topic and the text that marks it; the first that is found counts.
MARKERS = (("contact", "@"), ("legal", "icense"), ("table", " | "))

Cell = tuple[str, str, str]


def topic_of(text: Column) -> Column:
    out = F.lit(OTHER)
    for topic, mark in reversed(MARKERS):
        out = F.when(text.contains(mark), topic).otherwise(out)
    return out


def rake(tokens: Mapping[Cell, float], targets: tuple[Mapping[str, float], ...], rounds: int = ROUNDS) -> dict[Cell, float]:
    """Tokens of the cells after fitting: each marginal in turn is scaled to its targets, ``rounds`` times.

    Targets of values without tokens are shared out over those that have some.
    """
    total = sum(tokens.values())
    fitted = dict(tokens)
    for _ in range(rounds):
        for side, target in enumerate(targets):
            sums: dict[str, float] = {}
            for cell, n in fitted.items():
                sums[cell[side]] = sums.get(cell[side], 0.0) + n
            share = sum(target.get(v, 0.0) for v, n in sums.items() if n > 0)
            for cell, n in fitted.items():
                have = sums[cell[side]]
                fitted[cell] = n * target.get(cell[side], 0.0) / share * total / have if have > 0 and share > 0 else 0.0
    return fitted


def probabilities(tokens: Mapping[Cell, float], fitted: Mapping[Cell, float], budget: float) -> dict[Cell, float]:
    """Probability of each cell: min(1, scale * ratio), the scale giving ``budget`` expected tokens if it can."""
    ratios = {c: fitted[c] / n for c, n in tokens.items() if n > 0}
    order = sorted(ratios, key=lambda c: -ratios[c])
    full, rest = 0.0, sum(tokens[c] * ratios[c] for c in order)
    scale = 0.0
    for cell in order:
        if rest <= 0:
            break
        scale = (budget - full) / rest
        if scale * ratios[cell] <= 1:
            break
        full += tokens[cell]
        rest -= tokens[cell] * ratios[cell]
    return {c: min(1.0, max(0.0, scale * r)) for c, r in ratios.items()}


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) that only depends on the id."""
    text = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(text, 1, HASH_DIGITS), 16, 10).cast("double") / float(16**HASH_DIGITS)


def _group(value: Column, target: Mapping[str, float]) -> Column:
    return F.when(value.isin([v for v in target if v != OTHER]), value).otherwise(OTHER)


def mix(
    docs: DataFrame,
    sources: Mapping[str, float] = SOURCES,
    languages: Mapping[str, float] = LANGUAGES,
    topics: Mapping[str, float] = TOPICS,
    budget: float = BUDGET,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` (doc_id, text, source, lang, ``carry``) with tokens, the cell, probability and sampled.

    ``budget`` is the expected share of the corpus's tokens to take. Tokens are words without white space.

    Null source or language belongs to OTHER. Null or empty text has no tokens; its document still has its cell's
    probability. A cell without any tokens has probability 1: it costs nothing. Null doc_ids share one draw, as do
    repeated ones. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *carry, F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        _group(F.col("source"), sources).alias("source_group"), _group(F.col("lang"), languages).alias("lang_group"),
        topic_of(text).alias("topic"),
    )
    cell = ["source_group", "lang_group", "topic"]
    sums = rows.groupBy(*cell).agg(F.sum("tokens").alias("tokens")).collect()  # no more rows than target combinations
    tokens = {(r.source_group, r.lang_group, r.topic): float(r.tokens) for r in sums}
    fitted = rake(tokens, (sources, languages, topics))
    chance = probabilities(tokens, fitted, budget * sum(tokens.values()))
    table = docs.sparkSession.createDataFrame(
        [(*c, chance.get(c, 1.0)) for c in tokens],
        "source_group string, lang_group string, topic string, probability double",
    )
    return rows.join(F.broadcast(table), cell).withColumn(
        "sampled", uniform(F.col("doc_id")) < F.round("probability", 9)
    )


def sample_mix(docs: DataFrame, **targets) -> DataFrame:
    """The sampled rows of ``docs``, in the same columns."""
    names = docs.columns
    packed = docs.select("doc_id", "text", "source", "lang", F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    return mix(packed, carry=("row",), **targets).where("sampled").select(
        *[F.col(f"row.`{c}`").alias(c) for c in names]
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` under the production targets."""
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select(
        "doc_id", "tokens", "source_group", "lang_group", "topic", F.round("probability", 9).alias("probability"), "sampled"
    )


_SIDES = (("source_group", SOURCES), ("lang_group", LANGUAGES), ("topic", TOPICS))


def _sql_group(column: str, target: Mapping[str, float]) -> str:
    names = ", ".join(f"'{v}'" for v in target if v != OTHER)
    return f"CASE WHEN {column} IN ({names}) THEN {column} ELSE '{OTHER}' END"


def _sql_rounds() -> str:
    out, last = [], "fit_0"
    for i in range(ROUNDS):
        for side, target in _SIDES:
            goal = "CASE " + side + "".join(f" WHEN '{v}' THEN {t}::DOUBLE" for v, t in target.items()) + " ELSE 0 END"
            name = f"fit_{i}_{side}"
            out.append(
                f"{name}_m AS MATERIALIZED (SELECT {side}, sum(n) AS have, {goal} AS goal FROM {last} GROUP BY 1),\n"
                f"{name} AS MATERIALIZED (SELECT f.source_group, f.lang_group, f.topic, f.tokens, CASE WHEN m.have > 0 THEN "
                f"f.n * m.goal / (SELECT sum(goal) FROM {name}_m WHERE have > 0) * (SELECT sum(tokens) FROM fit_0) / m.have "
                f"ELSE 0 END AS n FROM {last} f JOIN {name}_m m USING ({side}))"
            )
            last = name
    return ",\n".join(out) + f",\nfitted AS (SELECT * FROM {last})"


_TOPIC = "CASE " + " ".join(f"WHEN contains(t, '{m}') THEN '{k}'" for k, m in MARKERS) + f" ELSE '{OTHER}' END"
SQL = f"""
WITH base AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
docs AS MATERIALIZED (SELECT doc_id, len(regexp_extract_all(t, '{WORD}'))::BIGINT AS tokens,
    {_sql_group("source", SOURCES)} AS source_group, {_sql_group("lang", LANGUAGES)} AS lang_group, {_TOPIC} AS topic FROM base),
fit_0 AS MATERIALIZED (SELECT source_group, lang_group, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS n
    FROM docs GROUP BY 1, 2, 3),
{_sql_rounds()},
ratios AS (SELECT *, n / tokens AS ratio, row_number() OVER (ORDER BY n / tokens DESC) AS place FROM fitted WHERE tokens > 0),
scales AS (SELECT *, ({BUDGET} * (SELECT sum(tokens) FROM fit_0)
      - coalesce(sum(tokens) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(tokens * ratio) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM ratios),
chosen AS (SELECT scale FROM scales WHERE scale * ratio <= 1 ORDER BY place LIMIT 1),
chance AS (SELECT source_group, lang_group, topic, least(1.0, greatest(0.0, (SELECT scale FROM chosen) * ratio)) AS p FROM ratios)
SELECT doc_id, d.tokens, source_group, lang_group, topic, round(coalesce(p, 1.0), 9) AS probability,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {HASH_DIGITS}))::BIGINT::DOUBLE / {16**HASH_DIGITS}::DOUBLE
      < round(coalesce(p, 1.0), 9) AS sampled
FROM docs d LEFT JOIN chance USING (source_group, lang_group, topic)
"""

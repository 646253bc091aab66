"""Personal data: fixed kinds by pattern, and terms that reveal a protected value by how they co-occur with it.

Everything is DataFrame functions. A pattern's matches get their places by marking them in the text, splitting at the
marks and adding up lengths. A protected entity is a base value (an address, a number). For an entity e and a term t of
the same text, PMI(e; t) = log2(n(e,t) N / (n(e) n(t))) over the documents of the whole corpus says how much of e's
information content IC(e) = log2(N / n(e)) the term gives away. A term that gives away ``disclosure`` of some e's or
more, on the evidence of ``support`` different texts, is generalised to its first letters if those give away less of
every e, and removed otherwise, in every document that contains it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.layout import fits_broadcast, sized
from shelfcast.session import settle

KINDS = ("email", "ip", "card", "phone")
MARK, STAND_IN = "\u0001", "�"
#: Base patterns. Runs are possessive and start where a run starts or the last match ended, which keeps long texts
#: linear and finds the same leftmost matches.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "phone": "+", "ip": "."}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Terms are words and hyphenated words; the parts of a hyphenated word are words too.
TERM = r"(?<![\p{L}0-9@_%+])\p{L}{3,}+(?![0-9@_%+])"
HYPHENATED = r"(?<![\p{L}0-9@_%+])\p{L}++(?:[-\u2010\u2011]\p{L}++)++(?![0-9@_%+])"
_HYPHEN = r"\p{L}[-\u2010\u2011]\p{L}"
STEM = 4
_SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * (F.lit(1) + (n - i) % 2)
        return total + twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern: str, kind: str, rank: int, keep) -> Column:
    """Spans of the matches of ``pattern`` for which ``keep(value)`` holds; places in code points, end exclusive."""
    marked = F.regexp_replace(F.translate(text, MARK, STAND_IN), pattern, f"{MARK}$0{MARK}")
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        end = (acc["at"] + F.length(piece)).cast("int")
        span = F.struct(
            acc["at"].alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
            piece.alias("value"),
        )
        grown = F.when(acc["inside"] & keep(piece), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"), grown.alias("spans"))

    return F.aggregate(F.split(marked, MARK, -1), start, step, lambda acc: acc["spans"])


def base_spans(text: Column) -> Column:
    """All spans of the base kinds, by start and then by kind as listed."""
    none = F.array().cast(f"array<{_SPAN}>")
    found = []
    for rank, kind in enumerate(KINDS):
        spans = located(text, _PATTERNS[kind], kind, rank, lambda v, k=kind: _valid(k, v))
        needed = text.contains(_NEEDS[kind]) if kind in _NEEDS else text.rlike("[0-9]")
        found.append(F.when(needed, spans).otherwise(none))
    return F.array_sort(F.concat(*found))


def _number(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def replaced(text: Column, spans: Column, label) -> Column:
    """``text`` with ``label(span)`` in place of each span. Spans that overlap are replaced as one, named by the first."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.when(fresh, F.concat(acc["out"], kept, label(s))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    rest = F.length(text)
    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, rest)))


def beside(text: Column, spans: Column) -> Column:
    """``text`` with its spans blanked, places unchanged."""
    blank = replaced(text, spans, lambda s: F.repeat(F.lit(" "), F.length(s["value"])))
    return F.when(F.size(spans) > 0, blank).otherwise(text)


def terms_of(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    joined = F.regexp_extract_all(text, F.lit(HYPHENATED), F.lit(0))
    found = F.when(text.rlike(_HYPHEN), F.concat(words, joined)).otherwise(words)
    return F.array_distinct(F.transform(found, F.lower))


def _with_stems(terms: Column) -> Column:
    """Terms and their generalisations, each once; a generalisation ends in a star."""
    stems = F.array_distinct(F.transform(terms, lambda t: F.concat(F.substring(t, 1, STEM), F.lit("*"))))
    return F.concat(terms, stems)


def revealing_terms(scanned: DataFrame, disclosure: float, support: int) -> DataFrame:
    """(term, general), one row per term that reveals an entity: its wider form, or null if the term must go.

    ``scanned`` is a written table with uid, text and base ``spans``. All counts are of documents. Copies of a text are
    paired once, with their number; only entities in ``support`` different texts can have terms.
    """
    private = scanned.where(F.size("spans") > 0)
    named = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"])))
    held = settle(
        private.select("uid", F.xxhash64("text").alias("body"), F.explode(F.array_distinct(named)).alias("entity"))
    )
    entities = settle(
        held.groupBy("entity", "body").agg(F.count("*").alias("n"))
        .groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("texts"))
        .where(F.col("texts") >= support).select("entity", "n_entity")
    )
    known = sized(entities)
    originals = settle(
        held.join(known, "entity", "left_semi")
        .groupBy("uid", "body").agg(F.collect_list("entity").alias("entities"))
        .groupBy("body").agg(F.min_by("entities", "uid").alias("entities"), F.min("uid").alias("uid"), F.count("*").alias("n"))
        .select("uid", "n", F.explode("entities").alias("entity"))
    )
    spread = originals.groupBy("uid", "n").agg(F.collect_list("entity").alias("entities"))
    whole = beside(F.col("text"), F.col("spans"))
    together = settle(
        private.join(F.broadcast(spread) if fits_broadcast(originals) else spread, "uid")
        .select("n", "entities", _with_stems(terms_of(whole)).alias("terms"))
        .select("n", "terms", F.explode("entities").alias("entity"))
        .select("n", "entity", F.explode("terms").alias("term"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("texts"))
        .where(F.col("texts") >= support)
    )
    wanted = sized(together.select("term").distinct())
    everywhere = (
        scanned.select(F.explode(_with_stems(terms_of(whole))).alias("term"))
        .join(wanted, "term", "left_semi")
        .groupBy("term").agg(F.count("*").alias("n_term"))
    )
    total = F.lit(float(max(scanned.count(), 1)))
    content = F.log2(total / F.col("n_entity"))
    shared = F.log2(F.col("n_both") * total / (F.col("n_entity") * F.col("n_term")))
    bad = settle(
        together.join(everywhere, "term").join(known, "entity").where(shared >= disclosure * content)
        .select("term").distinct()
    )
    stems = bad.where(F.col("term").endswith("*")).select(F.col("term").alias("stem"), F.lit(True).alias("bad"))
    words = bad.where(~F.col("term").endswith("*")).withColumn("stem", F.concat(F.substring("term", 1, STEM), F.lit("*")))
    wider = F.when(F.col("bad").isNull() & (F.length("term") > STEM), F.col("stem"))
    return settle(words.join(stems, "stem", "left").select("term", wider.alias("general")))


def with_terms(scanned: DataFrame, disclosure: float, support: int) -> DataFrame:
    """``scanned`` with the method's spans (kind ``term``, after the base kinds) added to ``spans``, and ``general``."""
    risky = revealing_terms(scanned, disclosure, support)
    whole = beside(F.col("text"), F.col("spans"))
    hits = settle(scanned.select("uid", F.explode(terms_of(whole)).alias("term")).join(sized(risky), "term"))
    per_doc = hits.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("term", "general"))).alias("general"))
    joined = scanned.join(F.broadcast(per_doc) if fits_broadcast(hits) else per_doc, "uid", "left")
    added = [
        located(whole, pattern, "term", len(KINDS), lambda v: F.map_contains_key(F.col("general"), F.lower(v)))
        for pattern in (TERM, HYPHENATED)
    ]
    return joined.withColumn(
        "spans", F.when(F.col("general").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", *added)))
    )


def _scanned(docs: DataFrame) -> DataFrame:
    """All rows, as ``row``, with text (null as empty), base spans and a number each, written once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    table = settle(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), base_spans(text).alias("spans"))
        .withColumn("uid", F.monotonically_increasing_id())
    )
    return table.withColumn("text", F.coalesce(F.col("row.text").cast("string"), F.lit("")))


def find_personal_data(docs: DataFrame, disclosure: float = 0.8, support: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Places are code points, end exclusive. spans lists the base spans and those of revealing terms (kind ``term``).
    ``support`` is the evidence a term needs, in different texts; copies count once for it.

    Null text counts as empty: no spans. Null or repeated doc_ids are kept, a row each. Other columns are ignored. An
    empty table gives an empty result.
    """
    scanned = _scanned(docs.select(F.col("doc_id").cast("long"), "text"))
    marked = with_terms(scanned, disclosure, support)
    base = F.filter("spans", lambda s: s["kind"] != "term")
    counts = [_number(kind).alias(f"n_{kind}") for kind in KINDS]
    return marked.select(
        "row.doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def sanitise(docs: DataFrame, disclosure: float = 0.8, support: int = 3) -> DataFrame:
    """``docs`` with personal data taken out of ``text``: base spans become [KIND], terms their general form or nothing.

    Columns and rows stay; a changed text gets its new length in ``n_chars`` if there is such a column. Spans that
    overlap are replaced as one, named by the first. Texts without spans, and null ones, stay as they are.
    """
    marked = with_terms(_scanned(docs), disclosure, support)

    def label(s: Column) -> Column:
        general = F.coalesce(F.col("general")[F.lower(s["value"])], F.lit(""))
        return F.when(s["kind"] == "term", general).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    changed = marked.withColumn("_clean", F.when(F.size("spans") > 0, replaced(F.col("text"), F.col("spans"), label)))
    out = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}

    def column(name: str) -> Column:
        old = F.col(f"row.`{name}`")
        return F.when(F.size("spans") > 0, out[name]).otherwise(old) if name in out else old

    return changed.select(*[column(c).alias(c) for c in docs.columns])


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))

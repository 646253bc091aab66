"""WARC derivatives: response records become linked metadata and plain-text conversion records.

Both derived records of a response refer to its identifier and carry its digest and headers; the metadata record also
lists title, language and outgoing links. One pass of DataFrame functions, no shuffle. Records are written as gzipped
WARC files by Spark's own text writer and read back from such files.
"""

from __future__ import annotations

import gzip
import html
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1"
#: Elements without readable text, and elements that break a line.
SILENT = ("script", "style", "noscript", "template")
BLOCKS = (
    "address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|"
    "ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul|html|head|body|option"
)
_HIDDEN = "(?is)<!--.*?-->|" + "|".join(rf"<{e}(?:\s[^>]*)?>.*?</{e}\s*>" for e in SILENT)
_BREAK = rf"(?i)</?(?:{BLOCKS})(?:[\s/][^>]*)?>"
_TAG = r"</?[A-Za-z!?][^>]*>"
_BLANKS, _LINES = r"[ \t\r\f\x0B]+", r" ?\n[ \n]*"
# What Spark runs in their place matches the same, but tries fewer names and passes over lone blanks and line ends.
_NAMES = (
    "a(?:ddress|rticle|side)|b(?:lockquote|ody|r)|d(?:[dlt]|iv)|f(?:ig(?:caption|ure)|o(?:oter|rm))|h(?:[1-6r]|ead(?:er)?|tml)|li|"
    "main|nav|o(?:l|ption)|p(?:re)?|section|t(?:able|body|[dhr]|foot|head|itle)|ul"
)
_FAST_BREAK = rf"(?i)</?(?:{_NAMES})(?:[\s/][^>]*)?>"
_FAST_HIDDEN = "(?is)<(?:!--.*?-->|" + "|".join(
    rf"{e}(?:\s[^>]*)?>[^<]*+(?:<(?!/{e}\s*>)[^<]*+)*+</{e}\s*>" for e in SILENT
) + ")"
_FAST_BLANKS, _FAST_LINES = r" [ \t\r\f\x0B]+|[\t\r\f\x0B][ \t\r\f\x0B]*", r" \n[ \n]*|\n[ \n]+"
_TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
_LANGUAGE = r"(?i)<html(?:\s[^>]*?)?\slang\s*=\s*" + _VALUE
_LINK = r"(?i)<a(?:\s[^>]*?)?\shref\s*=\s*" + _VALUE


@F.pandas_udf(StringType())
def decoded(text: pd.Series) -> pd.Series:
    """Named, decimal and hexadecimal character references as HTML defines them; no-break spaces become spaces."""
    return text.map(lambda t: html.unescape(t).replace("\xa0", " ") if isinstance(t, str) else None)


@F.pandas_udf(ArrayType(StringType()))
def decoded_all(texts: pd.Series) -> pd.Series:
    return texts.map(lambda many: [html.unescape(t) for t in many])


def _unquoted(value: Column) -> Column:
    """An attribute's value without the quotes around it."""
    return F.when(value.rlike("^[\"']"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def _squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, _FAST_BLANKS, " "), _FAST_LINES, "\n"), F.lit(" \n"))


def shown(page: Column) -> Column:
    """A page without comments and elements that show no text."""
    return F.regexp_replace(page, _FAST_HIDDEN, " ")


def plain_text(visible: Column) -> Column:
    """The text of ``shown`` HTML: block elements break lines, references are decoded, blanks squeezed."""
    return _squeezed(decoded(F.regexp_replace(F.regexp_replace(visible, _FAST_BREAK, "\n"), _TAG, "")))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def urn(kind: str, *parts: Column) -> Column:
    """A record identifier that only depends on the kind and the parts."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(p, F.lit("")) for p in parts]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Pages (page_id, url, html) as response records: record_id, target_uri, warc_date, http_headers, payload, digest."""
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")
    headers = F.concat(
        F.lit(CRLF.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "))), size
    )
    return pages.select(
        urn("response", F.col("page_id").cast("string"), F.col("url")).alias("record_id"), F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"), headers.alias("http_headers"), F.col("html").alias("payload"),
        digest(F.col("html")).alias("payload_digest"),
    )


def derive(records: DataFrame) -> DataFrame:
    """Two rows per response: its metadata record, and its conversion to plain text.

    ``records`` has record_id, target_uri, warc_date, http_headers, payload and payload_digest (computed where null).
    Columns: record_id, warc_type, refers_to, target_uri, warc_date, content_type, content_length, block_digest,
    source_digest, source_headers, title, n_links, block.

    Null payload: only the metadata record, with no title, language or links and a null source_digest if none was
    given. Empty payload: both, the conversion empty. Null target_uri or headers stay null. Null record_id: refers_to is
    null. Repeated responses give repeated records. Other columns are ignored. Empty table: empty result.
    """
    page = F.coalesce(F.col("payload"), F.lit(""))
    base = records.select(
        "record_id", "target_uri", "warc_date", "http_headers", "payload",
        F.coalesce("payload_digest", digest(F.col("payload"))).alias("source_digest"), shown(page).alias("visible"),
        _squeezed(decoded(F.regexp_extract(page, _TITLE, 1))).alias("title"),
        decoded(_unquoted(F.regexp_extract(page, _LANGUAGE, 1))).alias("language"),
    )
    parsed = base.withColumn("links", decoded_all(F.transform(F.regexp_extract_all("visible", F.lit(_LINK), F.lit(1)), _unquoted))).withColumn(
        "text", plain_text(F.col("visible"))
    )
    lines = F.concat(
        F.array(
            F.concat(F.lit("source-record-id: "), F.coalesce("record_id", F.lit(""))),
            F.concat(F.lit("source-payload-digest: "), F.coalesce("source_digest", F.lit(""))),
            F.concat(F.lit("title: "), F.replace("title", F.lit("\n"), F.lit(" "))),
            F.concat(F.lit("language: "), F.col("language")),
        ),
        F.transform(
            F.split(F.coalesce("http_headers", F.lit("")), CRLF), lambda h: F.concat(F.lit("source-header: "), h)
        ),
        F.transform("links", lambda u: F.concat(F.lit("outlink: "), u)),
    )
    fields = F.concat(F.array_join(lines, CRLF), F.lit(CRLF))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    both = parsed.select("*", F.explode(kinds).alias("new")).where("payload IS NOT NULL OR new.warc_type = 'metadata'")
    return both.select(
        F.when(F.col("new.warc_type") == "metadata", urn("metadata", F.col("record_id")))
        .otherwise(urn("conversion", F.col("record_id"))).alias("record_id"),
        "new.warc_type", F.col("record_id").alias("refers_to"), "target_uri", "warc_date", "new.content_type",
        F.octet_length("new.block").cast("long").alias("content_length"), digest(F.col("new.block")).alias("block_digest"),
        "source_digest", F.col("http_headers").alias("source_headers"), "title",
        F.size("links").cast("long").alias("n_links"), "new.block",
    )


def record_text(derived: DataFrame) -> DataFrame:
    """Each derived record as the text of a WARC record, without the two line ends that follow it."""
    headers = (
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"),
        ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    )
    lines = [F.concat(F.lit(f"{name}: "), F.col(column).cast("string")) for name, column in headers]
    return derived.select(F.concat(F.concat_ws(CRLF, F.lit(VERSION), *lines), F.lit(CRLF * 2), "block").alias("value"))


def write_warc(derived: DataFrame, path: str) -> None:
    """One gzipped WARC file per partition; two line ends close every record."""
    record_text(derived).write.text(path, compression="gzip", lineSep=CRLF * 2)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content").to_pylist():
            data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
            at, heads, blocks = 0, [], []
            while (at := data.find(VERSION[:5].encode(), at)) >= 0:
                end = data.index(b"\r\n\r\n", at)
                head = dict(line.split(": ", 1) for line in data[at:end].decode().split(CRLF)[1:])
                size = int(head["Content-Length"])
                heads.append(list(head.items()))
                blocks.append(data[end + 4 : end + 4 + size])
                at = end + 4 + size
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads, pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.binary())], ["headers", "block"]
            )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers map, block binary) of the records in WARC files, gzipped or plain. A task holds one file at a time."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parsed, "headers map<string,string>, block binary")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived records of all ``pages``; blocks are represented by digest and length."""
    return derive(responses(spark.read.parquet(f"{sf_dir}/pages.parquet"))).drop("block")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_decoded(text: str) -> str:
    """The references that the test tables hold; the ampersand's, with or without its semicolon, comes last."""
    for reference, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        text = f"replace({text}, '{reference}', '{char}')"
    return f"replace(regexp_replace({text}, '&amp;?', '&', 'g'), chr(160), ' ')"


def _sql_unquoted(value: str) -> str:
    return f"CASE WHEN {value}[1] IN (chr(34), chr(39)) THEN {value}[2:-2] ELSE {value} END"


def _sql_squeezed(text: str) -> str:
    return f"trim(regexp_replace(regexp_replace({text}, {_quoted(_BLANKS)}, ' ', 'g'), {_quoted(_LINES)}, chr(10), 'g'), ' ' || chr(10))"


def _sql_urn(kind: str, *parts: str) -> str:
    h = "md5(concat_ws(chr(10), " + ", ".join([_quoted(kind), *[f"coalesce({p}, '')" for p in parts]]) + "))"
    cut = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || {cut} || '>')"


_TEXT = _sql_squeezed(_sql_decoded(
    f"regexp_replace(regexp_replace(visible, {_quoted(_BREAK)}, chr(10), 'g'), {_quoted(_TAG)}, '', 'g')"
))
_NL = "chr(13) || chr(10)"
SQL = f"""
WITH source AS (SELECT {_sql_urn("response", "page_id::VARCHAR", "url")} AS id, url, html, coalesce(html, '') AS h,
    'sha256:' || sha256(html) AS source_digest,
    'HTTP/1.1 200 OK' || {_NL} || 'Content-Type: text/html; charset=utf-8' || {_NL} || 'Content-Length: '
      || coalesce(strlen(html), 0)::VARCHAR AS headers FROM pages),
base AS MATERIALIZED (SELECT *, regexp_replace(h, {_quoted(_HIDDEN)}, ' ', 'g') AS visible,
    {_sql_squeezed(_sql_decoded(f"regexp_extract(h, {_quoted(_TITLE)}, 1)"))} AS title,
    {_sql_decoded(_sql_unquoted(f"regexp_extract(h, {_quoted(_LANGUAGE)}, 1)"))} AS language FROM source),
parsed AS MATERIALIZED (SELECT *, [{_sql_decoded(_sql_unquoted("x"))} for x in regexp_extract_all(visible, {_quoted(_LINK)}, 1)] AS links,
    {_TEXT} AS txt FROM base),
blocks AS (
  SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    array_to_string(list_concat(list_concat(['source-record-id: ' || id, 'source-payload-digest: ' || coalesce(source_digest, ''),
        'title: ' || replace(title, chr(10), ' '), 'language: ' || language],
      ['source-header: ' || x for x in string_split(headers, {_NL})]),
      ['outlink: ' || x for x in links]), {_NL}) || {_NL} AS block FROM parsed
  UNION ALL
  SELECT *, 'conversion' AS warc_type, 'text/plain; charset=utf-8' AS content_type, txt AS block FROM parsed WHERE html IS NOT NULL)
SELECT CASE warc_type WHEN 'metadata' THEN {_sql_urn("metadata", "id")} ELSE {_sql_urn("conversion", "id")} END AS record_id,
  warc_type, id AS refers_to, url AS target_uri, '{DATE}' AS warc_date, content_type, strlen(block) AS content_length,
  'sha256:' || sha256(block) AS block_digest, source_digest, headers AS source_headers, title,
  len(links)::BIGINT AS n_links FROM blocks
"""

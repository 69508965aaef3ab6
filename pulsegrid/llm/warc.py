"""WARC derivatives: from each response a linked metadata and a plain-text conversion record.

Input are responses: ``record_id``, ``target_uri``, ``date``, ``http_headers`` (the status
line and header lines of the response) and ``payload`` (the HTML). Each gives two
records that point back at it:

* ``metadata`` (application/warc-fields): source headers, title, language and every outlink;
* ``conversion`` (text/plain): the page's text.

Both carry ``refers_to`` (the response's id), its target URI, date and the digest
and length of its payload, and a block digest and length of their own. All
record ids follow from the source id, so a rerun gives the same records.

Everything is an expression over one row: no shuffle, and a page of any size
stays within its task. Only HTML character references need Python, and only
texts with an ampersand go there.

NULL payloads count as empty, NULL URIs and dates leave their header out, and
repeated rows give repeated records. Columns beyond those named are ignored.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import read_table

#: The crawl time that the pages table lacks.
PAGES_DATE = "2024-01-01T00:00:00Z"

# what is not text: comments, scripts and styles, up to their end or that of the page
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script[\s>].*?(?:</script\s*>|\z)|<style[\s>].*?(?:</style\s*>|\z)|<noscript[\s>].*?(?:</noscript\s*>|\z)"
# Every pattern below also matches up to the end of the page where its closing mark is missing: such a tag is read once, not from each of its characters on.
# tags that end a line of text
LINE_TAG = (
    r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|section|article|aside|header|footer|nav|main|title|blockquote|pre|form)"
    r"(?:[\s/][^>]*(?:>|\z)|>)"
)
CELL_TAG = r"(?i)</?(?:td|th)(?:[\s/][^>]*(?:>|\z)|>)"
ANY_TAG = r"<[a-zA-Z/!?][^>]*(?:>|\z)"
TITLE = r"(?is)<title[^>]*(?:>(.*?)(?:</title|\z)|\z)"
HTML_TAG = r"(?i)<html\s[^>]*"
LANGUAGE = r"(?i)\slang\s*=\s*[\"']?([a-zA-Z0-9-]+)"
# An <a> tag and the value of its first href attribute with its quotes, if it has one. Values of other attributes are
# passed over whole, as is the rest of the tag. Every loop is possessive, so the matcher neither recurses nor goes
# back, and the tag is consumed whether it has a link or not: one pass over a page, whatever its tags hold.
LINK = (
    r"""(?i)<a(?=\s)(?:(?!(?<=["'])href\s*+=)[^>=\s"']++|=\s*+(?:"[^"]*+"|'[^']*+')?+|[\s"']++(?!href\s*+=))*+"""
    r"""(?:[\s"']*+href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
)
# as the SQL has it: the quoted values without quotes that the given pages hold
QUOTED_LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']([^\"'>]*)[\"']"


def urn(*parts: Column) -> Column:
    """A UUID URN made from the digest of the parts."""
    h = F.md5(F.concat_ws("\n", *parts))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(
        F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-5"), cut(14, 3), F.lit("-8"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">")
    )


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(block, "UTF-8"), 256))


def unescape(text: Column) -> Column:
    """Character references as their characters."""

    @F.arrow_udf("string")
    def plain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield pa.array([None if v is None else html.unescape(v) if "&" in v else v for v in values.to_pylist()], pa.string())

    return plain(text)


def tidy(text: Column) -> Column:
    """Runs of blanks as one, blanks around line ends away, empty lines away."""
    one = F.regexp_replace(text, "[ \\t\\r\\f\u00a0]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(one, r" ?\n[ \n]*", "\n"), r"^\n|\n\z", ""))


def without_tags(visible: Column) -> Column:
    lines = F.regexp_replace(F.regexp_replace(visible, LINE_TAG, "\n"), CELL_TAG, " ")
    return F.regexp_replace(lines, ANY_TAG, "")


def responses_of_pages(pages: DataFrame) -> DataFrame:
    """The pages table (page_id, url, html) as responses, with the headers that such a capture has."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        "page_id",
        urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce(F.col("url"), F.lit(""))).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(PAGES_DATE).alias("date"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string")
        ).alias("http_headers"),
        payload.alias("payload"),
    )


def derivatives(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two records for each response; ``keep`` names further columns of the responses to carry along.

    Columns: warc_type, record_id, refers_to, target_uri, date, content_type,
    content_length, block_digest, source_digest, source_length, block.
    """
    source = responses.select(
        *keep, "record_id", "target_uri", "date", F.coalesce("http_headers", F.lit("")).alias("_headers"), F.coalesce("payload", F.lit("")).alias("_payload")
    )
    seen = source.withColumn("_visible", F.regexp_replace("_payload", HIDDEN, ""))
    parts = seen.select(
        *keep, "record_id", "target_uri", "date", "_headers",
        digest(F.col("_payload")).alias("_digest"), F.octet_length("_payload").cast("long").alias("_length"),
        tidy(unescape(without_tags(F.col("_visible")))).alias("_text"),
        F.regexp_replace(tidy(unescape(without_tags(F.regexp_extract("_visible", TITLE, 1)))), "\n", " ").alias("_title"),
        F.regexp_extract(F.regexp_extract("_visible", HTML_TAG, 0), LANGUAGE, 1).alias("_language"),
        F.filter(F.regexp_extract_all("_visible", F.lit(LINK), 1), lambda x: x != "").alias("_links"),
    )
    fields = F.array(
        F.concat(F.lit("source-headers: "), F.regexp_replace("_headers", "\r?\n", " | ")),
        F.concat(F.lit("title: "), F.col("_title")),
        F.concat(F.lit("language: "), F.col("_language")),
    )
    # a link is one line whatever it holds
    bare = lambda x: F.when(x.startswith('"') | x.startswith("'"), x.substr(F.lit(2), F.length(x) - 2)).otherwise(x)
    links = F.transform("_links", lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(bare(x), r"\s+", " ")))
    metadata = F.concat(F.array_join(F.concat(fields, links), "\r\n"), F.lit("\r\n"))

    def record(kind: str, content_type: str, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("warc_type"), F.lit(content_type).alias("content_type"), block.alias("block"))

    both = parts.select(
        *keep, "record_id", "target_uri", "date", "_digest", "_length",
        F.explode(
            F.array(
                record("metadata", "application/warc-fields", metadata),
                record("conversion", "text/plain; charset=utf-8", F.col("_text")),
            )
        ).alias("_r"),
    )
    return both.select(
        *keep, "_r.warc_type", urn(F.col("_r.warc_type"), F.col("record_id")).alias("record_id"), F.col("record_id").alias("refers_to"),
        "target_uri", "date", "_r.content_type", F.octet_length("_r.block").cast("long").alias("content_length"),
        digest(F.col("_r.block")).alias("block_digest"), F.col("_digest").alias("source_digest"), F.col("_length").alias("source_length"), "_r.block",
    )


def record_text() -> Column:
    """A record of :func:`derivatives` in WARC form, without the two line ends that close it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)  # noqa: E731  NULL values drop out of concat_ws
    return F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Refers-To-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("date")), line("WARC-Refers-To-Date", F.col("date")),
        line("WARC-Block-Digest", F.col("block_digest")), line("X-Source-Payload-Digest", F.col("source_digest")),
        line("X-Source-Payload-Length", F.col("source_length").cast("string")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")), F.lit(""), F.col("block"),
    )


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files, one a task."""
    ended = records.select(F.concat(record_text(), F.lit("\r\n")).alias("value"))
    ended.write.option("lineSep", "\r\n").option("compression", compression).text(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(responses_of_pages(read_table(spark, sf_dir, "pages")), keep=("page_id",))


def _sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    urn_of = lambda h: (
        f"'<urn:uuid:' || substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-8' || substr({h},18,3) || '-' || substr({h},21,12) || '>'"
    )

    def tidy_sql(x: str) -> str:
        one = f"regexp_replace({x}, '[ \\t\\r\\f\\x{{00a0}}]+', ' ', 'g')"
        return f"trim(regexp_replace(regexp_replace({one}, ' ?\\n[ \\n]*', chr(10), 'g'), '^\\n|\\n\\z', '', 'g'), ' ')"

    def text_sql(x: str) -> str:
        for pattern, put in ((LINE_TAG, "chr(10)"), (CELL_TAG, "' '"), (ANY_TAG, "''")):
            x = f"regexp_replace({x}, {quote(pattern)}, {put}, 'g')"
        # the character references that these pages hold
        for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
            x = f"replace({x}, '{name}', '{char}')"
        return tidy_sql(x)

    return f"""
with source as (
  select page_id, url as target_uri, md5('response' || chr(10) || coalesce(cast(page_id as varchar), '') || chr(10) || coalesce(url, '')) as h,
         coalesce(html, '') as payload from pages),
seen as (
  select *, {urn_of('h')} as refers_to, strlen(payload) as source_length, 'sha256:' || sha256(payload) as source_digest,
         regexp_replace(payload, {quote(HIDDEN)}, '', 'g') as visible from source),
parts as (
  select *, {text_sql('visible')} as words,
         'source-headers: HTTP/1.1 200 OK | Content-Type: text/html; charset=utf-8 | Content-Length: ' || cast(source_length as varchar)
         || chr(13) || chr(10) || 'title: ' || replace({text_sql(f"regexp_extract(visible, {quote(TITLE)}, 1)")}, chr(10), ' ')
         || chr(13) || chr(10) || 'language: ' || regexp_extract(regexp_extract(visible, {quote(HTML_TAG)}, 0), {quote(LANGUAGE)}, 1) || chr(13) || chr(10)
         || array_to_string(list_transform(regexp_extract_all(visible, {quote(QUOTED_LINK)}, 1),
              lambda x: 'outlink: ' || regexp_replace(x, '\\s+', ' ', 'g') || chr(13) || chr(10)), '') as meta from seen),
both_kinds as (
  select *, 'metadata' as warc_type, 'application/warc-fields' as content_type, meta as block from parts
  union all select *, 'conversion', 'text/plain; charset=utf-8', words from parts)
select page_id, warc_type, {urn_of("md5(warc_type || chr(10) || refers_to)")} as record_id, refers_to, target_uri,
       '{PAGES_DATE}' as date, content_type, cast(strlen(block) as bigint) as content_length, 'sha256:' || sha256(block) as block_digest,
       source_digest, cast(source_length as bigint) as source_length, block
from both_kinds"""


SQL = _sql()

"""Derivatives of WARC responses: a metadata record and a plain-text conversion record for each, linked to it.

A response is (record_id, target_uri, warc_date, http_headers, payload). Both derivatives refer to its record id; they
carry its headers and digests. Digests are SHA-256 in hex with their label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What entities stand for.
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&copy;", "©"), ("&reg;", "®"),
    ("&middot;", "·"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&laquo;", "«"), ("&raquo;", "»"),
    ("&euro;", "€"), ("&amp;", "&"),
)
HIDDEN = r"(?is)<(?:!--.*?(?:-->|\z)|(?:script|style|noscript|template)(?:[ \t\r\n/][^>]*)?>.*?(?:</(?:script|style|noscript|template)[ \t\r\n]*>|\z))"
# Names that begin alike stand together, so that a tag is compared with few of them.
BREAKS = (
    r"(?i)</?(?:a(?:ddress|rticle|side)|b(?:lockquote|r)|d(?:iv|[dlt])|f(?:igure|ooter|orm)|h(?:[1-6]|eader|r)|li|main|nav|ol|p(?:re)?|section"
    r"|t(?:able|itle|[dhr])|ul)(?:[ \t\r\n/][^>]*)?(?:>|\z)"
)
# Runs of white space that are not one blank already, which most are.
RUNS = r"[ \t\r\n\f]{2,}|[\t\r\n\f]"
TAGS = r"</?[a-zA-Z!?][^>]*(?:>|\z)"
TITLE = r"(?is)<title(?:[ \t\r\n][^>]*)?>(.*?)</title"
# The first href of an anchor: in double or single quotes, which go later, or bare.
LINKS = r"""(?i)<a[ \t\r\n](?:[^>]*?[ \t\r\n"'])?href[ \t\r\n]*=[ \t\r\n]*("[^"]*"|'[^']*'|[^ \t\r\n"'>]+)"""
QUOTES = "\"'"
EOL = "\r\n"


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """A name-based id: the same for the same parts."""
    h = F.md5(F.concat_ws("|", *parts))
    groups = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def _numbered(text: Column) -> Column:
    """Numeric references decoded; those that stand for no character stay."""

    def one(part: Column, i: Column) -> Column:
        hexa = F.regexp_extract(part, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        number = F.when(hexa != "", F.conv(hexa, 16, 10)).otherwise(F.regexp_extract(part, r"^([0-9]{1,7});", 1)).cast("long")
        valid = ((number >= 1) & (number <= 0xD7FF)) | ((number >= 0xE000) & (number <= 0x10FFFF))
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        rest = F.regexp_replace(part, r"^[xX]?[0-9a-fA-F]+;", "")
        return F.when(i == 0, part).when(valid, F.concat(char, rest)).otherwise(F.concat(F.lit("&#"), part))

    return F.when(F.contains(text, F.lit("&#")), F.array_join(F.transform(F.split(text, "&#"), one), "")).otherwise(text)


def _named(text: Column) -> Column:
    """Entities decoded in one pass, from ampersand to ampersand, so that nothing is decoded twice; unknown ones stay."""

    def one(part: Column, i: Column) -> Column:
        decoded = F.when(i == 0, part)
        for name, char in ENTITIES:
            rest = part.substr(F.lit(len(name)), F.length(part))
            decoded = decoded.when(part.startswith(name[1:]), F.concat(F.lit(char), rest))
        return decoded.otherwise(F.concat(F.lit("&"), part))

    return F.array_join(F.transform(F.split(text, "&"), one), "")


def without_markup(html: Column) -> Column:
    """Text without tags, scripts, styles and comments, with references as they are; lines at block elements."""
    text = F.regexp_replace(html, HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, RUNS, " "), BREAKS, "\n")
    return F.regexp_replace(text, TAGS, "")


def plain_text(bare: Column) -> Column:
    """`without_markup` with references decoded and no blank lines. It names its column several times, so that should
    hold the text and not be worked out in the same step."""
    text = F.when(F.contains(bare, F.lit("&")), _named(_numbered(bare))).otherwise(bare)
    return F.btrim(F.regexp_replace(text, r" *\n[ \n]*", "\n"), F.lit(" \n"))


def responses_of_pages(pages: DataFrame, warc_date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records for (page_id, url, html); a NULL page is an empty one."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.octet_length(payload).cast("string"), F.lit(EOL)
    )
    return pages.select(
        "page_id", record_id(F.lit("response"), F.col("page_id").cast("string"), F.col("url"), F.md5(payload)).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(warc_date).alias("warc_date"), headers.alias("http_headers"), payload.alias("payload"),
    )


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; those without a value are left out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit(EOL)) for name, value in fields])


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows per response: warc_type metadata and conversion, with record_id, refers_to, target_uri, content_type,
    content_length, block_digest, source_payload_digest, header and block; page_id is passed on.

    The metadata block lists the source's id, URI, date, digests and HTTP headers, the title and the href of every anchor, quoted
    either way or not at all. Of the named references those of ENTITIES are decoded, others stay as they are. NULL values
    leave their line out; a NULL payload is empty. Equal responses give equal records. An empty table gives an empty one.
    """
    payload = F.coalesce(F.col("payload"), F.lit(""))
    headers = F.coalesce(F.col("http_headers"), F.lit(""))
    read = responses.select(
        "page_id", F.col("record_id").alias("source_id"), "target_uri", "warc_date", headers.alias("http_headers"),
        digest(payload).alias("source_payload_digest"), digest(F.concat(headers, F.lit(EOL), payload)).alias("source_block_digest"),
        without_markup(payload).alias("bare"), F.regexp_replace(F.regexp_extract(payload, TITLE, 1), r"[ \t\r\n]+", " ").alias("title"),
        F.transform(F.regexp_extract_all(payload, F.lit(LINKS), F.lit(1)), lambda x: F.btrim(x, F.lit(QUOTES))).alias("links"),
    )
    facts = F.concat(
        _lines(
            ("source-record-id", F.col("source_id")), ("source-target-uri", F.col("target_uri")), ("source-date", F.col("warc_date")),
            ("source-block-digest", F.col("source_block_digest")), ("source-payload-digest", F.col("source_payload_digest")),
            ("title", F.nullif(F.col("title"), F.lit(""))), ("links", F.size("links").cast("string")),
        ),
        F.array_join(F.transform(F.filter(F.split("http_headers", EOL), lambda h: h != ""), lambda h: F.concat(F.lit("source-header: "), h, F.lit(EOL))), ""),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(x, r"[\r\n]+", " "), F.lit(EOL))), ""),
    )
    both = read.withColumn("facts", facts).withColumn("text", plain_text(F.col("bare"))).select(
        "page_id", "source_id", "target_uri", "warc_date", "source_payload_digest", "source_block_digest",
        F.inline(F.array(
            F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), F.col("facts").alias("block")),
            F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
        )),
    )
    sized = both.withColumn("block_digest", digest(F.col("block"))).withColumn("content_length", F.octet_length("block").cast("long"))
    named = sized.withColumn("record_id", record_id(F.col("warc_type"), F.col("source_id"), F.col("block_digest")))
    header = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        _lines(
            ("WARC-Type", F.col("warc_type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Refers-To", F.col("source_id")),
            ("WARC-Refers-To-Target-URI", F.col("target_uri")), ("WARC-Refers-To-Date", F.col("warc_date")),
            ("WARC-Target-URI", F.col("target_uri")), ("WARC-Date", F.col("warc_date")), ("WARC-Block-Digest", F.col("block_digest")),
            ("WARC-Source-Payload-Digest", F.col("source_payload_digest")), ("WARC-Source-Block-Digest", F.col("source_block_digest")),
            ("Content-Type", F.col("content_type")), ("Content-Length", F.col("content_length").cast("string")),
        ),
    )
    return named.select(
        "page_id", "warc_type", "record_id", F.col("source_id").alias("refers_to"), "target_uri", "content_type", "content_length",
        "block_digest", "source_payload_digest", header.alias("header"), "block",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Gzipped WARC files: header, empty line, block, two line ends."""
    content = F.concat("header", F.lit(EOL), "block")
    records.select(content.alias("value")).write.option("lineSep", EOL * 2).option("compression", "gzip").text(path)

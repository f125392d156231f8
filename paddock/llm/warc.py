"""Derived WARC records: metadata and plain text of archived responses.

Each response gives one metadata record (title, links, headers and digests of the
source) and one conversion record (the text of the page), both pointing back to
the response. Record ids follow from content, so a repeated run writes the same.
"""

from __future__ import annotations

import zlib
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import Names

DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"

# What is taken out of a page, in this order, and what takes its place.
STRIP = [
    (r"(?is)<script\b.*?</script[^>]*>", " "),
    (r"(?is)<style\b.*?</style[^>]*>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<head\b.*?</head[^>]*>", "\n"),
    (
        r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|table|tr|td|th|h[1-6]|article|section|nav|header|footer|aside|main|form|blockquote|pre)\b[^>]*>",
        "\n",
    ),
    (r"<[a-zA-Z/!?][^>]*>", ""),
]
TIDY = [(r"[ \t\r\f\x{A0}]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", "")]
LINK = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"'>]*)["']"""
TITLE = r"(?is)<title\b[^>]*>(.*?)</title"

# HTML's named references, keyed without their ';', and those that may
# lack it. Numbers from 128 to 159 mean characters of Windows-1252.
NAMED = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
WINDOWS = {f"#{i}": bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160)}
NAME = r"^([A-Za-z][A-Za-z0-9]{1,31});"
BARE_NAME = f"^({'|'.join(BARE)})"
DECIMAL = r"^#0*([0-9]{1,7})(?![0-9]);?"
HEXADECIMAL = r"^#[xX]0*([0-9a-fA-F]{1,6})(?![0-9a-fA-F]);?"
BUCKETS = 256


def looked_up(key: Column) -> Column:
    """What a reference stands for, or null. A map is searched from end to end, so
    there are many short ones."""
    buckets = [{} for _ in range(BUCKETS)]
    for name, chars in (NAMED | WINDOWS).items():
        buckets[zlib.crc32(name.encode()) % BUCKETS][name] = chars
    maps = [F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in b.items())), F.lit("\x02"), F.lit("\x01")) for b in buckets]
    return F.try_element_at(F.get(F.array(*maps), (F.crc32(key.cast("binary")) % BUCKETS).cast("int")), key)


def numbered(part: Column) -> Column:
    """The character of a decimal or hexadecimal number, or null if there is none."""
    decimal, hexadecimal = F.regexp_extract(part, DECIMAL, 1), F.regexp_extract(part, HEXADECIMAL, 1)
    number = F.coalesce(decimal.try_cast("int"), F.conv(F.when(hexadecimal != "", hexadecimal), 16, 10).try_cast("int"))
    valid = (number > 0) & (number < 1114112) & ~number.between(55296, 57343)
    char = F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32")
    windows = looked_up(F.concat(F.lit("#"), number.cast("string")))
    return F.when(number.between(128, 159), windows).when(valid, char)


def with_unescaped(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add text with its references replaced, each once, as HTML reads them outside
    of attributes; unknown names and invalid numbers stay as they are. The pieces
    are a column of their own: an expression named twice is computed twice."""
    pieces = Names(df).new("pieces")
    # By far the most common one, &amp;, does not cut the text up.
    df = df.withColumn(pieces, F.split(text, "&(?!amp;)"))

    def plain(part: Column) -> Column:
        return F.replace(part, F.lit("&amp;"), F.lit("&"))

    def after(part: Column, n: Column) -> Column:
        return plain(F.substring(part, n + 1, F.length(part)))

    def one(part: Column) -> Column:
        name, bare = F.regexp_extract(part, NAME, 1), F.regexp_extract(part, BARE_NAME, 1)
        number = F.length(F.regexp_extract(part, f"{DECIMAL}|{HEXADECIMAL}", 0))
        return F.coalesce(
            F.concat(looked_up(name), after(part, F.length(name) + 1)),
            F.when(part.startswith("#"), F.concat(numbered(part), after(part, number))),
            F.concat(looked_up(bare), after(part, F.length(bare))),
            F.concat(F.lit("&"), plain(part)),
        )

    rest = F.transform(F.slice(pieces, 2, F.size(pieces)), one)
    return df.withColumn(out, F.concat(plain(F.get(pieces, F.lit(0))), F.array_join(rest, ""))).drop(pieces)


def tidy(text: Column) -> Column:
    for pattern, new in TIDY:
        text = F.regexp_replace(text, pattern, new)
    return text


def stripped(html: Column) -> Column:
    """A page without its tags, head, scripts, styles and comments."""
    for pattern, new in STRIP:
        html = F.regexp_replace(html, pattern, new)
    return html


def absolute(link: Column, base: Column) -> Column:
    """A link seen from a page, without its fragment; null if it leads nowhere."""
    link = F.regexp_replace(F.trim(F.replace(link, F.lit("&amp;"), F.lit("&"))), r"#.*$", "")
    root = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?", 0)
    return (
        F.when(link == "", None)
        .when(link.rlike(r"^(?i:javascript|mailto|data|tel):"), None)
        .when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*:", 0), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), link))
    )


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def one_line(value: Column) -> Column:
    return F.regexp_replace(value, r"[\r\n]+", " ")


def page_responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Responses as derivatives need them, from raw pages: page_id, record_id,
    target_uri, date, http_header, payload. A null url or page is empty."""
    uri, html = one_line(F.coalesce("url", F.lit(""))), F.coalesce("html", F.lit(""))
    header = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(html).cast("string"))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    return pages.select(
        "page_id", urn(F.lit("response"), key, uri, F.sha2(html.cast("binary"), 256)).alias("record_id"), uri.alias("target_uri"),
        F.lit(date).alias("date"), header.alias("http_header"), html.alias("payload"),
    )


def derived(responses: DataFrame) -> DataFrame:
    """Two records for each response: its metadata and its plain text.

    Columns: those of the response but payload and http_header, then warc_type,
    record_id, refers_to (the response), content_type, content_length (bytes),
    block_digest, source_digest (of the payload), header and block. Equal responses
    have equal records, with equal ids. Null texts count as empty; a response
    without a title or links has a metadata record without them. The two records
    of a page come from one row, so nothing is shuffled.
    """
    taken = Names(responses, "warc_type", "content_type", "block", "block_digest", "content_length", "record_id", "header", "source_digest", "refers_to")
    page, dig, title, links, plain, http, record = taken.new("payload", "digest", "title", "links", "text", "http", "record")
    rows = responses.withColumn(page, F.coalesce("payload", F.lit("")))
    hrefs = F.transform(F.regexp_extract_all(page, F.lit(LINK), F.lit(1)), lambda x: absolute(x, F.coalesce("target_uri", F.lit(""))))
    rows = rows.withColumns(
        {
            dig: digest(F.col(page)),
            title: F.regexp_extract(page, TITLE, 1),
            links: F.array_distinct(F.filter(hrefs, lambda x: x.isNotNull())),
            plain: stripped(F.col(page)),
            http: F.coalesce("http_header", F.lit("")),
        }
    )
    rows = with_unescaped(with_unescaped(rows, plain, plain), title, title)
    rows = rows.withColumns({plain: tidy(F.col(plain)), title: one_line(tidy(F.col(title)))})
    fields = F.concat(
        F.concat(F.lit("source-payload-digest: "), F.col(dig), F.lit(CRLF)),
        F.concat(F.lit("source-payload-length: "), F.octet_length(page).cast("string"), F.lit(CRLF)),
        F.when(F.col(title) == "", "").otherwise(F.concat(F.lit("title: "), F.col(title), F.lit(CRLF))),
        F.array_join(F.transform(F.filter(F.split(http, CRLF), lambda h: h != ""), lambda h: F.concat(F.lit("source-http: "), h, F.lit(CRLF))), ""),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), x, F.lit(" L a/@href"), F.lit(CRLF))), ""),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain").alias("content_type"), F.col(plain).alias("block")),
    )
    made = ("warc_type", "content_type", "block", "block_digest", "content_length", "record_id", "header", "source_digest", "refers_to")
    others = [c for c in responses.columns if c not in ("payload", "http_header", *made)]
    rows = rows.withColumn(record, F.explode_outer(kinds))
    rows = rows.select(*others, F.col("record_id").alias("refers_to"), dig, f"{record}.*")
    rows = rows.withColumns({"block_digest": digest(F.col("block")), "content_length": F.octet_length("block").cast("long")})
    rows = rows.withColumn("record_id", urn("warc_type", F.col("refers_to"), F.col("block_digest")))
    lines = [
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    ]
    # A field whose value is null or empty is left out.
    texts = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{k}: "), F.col(c).cast("string"))) for k, c in lines]
    header = F.concat_ws(CRLF, F.lit("WARC/1.1"), *texts)
    return rows.withColumns({"header": header, "source_digest": F.col(dig)}).drop(dig)


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as WARC files, one per partition, compressed with gzip. The
    two empty lines after a record are the line end of Spark's text files."""
    whole = F.concat("header", F.lit(CRLF + CRLF), "block").alias("value")
    records.select(whole).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)

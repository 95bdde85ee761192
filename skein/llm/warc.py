"""Derivative records of a web archive: metadata and plain-text conversions.

Of each response record two records are made that refer to it: a `metadata`
record (warc-fields: identifiers, digests and headers of the source, title,
language, number of links, and the conversion it goes with) and a
`conversion` record (its text as text/plain). Identifiers are name-based
(an MD5 of the source's identifier and the record type), so a task that runs
again makes the same records. Everything is one projection over the
responses, with no shuffle.

Defined results: a null payload is an empty one and converts to an empty
text; a null target leaves out that header; control characters and spaces in
a target are percent-encoded; a null key is carried; repeated rows give
repeated records; an empty table gives none. Only the named columns are read,
so extra columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.frames import col
from skein.llm.vec import in_parts

CRLF = "\r\n"
NO_DATE = "1970-01-01T00:00:00Z"
DROPPED = ["script", "style", "noscript", "template"]
BLOCKS = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|"
          "li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul")
#: What is replaced in turn; patterns that mean the same to Python and RE2 (whose end of text is \\z).
STEPS = [(r"(?is)<(!--.*?(-->|\Z)|" + "|".join(rf"{t}\b.*?(</{t}[ \t\r\n\f]*>|\Z)" for t in DROPPED) + ")", " "),
         (rf"(?i)</?({BLOCKS})\b[^>]*>", "\n"), (r"<[a-zA-Z/!?][^>]*>", "")]
ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
SPACES = [(r"[ \t\r\f\x{00a0}]{2,}|[\t\r\f\x{00a0}]", " "), (r" ?\n[ \n]*", "\n")]
TITLE = r"(?is)<title\b[^>]*>(.*?)</title"
LANG = r"(?i)<html\b[^>]*\blang=\"?([a-zA-Z-]+)"
CHARSET = r"(?i)<meta\b[^>]*\bcharset=\"?([a-zA-Z0-9_-]+)"
LINK = r"(?i)<a\b[^>]*\bhref="
NAMED = {n: chr(c) for n, c in sorted(name2codepoint.items())} | {"apos": "'"}


_STEPS = [(re.compile(p, re.ASCII), by) for p, by in STEPS]
_ENTITY = re.compile(ENTITY, re.ASCII)
_BLANK = str.maketrans("\t\r\f\xa0", "    ")


def _character(m: re.Match) -> str:
    """What one entity stands for; an unknown name stays as it is."""
    body = m[1]
    if body[0] != "#":
        return NAMED.get(body, m[0])
    code = int(body[2:], 16) if body[1] in "xX" else int(body[1:])
    return chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else "\ufffd"


def plain_text(html: str) -> str:
    """The text of a page: comments, scripts and styles out, a line for each
    block element, entities decoded once, runs of white space closed up."""
    for pattern, by in _STEPS:
        html = pattern.sub(by, html)
    if "&" in html:
        html = _ENTITY.sub(_character, html)
    if any(c in html for c in "\t\r\f\xa0"):
        html = html.translate(_BLANK)
    lines = (" ".join(filter(None, line.split(" "))) for line in html.split("\n"))
    return "\n".join(filter(None, lines))


def with_plain_text(df: DataFrame, html: str, text: str, title: str) -> DataFrame:
    """``df`` with two more columns: the text of the page in column ``html``
    and of its title."""
    at = df.columns.index(html)
    found = re.compile(TITLE, re.ASCII)
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType()), T.StructField(title, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, pages in in_parts(batches, at, 8 << 20):
            titles = [m[1] if (m := found.search(p)) else "" for p in pages]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([plain_text(p) for p in pages], pa.string()),
                 pa.array([plain_text(t) for t in titles], pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(block, "UTF-8"), 256))


def record_id(*names: Column) -> Column:
    h = F.md5(F.encode(F.concat_ws("\n", *names), "UTF-8"))
    s = lambda at, n: F.substring(h, at, n)
    return F.concat(F.lit("<urn:uuid:"), s(1, 8), F.lit("-"), s(9, 4), F.lit("-3"), s(14, 3), F.lit("-a"), s(18, 3),
                    F.lit("-"), s(21, 12), F.lit(">"))


def safe_uri(uri: Column) -> Column:
    for bad, good in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        uri = F.replace(uri, F.lit(bad), F.lit(good))
    return uri


def responses_of(pages: DataFrame, key: str = "page_id", uri: str = "url", html: str = "html") -> DataFrame:
    """Raw pages as response records: ``key``, ``record_id``, ``target_uri``,
    ``date``, ``http_headers`` and ``payload``."""
    payload = F.coalesce(col(html), F.lit(""))
    charset = F.lower(F.regexp_extract(payload, CHARSET, 1))
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html"),
                       F.when(charset != "", F.concat(F.lit("; charset="), charset)).otherwise(""),
                       F.lit(f"{CRLF}Content-Length: "), F.octet_length(payload).cast("string"))
    return pages.select(col(key).alias("key"), record_id(F.lit("response"), F.coalesce(col(uri), F.lit("")), payload)
                        .alias("record_id"), col(uri).alias("target_uri"), F.lit(NO_DATE).alias("date"),
                        headers.alias("http_headers"), payload.alias("payload"))


def parse_responses(raw: DataFrame, record: str = "record") -> DataFrame:
    """Response records given as text (header, empty line, HTTP message), in
    the columns of ``responses_of``; the key is the record's identifier.
    Records of other types are left out."""
    def cut(c, n):
        return F.substring_index(c, CRLF * 2, n)

    head = cut(F.col("r"), 1)
    # substring from a column position: what follows the first empty line
    after = lambda c: F.when(F.instr(c, CRLF * 2) > 0, c.substr(F.instr(c, CRLF * 2) + 4, F.length(c))).otherwise("")
    value = lambda name: F.regexp_extract(F.col("head"), rf"(?im)^{name}:[ \t]*(.*?)[ \t\r]*$", 1)
    rows = raw.select(col(record).alias("r")).select(head.alias("head"), after(F.col("r")).alias("body"))
    rows = rows.filter(F.lower(value("WARC-Type")) == "response")
    return rows.select(value("WARC-Record-ID").alias("key"), value("WARC-Record-ID").alias("record_id"),
                       F.nullif(value("WARC-Target-URI"), F.lit("")).alias("target_uri"), value("WARC-Date").alias("date"),
                       cut(F.col("body"), 1).alias("http_headers"), after(F.col("body")).alias("payload"))


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records of each response: ``key``, ``record_type``, ``record_id``,
    ``refers_to``, ``target_uri``, ``date``, ``content_type``,
    ``content_length``, ``block_digest``, ``source_digest`` (of the response's
    payload), ``header`` (the record's header lines) and ``block``."""
    payload = F.coalesce(F.col("payload"), F.lit(""))
    step = responses.select(
        "key", F.col("record_id").alias("refers_to"), safe_uri(F.col("target_uri")).alias("target_uri"), "date",
        "http_headers", payload.alias("payload"), digest(payload).alias("source_digest"),
        F.lower(F.regexp_extract(payload, LANG, 1)).alias("lang"), F.regexp_count(payload, F.lit(LINK)).alias("links"),
        record_id(F.lit("metadata"), F.col("record_id")).alias("metadata_id"),
        record_id(F.lit("conversion"), F.col("record_id")).alias("conversion_id"))
    step = with_plain_text(step, "payload", "text", "title")
    source = F.array_join(F.transform(F.split(F.coalesce("http_headers", F.lit("")), CRLF),
                                      lambda x: F.concat(F.lit("source-header: "), x)), CRLF)
    fields = F.concat(
        F.lit("source-record-id: "), F.col("refers_to"), F.lit(f"{CRLF}source-payload-digest: "), F.col("source_digest"),
        F.lit(CRLF), source, F.lit(f"{CRLF}conversion-record-id: "), F.col("conversion_id"),
        F.lit(f"{CRLF}conversion-digest: "), digest(F.col("text")),
        F.lit(f"{CRLF}title: "), F.replace(F.col("title"), F.lit("\n"), F.lit(" ")), F.lit(f"{CRLF}language: "), F.col("lang"),
        F.lit(f"{CRLF}links: "), F.col("links").cast("string"), F.lit(CRLF))
    both = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.col("metadata_id").alias("record_id"),
                 F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.col("conversion_id").alias("record_id"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")))
    rows = step.select("key", "refers_to", "target_uri", "date", "source_digest", F.inline(both))
    rows = rows.withColumns({"content_length": F.octet_length("block").cast("long"), "block_digest": digest(F.col("block"))})
    line = lambda name, value: F.concat(F.lit(f"{CRLF}{name}: "), value)
    header = F.concat(
        F.lit("WARC/1.1"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")), line("WARC-Refers-To", F.col("refers_to")),
        F.coalesce(line("WARC-Target-URI", F.col("target_uri")), F.lit("")), line("WARC-Block-Digest", F.col("block_digest")),
        line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string")))
    return rows.select("key", "record_type", "record_id", "refers_to", "target_uri", "date", "content_type",
                       "content_length", "block_digest", "source_digest", header.alias("header"), "block")


def write_records(records: DataFrame, path: str, compression: str = "none") -> None:
    """The records as WARC text files: header, empty line, block, and two line
    ends after each."""
    records.select(F.concat("header", F.lit(CRLF * 2), "block")).write.option("lineSep", CRLF * 2).option(
        "compression", compression).text(path)


# ------------------------------------------------------------------ the same in SQL
def _lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\r", "'||chr(13)||'").replace("\n", "'||chr(10)||'") + "'"


def _text_sql(html: str) -> str:
    out = f"coalesce({html}, '')"
    for pattern, by in STEPS:
        out = f"regexp_replace({out}, {_lit(pattern.replace(chr(92) + "Z", chr(92) + "z"))}, {_lit(by)}, 'g')"
    return out


def _decoded_sql(raw: str) -> str:
    names = "MAP {" + ", ".join(f"{_lit(n)}: {_lit(c)}" for n, c in NAMED.items()) + "}"
    num = "CASE WHEN lower(b[2]) = 'x' THEN CAST('0x' || substr(b, 3) AS INTEGER) ELSE CAST(substr(b, 2) AS INTEGER) END"
    code = num.replace("b[2]", "substr(e, 3, 1)").replace("substr(b, 3)", "substr(e, 4, length(e) - 4)").replace(
        "substr(b, 2)", "substr(e, 3, length(e) - 3)")
    char = (f"CASE WHEN e IS NULL THEN '' WHEN substr(e, 2, 1) = '#' THEN CASE WHEN ({code}) BETWEEN 1 AND 1114111 AND NOT "
            f"({code}) BETWEEN 55296 AND 57343 THEN chr({code}) ELSE chr(65533) END "
            f"ELSE coalesce({names}[substr(e, 2, length(e) - 2)], e) END")
    joined = (f"array_to_string(list_transform(list_zip(string_split_regex({raw}, {_lit(ENTITY)}), "
              f"regexp_extract_all({raw}, {_lit(ENTITY)})), lambda z: z[1] || {char.replace('e IS', 'z[2] IS')}), '')")
    for old, new in (("(e,", "(z[2],"), ("(e)", "(z[2])"), (", e)", ", z[2])")):
        joined = joined.replace(old, new)
    out = f"CASE WHEN contains({raw}, '&') THEN {joined} ELSE {raw} END"
    for pattern, by in SPACES:
        out = f"regexp_replace({out}, {_lit(pattern)}, {_lit(by)}, 'g')"
    return f"trim(regexp_replace(regexp_replace({out}, '^[ \\n]+', ''), '[ \\n]+\\z', ''), ' ')"


def _id_sql(kind: str, *names: str) -> str:
    h = f"md5(concat_ws(chr(10), '{kind}', {', '.join(names)}))"
    return (f"concat('<urn:uuid:', substr({h},1,8), '-', substr({h},9,4), '-3', substr({h},14,3), '-a', substr({h},18,3), '-', "
            f"substr({h},21,12), '>')")


def sql(table: str = "pages") -> str:
    """``derivatives(responses_of(pages))`` for DuckDB."""
    nl = "chr(13)||chr(10)"
    uri = "target_uri"
    for bad, good in ((9, "%09"), (13, "%0D"), (10, "%0A")):
        uri = f"replace({uri}, chr({bad}), '{good}')"
    uri = f"replace({uri}, ' ', '%20')"
    dig = lambda x: f"'sha256:' || sha256({x})"
    return f"""
WITH r AS (SELECT page_id AS key, url AS target_uri, coalesce(html, '') AS payload,
    {_id_sql('response', "coalesce(url, '')", "coalesce(html, '')")} AS refers_to,
    lower(regexp_extract(coalesce(html, ''), {_lit(CHARSET)}, 1)) AS charset FROM {table}),
s AS (SELECT *, 'HTTP/1.1 200 OK' AS h1, 'Content-Type: text/html' || CASE WHEN charset <> '' THEN '; charset=' || charset
    ELSE '' END AS h2, 'Content-Length: ' || strlen(payload) AS h3, {_text_sql('payload')} AS raw,
    {_text_sql(f"regexp_extract(payload, {_lit(TITLE)}, 1)")} AS raw_title,
    lower(regexp_extract(payload, {_lit(LANG)}, 1)) AS lang, len(regexp_extract_all(payload, {_lit(LINK)})) AS links,
    {_id_sql('metadata', 'refers_to')} AS metadata_id, {_id_sql('conversion', 'refers_to')} AS conversion_id,
    {dig('payload')} AS source_digest FROM r),
t AS (SELECT *, {_decoded_sql('raw')} AS txt, {_decoded_sql('raw_title')} AS title FROM s),
u AS (SELECT *, concat('source-record-id: ', refers_to, {nl}, 'source-payload-digest: ', source_digest, {nl},
    'source-header: ', h1, {nl}, 'source-header: ', h2, {nl}, 'source-header: ', h3, {nl}, 'conversion-record-id: ',
    conversion_id, {nl}, 'conversion-digest: ', {dig('txt')}, {nl}, 'title: ', replace(title, chr(10), ' '), {nl},
    'language: ', lang, {nl}, 'links: ', links, {nl}) AS fields FROM t),
v AS (SELECT key, refers_to, target_uri, source_digest, 'metadata' AS record_type, metadata_id AS record_id,
    'application/warc-fields' AS content_type, fields AS block FROM u UNION ALL
    SELECT key, refers_to, target_uri, source_digest, 'conversion', conversion_id, 'text/plain; charset=utf-8', txt FROM u),
w AS (SELECT key, record_type, record_id, refers_to, {uri} AS target_uri, '{NO_DATE}' AS date, content_type,
    CAST(strlen(block) AS BIGINT) AS content_length, {dig('block')} AS block_digest, source_digest, block FROM v)
SELECT key AS page_id, record_type, record_id, refers_to, target_uri, date, content_type, content_length, block_digest,
    source_digest, concat('WARC/1.1', {nl}, 'WARC-Type: ', record_type, {nl}, 'WARC-Record-ID: ', record_id, {nl}, 'WARC-Date: ',
    date, {nl}, 'WARC-Refers-To: ', refers_to, CASE WHEN target_uri IS NULL THEN '' ELSE {nl} || 'WARC-Target-URI: ' || target_uri
    END, {nl}, 'WARC-Block-Digest: ', block_digest, {nl}, 'Content-Type: ', content_type, {nl}, 'Content-Length: ',
    content_length) AS header, block FROM w"""

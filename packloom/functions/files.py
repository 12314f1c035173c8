"""File signatures and metadata, as Column expressions over file bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packloom.functions.text import casefold

# Signatures, extensions and names.
PDF, ZIP, OLE2, PNG, JPEG = "25504446", "504B0304", "D0CF11E0A1B11AE1", "89504E470D0A1A0A", "FFD8FF"
GIFS = ("474946383761", "474946383961")
MIME = (
    ("pdf", "application/pdf"),
    ("xlsx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    ("xls", "application/vnd.ms-excel"),
    ("csv", "text/csv"),
    ("text", "text/plain"),
    ("json", "application/json"),
    ("zip", "application/zip"),
)
SUPPORTED = ("pdf", "xlsx", "xls", "csv", "image", "text", "json", "zip")
IGNORED_NAMES = (".ds_store", "thumbs.db", "desktop.ini")
TEMPORARY_PREFIX = "~$"
SNIFF_BYTES = 512
HEADER_CHARS = 500
PDF_HEADER_BYTES = 4096


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """The last suffix in lower case with its dot; empty for names without, or with a leading or last dot alone."""
    return F.lower(F.regexp_extract(name, r"[^/](\.[^./]+)$", 1))


def is_ignored(name: Column) -> Column:
    low = casefold(name)
    return low.startswith(TEMPORARY_PREFIX) | low.isin(*IGNORED_NAMES)


def _begins(content: Column, *hex_prefixes: str) -> Column:
    hit = F.lit(False)
    for p in hex_prefixes:
        hit = hit | (F.substring(content, 1, len(p) // 2) == F.unhex(F.lit(p)))
    return hit


def looks_like_text(head: Column) -> Column:
    """Bytes that aren't empty, have no NUL and are UTF-8."""
    return (F.length(head) > 0) & (F.instr(F.decode(head, "ISO-8859-1"), "\0") == 0) & F.is_valid_utf8(head.cast("string"))


def file_type(content: Column, name: Column) -> Column:
    """The type by signature first, by extension next; a text header makes other files text."""
    ext = extension(name)
    head = F.substring(content, 1, SNIFF_BYTES)
    return (
        F.when(_begins(content, PDF), "pdf")
        .when(_begins(content, ZIP), F.when(ext == ".xlsx", "xlsx").otherwise("zip"))
        .when(ext == ".zip", "zip")
        .when(_begins(content, OLE2), "xls")
        .when(_begins(content, PNG, JPEG, *GIFS), "image")
        .when(ext == ".csv", "csv")
        .when(ext == ".json", "json")
        .when(ext.isin(".txt", ".md", ".log") | looks_like_text(head), "text")
        .otherwise("unknown")
    )


def mime_type(content: Column, kind: Column) -> Column:
    """Of images by their signature, of others by type; null for unknown ones."""
    out = F.when(_begins(content, PNG), "image/png").when(_begins(content, JPEG), "image/jpeg").when(_begins(content, *GIFS), "image/gif")
    out = F.when(kind == "image", out)
    for k, m in MIME:
        out = out.when(kind == k, m)
    return out


def disposition(name: Column, kind: Column, readable: Column | None = None) -> Column:
    out = F.when(is_ignored(name), "ignored").when(~kind.isin(*SUPPORTED), "registered_with_warnings").otherwise("registered")
    return out if readable is None else F.when(~readable, "rejected").otherwise(out)


def pdf_pages(content: Column) -> Column:
    """How often a page object's type is spelled out; null where it never is."""
    n = F.regexp_count(F.decode(content, "ISO-8859-1"), F.lit("/Type ?/Page"))
    return F.when(n > 0, n)


def pdf_header(content: Column) -> Column:
    return F.substring(F.decode(F.substring(content, 1, PDF_HEADER_BYTES), "ISO-8859-1"), 1, HEADER_CHARS)


def text_header(content: Column) -> Column:
    """The first characters; bytes that aren't UTF-8 are dropped, line ends are line feeds."""
    text = F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))
    return F.substring(F.regexp_replace(text, "\r\n?", "\n"), 1, HEADER_CHARS)

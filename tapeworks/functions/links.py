"""Links, file names and anchors in page and message text.

URLs on venue pages are often not valid URIs (blanks, raw umlauts, ``%%``), so
they are split with the generic URI pattern and never handed to a strict parser.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.-]*):"
_NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
# Inside a tag: a ``>`` in a quoted value doesn't end it; quotes elsewhere are characters.
_INSIDE = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""
# One pass over a page: what holds no anchors is consumed first, and gives ''.
_TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea)\b" + _INSIDE + r">.*?(?:</\1\s*+>|\z)"
          r"|(<a\s" + _INSIDE + r">.*?</a\s*+>)")
_OPEN_TAG = r"(?is)^<a\s(" + _INSIDE + ")>"
_NO_TEXT = r"(?is)<!--.*?-->|<" + _INSIDE + ">"
_ATTRIBUTE = r"""(?:=|[^\s=>]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)\s*+"""

# The delivery link of the bond venue and its stamp in file names.
DELIVERY_LINK = r"(?i)https://dl\.luxse\.com/dl\?v=[^\s<>\"]+"
LINK_MINUTE = r"(\d{4}-\d{2}-\d{2}T\d{2}_\d{2})\.json\.gz"


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def filename_from_url(url: Column, fallback: str = "download.bin") -> Column:
    """Last non-empty path segment, without query."""
    name = F.regexp_extract(url_path(url), r"([^/]+)/*$", 1)
    return F.when(name == "", F.lit(fallback)).otherwise(name)


def last_segment(url: Column) -> Column:
    """Everything behind the last slash, query included."""
    return F.regexp_extract(url, r"([^/]*)$", 1)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def absolute_url(href: Column, base: Column) -> Column:
    """Resolve ``href`` against the page it stands on."""
    scheme = F.lower(F.regexp_extract(base, _SCHEME, 1))
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(base, _NETLOC, 1))
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (F.when(href.startswith("http://") | href.startswith("https://"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(site, href))
            .otherwise(F.concat(site, folder, href)))


def disposition_filename(header: Column, url: Column) -> Column:
    """File name from a Content-Disposition header, else from the URL."""
    given = F.btrim(F.regexp_extract(header, r"(?s)filename=(.*)$", 1), F.lit(" \t\r\n"))
    return F.when(F.contains(header, F.lit("filename=")), F.btrim(given, F.lit('"'))).otherwise(
        filename_from_url(url))


def link_minute(link: Column) -> Column:
    """The minute stamped into a ``….json.gz`` link."""
    return F.try_to_timestamp(F.regexp_extract(link, LINK_MINUTE, 1),
                              F.lit("yyyy-MM-dd'T'HH_mm"))


def strip_amp(link: Column) -> Column:
    return F.replace(link, F.lit("amp;"), F.lit(""))


def delivery_link(text: Column) -> Column:
    """First delivery link in a message, null when there is none."""
    return F.nullif(F.regexp_extract(text, DELIVERY_LINK, 0), F.lit(""))


def unescape(text: Column) -> Column:
    """The five predefined entities and the no-break space."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def anchors(html: Column) -> Column:
    """All ``<a …>…</a>`` elements as an array of their source text.

    Those in comments, scripts, styles and text areas are no elements.
    """
    found = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(2))
    return F.filter(found, lambda a: a != "")


def anchor_attribute(anchor: Column, name: str) -> Column:
    """Attribute of an anchor, '' when missing; of a repeated one the first counts."""
    tag = F.regexp_extract(anchor, _OPEN_TAG, 1)
    value = (rf"(?is)^\s*+(?:(?!{name}\s*+=){_ATTRIBUTE})*+{name}\s*+=\s*+"
             r"""(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
    return unescape(F.concat(*[F.regexp_extract(tag, value, k) for k in (1, 2, 3)]))


def anchor_text(anchor: Column) -> Column:
    """Text between the tags, trimmed."""
    return F.btrim(unescape(F.regexp_replace(anchor, _NO_TEXT, "")), F.lit(" \t\r\n\f\x0b "))

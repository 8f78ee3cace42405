"""Web pages, which need not be well-formed: what is wanted is matched, nothing is parsed. All built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[ \t\n\x0b\f\r]+"


def plain(markup: Column) -> Column:
    """Text without comments, scripts, styles and tags; the common entities decoded, white space collapsed."""
    text = F.regexp_replace(markup, r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def title(html: Column) -> Column:
    """The first h1's text, else empty."""
    return plain(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))


def hrefs(html: Column) -> Column:
    """Targets of all links in order, repeats kept."""
    return F.regexp_extract_all(html, F.lit(r'<a[^>]*href="([^"]*)"'), F.lit(1))


def items(html: Column) -> Column:
    """Texts of all list items."""
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1)), plain)

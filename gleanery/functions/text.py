"""Text cleaning: white space, redirects, domains, keys, codes, links."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The redirector's address, the markers around its target, the storage address.
REDIRECT_PREFIX = "https://www.google.com/"
REDIRECT_START = "&url="
REDIRECT_END = "&ct=ga"
STORAGE_BASE = "https://storage.yandexcloud.net/"

# Every character that counts as white space at the ends of a Unicode text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(col: Column) -> Column:
    """Remove Unicode white space at both ends; plain ``trim`` removes blanks only."""
    return F.btrim(col, F.lit(WHITESPACE))


def unwrap_redirect(
    url: Column, prefix: str = REDIRECT_PREFIX, start: str = REDIRECT_START, end: str = REDIRECT_END
) -> Column:
    """Target of a redirect link, not percent-decoded; other links stay as they are.

    A link with the prefix but without both markers is no redirect and stays too.
    """
    pattern = f"(?s){re.escape(start)}(.*?){re.escape(end)}"
    wrapped = url.startswith(prefix) & url.rlike(pattern)
    return F.when(wrapped, F.regexp_extract(url, pattern, 1)).otherwise(url)


def url_domain(url: Column) -> Column:
    """Host with port and user info, without a leading ``www.``; NULL unless http or https."""
    return F.nullif(F.regexp_extract(url, r"^https?://(?:www\.)?([^/]*)", 1), F.lit(""))


def md5_key(*cols: Column) -> Column:
    """Hex digest of the texts joined without a delimiter (the stored key has none)."""
    return F.md5(F.concat(*cols))


def drop_quotes(col: Column) -> Column:
    return F.replace(col, F.lit("'"), F.lit(""))


def code_prefixes(codes: Column, parts: int = 2) -> Column:
    """First ``parts`` dot-separated parts of every code, as a set."""
    return F.array_distinct(F.transform(codes, lambda code: F.substring_index(code, ".", parts)))


def concat_skip_null(*cols: Column) -> Column:
    """Join texts, leaving NULLs out (``concat`` would return NULL)."""
    return F.concat_ws("", *cols)


def storage_link(bucket: Column, key: Column, base: str = STORAGE_BASE) -> Column:
    """Address of a stored object; empty text without a key."""
    return F.when(key.isNull(), F.lit("")).otherwise(
        concat_skip_null(F.lit(base), bucket, F.lit("/"), key)
    )

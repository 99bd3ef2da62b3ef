"""URL resolution and normal form, as a vectorised helper."""

from __future__ import annotations

from urllib.parse import parse_qsl, quote, unquote, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: characters that stay as they are in a path
_PATH_SAFE = "/;:@&=+$,!~*'()%"


def canonical(base: str | None, href: str | None) -> str | None:
    """Absolute URL: lower-case scheme and host, sorted query, no fragment."""
    if href is None:
        return None
    try:
        parts = urlsplit(urljoin(base or "", href.strip()))
    except ValueError:
        return None
    # Percent signs that belong to the text itself, and encoded slashes, stay encoded.
    path = unquote(parts.path.replace("%25", "%2525").replace("%2F", "%252F")
                   .replace("%2f", "%252F").replace("%3F", "%253F").replace("%3f", "%253F"))
    query = urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True)))
    return urlunsplit((
        parts.scheme.lower(), parts.netloc.lower(), quote(path, safe=_PATH_SAFE) or "/", query, "",
    ))


@F.pandas_udf(T.StringType())
def canonical_url(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series(map(canonical, base, href), dtype=object)

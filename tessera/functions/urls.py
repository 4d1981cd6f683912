"""Canonical URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that say where a click came from, beside those that begin with utm_.
TRACKING = ("ref", "refs", "referrer", "source", "src", "via", "fbclid", "gclid", "mc_cid", "mc_eid", "trk", "gh_src", "lever-source", "lever-origin")

#: Blanks that str.strip takes off.
_BLANK = r"[\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
#: Scheme, authority, path, query and fragment.
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _decoded(part: Column) -> Column:
    """Percent signs that begin no code stand for themselves."""
    return F.url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(part: Column) -> Column:
    """Letters, digits and _ . - ~ stay, a blank is a plus."""
    return F.replace(F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _sorted_query(query: Column) -> Column:
    """Parameters that don't track, decoded, in order, and encoded again."""
    names = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.when(p.contains("="), F.regexp_replace(p, "^[^=]*=", "")).otherwise("")).alias("v")))
    kept = F.filter(names, lambda p: ~(F.lower(p["k"]).startswith("utm_") | F.lower(p["k"]).isin(*TRACKING)))
    return F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host without www., no fragment, no slash at the end, no tracking, sorted parameters."""
    url = F.regexp_replace(url, rf"^{_BLANK}+|{_BLANK}+\z", "")
    scheme, host, path, query = (F.regexp_extract(url, _PARTS, i) for i in (1, 2, 3, 4))
    host = F.regexp_replace(F.lower(host), r"^www\.", "")
    path = F.regexp_replace(path, "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    query = F.when(query == "", "").otherwise(_sorted_query(query))
    start = F.concat(F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""))
    return F.concat(start, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))

"""Header metadata from already fetched job pages (fetching itself is not built).

S10 reads three things from a page: the bold texts of the low-emphasis
elements (salary / work-type badges), the badges that are a work type, and the
text after "job type is" in a visually hidden element.  Parts are joined
with "; " and the groups with a newline; no part → null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.literals import lit_array

# Page markers and the work-type badge words.
BADGE_CLASS = "tvm__text--low-emphasis"
HIDDEN_CLASS = "visually-hidden"
JOB_TYPE_MARKER = "job type is"
WORK_TYPE_BADGES = ["hybrid", "remote", "onsite"]
# Fixed value: the job site whose pages carry those badges (other sites get the S11 fallback).
BADGE_SITE = "linkedin.com"

# Character references that badges hold.
_ENTITIES = {"&nbsp;": " ", "&#160;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&pound;": "£", "&euro;": "€", "&amp;": "&"}


def page_title(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"<title>([^<]*)</title>", 1), F.lit(""))


def _with_class(html: Column, name: str) -> Column:
    """The elements (as written, up to their first own end tag) one of whose classes is ``name``."""
    tag = rf"""(?is)<(\w+)\b[^>]*?\bclass\s*=\s*(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?')[^>]*>.*?</\1\s*>"""
    return F.regexp_extract_all(html, F.lit(tag), 0)


def _shown(fragment: Column) -> Column:
    """The text of a fragment: tags dropped, references decoded, white space as one space."""
    text = F.regexp_replace(fragment, r"(?s)<[^>]*>", "")
    for ref, char in _ENTITIES.items():
        text = F.replace(text, F.lit(ref), F.lit(char))
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def page_header(html: Column) -> Column:
    bold = F.transform(_with_class(html, BADGE_CLASS), lambda e: F.regexp_extract(e, r"(?is)<strong\b[^>]*>(.*?)</strong\s*>", 1))
    badges = F.filter(F.transform(bold, _shown), lambda x: x != "")
    work = F.filter(badges, lambda x: F.array_contains(lit_array(WORK_TYPE_BADGES), F.lower(x)))
    hidden = F.filter(F.transform(_with_class(html, HIDDEN_CLASS), _shown), lambda x: F.lower(x).contains(JOB_TYPE_MARKER))
    # As in the first hidden text that speaks of it, up to a second mention, without full stops.
    told = F.regexp_extract(F.get(hidden, F.lit(0)), rf"(?is){JOB_TYPE_MARKER}(.*?)(?:{JOB_TYPE_MARKER}|$)", 1)
    job_type = F.trim(F.replace(told, F.lit("."), F.lit("")))
    parts = F.array_compact(F.array(
        F.nullif(F.array_join(badges, "; "), F.lit("")),
        F.nullif(F.array_join(work, "; "), F.lit("")),
        F.nullif(job_type, F.lit("")),
    ))
    return F.when(F.size(parts) > 0, F.array_join(parts, "\n"))


def fallback_header(link: Column, title: Column, description: Column) -> Column:
    """For links of other sites, 'title | description'; non-http links → null."""
    return (F.when(link.isNull() | ~link.startswith("http"), F.lit(None).cast("string"))
            .when(link.contains(BADGE_SITE), F.lit(None).cast("string"))
            .when(title.isNotNull() | description.isNotNull(), F.concat_ws(" | ", title, description)))

"""URLs, handles and links as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairground.functions.text import strip

#: What social links look like, and language codes that open a path.
MUTE = r"(?i)facebook\.com/(sharer|plugins|profile\.php|story\.php|dialog|login)|twitter\.com/intent/|notfound|(https?://.*){2,}"
FACEBOOK_DEEP = r"(?i)^(https?://(?:www\.|m\.|it-it\.)?facebook\.com/[^/?#]+)/(?:events|about|mentions|reels|photos|videos|posts|past_hosted_events)\b.*"
INSTAGRAM_DEEP = r"(?i)^(https?://(?:www\.)?instagram\.com/[^/?#]+)/(?:reels|tagged)\b.*"
VERDICTS = (
    ("gruppo_facebook", r"(?i)facebook\.com/groups/"),
    ("permalink_post_da_risolvere", r"(?i)instagram\.com/p/[\w-]+"),
    ("link_a_evento_non_a_pagina", r"(?i)facebook\.com/events/[^?#]+/\d+"),
    ("tag_di_localita_non_e_un_profilo", r"(?i)instagram\.com/explore/locations/"),
    ("link_a_reel_non_a_profilo", r"(?i)(?:instagram|facebook)\.com/reel/"),
    ("id_numerico_da_risolvere", r"facebook\.com/(\d+)/?$"),
)
LANGUAGES = "it en fr de es pt".split()
DATE_SLUG = r"^\d{1,4}[-_]\d{1,2}[-_]\d{1,4}$"


def platform(url: Column) -> Column:
    low = F.lower(url)
    return F.when(low.contains("facebook.com"), "facebook").when(low.contains("instagram.com"), "instagram")


def social_url(url: Column) -> Column:
    """One host spelling, deep links cut to the profile, no closing slash."""
    c = F.regexp_replace(F.trim(url), r"(?i)^https?://(www\.|m\.|it-it\.)?facebook\.com", "https://www.facebook.com")
    c = F.regexp_replace(c, r"(?i)^https?://(www\.)?instagram\.com", "https://www.instagram.com")
    return F.when(c.rlike(FACEBOOK_DEEP), F.regexp_replace(c, FACEBOOK_DEEP, "$1")).when(c.rlike(INSTAGRAM_DEEP), F.regexp_replace(c, INSTAGRAM_DEEP, "$1")).otherwise(F.regexp_replace(c, r"/+$", ""))


#: Where a profile's name stands in an address, in the order in which it is looked for.
PEOPLE, SHORT = r"(?i)facebook\.com/people/([^/?#]+)/(\d+)", r"(?i)facebook\.com/p/([^/?#]+)"
CATEGORY, PAGES = r"(?i)facebook\.com/pages/category/[^/?#]+/([^/?#]+-\d+)", r"(?i)facebook\.com/pages/([^/?#]+)/(\d+)"
FACEBOOK_NAME, INSTAGRAM_NAME = r"(?i)facebook\.com/([^/?#]+)", r"(?i)instagram\.com/([^/?#]+)"


def social_handle(url: Column) -> Column:
    """The profile's name in a social URL; null if there is none."""
    part = lambda p, i=1: F.nullif(F.regexp_extract(url, p, i), F.lit(""))
    numbered = lambda p: F.concat(part(p), F.lit("-"), part(p, 2))
    facebook = F.coalesce(numbered(PEOPLE), part(SHORT), part(CATEGORY), numbered(PAGES), part(FACEBOOK_NAME))
    return F.when(platform(url) == "facebook", facebook).otherwise(part(INSTAGRAM_NAME))


def social_verdict(url: Column) -> Column:
    """``scarto`` for links of no use, the reason of those to review, ``ok`` for profiles of a known platform."""
    out = F.when(F.trim(F.coalesce(url, F.lit(""))) == "", "scarto").when(url.rlike(MUTE), "scarto")
    for reason, pattern in VERDICTS:
        out = out.when(url.rlike(pattern), reason)
    return out.when(platform(url).isNull() | social_handle(social_url(url)).isNull(), "scarto").otherwise("ok")


def author_handle(href: Column, where: Column) -> Column:
    """Who a feed's author link names: the id of a numbered profile, else the first segment of the path."""
    numbered = F.nullif(F.regexp_extract(href, r"[?&]id=([^&#]+)", 1), F.lit(""))
    path = F.regexp_replace(F.regexp_replace(href, r"^[a-z]+://[^/?#]*", ""), r"[?#].*$", "")
    first = F.lower(F.regexp_extract(path, r"^/*([^/]+)", 1))
    return F.when((where == "facebook") & numbered.isNotNull(), F.concat(F.lit("profile.php?id="), numbered)).otherwise(first)


def followed_handle(href: Column) -> Column:
    """The last segment of a followed profile's link, or its id."""
    last = F.element_at(F.split(F.regexp_replace(F.regexp_replace(href, r"\?.*$", ""), r"^/+|/+$", ""), "/"), -1)
    numbered = F.regexp_extract(href, r"[?&]id=(\d+)", 1)
    return F.when(last == "profile.php", F.when(numbered != "", F.concat(F.lit("profile.php?id="), numbered)).otherwise("")).otherwise(last)


def handle_url(where: Column, handle: Column) -> Column:
    return F.concat(F.when(where == "instagram", "https://www.instagram.com/").otherwise("https://www.facebook.com/"), handle)


def post_id(permalink: Column, text: Column) -> Column:
    """A post's own id, else a hash of its text, else what is left of its link."""
    own = F.nullif(F.regexp_extract(permalink, r"/(?:posts|videos|p|reel)/([^/?#]+)", 1), F.lit(""))
    plain = F.regexp_replace(F.regexp_replace(permalink, r"\?.*$", ""), "[^a-zA-Z0-9]", "")
    return F.coalesce(own, F.when(F.coalesce(text, F.lit("")) != "", F.left(F.sha1(strip(text)), F.lit(16))), F.nullif(F.right(plain, F.lit(32)), F.lit("")), permalink)


def further_url(url: Column) -> Column:
    """A link to read more at: domains get a scheme, local paths and drive letters are null."""
    c = F.trim(url)
    local = c.contains("\\") | F.split(c, "/")[0].contains(":")
    return F.when(F.coalesce(c, F.lit("")) == "", None).when(F.lower(c).rlike("^https?://"), c).when(local, None).otherwise(F.concat(F.lit("https://"), c))


def town_url(name: Column, province: Column) -> Column:
    return F.concat(F.lit("https://www.comune."), F.regexp_replace(F.lower(name), "[^a-z]+", ""), F.lit("."), F.lower(province), F.lit(".it/"))


def page_town(address: Column) -> Column:
    """The town in "…, Town, Italy"."""
    return F.nullif(F.trim(F.regexp_extract(address, r",\s*([A-Za-zÀ-ÿ'’ ]+),\s*Italy", 1)), F.lit(""))


def generic_feed(url: Column) -> Column:
    """Whether a feed is that of the whole site."""
    return F.regexp_replace(F.regexp_replace(url, r"^https?://[^/]+", ""), "/+$", "") == "/feed"


def language_segment(segment: Column) -> Column:
    return segment.isin(LANGUAGES) | segment.rlike("(?i)^[a-z]{2,3}-[a-z]{2}$")


def absolute(href: Column, base: Column) -> Column:
    """A link as seen from a page: absolute, host-relative, query-only or relative to the page's folder."""
    root = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    joined = F.concat(folder, href)
    joined = F.regexp_replace(F.regexp_replace(joined, r"/\./", "/"), r"/[^/]+/\.\./", "/")
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([a-zA-Z]+:)", 1), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#") | (href == ""), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .otherwise(joined)
    )

"""Listing pages: links, title fallback and the overview item classifier."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..schemas import DRIVETRAIN_VALUES, OVERVIEW_FIELDS

LINK_ATTR = 'data-test="cardLinkCover"'
TITLE_ATTR = 'data-test="marketplaceVdpHeader"'
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def listing_links(pages: DataFrame, attr: str | None = LINK_ATTR, cap: int = 30) -> DataFrame:
    """(page_id, pos, href) of the anchors carrying ``attr`` (any anchor when
    None), in page order, at most ``cap`` per page. Per-row array functions:
    no shuffle."""
    if attr:
        anchors = F.regexp_extract_all("html", F.lit(r"(<a\s[^>]*>)"), 1)
        hrefs = F.transform(F.filter(anchors, lambda a: a.contains(attr)),
                            lambda a: F.regexp_extract(a, r'href="([^"]*)"', 1))
    else:
        hrefs = F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="([^"]*)"'), 1)
    return (pages.select("page_id", F.posexplode(hrefs).alias("pos", "href"))
                 .filter(F.col("pos") < cap))


def html_text(c: Column) -> Column:
    """Inner HTML -> text: tags removed, common entities decoded, stripped."""
    t = F.regexp_replace(c, r"<[^>]+>", "")
    for ent, ch in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return py_strip(t)


def page_title_fallback(pages: DataFrame, attr: str = TITLE_ATTR) -> DataFrame:
    """First of: <h1 attr>, <div attr>, first <h1>; else 'No Title'."""
    def grab(pat):
        return F.nullif(F.regexp_extract("html", pat, 1), F.lit(""))
    h1a = grab(r"(?s)<h1[^>]*" + attr + r"[^>]*>(.*?)</h1>")
    diva = grab(r"(?s)<div[^>]*" + attr + r"[^>]*>(.*?)</div>")
    h1 = grab(r"(?s)<h1[^>]*>(.*?)</h1>")
    title = F.coalesce(html_text(F.coalesce(h1a, diva, h1)), F.lit("No Title"))
    return pages.select("page_id", title.alias("title"))


def _rule(x: Column) -> Column:
    """Item text -> struct(field, value) by the ordered rules; NULL field = unused."""
    drive = F.array(*[F.lit(v) for v in DRIVETRAIN_VALUES])

    def after(prefix):
        return py_strip(F.replace(x, F.lit(prefix), F.lit("")))
    pairs = [
        (x.startswith("Exterior:"), "Exterior", after("Exterior:")),
        (x.startswith("Interior:"), "Interior", after("Interior:")),
        (x.contains("miles") & ~x.contains("miles away"), "Mileage", py_strip(x)),
        (x.startswith("Fuel Type:"), "Fuel Type", after("Fuel Type:")),
        (x.contains("city /"), "MPG", py_strip(x)),
        (x.contains("Transmission"), "Transmission", py_strip(x)),
        (F.array_contains(drive, x), "Drivetrain", x),
        (x.contains("L") & x.contains("Gas"), "Engine", py_strip(x)),
        (x.startswith("Listed"), "Listed Since", after("Listed")),
        (x.startswith("VIN:"), "VIN", after("VIN:")),
        (x.startswith("Stock Number:"), "Stock Number", after("Stock Number:")),
        (x.contains("miles away"), "Location", py_strip(F.substring_index(x, "(", 1))),
    ]
    tagged = None
    for cond, name, val in pairs:
        entry = F.struct(F.lit(name).alias("field"), val.alias("value"))
        tagged = F.when(cond, entry) if tagged is None else tagged.when(cond, entry)
    return tagged


def overview_classify(df: DataFrame, items: str = "items") -> DataFrame:
    """Array of overview item texts -> the 12 overview fields ('N/A' default;
    a later item overwrites an earlier one for the same field, the session's
    LAST_WIN map policy). Each item walks the rules once; array functions instead
    of explode + pivot, so no shuffle."""
    keep = [c for c in df.columns if c != items]
    tagged = F.filter(F.transform(F.col(items), _rule), lambda s: s.isNotNull())
    step = df.select(*keep, F.map_from_entries(tagged).alias("__ov"))
    return step.select(*keep, *[F.coalesce(F.col("__ov")[n], F.lit("N/A")).alias(n) for n in OVERVIEW_FIELDS])

"""Event-field expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateau.config import EVENT_NAME_MAP, TABLET_MIN_PX, UNKNOWN_EVENT
from plateau.functions.common import as_col, literal_map


def falsy_coalesce(*cols) -> Column:
    """Python ``a or b or ...`` on text values: NULL, '' and '0' fall through."""
    parts = [F.when(~as_col(c).isin("", "0"), as_col(c)) for c in cols[:-1]]
    return F.coalesce(*parts, as_col(cols[-1]))


def clean_event_name(c) -> Column:
    """NULL/empty -> 'Unknown Event'; technical names -> readable ones; else unchanged."""
    c = as_col(c)
    return (F.when(c.isNull() | (c == ""), F.lit(UNKNOWN_EVENT))
            .otherwise(F.coalesce(F.try_element_at(literal_map(EVENT_NAME_MAP), c), c)))


def device_type(height, width) -> Column:
    """Larger screen side >= 1024 -> 'tablet', else 'mobile'; NULL or non-integer -> 'unknown' (F02)."""
    h, w = as_col(height).cast("string").try_cast("int"), as_col(width).cast("string").try_cast("int")
    known = h.isNotNull() & w.isNotNull()
    return (F.when(~known, "unknown")
            .when(F.greatest(h, w) >= TABLET_MIN_PX, "tablet").otherwise("mobile"))


def resolve_platform(platform, mp_lib, os_name) -> Column:
    """``platform or mp_lib or 'unknown'``; 'react-native' resolved by the OS name."""
    p = F.coalesce(F.when(as_col(platform) != "", as_col(platform)), as_col(mp_lib), F.lit("unknown"))
    os_l = F.lower(F.coalesce(as_col(os_name), F.lit("")))
    return (F.when(p != "react-native", p)
            .when(os_l.contains("ios"), "ios").when(os_l.contains("android"), "android")
            .otherwise("mobile"))


def item_id_from_route(route) -> Column:
    """Id after '/recipes/' up to the next '/' or '?'; missing, empty or '[id]' -> 'unknown' (F08)."""
    r = as_col(route)
    rid = F.regexp_extract(r, r"/recipes/([^/?]*)", 1)
    return F.when(r.isNull() | ~r.contains("/recipes/") | rid.isin("", "[id]"), "unknown").otherwise(rid)


def format_interaction(event, ts, recipe_id, route=None, include_ids: bool = True) -> Column:
    """Output struct of an interaction as JSON text."""
    fields = [as_col(event).alias("event_type"), as_col(ts).cast("bigint").alias("timestamp")]
    if include_ids:
        fields.append(F.coalesce(as_col(recipe_id).cast("string"), F.lit("unknown")).alias("recipe_id"))
    if route is not None:
        fields.append(as_col(route).alias("current_route"))
    return F.to_json(F.struct(*fields))

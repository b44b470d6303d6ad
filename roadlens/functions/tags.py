"""Column rules over a map of road tags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the road policy.
DRIVING_CLASSES = [
    "living_street", "motorway", "motorway_link", "primary", "primary_link", "residential", "road", "secondary", "secondary_link",
    "tertiary", "tertiary_link", "trunk", "trunk_link", "unclassified",
]
PROHIBITED = ["no", "private"]
ACCESS_KEYS = ["access", "vehicle", "motor_vehicle", "motorcar"]
ONEWAY = ["yes", "true", "1", "-1", "reverse", "T", "F"]
NOT_ONEWAY = ["no", "false", "0"]
REVERSED = ["-1", "reverse", "T"]
DEFAULT_WIDTH_M, DEFAULT_SPEED_KPH = 3.5, 50.0


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def exclusion_reason(tags: Column) -> Column:
    """Why a way is not a public driving road: the first reason that holds, null if none does."""
    kind = tag(tags, "highway")
    reasons = [
        F.when(kind.isNull(), F.lit("not_a_highway")),
        F.when(~kind.isin(DRIVING_CLASSES), F.concat(F.lit("highway="), kind)),
        F.when(tag(tags, "area") == "yes", F.lit("area=yes")),
    ]
    reasons += [F.when(tag(tags, k).isin(PROHIBITED), F.concat(F.lit(f"{k}="), tag(tags, k))) for k in ACCESS_KEYS]
    return F.coalesce(*reasons)


def single_lane_oneway(tags: Column) -> Column:
    """A single lane with no statement on direction reads as one way."""
    said = F.coalesce(tag(tags, "oneway").isin(ONEWAY + NOT_ONEWAY), F.lit(False))
    directional = tag(tags, "lanes:forward").isNotNull() | tag(tags, "lanes:backward").isNotNull()
    roundabout = F.coalesce(tag(tags, "junction") == "roundabout", F.lit(False))
    return F.coalesce(tag(tags, "lanes") == "1", F.lit(False)) & ~directional & ~said & ~roundabout


def positive_int(value: Column) -> Column:
    """An integer above 0, else null."""
    n = F.expr("try_cast(x as int)") if isinstance(value, str) else value.try_cast("int")
    return F.when(n > 0, n)


def lane_count(own: Column, total: Column, opposite: Column, oneway: Column) -> Column:
    """struct(lanes, confidence, reason) of one direction from the directional, total and opposite tags."""
    own, total, opposite = positive_int(own), positive_int(total), positive_int(opposite)
    answer = lambda n, c, r: F.struct(n.cast("int").alias("lanes"), F.lit(c).alias("confidence"), F.lit(r).alias("reason"))
    return (
        F.when(own.isNotNull(), answer(own, "high", "directional"))
        .when(oneway & total.isNotNull(), answer(total, "high", "oneway_total"))
        .when(total.isNotNull() & opposite.isNotNull() & (total > opposite), answer(total - opposite, "high", "total_minus_opposite"))
        .when(total.isNotNull() & opposite.isNotNull(), answer(F.lit(1), "low", "contradictory"))
        .when(total.isNotNull() & (total % 2 == 0), answer(F.floor(total / 2), "medium", "even_split"))
        .when(total.isNotNull(), answer(F.greatest(F.lit(1), F.floor(total / 2)), "low", "odd_split"))
        .otherwise(answer(F.lit(1), "low", "missing"))
    )


def lane_width(width: Column, lanes: Column, default_m: float = DEFAULT_WIDTH_M) -> Column:
    """Metres per lane from a width tag, else the default."""
    metres = F.regexp_replace(F.lower(width), r"\s*m$", "").try_cast("double")
    return F.coalesce(F.when((metres > 0) & (lanes > 0), metres / lanes), F.lit(default_m))


def speed_kph(maxspeed: Column, class_default: Column) -> Column:
    """Speed limit in km/h from a tag in km/h or mph, else the class default, else 50."""
    number = F.regexp_extract(maxspeed, r"^\s*(\d+(?:\.\d+)?)\s*(?:km/h|kmh|kph|mph)?\s*$", 1).try_cast("double")
    return F.coalesce(F.when(F.lower(maxspeed).contains("mph"), number * 1.609344).otherwise(number), class_default, F.lit(DEFAULT_SPEED_KPH))


def turn_slots(value: Column, left_hand: Column) -> Column:
    """array(array(permission)) per lane from the driver's left; the order is turned for left-hand traffic."""
    slots = F.transform(F.split(value, r"\|", -1), lambda s: F.filter(F.split(s, ";"), lambda p: p != ""))
    return F.when(left_hand, F.reverse(slots)).otherwise(slots)


def uturn_status(permissions: Column) -> Column:
    """active if a U-turn is tagged, excluded if only other turns are, review_required without tags."""
    return (
        F.when(F.exists(permissions, lambda p: p.isin("reverse", "uturn")), "active")
        .when(F.coalesce(F.size(permissions), F.lit(0)) > 0, "excluded").otherwise("review_required")
    )


def is_stop_line(tags: Column) -> Column:
    """Any key or value that reads stop_line."""
    words = F.concat(F.map_keys(tags), F.map_values(tags))
    return F.coalesce(F.exists(words, lambda w: F.translate(F.lower(w), "- ", "__") == "stop_line"), F.lit(False))


def canonical_json(tags: Column) -> Column:
    """Tags as JSON with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(tags))))


def content_id(*parts: Column, length: int = 16) -> Column:
    """The first hex digits of a sha256 over parts joined by U+001F; a null part is U+0000."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)), 256), 1, length)


def movement_class(angle: Column) -> Column:
    """reverse from 145 degrees, through up to 35, slight below 70, else left or right by sign."""
    size = F.abs(angle)
    side = F.when(angle > 0, "left").otherwise("right")
    return F.when(size >= 145, "reverse").when(size <= 35, "through").when(size < 70, F.concat(F.lit("slight_"), side)).otherwise(side)


def movement_family(movement: Column) -> Column:
    """Slight and full turns to a side are one family."""
    return F.when(movement.isin("left", "slight_left"), "left").when(movement.isin("right", "slight_right"), "right").otherwise(movement)


def movement_matches(permission: Column, movement: Column) -> Column:
    """Whether a tagged permission allows a movement."""
    return (
        F.when(permission.isin("left", "right"), movement.isin("left", "right", "slight_left", "slight_right", "sharp_left", "sharp_right") & movement.endswith(permission))
        .when(permission == "reverse", movement.isin("reverse", "uturn")).otherwise(permission == movement)
    )

"""Places, categories, severity, impulses, decay and similarity."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C
from .values import hours_between


def lookup(key: Column, values: dict, kind: str = "double") -> Column:
    """A small fixed table as a map literal, null for other keys."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key).cast(kind)


def root_code(raw: Column) -> Column:
    """A root code with its leading zero; longer codes are left as they are."""
    code = F.trim(raw)
    return F.when(F.length(code) < 2, F.lpad(code, 2, "0")).otherwise(code)


def root_category(raw: Column) -> Column:
    return lookup(root_code(raw), {k: v[0] for k, v in C.ROOTS.items()}, "string")


def root_coefficient(raw: Column) -> Column:
    return lookup(root_code(raw), {k: v[1] for k, v in C.ROOTS.items()})


def iso_country(fips: Column) -> Column:
    return lookup(F.upper(F.trim(fips)), C.FIPS, "string")


def half_life(category: Column) -> Column:
    return lookup(category, C.HALF_LIFE)


def pillar(category: Column) -> Column:
    return lookup(category, C.PILLAR, "string")


def category_compat(a: Column, b: Column) -> Column:
    return F.when(a == b, C.COMPAT_SAME).when(pillar(a) == pillar(b), C.COMPAT_PILLAR).otherwise(C.COMPAT_CROSS)


def clamp(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return 2 * C.EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def geo_proximity(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.exp(-haversine_km(lat1, lon1, lat2, lon2) / C.GEO_DECAY_KM)


def severity(goldstein: Column, root: Column, quad: Column) -> Column:
    """In [0, 1]; 0 without a score or a known root code."""
    weight = F.coalesce(lookup(quad.cast("int"), C.QUAD), F.lit(C.QUAD_OTHER))
    return F.coalesce(clamp((10 - goldstein) / 20 * root_coefficient(root) * weight), F.lit(0.0))


def velocity(mentions: Column) -> Column:
    return F.least(F.lit(1.0), F.log1p(mentions) / math.log1p(C.VELOCITY_MENTIONS))


def confirmation(sources: Column) -> Column:
    return F.least(F.lit(1.0), F.log1p(sources) / math.log1p(C.CONFIRMATION_SOURCES))


def available_weights() -> dict[str, float]:
    """Weights of the three news terms, scaled to a sum of 1; the others are not fed yet."""
    news = ("newsVelocity", "sourceConfirmation", "severity")
    total = sum(C.IMPULSE_WEIGHTS[k] for k in news)
    return {k: C.IMPULSE_WEIGHTS[k] / total if k in news else 0.0 for k in C.IMPULSE_WEIGHTS}


def combined(components: dict[str, Column], weights: dict[str, float] | None = None) -> Column:
    """Weighted sum of components, each held within [0, 1]."""
    weights = C.IMPULSE_WEIGHTS if weights is None else weights
    total = F.lit(0.0)
    for name, value in components.items():
        total = total + clamp(value) * F.lit(float(weights[name]))
    return total


def impulse(mentions: Column, sources: Column, severe: Column) -> Column:
    return combined({"newsVelocity": velocity(mentions), "sourceConfirmation": confirmation(sources), "severity": severe}, available_weights())


def decay_factor(category: Column, hours: Column) -> Column:
    """Share of a score that is left after some hours; time never runs back."""
    return F.exp(-F.lit(math.log(2)) / half_life(category) * F.greatest(hours, F.lit(0.0)))


def decayed(score: Column, updated: Column, now: Column, category: Column) -> Column:
    return score * decay_factor(category, hours_between(updated, now))


def bumped(score: Column, updated: Column, now: Column, category: Column, magnitude: Column) -> Column:
    """A score after an arrival: decayed to now, plus what is not negative of the magnitude."""
    return decayed(score, updated, now, category) + F.greatest(magnitude, F.lit(0.0))


def time_proximity(event_at: Column, situation_at: Column, category: Column) -> Column:
    hours = F.abs(hours_between(situation_at, event_at))
    return F.coalesce(F.exp(-F.lit(math.log(2)) * hours / half_life(category)), F.lit(0.0))


def similarity(entity: Column, geo: Column, category: Column, time: Column, located: Column) -> Column:
    """Four weighted terms; the other three share the weight of an unknown place."""
    rest = C.SIM_ENTITY * entity + C.SIM_CATEGORY * category + C.SIM_TIME * time
    return F.when(located, rest + C.SIM_GEO * geo).otherwise(rest / (1 - C.SIM_GEO))


def entity_signature(actor1: Column, actor2: Column, country: Column) -> Column:
    """Distinct marks of who and where; empty text counts as absent."""
    mark = lambda kind, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(kind), c))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(mark("actor:", actor1), mark("actor:", actor2), mark("geo:", country)))))


def relevant(actor1: Column, actor2: Column, country1: Column, country2: Column) -> Column:
    """A state, armed or intergovernmental actor takes part, or the actors' countries differ."""

    def typed(code: Column) -> Column:
        code = F.coalesce(code, F.lit(""))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(code) - 2), F.lit(3))
        return F.exists(starts, lambda i: F.substring(code, i, F.lit(3)).isin(*C.ACTOR_TYPES))

    a, b = F.coalesce(country1, F.lit("")), F.coalesce(country2, F.lit(""))
    return typed(actor1) | typed(actor2) | ((a != "") & (b != "") & (a != b))


def major_criteria(hours: Column, sources: Column, sigma: Column, points: Column) -> Column:
    """How many criteria of a major situation hold: sustained coverage, market move, outlook move."""
    covered = (hours >= C.MAJOR_HOURS) & (sources >= C.MAJOR_SOURCES)
    return sum((F.coalesce(c, F.lit(False)).cast("int") for c in (sigma > C.MAJOR_SIGMA, points > C.MAJOR_POINTS)), F.coalesce(covered, F.lit(False)).cast("int"))

"""Scalar expressions of the domain, on columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from strataflux.criteria import CLASS_LABELS, LEVEL_LABELS, RATIO_THRESHOLDS, WAVELENGTH_M, Criteria

METRES_PER_DEGREE = 111_320.0


def local_x(lon: Column, lon0: Column, lat0: Column) -> Column:
    return (lon - lon0) * METRES_PER_DEGREE * F.cos(F.radians(lat0))


def local_y(lat: Column, lat0: Column) -> Column:
    return (lat - lat0) * METRES_PER_DEGREE


def vertical(los: Column, incidence_deg: Column) -> Column:
    return los / F.cos(F.radians(incidence_deg))


def phase_to_mm(phase: Column) -> Column:
    return -phase * (WAVELENGTH_M / (4 * math.pi) * 1000)


def corrected_phase(phase: Column, look_error: Column, atmosphere: Column) -> Column:
    """Phase less what is known of the look-angle error and the atmosphere of the slave."""
    return phase - F.coalesce(look_error, F.lit(0.0)) - F.coalesce(atmosphere, F.lit(0.0))


def mm_to_phase(mm: Column) -> Column:
    return mm * (4 * math.pi / (WAVELENGTH_M * 1000))


def decimal_years(date: Column, master: Column) -> Column:
    return F.datediff(date, master) / 365.25


def track_key(direction: Column, path: Column, tag: Column) -> Column:
    return F.concat(F.lower(F.substring(direction, 1, 1)), path.cast("string"), F.coalesce(tag, F.lit("")))


def matlab_date(day: Column) -> Column:
    return F.date_add(F.lit("0001-01-01").cast("date"), day.cast("int") - 367)


def class_label(code: Column) -> Column:
    labels = F.create_map(*(F.lit(x) for pair in CLASS_LABELS.items() for x in pair))
    return F.coalesce(labels[code], F.lit("기타"))


def bearing(ax: Column, ay: Column) -> Column:
    """Degrees from north of an axis, from 0 to 180."""
    return F.pmod(F.degrees(F.atan2(ax, ay)), F.lit(180.0))


def rectangle_distance(s: Column, c: Column, length: Column, width: Column) -> Column:
    """Distance to a deck of that length along s and width across."""
    return F.hypot(F.greatest(F.abs(s) - length / 2, F.lit(0.0)), F.greatest(F.abs(c) - width / 2, F.lit(0.0)))


def grade(ratio: Column, thresholds: tuple[float, float, float] | Column) -> Column:
    """0 to 3: how many of three rising thresholds the ratio reaches."""
    t = [thresholds[k] if isinstance(thresholds, Column) else F.lit(float(thresholds[k])) for k in range(3)]
    return F.when(ratio >= t[2], 3).when(ratio >= t[1], 2).when(ratio >= t[0], 1).otherwise(0)


def thresholds_of(cls: Column, criteria: Criteria = Criteria()) -> Column:
    table = F.create_map(*(x for k, v in criteria.thresholds.items() for x in (F.lit(k), F.array(*(F.lit(float(y)) for y in v)))))
    return F.coalesce(table[cls], F.array(*(F.lit(y) for y in RATIO_THRESHOLDS["기타"])))


def span(kind: Column, length: Column, criteria: Criteria = Criteria()) -> Column:
    table = F.create_map(*(x for k, v in criteria.spans_m.items() for x in (F.lit(k), F.lit(float(v)))))
    return F.least(F.coalesce(table[kind], F.lit(criteria.span_default_m)), F.greatest(length, F.lit(1.0)))


def level(ratio_now: Column, ratio_later: Column, thresholds: tuple[float, float, float] | Column) -> Column:
    """The grade now; the projected grade may raise it by one step."""
    now, later = grade(ratio_now, thresholds), grade(ratio_later, thresholds)
    return F.greatest(now, F.least(later, now + 1))


def status_label(level: Column) -> Column:
    out = F.when(level.isNull(), "미처리").when(level < 0, "판정 불가")
    for k, name in enumerate(LEVEL_LABELS):
        out = out.when(level == k, name)
    return out


def confidence(cover: Column, has_ring: Column) -> Column:
    return F.when(~has_ring, "낮음").when(cover >= 0.5, "높음").when(cover >= 0.25, "보통").otherwise("낮음")

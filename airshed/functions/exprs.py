"""Column -> Column business rules.

Every function returns a built-in Catalyst expression (CASE chains,
arithmetic, string predicates), so it stays inside whole-stage codegen and
costs nothing extra at scale. Rule tables come from ``airshed.rules`` by
default and can be replaced by the caller.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed import rules

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(x: float | int | str) -> Column:
    """Exact decimal literal (keeps decimal arithmetic exact on decimal
    columns; on double columns Spark widens it to the same double a SQL
    engine would)."""
    return F.lit(Decimal(str(x)))


# ---------------------------------------------------------------------------
# Keys
# ---------------------------------------------------------------------------

def surrogate_key(*cols: ColumnOrName, null_marker: str = rules.SURROGATE_NULL,
                  sep: str = rules.SURROGATE_SEP) -> Column:
    """md5 hex key over one or more columns.

    Each value is cast to text, NULL replaced by a marker, and parts joined
    with ``sep``; a single column has no separator.
    """
    parts = [F.coalesce(col(c).cast("string"), F.lit(null_marker)) for c in cols]
    joined = parts[0] if len(parts) == 1 else F.concat_ws(sep, *parts)
    return F.md5(joined)


# ---------------------------------------------------------------------------
# Classification
# ---------------------------------------------------------------------------

_OPS = {
    "<": lambda c, b: c < b,
    "<=": lambda c, b: c <= b,
    ">": lambda c, b: c > b,
    ">=": lambda c, b: c >= b,
    "=": lambda c, b: c == b,
}


def bucketize(c: ColumnOrName, cuts: Sequence[tuple[str, float, str]], default: str | None,
              null_label: str | None = None) -> Column:
    """Ordered cut list -> label; first true rule wins.

    SQL three-valued logic is kept: a NULL input matches no rule and gets
    ``default`` unless ``null_label`` is given (a CASE in the reference
    sends NULL to its ELSE branch).
    """
    x = col(c)
    expr = None
    for op, bound, label in cuts:
        cond = _OPS[op](x, dec(bound))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(default))
    if null_label is not None:
        expr = F.when(x.isNull(), F.lit(null_label)).otherwise(expr)
    return expr


def alias_value(c: ColumnOrName, mapping: Mapping[str, str] = rules.CITY_ALIASES,
                null_default: str = rules.CITY_UNKNOWN, fold_case: bool = True) -> Column:
    """Spelling normalisation by equality on lower(c); unmatched values pass
    through, NULL becomes ``null_default``."""
    x = col(c)
    key = F.lower(x) if fold_case else x
    lookup = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.element_at(lookup, key), x, F.lit(null_default))


def _any_contains(text: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def keyword_class(fields: Mapping[str, ColumnOrName],
                  rules_list: Sequence[tuple],
                  default: ColumnOrName | str | None,
                  lower: bool = True) -> Column:
    """Ordered keyword rules over one or more text fields.

    ``fields`` maps a field name to its column; each rule is either
    ``(keywords, label)`` (searched in every field) or
    ``(keywords, field_names, label)``. Matching is substring, like SQL
    ``LIKE '%kw%'``; with ``lower`` the text is lower-cased first.
    Three-valued logic is kept: a rule over ``a OR b`` is true when either
    side is true, even if the other is NULL.
    """
    # a plain CASE: stays inside whole-stage codegen, where the lower-casing
    # of a field is one common subexpression of all its rules
    texts = {n: F.lower(col(v)) if lower else col(v) for n, v in fields.items()}
    expr = None
    for rule in rules_list:
        words, names, label = (rule[0], tuple(texts), rule[1]) if len(rule) == 2 else rule
        cond = reduce(lambda a, b: a | b, [_any_contains(texts[n], words) for n in names])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(col(default) if isinstance(default, Column) else F.lit(default))


def station_city(station: ColumnOrName,
                 rules_list: Sequence[tuple] = rules.STATION_CITY_RULES) -> Column:
    """City from a station name by case-sensitive substring; else the name."""
    return keyword_class({"s": station}, rules_list, default=col(station), lower=False)


def aqi_category(category: ColumnOrName,
                 rules_list: Sequence[tuple] = rules.AQI_CATEGORY_RULES) -> Column:
    return keyword_class({"c": F.trim(col(category))}, rules_list, rules.AQI_CATEGORY_DEFAULT)


def disaster_type(title: ColumnOrName, summary: ColumnOrName,
                  rules_list: Sequence[tuple] = rules.DISASTER_TYPE_RULES) -> Column:
    return keyword_class({"title": title, "summary": summary}, rules_list,
                         rules.DISASTER_TYPE_DEFAULT)


def severity_level(title: ColumnOrName,
                   rules_list: Sequence[tuple] = rules.SEVERITY_RULES) -> Column:
    return keyword_class({"title": title}, rules_list, rules.SEVERITY_DEFAULT)


def weight_of(c: ColumnOrName, weights: Mapping[str, int], default: int = 0) -> Column:
    """Simple CASE value -> weight (unknown and NULL -> default)."""
    lookup = F.create_map(*[F.lit(v) for kv in weights.items() for v in kv])
    return F.coalesce(F.element_at(lookup, col(c)), F.lit(default))


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------

def _segment_index(v: Column, seg: tuple) -> Column:
    upper, c_lo, c_hi, i_lo, span = seg
    if c_lo == 0 and i_lo == 0:
        raw = v / dec(c_hi) * F.lit(span)
    else:
        raw = F.lit(i_lo) + (v - dec(c_lo)) / (dec(c_hi) - dec(c_lo)) * F.lit(span)
    return F.round(raw, 0)


def _aqi_for_code(code: str, v: Column, breakpoints, above_last, cap) -> Column:
    segs = breakpoints.get(code)
    if not segs:
        return F.when(v.isNotNull(), F.least(F.round(v, 0).cast("int"), F.lit(cap)))
    expr = None
    for seg in segs:
        cond = v <= dec(seg[0])
        idx = _segment_index(v, seg).cast("int")
        expr = F.when(cond, idx) if expr is None else expr.when(cond, idx)
    return expr.otherwise(F.lit(above_last))


def aqi_subindex(code: str | ColumnOrName, value: ColumnOrName,
                 breakpoints=rules.AQI_BREAKPOINTS, null_as: int | None = None,
                 above_last: int = rules.AQI_ABOVE_LAST, cap: int = rules.AQI_CAP) -> Column:
    """Piecewise-linear AQI sub-index.

    ``code`` is a fixed pollutant code (one CASE chain) or a column (one
    chain per known code). NULL input gives NULL by default; ``null_as=500``
    reproduces the reference's ELSE branch for pm25/pm10/o3.
    """
    v = col(value)
    if isinstance(code, str):
        out = _aqi_for_code(code, v, breakpoints, above_last, cap)
        if code in breakpoints:
            out = F.when(v.isNull(), F.lit(null_as)).otherwise(out)
        return out
    expr = None
    for known in breakpoints:
        branch = F.when(v.isNull(), F.lit(null_as)).otherwise(
            _aqi_for_code(known, v, breakpoints, above_last, cap))
        expr = F.when(code == known, branch) if expr is None else expr.when(code == known, branch)
    return expr.otherwise(_aqi_for_code("", v, breakpoints, above_last, cap))


def risk_score(aqi: ColumnOrName, flow: ColumnOrName, fires: ColumnOrName) -> Column:
    """Composite 0-100 risk from AQI, river flow and fire count (NULL -> 0)."""
    a = F.least(F.coalesce(col(aqi), F.lit(0)) / dec(rules.RISK_AQI_SCALE) * F.lit(rules.RISK_AQI_CAP),
                F.lit(rules.RISK_AQI_CAP))
    f = F.least(F.coalesce(col(flow), F.lit(0)) / dec(rules.RISK_FLOW_SCALE) * F.lit(rules.RISK_FLOW_CAP),
                F.lit(rules.RISK_FLOW_CAP))
    h = F.least(F.coalesce(col(fires), F.lit(0)) * F.lit(rules.RISK_FIRE_POINTS), F.lit(rules.RISK_FIRE_CAP))
    # The sum is rounded as an exact decimal (the reference casts it to
    # numeric), so a double input cannot flip a half-way case.
    return F.least(F.round((a + f + h).cast("decimal(38,12)"), 1), F.lit(rules.RISK_TOTAL_CAP))


def capped_scaled(c: ColumnOrName, scale: float, points: int, cap: int, digits: int = 1) -> Column:
    """least(round(c / scale * points, digits), cap)."""
    return F.least(F.round(col(c) / dec(scale) * F.lit(points), digits), F.lit(cap))


def aqi_component(official_avg: ColumnOrName, avg_value: ColumnOrName, code: ColumnOrName,
                  pm_code: str = "pm25") -> Column:
    """Official AQI / 500 * 40, else pm2.5 average / 250 * 40, else 0; cap 40."""
    return (
        F.when(col(official_avg).isNotNull(),
               capped_scaled(official_avg, rules.RISK_AQI_SCALE, rules.RISK_AQI_CAP, rules.RISK_AQI_CAP))
        .when(col(avg_value).isNotNull() & (col(code) == pm_code),
              capped_scaled(avg_value, rules.RISK_PM25_SCALE, rules.RISK_AQI_CAP, rules.RISK_AQI_CAP))
        .otherwise(F.lit(0))
    )


def heat_index(temp: ColumnOrName, humidity: ColumnOrName,
               coeffs: tuple = rules.HEAT_INDEX_COEFFS,
               min_temp: float = rules.HEAT_INDEX_MIN_TEMP) -> Column:
    """Simplified heat index above ``min_temp``; else the temperature."""
    t, h = col(temp), col(humidity)
    a, b, c, d = (dec(x) for x in coeffs)
    hi = F.round(a + b * t + c * h + d * t * h, 1)
    return F.when(t > dec(min_temp), hi).otherwise(t)


# ---------------------------------------------------------------------------
# Predicates
# ---------------------------------------------------------------------------



def in_box(lat: ColumnOrName, lon: ColumnOrName, box=rules.VIETNAM_BOX) -> Column:
    lat_lo, lat_hi, lon_lo, lon_hi = box
    return col(lat).between(dec(lat_lo), dec(lat_hi)) & col(lon).between(dec(lon_lo), dec(lon_hi))



# ---------------------------------------------------------------------------
# Text and time
# ---------------------------------------------------------------------------

def parse_local_time(c: ColumnOrName, regex: str = rules.LOCAL_TIME_REGEX,
                     fmt: str = rules.LOCAL_TIME_FORMAT) -> Column:
    """Find ``HH:mm dd/MM/yyyy`` anywhere in the text and parse that piece;
    no match or an invalid date gives NULL."""
    piece = F.regexp_extract(col(c), f"({regex})", 1)
    return F.when(col(c).rlike(regex), F.try_to_timestamp(piece, F.lit(fmt)))


def to_utc(c: ColumnOrName, tz: str | None = rules.SOURCE_TIMEZONE) -> Column:
    """Treat a wall-clock time as local to ``tz`` and shift it to UTC."""
    x = col(c).cast("timestamp")
    return x if tz is None else F.to_utc_timestamp(x, tz)


def numeric_text(c: ColumnOrName, regex: str = rules.HTML_NUMERIC_REGEX) -> Column:
    """Digits with at most one dot -> double, else NULL (empty -> NULL)."""
    x = col(c)
    return F.when(x.rlike(regex) & (F.length(x) > 0) & (x != "."), x.try_cast("double"))


def absolute_url(link: ColumnOrName, base: ColumnOrName | str) -> Column:
    """Keep http(s) links; prefix others with the base; empty stays empty."""
    lk = col(link)
    b = F.lit(base) if isinstance(base, str) else col(base)
    return F.when((lk.isNull()) | (lk == ""), lk).when(lk.startswith("http"), lk).otherwise(F.concat(b, lk))


def site_root(url: ColumnOrName) -> Column:
    """scheme://host of a URL (the base for relative links)."""
    return F.regexp_extract(col(url), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)

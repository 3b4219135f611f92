"""Per-pair settings: coercion, lookup with fallback, and precedence."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast import PAIR
from stockcast.functions.columns import plain_number, positive_ints
from stockcast.schemas import SETTING_TYPES
from stockcast.settings import DEFAULT_SETTINGS, VOLUME_SHARE, ZSCORE_RULES
from stockcast.sources.tables import active_config

# Section and name in a nested settings document -> flat setting.
_NESTED = {
    ("holiday", "use_doubleday_peak"): "use_doubleday_peak",
    ("holiday", "use_public_holiday"): "use_public_holiday",
    ("holiday", "use_midmonth_dates"): "use_midmonth_dates",
    ("holiday", "use_payday_dates"): "use_payday_dates",
    ("lag_features", "lag_days"): "lag_days",
    ("lag_features", "rolling_mean_windows"): "rolling_mean_windows",
    ("promo", "use_promotions"): "use_promotions",
    ("promo", "holiday_lower_window"): "promo_lower_window",
    ("promo", "holiday_upper_window"): "promo_upper_window",
    ("impact_dates", "holiday_lower_window"): "impact_lower_window",
    ("impact_dates", "holiday_upper_window"): "impact_upper_window",
    ("impact_dates", "top_skus_n"): "impact_top_skus_n",
    ("prophet", "weekly_seasonality"): "prophet_weekly_seasonality",
    ("prophet", "daily_seasonality"): "prophet_daily_seasonality",
    ("prophet", "seasonality_mode"): "prophet_seasonality_mode",
    ("prophet", "changepoint_prior_scale"): "prophet_changepoint_prior_scale",
    ("prophet", "changepoint_range"): "prophet_changepoint_range",
    ("prophet", "seasonality_prior_scale"): "prophet_seasonality_prior_scale",
}


def flatten_override(payload: Mapping | None) -> dict:
    """Settings named in a nested request document; sections may sit under 'advanced' or on top.

    Besides the settings per pair: the request's z-score rules and test days, which hold for the whole run.
    """
    payload = dict(payload or {})
    sections = {**payload, **dict(payload.get("advanced") or {})}
    flat = {}
    for (section, name), setting in _NESTED.items():
        value = (sections.get(section) or {}).get(name)
        if value is not None:
            flat[setting] = value
    impact = sections.get("impact_dates") or {}
    bands = impact.get("cv_bands") or []
    if len(bands) >= 2:
        flat["impact_cv_band_low"], flat["impact_cv_band_high"] = bands[0], bands[1]
    if impact.get("zscore_rules") is not None:
        flat["zscore_rules"] = zscore_rules(impact["zscore_rules"])
    if (sections.get("execution") or {}).get("test_days") is not None:
        flat["test_days"] = int(sections["execution"]["test_days"])
    return flat


def zscore_rules(values: list | None) -> list[tuple[int, float]]:
    """Usable (window, threshold) rules of a request; the built-in ones if none is."""
    rules = []
    for value in values or []:
        try:
            window, threshold = int(value["window"]), float(value["threshold"])
        except (TypeError, ValueError, KeyError):
            continue
        if window > 0:
            rules.append((window, threshold))
    return rules or list(ZSCORE_RULES)


def clamp_share(c: Column) -> Column:
    """Volume threshold between 0 and 1."""
    value = F.coalesce(c.try_cast("double"), F.lit(VOLUME_SHARE))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def coerce_config(raw: DataFrame) -> DataFrame:
    """Settings in their types. What does not parse is null, so a lower level decides."""

    values = coerced({name: F.col(name) for name in SETTING_TYPES if name in raw.columns})
    others = [c for c in raw.columns if c not in values]
    return raw.select(*others, *[c.alias(name) for name, c in values.items()])


def coerced(raw: Mapping[str, Column]) -> dict[str, Column]:
    """Every setting in its type, null where it is missing or does not parse."""

    def typed(name: str, kind: str) -> Column:
        if name not in raw:
            return F.lit(None).cast(kind)
        if kind == "ARRAY<INT>":
            return positive_ints(raw[name])
        return plain_number(raw[name]) if kind == "DOUBLE" else raw[name].try_cast(kind)

    values = {name: typed(name, kind) for name, kind in SETTING_TYPES.items()}
    low, high = values["impact_cv_band_low"], values["impact_cv_band_high"]
    both = low.isNotNull() & high.isNotNull()
    values["impact_cv_band_low"] = F.when(both, low)
    values["impact_cv_band_high"] = F.when(both, high)
    top = values["impact_top_skus_n"]
    values["impact_top_skus_n"] = F.when(top.isNotNull(), F.greatest(F.lit(1), top))
    return values


def lookup_config(pairs: DataFrame, config: DataFrame) -> DataFrame:
    """The active settings row of each pair: its own, else its customer's default.

    The newest row wins, one without a time stamp before all others. The best row per key is an
    aggregate, so a customer with very many rows is reduced before the shuffle, and both joins are
    one to one on the config side.
    """
    names = list(SETTING_TYPES)
    active = coerce_config(active_config(config))
    newest_first = F.struct(
        F.col("updated_at").isNotNull(),
        -F.unix_micros(F.col("updated_at").cast("timestamp")),
        F.to_json(F.struct(*names)),
    )
    best = F.min_by(F.struct(*names), newest_first)
    own = (
        active.filter(F.col("warehousecode").isNotNull())
        .groupBy(F.col("customercode").alias("customer_code"), "warehousecode")
        .agg(best.alias("_own"))
    )
    general = (
        active.filter(F.col("warehousecode").isNull())
        .groupBy(F.col("customercode").alias("customer_code"))
        .agg(best.alias("_general"))
    )
    found = pairs.select(*PAIR).distinct().join(own, PAIR, "left").join(general, "customer_code", "left")
    level = F.when(F.col("_own").isNotNull(), "warehouse").when(F.col("_general").isNotNull(), "customer")
    row = F.coalesce("_own", "_general")
    return found.select(*PAIR, level.alias("config_level"), *[row[n].alias(n) for n in names])


def effective_config(found: DataFrame, override: Mapping | None = None) -> DataFrame:
    """One complete row of settings per pair: request, then config row, then built-in default."""
    return with_defaults(found, override).select(*PAIR, *SETTING_TYPES)


def with_defaults(rows: DataFrame, override: Mapping | None = None) -> DataFrame:
    """Rows with every setting filled in: from the request, the row itself or the built-in value.

    Request values go through the same checks as the config table's. A list of the request without a usable entry
    stands for the built-in list.
    """
    override = dict(override or {})

    def literal(value, kind):
        column = F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)
        return column.cast(kind)

    def text(value):
        if isinstance(value, (list, tuple)):
            return F.array(*[F.lit(str(v)) for v in value]).cast("array<string>")
        return F.lit(str(value))

    request = coerced({name: text(override[name]) for name in SETTING_TYPES if override.get(name) is not None})

    def chosen(name, kind):
        default = literal(DEFAULT_SETTINGS[name], kind)
        if isinstance(override.get(name), (list, tuple)):
            return F.coalesce(request[name], default)
        return F.coalesce(request[name], *([F.col(name)] if name in rows.columns else []), default)

    return rows.withColumns({name: chosen(name, kind) for name, kind in SETTING_TYPES.items()})

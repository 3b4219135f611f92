"""Penalised least-squares fit of one series: trend with changepoints, seasonality, holidays, regressors.

Published form: y = g(t) * (1 + s(t) + h(t) + x b) or g(t) + s(t) + h(t) + x b (Taylor and Letham, 2018).
The changepoints have the published sparse prior, an absolute penalty on each bend; all other priors are normal, squared
penalties. This is the one step that needs Python: Spark hands over whole series and reads back one JSON document each.
"""

from __future__ import annotations

import numpy as np

# Published defaults of the model.
CHANGEPOINTS = 25
WEEKLY_ORDER, YEARLY_ORDER = 3, 10
WEEK, YEAR = 7.0, 365.25
YEARLY_MIN_DAYS = 730
TREND_PRIOR, HOLIDAY_PRIOR, REGRESSOR_PRIOR = 5.0, 10.0, 10.0
#: rounds of the alternation at most; a document says how many it took and whether it settled before
ROUNDS = 200


def fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angle = 2.0 * np.pi * np.outer(days, np.arange(1, order + 1)) / period
    return np.stack([np.sin(angle), np.cos(angle)], axis=2).reshape(len(days), 2 * order)


def history_features(y: np.ndarray, lags, rolling) -> dict[str, np.ndarray]:
    """Lags and means of the rows before, NaN where the history is too short."""
    features = {}
    for n in lags:
        shifted = np.full(len(y), np.nan)
        shifted[n:] = y[: max(len(y) - n, 0)]
        features[f"y_lag{n}"] = shifted
    for n in rolling:
        means = np.full(len(y), np.nan)
        if len(y) > n:
            means[n:] = np.lib.stride_tricks.sliding_window_view(y, n)[:-1].mean(axis=1)
        features[f"rolling_mean_{n}"] = means
    return features


def _solve(design, target, penalty):
    gram = design.T @ design
    gram[np.diag_indices_from(gram)] += penalty
    return np.linalg.solve(gram, design.T @ target)


def _sparse(design, target, ridge, weight, start):
    """Minimum of |target - design x|^2 / 2 + sum(ridge x^2) / 2 + sum(weight |x|), exactly.

    An active set with signs: the smooth problem of the active columns is solved, going no further than where the first of
    them reaches zero, which then leaves; at rest the column that breaks its bound most enters. Each step lowers the sum, so no set
    of signs returns, and the steps are about as many as the bends that change.
    """
    gram = design.T @ design
    gram[np.diag_indices_from(gram)] += ridge
    pull = design.T @ target
    free = weight == 0.0
    x, sign = start.copy(), np.where(free, 0.0, np.sign(start))
    tolerance = 1e-9 * max(float(np.abs(pull).max(initial=0.0)), 1e-30)
    for _ in range(50 * len(x)):
        active = np.flatnonzero(free | (sign != 0))
        goal = np.zeros(len(x))
        goal[active] = np.linalg.solve(gram[np.ix_(active, active)], pull[active] - weight[active] * sign[active])
        over = np.flatnonzero(goal * sign < 0)
        if len(over):
            share = x[over] / (x[over] - goal[over])
            leaving = over[np.argmin(share)]
            x = x + share.min() * (goal - x)
            x[leaving] = sign[leaving] = 0.0
            continue
        x = goal
        slope = pull - gram @ x
        excess = np.where(free | (sign != 0), -np.inf, np.abs(slope) - weight)
        entering = int(np.argmax(excess))
        if excess[entering] <= tolerance:
            break
        sign[entering] = np.sign(slope[entering])
    return x


def _distance(slope, x, ridge, weight):
    """How far each column is from a minimum: the slope that its penalties do not balance."""
    rest = slope - ridge * x
    bound = np.maximum(np.abs(rest) - weight, 0.0)
    return np.where((weight > 0) & (x == 0), bound, np.abs(rest - weight * np.sign(x)))


def _estimate(trend, effects, y, trend_prior, change_prior, effect_prior, multiplicative, max_rounds=ROUNDS):
    """Alternate between the trend and the effects until neither moves. The trend's columns behind those of `trend_prior` are bends."""
    straight, bends = len(trend_prior), trend.shape[1] - len(trend_prior)
    ridge = np.concatenate([1.0 / trend_prior**2, np.zeros(bends)])
    weight = np.concatenate([np.zeros(straight), np.full(bends, 1.0 / change_prior)])
    noise = max(float(np.var(y)), 1e-8)
    beta = np.zeros(effects.shape[1])
    theta = _sparse(trend, y, noise * ridge, noise * weight, np.zeros(trend.shape[1]))
    settled, rounds = False, 0
    while not settled and rounds < max_rounds:
        rounds += 1
        level, used = trend @ theta, noise
        if multiplicative:
            beta_new = _solve(level[:, None] * effects, y - level, noise / effect_prior**2)
            factor = 1.0 + effects @ beta_new
            theta = _sparse(factor[:, None] * trend, y, noise * ridge, noise * weight, theta)
            fitted = (trend @ theta) * factor
        else:
            joint = _sparse(
                np.hstack([trend, effects]), y, noise * np.concatenate([ridge, 1.0 / effect_prior**2]),
                noise * np.concatenate([weight, np.zeros(len(beta))]), np.concatenate([theta, beta]),
            )
            theta, beta_new = joint[: trend.shape[1]], joint[trend.shape[1] :]
            fitted = trend @ theta + effects @ beta_new
        noise = max(float(np.mean((y - fitted) ** 2)), 1e-8)
        settled = np.allclose(beta, beta_new, rtol=1e-4, atol=1e-6) and abs(noise - used) <= 1e-4 * used
        beta = beta_new
    # what the last penalties leave unbalanced at the result, per unit of the largest column
    factor = (1.0 + effects @ beta) if multiplicative else np.ones(len(y))
    level = trend @ theta if multiplicative else np.ones(len(y))
    rest = y - (trend @ theta) * factor if multiplicative else y - trend @ theta - effects @ beta
    by_trend = _distance((factor[:, None] * trend).T @ rest, theta, used * ridge, used * weight)
    by_effect = (level[:, None] * effects).T @ rest - used / effect_prior**2 * beta
    gradient = float(max(np.abs(by_trend).max(initial=0.0), np.abs(by_effect).max(initial=0.0)) / len(y))
    return theta, beta, float(np.sqrt(noise)), rounds, bool(settled), gradient


def _iso(day) -> str:
    return str(np.datetime64(int(day), "D"))


def fit_series(days, y, promo_days, features, settings) -> dict:
    """Model document of one series.

    `days` are day numbers since 1970-01-01 in order, `features` maps a holiday feature to the days
    it is active on, `settings` has the pair's effective settings.
    """
    days = np.asarray(days, dtype=np.int64)
    y = np.asarray(y, dtype=float)
    promo_days = np.asarray(promo_days, dtype=np.int64)
    history = history_features(y, settings["lag_days"], settings["rolling_mean_windows"])
    complete = np.all([np.isfinite(v) for v in history.values()] + [np.isfinite(y)], axis=0)
    if complete.sum() < 2:
        raise ValueError("fewer than 2 rows with complete features")
    days, y = days[complete], y[complete]
    n = len(y)
    first, last = days[0], days[-1]
    span = float(max(last - first, 1))
    t = (days - first) / span
    y_scale = float(np.abs(y).max()) or 1.0
    scaled = y / y_scale

    reach = int(np.floor(n * settings["prophet_changepoint_range"]))
    count = min(CHANGEPOINTS, max(reach - 1, 0))
    at = t[np.linspace(0, reach - 1, count + 1).round().astype(int)[1:]] if count else np.zeros(0)
    trend = np.column_stack([t, np.ones(n), np.maximum(t[:, None] - at[None, :], 0.0)])
    trend_prior, change_prior = np.array([TREND_PRIOR, TREND_PRIOR]), settings["prophet_changepoint_prior_scale"]

    blocks, priors = [], []
    weekly = bool(settings["prophet_weekly_seasonality"])
    yearly = last - first >= YEARLY_MIN_DAYS
    for wanted, period, order in ((weekly, WEEK, WEEKLY_ORDER), (yearly, YEAR, YEARLY_ORDER)):
        if wanted:
            blocks.append(fourier(days, period, order))
            priors += [settings["prophet_seasonality_prior_scale"]] * (2 * order)
    for offset in range(settings["promo_lower_window"], settings["promo_upper_window"] + 1):
        if len(promo_days):
            features = {**features, f"promotion_{offset:+d}": promo_days + offset}
    for active in features.values():
        blocks.append(np.isin(days, active).astype(float)[:, None])
        priors.append(HOLIDAY_PRIOR)

    regressors = {name: v[complete] for name, v in history.items()}
    regressors["promo_flag"] = np.isin(days, promo_days).astype(float)
    centers, scales = [], []
    for values in regressors.values():
        distinct = np.unique(values)
        plain = len(distinct) < 2 or (len(distinct) == 2 and set(distinct) == {0.0, 1.0})
        centers.append(0.0 if plain else float(values.mean()))
        scales.append(1.0 if plain else float(values.std(ddof=1)))
        blocks.append(((values - centers[-1]) / scales[-1])[:, None])
        priors.append(REGRESSOR_PRIOR)

    mode = str(settings["prophet_seasonality_mode"])
    theta, beta, sigma, rounds, converged, gradient = _estimate(
        trend, np.hstack(blocks), scaled, trend_prior, change_prior, np.array(priors), mode == "multiplicative"
    )

    cut = iter(np.split(beta, np.cumsum([b.shape[1] for b in blocks])[:-1]))
    week_effect = fourier(np.arange(-3, 4), WEEK, WEEKLY_ORDER) @ next(cut) if weekly else []
    year_coefs = next(cut) if yearly else []
    holiday_effect: dict[str, float] = {}
    for active in features.values():
        effect = float(next(cut)[0])
        for day in np.unique(active[active >= first]) if effect else ():
            holiday_effect[_iso(day)] = holiday_effect.get(_iso(day), 0.0) + effect
    return {
        "mode": mode,
        "first_ds": _iso(first),
        "last_ds": _iso(last),
        "span_days": span,
        "y_scale": y_scale,
        "slope": float(theta[0]),
        "level": float(theta[1]),
        "change_at": [float(v) for v in at],
        "change_by": [float(v) for v in theta[2:]],
        "weekly": [float(v) for v in week_effect],
        "yearly": [float(v) for v in year_coefs],
        "holiday_effect": holiday_effect,
        "regressors": [
            {"name": name, "coef": float(next(cut)[0]), "center": c, "scale": s, "last": float(values[-1])}
            for (name, values), c, s in zip(regressors.items(), centers, scales)
        ],
        "sigma": sigma,
        "n_rows": n,
        "daily_seasonality": bool(settings["prophet_daily_seasonality"]),
        "rounds": rounds,
        "converged": converged,
        "gradient": gradient,
    }

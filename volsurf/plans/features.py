"""Stock/day features from contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dte_bucket, finite, nan_mean, safe_divide
from ..functions.pricing import with_atm_greeks
from ..operators.filters import surface_eligible
from ..operators.quantiles import exact_quantiles
from ..schemas import DAILY_FEATURES, DELTA_TARGETS, DTE_BUCKETS, GREEKS, NEAR_ATM

KEYS = ["trade_date", "underlying"]


def _side_means(df: DataFrame, values: dict[str, str], name) -> list[Column]:
    return [F.avg(F.when(F.col("option_type") == side, finite(F.col(c)))).alias(name(side, m)) for m, c in values.items() for side in ("call", "put")]


def daily_features(contracts: DataFrame, prefix: str = "atm_") -> DataFrame:
    """Ten means per day and stock: volatility and four Greeks for calls and for puts, in one aggregation."""
    values = {"iv": "implied_volatility"} | {g: f"{prefix}{g}" for g in GREEKS}
    kept = contracts.filter("trade_date is not null and underlying is not null and option_type in ('call', 'put')")
    return kept.groupBy(*KEYS).agg(*_side_means(kept, values, lambda side, m: f"avg_{side}_{m}")).select(*KEYS, *DAILY_FEATURES)


def group_means(contracts: DataFrame, prefix: str = "atm_") -> DataFrame:
    """Means by day, stock and option type."""
    kept = contracts.filter("trade_date is not null and underlying is not null and option_type is not null")
    values = {"mean_iv": "implied_volatility"} | {f"mean_{g}": f"{prefix}{g}" for g in GREEKS}
    return kept.groupBy(*KEYS, "option_type").agg(*(F.avg(finite(F.col(c))).alias(a) for a, c in values.items()))


def daily_features_from_means(contracts: DataFrame) -> DataFrame:
    """Features where contracts lack Greeks: mean inputs per group first, then the Greeks of that mean option."""
    inputs = ("implied_volatility", "underlying_close", "time_to_expiry_years", "risk_free_rate", "dividend_yield")
    groups = contracts.filter("option_type in ('call', 'put')").groupBy(*KEYS, "option_type").agg(*(F.avg(finite(F.col(c))).alias(c) for c in inputs))
    return daily_features(with_atm_greeks(groups))


def paper_features(contracts: DataFrame, prefix: str = "atm_") -> DataFrame:
    """The same means under the names sigma, delta, ... with suffixes c and p."""
    values = {"sigma": "implied_volatility"} | {g: f"{prefix}{g}" for g in GREEKS}
    return contracts.groupBy("underlying", "trade_date").agg(*_side_means(contracts, values, lambda side, m: f"{m}_{side[0]}"))


def narrow(features: DataFrame) -> DataFrame:
    """(trade_date, underlying, feature, value): the ten final tables as one long one."""
    return features.unpivot(KEYS, DAILY_FEATURES, "feature", "value")


def final_tables(features: DataFrame) -> dict[str, DataFrame]:
    """The ten narrow tables; a feature that is absent has an empty one."""
    empty = features.select(*KEYS, F.lit(None).cast("double").alias("value")).limit(0)
    return {f: features.select(*KEYS, f) if f in features.columns else empty.withColumnRenamed("value", f) for f in DAILY_FEATURES}


def described(features: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, n, mean, std, low, q25, q50, q75, high), rounded to four digits."""
    long = features.unpivot(KEYS, columns, "feature", "value").filter("value is not null")
    stats = {"mean": F.avg("value"), "std": F.stddev("value"), "low": F.min("value"), "high": F.max("value")}
    whole = long.groupBy("feature").agg(F.count("*").alias("n"), *(c.alias(k) for k, c in stats.items()))
    quartiles = exact_quantiles(long, ["feature"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    # a row for each feature
    both = whole.join(F.broadcast(quartiles), "feature")
    return both.select("feature", "n", *(F.round(c, 4).alias(c) for c in ("mean", "std", "low", "q25", "q50", "q75", "high")))


def _target() -> Column:
    """The delta target within whose tolerance a contract lies; tolerances of one side don't overlap, so there is one at most."""
    out = F
    for name, (side, target, tolerance) in DELTA_TARGETS.items():
        out = out.when((F.col("option_type") == side) & (F.abs(F.col("delta") - target) <= tolerance), name)
    return out


_PICK = ("d", "o", "e", "k", "t")


def selected(contracts: DataFrame) -> DataFrame:
    """One row per stock, day and bucket: of each target the contract nearest to it, if within its tolerance.

    Every contract has one target or none, so one aggregation by target picks
    all; it is combined before the shuffle, and a second one on its few rows
    spreads targets to columns.  Ties go to the earlier ordinal, then expiry,
    strike and ticker.
    """
    ordinal = F.col("ordinal") if "ordinal" in contracts.columns else F.lit(0)
    rows = contracts.withColumns({"bucket": dte_bucket(F.col("dte_days")), "target": _target()}).filter("bucket is not null and target is not null")
    goal = F.create_map(*(F.lit(x) for n, (_, t, _) in DELTA_TARGETS.items() for x in (n, t)))
    pick = F.struct(
        F.abs(F.col("delta") - goal[F.col("target")]).alias("d"), ordinal.alias("o"), F.col("expiration_date").alias("e"), F.col("strike").alias("k"), F.col("ticker").alias("t"),
        F.col("implied_volatility").alias("iv"), "gamma", "theta", "vega",
    )
    return _by_target(rows.groupBy(*KEYS, "bucket", "target").agg(F.min(pick).alias("p")))


def selected_of_closes(contracts: DataFrame, closes: DataFrame, greeks: Callable[[str], dict[str, str]]) -> DataFrame:
    """The same where a stock's day may have several closes (see ``joins.day_closes``), and a contract counts with each of them.

    ``greeks`` gives the texts of the Greeks at a close, over the contracts'
    columns.  In its row, a contract finds for each target of its side the close
    that brings it nearest; rows are never multiplied by closes.
    """
    rows = contracts.withColumn("bucket", dte_bucket(F.col("dte_days"))).filter("bucket is not null and strike > 0 and implied_volatility > 0")
    goals = {side: F.array(*(F.struct(F.lit(n).alias("target"), F.lit(t).alias("goal"), F.lit(tol).alias("tolerance")) for n, (s, t, tol) in DELTA_TARGETS.items() if s == side)) for side in ("call", "put")}
    own = F.when(F.col("option_type") == "call", goals["call"]).when(F.col("option_type") == "put", goals["put"])
    deltas = rows.join(closes, ["underlying", "trade_date"]).withColumn("_deltas", F.expr(f"transform(closes, c -> struct({greeks('c')['delta']} AS delta, c AS close))"))
    nearest = lambda g: F.array_min(F.transform("_deltas", lambda x: F.struct(F.abs(x["delta"] - g["goal"]).alias("d"), x["close"].alias("close"))))
    each = F.transform(own, lambda g: F.struct(g["target"].alias("target"), g["tolerance"].alias("tolerance"), nearest(g).alias("at")))
    found = deltas.select(*KEYS, "bucket", "ordinal", "expiration_date", "strike", "ticker", "implied_volatility", "option_type", F.inline(F.filter(each, lambda x: x["at"]["d"] <= x["tolerance"])))
    pick = F.struct(F.col("at.d").alias("d"), F.col("ordinal").alias("o"), F.col("expiration_date").alias("e"), F.col("strike").alias("k"), F.col("ticker").alias("t"), F.col("implied_volatility").alias("iv"), F.col("at.close").alias("c"), F.col("option_type").alias("s"))
    best = found.groupBy(*KEYS, "bucket", "target").agg(F.min(pick).alias("p"))
    picked = best.select(*KEYS, "bucket", "target", "p", F.col("p.k").alias("strike"), F.col("p.iv").alias("implied_volatility"), F.col("p.c").alias("underlying_close"), F.col("p.s").alias("option_type"))
    texts = greeks("underlying_close")
    return _by_target(picked.select(*KEYS, "bucket", "target", F.struct(*(F.col(f"p.{c}").alias(c) for c in (*_PICK, "iv")), *(F.expr(texts[g]).alias(g) for g in ("gamma", "theta", "vega"))).alias("p")))


def _by_target(best: DataFrame) -> DataFrame:
    """Targets to columns: what was picked (p) for each."""
    own = lambda n: F.max(F.when(F.col("target") == n, F.col("p")))
    wide = best.groupBy(*KEYS, "bucket").agg(*(own(n).alias(f"_{n}") for n in DELTA_TARGETS))
    value = lambda n: F.when(F.col(f"_{n}").isNotNull(), F.struct(*(F.col(f"_{n}.{c}") for c in ("iv", "gamma", "theta", "vega"))))
    return wide.select(*KEYS, "bucket", *(value(n).alias(f"{n}_v") for n in DELTA_TARGETS), *(F.col(f"_{n}.d").alias(f"{n}_d") for n in DELTA_TARGETS))


def selection_long(wide: DataFrame) -> DataFrame:
    """(trade_date, underlying, bucket, target, iv, gamma, theta, vega, distance) of the selected contracts."""
    each = F.array(*(F.struct(F.lit(n).alias("target"), F.col(f"{n}_v").alias("v"), F.col(f"{n}_d").alias("distance")) for n in DELTA_TARGETS))
    return wide.select(*KEYS, "bucket", F.inline(each)).filter("v is not null").select(*KEYS, "bucket", "target", "v.iv", "v.gamma", "v.theta", "v.vega", "distance")


#: Metrics of a bucket, in the order of the output.
METRICS = (
    "put_10_delta_iv put_25_delta_iv atm_call_iv atm_put_iv atm_iv call_25_delta_iv call_10_delta_iv risk_reversal_25_delta risk_reversal_10_delta "
    "put_skew_10_25 call_skew_10_25 curvature_25_delta curvature_10_delta skew_slope put_25_delta_gamma call_25_delta_gamma put_10_delta_gamma "
    "call_10_delta_gamma gamma_rr_25_delta gamma_wing_ratio vega_rr_25_delta theta_rr_25_delta"
).split()
RAW_GAMMA = (
    "near_atm_gamma_sum_raw put_gamma_sum_raw call_gamma_sum_raw gamma_imbalance_sum_raw near_atm_gamma_mean put_gamma_mean call_gamma_mean gamma_imbalance_mean".split()
)
DISTANCES = {n: f"{n}{'' if n.endswith('delta') else '_delta'}_distance" for n in DELTA_TARGETS}
SURFACE_COLUMNS = [
    *KEYS, *METRICS, *RAW_GAMMA, *(f"{m}_{b}" for b in DTE_BUCKETS for m in METRICS), "atm_term_slope", "put_skew_term_slope", "rr_term_slope",
    "n_contracts_total", *(f"n_contracts_{b}" for b in DTE_BUCKETS), *DISTANCES.values(),
]


def _slope(points: list[tuple[float, Column]]) -> Column:
    """Least-squares slope over the points that have a value; null below two."""
    known = F.filter(F.array(*(F.struct(F.lit(x).alias("x"), y.alias("y")) for x, y in points)), lambda p: p["y"].isNotNull())
    zero = F.struct(*(F.lit(0.0).alias(c) for c in ("n", "x", "y", "xx", "xy")))

    def add(a: Column, p: Column) -> Column:
        return F.struct((a["n"] + 1).alias("n"), (a["x"] + p["x"]).alias("x"), (a["y"] + p["y"]).alias("y"), (a["xx"] + p["x"] * p["x"]).alias("xx"), (a["xy"] + p["x"] * p["y"]).alias("xy"))

    return F.aggregate(known, zero, add, lambda a: F.when(a["n"] >= 2, (a["n"] * a["xy"] - a["x"] * a["y"]) / (a["n"] * a["xx"] - a["x"] * a["x"])))


def _bucket_metrics() -> dict[str, Column]:
    v = {n: {c: F.col(f"{n}_v.{c}") for c in ("iv", "gamma", "theta", "vega")} for n in DELTA_TARGETS}
    iv = {n: v[n]["iv"] for n in DELTA_TARGETS}
    atm = nan_mean(iv["atm_call"], iv["atm_put"])
    gamma = {n: v[n]["gamma"] for n in DELTA_TARGETS}
    difference = lambda c, w: v[f"call_{w}_delta"][c] - v[f"put_{w}_delta"][c]
    wings = lambda w: nan_mean(iv[f"put_{w}_delta"], iv[f"call_{w}_delta"]) - atm
    return {f"{n}_iv": c for n, c in iv.items()} | {
        "atm_iv": atm,
        "risk_reversal_25_delta": difference("iv", 25),
        "risk_reversal_10_delta": difference("iv", 10),
        "put_skew_10_25": iv["put_10_delta"] - iv["put_25_delta"],
        "call_skew_10_25": iv["call_10_delta"] - iv["call_25_delta"],
        "curvature_25_delta": wings(25),
        "curvature_10_delta": wings(10),
        "skew_slope": _slope([(DELTA_TARGETS[n][1], iv[n]) for n in DELTA_TARGETS]),
        **{f"{n}_gamma": gamma[n] for n in DELTA_TARGETS if not n.startswith("atm")},
        "gamma_rr_25_delta": difference("gamma", 25),
        "gamma_wing_ratio": safe_divide(gamma["put_10_delta"], gamma["call_10_delta"]),
        "vega_rr_25_delta": difference("vega", 25),
        "theta_rr_25_delta": difference("theta", 25),
    }


def bucket_metrics(wide: DataFrame) -> DataFrame:
    """Per stock, day and bucket that has a selected contract: 22 metrics and six distances."""
    return wide.select(*KEYS, "bucket", *(c.alias(m) for m, c in _bucket_metrics().items()), *(F.col(f"{n}_d").alias(d) for n, d in DISTANCES.items()))


def raw_gamma(contracts: DataFrame) -> DataFrame:
    """Gamma sums (0 without rows) and means (null without rows) near the money, of puts and of calls, with imbalances."""
    where = {"near_atm": F.col("moneyness").between(*NEAR_ATM), "put": F.col("option_type") == "put", "call": F.col("option_type") == "call"}
    sums = [F.coalesce(F.sum(F.when(w, F.col("gamma"))), F.lit(0.0)).alias(f"{k}_gamma_sum_raw") for k, w in where.items()]
    means = [F.avg(F.when(w, F.col("gamma"))).alias(f"{k}_gamma_mean") for k, w in where.items()]
    bucket = dte_bucket(F.col("dte_days"))
    counts = [F.count_if(bucket == b).alias(f"n_contracts_{b}") for b in DTE_BUCKETS]
    out = contracts.groupBy(*KEYS).agg(F.count("*").alias("n_contracts_total"), *counts, *sums, *means)
    return out.withColumns({f"gamma_imbalance_{m}": F.col(f"call_gamma_{m}") - F.col(f"put_gamma_{m}") for m in ("sum_raw", "mean")})


def surface_features(contracts: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """The 111 columns of the delta-bucket surface, one row per stock and day; ``wide`` has the selected contracts, if they are known.

    Two aggregations of the same rows by nested keys; the bucket level is
    spread to columns in the second, so contracts are shuffled once per level
    and never joined bucket by bucket.
    """
    rows = surface_eligible(contracts)
    per = bucket_metrics(selected(rows) if wide is None else wide)
    spread = [F.max(F.when(F.col("bucket") == b, F.col(m))).alias(f"{m}_{b}") for b in DTE_BUCKETS for m in (*METRICS, *DISTANCES.values())]
    out = raw_gamma(rows).join(per.groupBy(*KEYS).agg(*spread), KEYS, "left")
    mean = {m: nan_mean(*(F.col(f"{m}_{b}") for b in DTE_BUCKETS)) for m in (*METRICS, *DISTANCES.values())}
    term = {"atm_term_slope": "atm_iv", "put_skew_term_slope": "put_25_delta_iv", "rr_term_slope": "risk_reversal_25_delta"}
    slopes = {k: F.col(f"{m}_90d") - F.col(f"{m}_30d") for k, m in term.items()}
    return out.withColumns(mean | slopes).select(*SURFACE_COLUMNS)


def contract_counts(contracts: DataFrame) -> DataFrame:
    """Per stock and day: contracts in all and by expiry bucket."""
    bucket = dte_bucket(F.col("dte_days"))
    return contracts.groupBy(*KEYS).agg(F.count("*").alias("n"), *(F.count_if(bucket == b).alias(f"n_{b}") for b in DTE_BUCKETS))


def missing_share(features: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """(area, missing_pct): the mean share of nulls over each group's columns, in percent."""
    means = features.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in dict.fromkeys(x for g in groups.values() for x in g)))
    each = [F.struct(F.lit(g).alias("area"), (100 * nan_mean(*map(F.col, cols))).alias("missing_pct")) for g, cols in groups.items()]
    return means.select(F.inline(F.array(*each)))

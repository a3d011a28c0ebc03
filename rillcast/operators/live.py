"""From a new observation to forecasts: gate, features, prediction rows, upkeep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.config import (
    AIR_SITE,
    LIVE_SIGNED,
    LIVE_TARGETS,
    PRECIPITATION_SITE,
    SNOW_SITE,
    Clip,
    Grid,
)
from rillcast.functions.timeaxis import (
    calendar,
    floor_div,
    horizon_bin,
    micros,
    next_exact,
    on_grid,
    season_name,
    shift,
    tick_of,
    tick_time,
)
from rillcast.functions.vectors import finite
from rillcast.operators.models import score_linear
from rillcast.operators.normalize import null_safe
from rillcast.operators.profile import latest_other, latest_per_series
from rillcast.operators.regular import (
    as_stretches,
    blank_negative,
    bucket_last,
    filled,
    observed_at,
    ticks,
)
from rillcast.operators.scan import best_rows, dense_ids, literal_rows, next_point, packed, sized
from rillcast.sources.staged import per_key, stage

# What tells the windows of ticks apart that events ask for.
WINDOW = ("site_id", "variable_code", "feature", "at")
EVENT_COLUMNS = ("datastream_id", "site_id", "variable_id", "variable_code", "datetime_utc", "value")
PAYLOAD = (
    "datastream_id long, site_id int, variable_id int, variable_code string, "
    "datetime_utc string, value double"
)
# Key of a stored prediction and the columns of the CSV copy.
# Microseconds of the earliest time that writes are told apart by (year 0 or so).
EARLIEST = -(2**56)
PREDICTION_KEY = (
    "model_family", "target_variable", "site_id", "history_end_time", "season_key", "horizon",
)
CSV_COLUMNS = (
    "source_datastream_id", "target_variable", "site_id", "season", "history_end_time",
    "forecast_start_time", "horizon", "horizon_bin", "target_timestamp", "prediction", "model_path",
)


@dataclass(frozen=True)
class Context:
    """A value taken from a support series as of the event."""

    name: str
    site_id: int
    variable_code: str
    window: int
    fill: str
    reduce: str
    least: int = 1


# The context of the discharge models.
CONTEXTS = {
    "discharge": (
        Context("snow_depth_latest", SNOW_SITE, "SnowDepth", 168, "carry", "last"),
        Context("air_temp_avg_last_24h", AIR_SITE, "AirTemp", 24, "time", "mean"),
        Context("precip_avg_last_24h", PRECIPITATION_SITE, "Precip", 24, "bounded", "mean", 18),
    ),
}


# --- events ---------------------------------------------------------------

def new_events(facts: DataFrame, variables: DataFrame, after_id: int, limit: int = 250) -> DataFrame:
    """The next events behind the high-water mark, oldest id first."""
    return (
        facts.where(F.col("datastream_id") > after_id)
        .join(variables.select("variable_id", "variable_code"), "variable_id")
        .select(*EVENT_COLUMNS)
        .orderBy("datastream_id")
        .limit(limit)
    )


def events_by_id(facts: DataFrame, variables: DataFrame, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Chosen events for a replay: a short list of ids, or a table with ``datastream_id``."""
    if isinstance(ids, DataFrame):
        chosen = facts.join(ids.select("datastream_id"), "datastream_id", "left_semi")
    else:
        chosen = facts.where(F.col("datastream_id").isin(list(ids)))
    return chosen.join(variables.select("variable_id", "variable_code"), "variable_id").select(*EVENT_COLUMNS)


def to_payload(events: DataFrame) -> DataFrame:
    """JSON payload of events on the hour."""
    fields = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if c == "datetime_utc" else F.col(c)
              for c in EVENT_COLUMNS]
    return events.where(on_grid("datetime_utc")).select(
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("payload")
    )


def from_payload(payloads: DataFrame, column: str = "payload") -> DataFrame:
    parsed = payloads.select(F.from_json(column, PAYLOAD).alias("e")).select("e.*")
    return parsed.withColumn("datetime_utc", F.try_to_timestamp("datetime_utc").cast("timestamp_ntz"))


# --- gate -----------------------------------------------------------------

def with_target(events: DataFrame, targets: Mapping[str, str] = LIVE_TARGETS) -> DataFrame:
    name = F.lit(None).cast("string")
    for code, target in targets.items():
        name = F.when(F.col("variable_code") == code, F.lit(target)).otherwise(name)
    return events.withColumn("target_variable", name)


def newer_than_others(events: DataFrame, facts: DataFrame) -> DataFrame:
    """Flag events later than every other row of their series (equal times fail)."""
    return latest_other(events, facts).withColumn(
        "is_newest", F.coalesce(F.col("datetime_utc") > F.col("latest_other"), F.lit(True))
    )


def forecast_season(events: DataFrame, grid: Grid = Grid()) -> DataFrame:
    return events.withColumn("season", season_name(F.month(shift("datetime_utc", 1, grid))))


def route(events: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per event and matching model; without a model one row with a null path."""
    models = registry.select("target_variable", "site_id", "season", "model_path")
    return events.join(models, ["target_variable", "site_id", "season"], "left")


def gate(events: DataFrame, facts: DataFrame, registry: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Every event with the reason it stops at; accepted ones have reason ``accepted``."""
    judged = newer_than_others(with_target(forecast_season(events, grid)), facts)
    return route(judged, registry).withColumn(
        "reason",
        F.when(F.col("datetime_utc").isNull(), F.lit("no_time"))
        .when(~on_grid("datetime_utc", grid), F.lit("not_exact_hour"))
        .when(F.col("target_variable").isNull(), F.lit("no_target"))
        .when(~F.col("is_newest"), F.lit("not_newer"))
        .when(F.col("model_path").isNull(), F.lit("no_model"))
        .otherwise(F.lit("accepted")),
    )


def reason_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("reason").agg(F.countDistinct("datastream_id").alias("n"))


# --- features -------------------------------------------------------------

def requests(
    accepted: DataFrame, lags: int, grid: Grid = Grid(), contexts: Mapping[str, Sequence[Context]] = CONTEXTS
) -> DataFrame:
    """Which ticks of which series are needed, each window once: ``at, feature, site, code, lo, hi``.

    ``at`` is the tick of the event's hour. Lags depend on the event's series
    and that hour, a context on its feature and the hour, neither on the
    event: any number of events of one series and hour ask for one window.
    """
    rows = [(t, c.name, c.site_id, c.variable_code, c.window) for t, cs in contexts.items() for c in cs]
    spark = accepted.sparkSession
    events = accepted.select(
        "target_variable", "site_id", "variable_code", tick_of("datetime_utc", grid).alias("hi")
    ).distinct()
    own = events.select(
        F.col("hi").alias("at"), F.lit("lags").alias("feature"), "site_id", "variable_code",
        (F.col("hi") - F.lit(lags - 1)).alias("lo"), "hi",
    ).distinct()
    if not rows:
        return own
    table = sized(
        literal_rows(
            spark, "target_variable string, feature string, site_id int, variable_code string, window int", rows
        ),
        len(rows),
    )
    support = events.select("target_variable", "hi").distinct().join(table, "target_variable").select(
        F.col("hi").alias("at"), "feature", "site_id", "variable_code",
        (F.col("hi") - F.col("window") + 1).alias("lo"), "hi",
    ).distinct()
    return own.unionByName(support)


def event_ticks(
    wanted: DataFrame, obs: DataFrame, grid: Grid = Grid(), span: int = 256, by: Sequence[str] = ("datastream_id", "feature")
) -> DataFrame:
    """Regular ticks of every request, gaps described but not yet filled. ``by`` tells requests apart.

    The range join is an equality join on (series, span of ticks): a request
    touches a few spans, an observation one. Only observations in requested
    spans are reduced to ticks.
    """
    keys = ["site_id", "variable_code", "span"]
    spans = wanted.withColumn(
        "span", F.explode(F.sequence(floor_div(F.col("lo"), span), floor_div(F.col("hi"), span)))
    )
    exact = grid if grid.label == "end" else Grid(grid.step, "end", grid.block)
    near = obs.withColumn("span", floor_div(tick_of("datetime_utc", exact), span)).join(
        spans.select(*keys).distinct(), keys, "left_semi"
    )
    clean = near.withColumn(
        "value", blank_negative(F.col("value"), F.col("variable_code").isin(list(LIVE_SIGNED)))
    )
    points = bucket_last(clean, exact, keys=keys)
    inside = (
        spans.join(points, keys)
        .where(F.col("tick").between(F.col("lo"), F.col("hi")))
        .select(*by, "lo", "hi", "tick", "value")
    )
    opening = wanted.select(
        *by, "lo", "hi", (F.col("lo") - 1).alias("tick"), F.lit(None).cast("double").alias("value")
    )
    # At most lags + 1 points per request: an uncut window is bounded here.
    return ticks(as_stretches(next_point(inside.unionByName(opening), by, None), by))


def event_series(
    wanted: DataFrame, obs: DataFrame, fill: str, grid: Grid = Grid()
) -> DataFrame:
    """Filled regular series ending at each event, one row per tick."""
    return event_ticks(wanted, obs, grid).select(
        "datastream_id", "feature", tick_time("tick", grid).alias("datetime"),
        observed_at().isNull().alias("missing_raw"), filled(fill).alias("value"),
    )


def event_features(
    accepted: DataFrame,
    obs: DataFrame,
    lags: int,
    max_gap: int = 10,
    grid: Grid = Grid(),
    contexts: Mapping[str, Sequence[Context]] = CONTEXTS,
) -> DataFrame:
    """Lags, context and calendar of each accepted event, with the reason it cannot be forecast."""
    # One row per window, not per event: written once, it is read for its spans, their points and its opening.
    asked = per_key(requests(accepted, lags, grid, contexts))
    cells = event_ticks(asked, obs, grid, by=WINDOW)
    every = {c.name: c for cs in contexts.values() for c in cs}
    fill_of = {"lags": "time", **{n: c.fill for n, c in every.items()}}
    value = F.lit(None).cast("double")
    for fill in sorted(set(fill_of.values())):
        names = [n for n, f in fill_of.items() if f == fill]
        value = F.when(F.col("feature").isin(names), filled(fill)).otherwise(value)
    t = F.col("tick")
    run = F.when(
        observed_at().isNull(), t - F.coalesce(F.col("prev_tick"), F.col("lo") - 1)
    ).otherwise(F.lit(0))
    cells = cells.select(*WINDOW, "tick", value.alias("v"), run.alias("run"))
    is_lag = F.col("feature") == "lags"
    aggs = [
        F.array_sort(F.collect_list(F.when(is_lag, F.struct("tick", "v")))).alias("_lags"),
        F.count(F.when(is_lag, F.col("v"))).alias("_n_lags"),
        F.max(F.when(is_lag, F.col("run"))).alias("longest_gap"),
    ]
    for name, c in every.items():
        mine = F.col("feature") == name
        v = F.when(mine, F.col("v"))
        number = F.max_by(v, F.when(mine, t)) if c.reduce == "last" else F.avg(v)
        aggs.append(F.when(F.count(v) >= c.least, number).alias(name))
        if c.reduce == "last":
            aggs[-1] = number.alias(name)
    # One row per series and hour, and one per hour with contexts, written once for both joins.
    series = {"_site": F.when(is_lag, F.col("site_id")), "_code": F.when(is_lag, F.col("variable_code"))}
    found = stage(cells.groupBy("at", is_lag.alias("_own"), *[c.alias(n) for n, c in series.items()]).agg(*aggs))
    own = found.where("_own").select(F.col("at").alias("_at"), *series, "_lags", "_n_lags", "longest_gap")
    hours = per_key(found.where("NOT _own").select(F.col("at").alias("_hour"), *every))
    wanted = {n: [t for t, cs in contexts.items() if n in {c.name for c in cs}] for n in every}
    lost = F.lit(None).cast("string")
    for target, cs in contexts.items():
        for c in reversed(cs):
            lost = F.when(
                (F.col("target_variable") == target) & F.col(c.name).isNull(), F.lit(f"no_{c.name}")
            ).otherwise(lost)
    start = F.col("forecast_start_time")
    hourly = accepted.withColumn("_hour", tick_of("datetime_utc", grid))
    out = (
        hourly.join(own, null_safe(hourly, own, {"_hour": "_at", "site_id": "_site", "variable_code": "_code"}))
        .join(hours, "_hour", "left")
        .withColumns({n: F.when(F.col("target_variable").isin(ts), F.col(n)) for n, ts in wanted.items()})
        .withColumn("lags", F.col("_lags.v"))
        .withColumn(
            "failure",
            F.when(F.col("_n_lags") == 0, F.lit("no_history"))
            .when(F.col("longest_gap") >= max_gap, F.lit("long_gap"))
            .when(F.col("_n_lags") < lags, F.lit("unfilled"))
            .otherwise(lost),
        )
        .withColumns(
            {
                "history_end_time": F.col("datetime_utc"),
                "forecast_start_time": shift("datetime_utc", 1, grid),
            }
        )
    )
    return out.withColumns({n: c for n, c in calendar(start).items() if n != "season"}).drop(
        "_lags", "_n_lags", "_hour", "_at", *series
    )


def feature_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """The feature row as JSON text, times as text."""
    types = dict(df.dtypes)
    fields = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
        if types[c].startswith("timestamp")
        else F.col(c)
        for c in columns
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


# --- predictions ----------------------------------------------------------

def forecast_rows(
    features: DataFrame,
    registry: DataFrame,
    horizons: int,
    clip: Clip = Clip(),
    grid: Grid = Grid(),
    family: str = "season_specific",
    json_columns: Sequence[str] = (),
) -> DataFrame:
    """Long prediction rows of the events that can be forecast."""
    ready = features.where(F.col("failure").isNull())
    if json_columns:
        ready = ready.withColumn("feature_row_json", feature_json(ready, json_columns))
    models = registry.select("target_variable", "site_id", "season", "slopes", "intercepts")
    scored = score_linear(
        ready.withColumn("targets", F.array().cast("array<double>")),
        models,
        horizons,
        clip,
        keys=("target_variable", "site_id", "season"),
    )
    return (
        scored.select(
            "*", F.posexplode("y_pred").alias("_pos", "prediction")
        )
        .withColumn("horizon", F.col("_pos") + 1)
        .select(
            F.col("datastream_id").alias("source_datastream_id"),
            F.lit(family).alias("model_family"),
            "target_variable",
            "site_id",
            "season",
            F.coalesce("season", F.lit("")).alias("season_key"),
            "history_end_time",
            "forecast_start_time",
            "horizon",
            horizon_bin("horizon", strict=False).alias("horizon_bin"),
            shift("forecast_start_time", F.col("_pos"), grid).alias("target_timestamp"),
            finite(F.col("prediction")).alias("prediction"),
            "model_path",
            *(["feature_row_json"] if json_columns else []),
        )
    )


def upsert(existing: DataFrame, incoming: DataFrame, order: str = "created_at") -> DataFrame:
    """Existing and incoming predictions, the latest write per key winning.

    Incoming rows win over existing ones; among themselves the larger ``order``
    and then the larger source id wins.
    """
    both = existing.withColumn("_new", F.lit(0)).unionByName(
        incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    since = F.coalesce(micros(F.col(order)), F.lit(EARLIEST)) - EARLIEST if order in both.columns else F.lit(0)
    # Up to 2**60 microseconds from the earliest time on, above them whether the row is new.
    rank = F.col("_new").cast("long") * (1 << 60) + F.least(F.greatest(since, F.lit(0)), F.lit((1 << 60) - 1))
    source = F.coalesce(F.col("source_datastream_id"), F.lit(-(1 << 63)))
    return best_rows(both, PREDICTION_KEY, packed(rank, source)).select(*existing.columns)


def preview(rows: DataFrame, n: int = 8) -> DataFrame:
    return rows.orderBy("target_variable", "site_id", "source_datastream_id", "horizon").limit(n)


def predictions_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Predictions of a set of source ids (a DataFrame with ``source_datastream_id``), ordered."""
    return rows.join(ids, "source_datastream_id", "left_semi").orderBy(
        "target_variable", "site_id", "source_datastream_id", "horizon"
    )


def completeness(ids: DataFrame, rows: DataFrame, expected: int = 24) -> DataFrame:
    """Per expected source id the prediction rows present and whether some are missing."""
    have = rows.groupBy("source_datastream_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.join(have, "source_datastream_id", "left").select(
        "source_datastream_id",
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)) < expected).alias("incomplete"),
    )


# --- upkeep ---------------------------------------------------------------

def target_sites(registry: DataFrame, targets: Mapping[str, str] = LIVE_TARGETS) -> DataFrame:
    """Distinct (target, site) of the registry with the variable code each listens to."""
    code = F.lit(None).cast("string")
    for c, t in targets.items():
        code = F.when(F.col("target_variable") == t, F.lit(c)).otherwise(code)
    return (
        registry.select("target_variable", "site_id")
        .distinct()
        .withColumn("variable_code", code)
        .orderBy("target_variable", "site_id")
    )


def next_hour_rows(facts: DataFrame, combos: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Per target the latest row, moved to the first grid time after it."""
    latest = latest_per_series(facts, ("site_id", "variable_code"))
    return combos.join(latest, ["site_id", "variable_code"]).select(
        "target_variable",
        "site_id",
        "variable_code",
        F.col("datetime_utc").alias("latest_timestamp"),
        F.col("value").alias("latest_value"),
        next_exact("datetime_utc", grid).alias("hypothetical_timestamp"),
        F.col("value").alias("hypothetical_value"),
    )


def delete_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the key set."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def insert_rows(facts: DataFrame, rows: DataFrame, natural: Sequence[str]) -> DataFrame:
    """Facts plus new rows with the next free ids, in the order of their natural key's digest."""
    top = facts.agg(F.coalesce(F.max("datastream_id"), F.lit(0))).scalar()
    numbered = dense_ids(rows, natural, "datastream_id", top)
    return facts.unionByName(numbered.select(*facts.columns))


def history_and_forecast(
    predictions: DataFrame, obs: DataFrame, codes: Mapping[str, str], hours: int = 72, grid: Grid = Grid()
) -> DataFrame:
    """Recent regular history and the forecast of each target in one long table."""
    code = F.lit(None).cast("string")
    for c, t in codes.items():
        code = F.when(F.col("target_variable") == t, F.lit(c)).otherwise(code)
    runs = predictions.select(
        "source_datastream_id", "target_variable", "site_id", "history_end_time"
    ).distinct()
    hi = tick_of("history_end_time", grid)
    wanted = runs.select(
        F.col("source_datastream_id").alias("datastream_id"), F.lit("lags").alias("feature"),
        "site_id", code.alias("variable_code"), (hi - F.lit(hours)).alias("lo"), hi.alias("hi"),
    )
    past = (
        event_series(wanted, obs, "time", grid)
        .withColumnRenamed("datastream_id", "source_datastream_id")
        .join(runs.select("source_datastream_id", "target_variable", "site_id"), "source_datastream_id")
        .select("source_datastream_id", "target_variable", "site_id", "datetime", "value",
                F.lit("history").alias("kind"))
    )
    ahead = predictions.select(
        "source_datastream_id", "target_variable", "site_id",
        F.col("target_timestamp").alias("datetime"), F.col("prediction").alias("value"),
        F.lit("forecast").alias("kind"),
    )
    return past.unionByName(ahead)

"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each callable derives the two logs from the tables in ``sf_dir`` and runs one
operator with the default parameters of ``pulsekit.params``. Keys with
double columns round them to 6 places in a tie-stable way (``stable_round``;
the oracle does the same) because summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit import params as P
from pulsekit.operators import etl
from pulsekit.session import shared_dir
from pulsekit.sources import (
    FEED_SCHEMA, load_fixture_logs, publish_mart, read_log, read_mart, read_published_mart, write_mart,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str, rounded: bool = False):
    def deco(fn):
        if rounded:
            def wrapped(spark, sf_dir, _fn=fn):
                return round_doubles(_fn(spark, sf_dir))
            QUERIES[key] = wrapped
        else:
            QUERIES[key] = fn
        return fn
    return deco


def stable_round(c, places: int = 6):
    """Round a double to ``places`` decimals without tie flips from float noise:
    snap to 9 decimals first (DECIMAL(38, 9)), then round the decimal half-up.
    Out-of-range or non-finite values fall back to a plain round."""
    snapped = F.round(c.try_cast(T.DecimalType(38, 9)), places).cast("double")
    return F.coalesce(snapped, F.round(c, places))


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select([
        stable_round(F.col(f.name), places).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def logs(spark: SparkSession, sf_dir: str):
    return load_fixture_logs(spark, sf_dir)


# ---------------------------------------------------------------- ETL
@query("feed_user_daily")
def _feed_user_daily(spark, sf_dir):
    return etl.feed_user_daily(logs(spark, sf_dir).feed, P.AS_OF)


@query("message_user_daily")
def _message_user_daily(spark, sf_dir):
    return etl.message_user_daily(logs(spark, sf_dir).messages, P.AS_OF)


@query("user_daily_merged")
def _user_daily_merged(spark, sf_dir):
    lg = logs(spark, sf_dir)
    return etl.user_daily_merged(lg.feed, lg.messages, P.AS_OF)


for _dim in etl.DIMENSIONS:
    def _slice(spark, sf_dir, _dim=_dim):
        lg = logs(spark, sf_dir)
        return etl.slice_metrics(lg.feed, lg.messages, P.AS_OF, _dim)
    QUERIES[f"slice_{_dim}"] = _slice


@query("etl_metrics_mart")
def _etl_metrics_mart(spark, sf_dir):
    lg = logs(spark, sf_dir)
    return etl.metrics_mart(lg.feed, lg.messages, P.AS_OF)


@query("etl_mart_roundtrip")
def _etl_mart_roundtrip(spark, sf_dir):
    """Load the mart twice into a fresh folder of the shared checkpoint dir and read it back."""
    lg = logs(spark, sf_dir)
    path = shared_dir(spark, "mart")
    mart = etl.metrics_mart(lg.feed, lg.messages, P.AS_OF)
    write_mart(mart, path)
    write_mart(mart, path)  # a rerun replaces the day instead of appending it again
    return read_mart(spark, path)


@query("etl_mart_published")
def _etl_mart_published(spark, sf_dir):
    """Load two days, one of them twice, by the manifest and read the report day back."""
    lg = logs(spark, sf_dir)
    path = shared_dir(spark, "published-mart")
    for as_of in (P.AS_OF, P.AS_OF.replace(day=P.AS_OF.day - 1), P.AS_OF):
        publish_mart(spark, etl.metrics_mart(lg.feed, lg.messages, as_of), path)
    day = P.AS_OF.replace(day=P.AS_OF.day - 1).isoformat()
    return read_published_mart(spark, path, day, day)


# ---------------------------------------------------------------- feed / app metrics
from pulsekit.operators import audience, pivots  # noqa: E402
from pulsekit.plans import reports  # noqa: E402


def _both(fn, **kw):
    def run(spark, sf_dir):
        lg = logs(spark, sf_dir)
        return fn(lg.feed, lg.messages, P.AS_OF, **kw)
    return run


def _feed_only(fn, **kw):
    def run(spark, sf_dir):
        return fn(logs(spark, sf_dir).feed, P.AS_OF, **kw)
    return run


QUERIES["feed_daily_metrics"] = _feed_only(audience.feed_daily_metrics)
QUERIES["dau_both_services"] = _both(audience.dau_both_services)
QUERIES["dau_both_same_day"] = _both(audience.dau_both_same_day)
QUERIES["dau_only_feed"] = _both(audience.dau_only_feed)
QUERIES["dau_only_messenger"] = _both(audience.dau_only_messenger)
QUERIES["dau_segments"] = _both(audience.dau_segments)
QUERIES["activity_by_hour"] = _both(audience.activity_by_hour)
QUERIES["new_posts_daily"] = _feed_only(audience.new_posts_daily)
QUERIES["app_daily_actions"] = _both(audience.app_daily_actions)
QUERIES["retention_cohorts"] = _both(audience.retention_cohorts)
QUERIES["acquisition_by_source"] = _both(audience.acquisition_by_source)
QUERIES["activity_heatmap"] = _both(pivots.activity_heatmap)
QUERIES["retention_matrix_organic"] = _both(pivots.retention_matrix, source="organic")
QUERIES["retention_matrix_ads"] = _both(pivots.retention_matrix, source="ads")
QUERIES["retention_rate_by_source"] = lambda s, d: round_doubles(
    _both(audience.retention_rate_by_source, cohorts=P.RETENTION_COHORTS)(s, d))
QUERIES["ads_cohort_dau"] = _both(audience.cohort_dau, source="ads",
                                  start_from=P.CAMPAIGN_START, start_to=P.CAMPAIGN_END)
QUERIES["ads_cohort_feed_dau"] = _both(audience.cohort_dau, source="ads", start_from=P.CAMPAIGN_START,
                                       start_to=P.CAMPAIGN_END, feed_only=True)
QUERIES["dau_drop_by_city"] = lambda s, d: round_doubles(_feed_only(audience.dau_change_by, dimension="city")(s, d))
QUERIES["feed_report_latest"] = _feed_only(reports.feed_report_latest)
QUERIES["app_report_latest"] = _both(reports.app_report_latest)
QUERIES["app_week_series"] = _both(reports.app_week_series)


# ---------------------------------------------------------------- experiment facts
from pulsekit.operators import experiment as X  # noqa: E402
from pulsekit.operators.histogram import equal_width_histogram  # noqa: E402


def user_metrics(spark, sf_dir, groups=P.ALL_GROUPS, first=P.EXPERIMENT_START, last=P.EXPERIMENT_END, extra=()):
    return X.user_ctr(logs(spark, sf_dir).feed, first, last, groups, extra)


def ab_users(spark, sf_dir):
    return user_metrics(spark, sf_dir, (P.AB_CONTROL, P.AB_TEST))


def split_users(spark, sf_dir):
    demo = user_metrics(spark, sf_dir, (P.AB_CONTROL, P.AB_TEST), extra=("gender", "city", "age"))
    return X.ctr_split(demo, P.AB_TEST, P.CTR_SPLIT_THRESHOLD).drop("city")


query("user_ctr", rounded=True)(lambda s, d: user_metrics(s, d))
query("global_ctr", rounded=True)(lambda s, d: X.group_ctr(user_metrics(s, d)))
query("aa_group_counts")(lambda s, d: X.column_counts(user_metrics(s, d, P.AA_GROUPS)))
query("describe_by_group", rounded=True)(lambda s, d: X.describe(ab_users(s, d), ["exp_group"], ["ctr", "views"]))
query("ctr_histogram", rounded=True)(
    lambda s, d: equal_width_histogram(ab_users(s, d), "ctr", P.HIST_BINS, by=["exp_group"]))
query("smoothed_ctr", rounded=True)(lambda s, d: X.smoothed_ctr(ab_users(s, d), P.SMOOTHING_ALPHA))
query("smoothed_ctr_histogram", rounded=True)(lambda s, d: equal_width_histogram(
    X.to_long(X.smoothed_ctr(ab_users(s, d), P.SMOOTHING_ALPHA), ["exp_group"], ["ctr", "smoothed_ctr"]),
    "value", P.HIST_BINS, by=["metric", "exp_group"], edges_by=["metric"]))
query("smoothing_effect", rounded=True)(lambda s, d: X.smoothing_effect(
    X.smoothed_ctr(ab_users(s, d), P.SMOOTHING_ALPHA), P.AB_CONTROL, P.AB_TEST))
query("linearized_likes", rounded=True)(lambda s, d: X.linearized_likes(user_metrics(s, d), P.LINEARIZATION_PAIRS))
query("bucket_ctr", rounded=True)(lambda s, d: X.bucket_ctr(ab_users(s, d), P.N_BUCKETS))
query("bucket_counts")(lambda s, d: X.bucket_counts(X.bucket_ctr(ab_users(s, d), P.N_BUCKETS)))
query("pre_period_ctr_histogram", rounded=True)(lambda s, d: equal_width_histogram(
    user_metrics(s, d, (P.AB_TEST,), P.PRE_PERIOD_START, P.PRE_PERIOD_END), "ctr", P.HIST_BINS, by=["exp_group"]))
query("user_ctr_demographics", rounded=True)(lambda s, d: user_metrics(
    s, d, (P.AB_CONTROL, P.AB_TEST), extra=("gender", "city", "age")).drop("city"))
query("ctr_split_users", rounded=True)(split_users)
query("ctr_split_describe", rounded=True)(lambda s, d: X.describe(split_users(s, d), ["segment"], ["likes", "views"]))


# ---------------------------------------------------------------- hypothesis tests
from pulsekit.operators.hypothesis import mann_whitney_u, welch_ttest  # noqa: E402

AB_PAIRS_WELCH = [(P.AB_CONTROL, P.AB_TEST), P.AA_GROUPS, P.LINEARIZATION_PAIRS[0]]
AB_PAIRS_MWU = [(P.AB_TEST, P.AB_CONTROL), P.AA_GROUPS]
TEST_FIRST = [(P.AB_TEST, P.AB_CONTROL)]


def _metric(df, name):
    return df.select(F.lit(name).alias("metric"), "*")


query("welch_ctr", rounded=True)(lambda s, d: _metric(
    welch_ttest(user_metrics(s, d), "exp_group", "ctr", AB_PAIRS_WELCH), "ctr"))
query("mwu_ctr", rounded=True)(lambda s, d: _metric(
    mann_whitney_u(user_metrics(s, d), "exp_group", "ctr", AB_PAIRS_MWU), "ctr"))
query("welch_smoothed_ctr", rounded=True)(lambda s, d: _metric(welch_ttest(
    X.smoothed_ctr(ab_users(s, d), P.SMOOTHING_ALPHA), "exp_group", "smoothed_ctr", TEST_FIRST), "smoothed_ctr"))
query("mwu_smoothed_ctr", rounded=True)(lambda s, d: _metric(mann_whitney_u(
    X.smoothed_ctr(ab_users(s, d), P.SMOOTHING_ALPHA), "exp_group", "smoothed_ctr", TEST_FIRST), "smoothed_ctr"))
query("welch_linearized", rounded=True)(lambda s, d: welch_ttest(
    X.to_long(X.linearized_likes(user_metrics(s, d), P.LINEARIZATION_PAIRS),
              ["control_group", "test_group", "exp_group"], ["ctr", "linearized_likes"]),
    "exp_group", "value", P.LINEARIZATION_PAIRS, by=["metric", "control_group", "test_group"]))
query("welch_bucket", rounded=True)(lambda s, d: _metric(
    welch_ttest(X.bucket_ctr(ab_users(s, d), P.N_BUCKETS), "exp_group", "bucket_ctr", TEST_FIRST), "bucket_ctr"))
query("mwu_bucket", rounded=True)(lambda s, d: _metric(
    mann_whitney_u(X.bucket_ctr(ab_users(s, d), P.N_BUCKETS), "exp_group", "bucket_ctr", TEST_FIRST), "bucket_ctr"))
query("ctr_split_mwu", rounded=True)(lambda s, d: mann_whitney_u(
    X.to_long(split_users(s, d), ["segment"], ["age", "gender", "likes", "views"]),
    "segment", "value", [("low", "high")], by=["metric"]))


# ---------------------------------------------------------------- resampling
from pulsekit.operators import resampling as RS  # noqa: E402


def boot_means(s, d):
    return RS.bootstrap_means(ab_users(s, d), "exp_group", "ctr", P.REPLICATES, P.SEED)


def poisson(s, d):
    return RS.poisson_bootstrap_ctr(ab_users(s, d), P.REPLICATES, P.SEED)


def aa_tests(s, d):
    um = user_metrics(s, d, P.AA_GROUPS)
    sizes = um.where(F.col("ctr").isNotNull()).groupBy("exp_group").count().collect()  # one row per arm
    n = max(2, round(min((r["count"] for r in sizes), default=0) * P.AA_SHARE))
    return RS.aa_simulation(um, P.AA_GROUPS[0], P.AA_GROUPS[1], P.AA_ITERATIONS, n, P.SEED)


def _once(df):
    """Write a small frame that is read twice to the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _series(df, prefix, value):
    return df.select(F.concat(F.lit(prefix), F.col("exp_group").cast("string")).alias("series"),
                     F.col(value).cast("double").alias("value"))


def boot_histograms(s, d):
    pb = poisson(s, d)
    long = (
        _series(boot_means(s, d), "resample_mean_g", "mean")
        .unionByName(_series(pb, "poisson_ctr_g", "ctr"))
        .unionByName(RS.replicate_difference(pb, P.AB_CONTROL, P.AB_TEST).select(
            F.lit("poisson_diff").alias("series"), F.col("diff").alias("value")))
    )
    return equal_width_histogram(_once(long), "value", P.HIST_BINS, by=["series"], edges_by=["series"])


query("bootstrap_means", rounded=True)(boot_means)
query("welch_bootstrap", rounded=True)(lambda s, d: welch_ttest(
    boot_means(s, d), "exp_group", "mean", [(P.AB_CONTROL, P.AB_TEST)]))
query("mwu_bootstrap", rounded=True)(lambda s, d: mann_whitney_u(
    boot_means(s, d), "exp_group", "mean", [(P.AB_CONTROL, P.AB_TEST)]))
query("poisson_bootstrap_ctr", rounded=True)(poisson)
query("poisson_bootstrap_diff", rounded=True)(lambda s, d: RS.replicate_difference(
    poisson(s, d), P.AB_CONTROL, P.AB_TEST))
query("welch_poisson_bootstrap", rounded=True)(lambda s, d: welch_ttest(
    poisson(s, d), "exp_group", "ctr", [(P.AB_CONTROL, P.AB_TEST)]))
query("bootstrap_histograms", rounded=True)(boot_histograms)
query("aa_simulation", rounded=True)(aa_tests)
query("aa_pvalue_histogram", rounded=True)(lambda s, d: equal_width_histogram(
    _once(aa_tests(s, d)), "p_value", P.PVALUE_BINS))
query("aa_false_positive_rate", rounded=True)(lambda s, d: RS.false_positive_rate(aa_tests(s, d)))


# ---------------------------------------------------------------- streaming
from pulsekit.streaming.live import run_live_feed_metrics, run_today_panel  # noqa: E402

query("live_feed_metrics", rounded=True)(lambda s, d: run_live_feed_metrics(s, d, glob="events.parquet").drop(
    "active_users"))
query("live_feed_users")(lambda s, d: run_live_feed_metrics(s, d, glob="events.parquet").select(
    "window_start", "window_end", "active_users"))
query("live_today_panel", rounded=True)(lambda s, d: run_today_panel(s, d, glob="events.parquet"))


# ---------------------------------------------------------------- history dashboard, SQL entry, inspection
from datetime import timedelta as _td  # noqa: E402

from pulsekit.sources.sql import FEED_DAILY_SQL, extract_df  # noqa: E402

QUERIES["feed_history_metrics"] = _feed_only(audience.feed_history_metrics)
QUERIES["activity_history_by_hour"] = _both(audience.activity_history_by_hour)


@query("feed_daily_metrics_sql")
def _feed_daily_sql(spark, sf_dir):
    """The feed KPI query through Spark SQL with named parameter markers and the log as an argument."""
    return extract_df(spark, FEED_DAILY_SQL, {"feed": logs(spark, sf_dir).feed},
                      first=P.AS_OF - _td(days=7), last=P.AS_OF - _td(days=1))


_TABLES: dict[tuple[str, str], str] = {}


@query("feed_daily_metrics_table")
def _feed_daily_table(spark, sf_dir):
    """The feed KPIs from a namespaced catalog table (made from the log once a session, in the shared folder)."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _TABLES:
        location = shared_dir(spark, "feed-table")
        name = "pulsekit_" + location.rsplit("-", 1)[1]
        spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
        logs(spark, sf_dir).feed.write.saveAsTable(f"{name}.feed_actions")
        _TABLES[at] = f"{name}.feed_actions"
    return audience.feed_daily_metrics(read_log(spark, _TABLES[at], FEED_SCHEMA), P.AS_OF)


query("user_ctr_preview", rounded=True)(lambda s, d: reports.preview(user_metrics(s, d), ["exp_group", "user_id"]))
query("user_ctr_shape")(lambda s, d: reports.shape(user_metrics(s, d)))


# ---------------------------------------------------------------- incremental user state
from pulsekit.operators import user_state as US  # noqa: E402
from pulsekit.plans import daily  # noqa: E402


_STORED: dict[tuple[str, str], str] = {}


def _stored_root(spark, sf_dir) -> str:
    """State in the shared folder, built once a session: a backfill, a day loaded ahead, a late
    day, a repeated day and a last run that also loads the day that was skipped."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _STORED:
        lg, root = logs(spark, sf_dir), shared_dir(spark, "user-state")
        daily.update_history(spark, lg.feed, lg.messages, P.AS_OF - _td(days=4), root)
        for before in (3, 4, 3):
            daily.load_day(spark, lg.feed, lg.messages, P.AS_OF - _td(days=before), root)
        daily.update_history(spark, lg.feed, lg.messages, P.AS_OF, root)
        _STORED[at] = root
    return _STORED[at]


def _state(spark, sf_dir):
    first_seen, sources = US.read_state(spark, _stored_root(spark, sf_dir))
    return logs(spark, sf_dir), first_seen, sources


def _daily_state(spark, sf_dir):
    return US.read_daily_state(spark, _stored_root(spark, sf_dir))


@query("acquisition_from_state")
def _acq_state(spark, sf_dir):
    _, fs, us = _state(spark, sf_dir)
    return US.acquisition_from_state(fs, us, P.AS_OF)


@query("retention_from_state")
def _ret_state(spark, sf_dir):
    lg, fs, _ = _state(spark, sf_dir)
    return US.retention_from_state(lg.feed, lg.messages, fs, P.AS_OF)


@query("dau_only_feed_from_state")
def _dof_state(spark, sf_dir):
    lg, fs, _ = _state(spark, sf_dir)
    return US.dau_only_feed_from_state(lg.feed, fs, P.AS_OF)


@query("app_daily_actions_from_state")
def _ada_state(spark, sf_dir):
    return US.app_daily_actions_from_state(*_daily_state(spark, sf_dir), P.AS_OF)


def _aa_ctr_histogram(s, d):
    """The A/A CTR histogram with seaborn's automatic bins, edges shared by both groups."""
    from pulsekit.operators.histogram import auto_bin_count
    um = user_metrics(s, d, P.AA_GROUPS)
    return equal_width_histogram(um, "ctr", auto_bin_count(um, "ctr"), by=["exp_group"])


query("aa_ctr_histogram", rounded=True)(_aa_ctr_histogram)



@query("dau_segments_from_state")
def _dau_state(spark, sf_dir):
    lg, fs, _ = _state(spark, sf_dir)
    return US.dau_segments_from_state(lg.feed, lg.messages, fs, P.AS_OF)


@query("app_report_from_state")
def _app_report_state(spark, sf_dir):
    lg, fs, us = _state(spark, sf_dir)
    return US.app_report_from_state(lg.feed, lg.messages, fs, us, *_daily_state(spark, sf_dir), P.AS_OF)


@query("feed_history_from_state")
def _feed_history_state(spark, sf_dir):
    return US.feed_history_from_state(_daily_state(spark, sf_dir)[0], P.AS_OF)


@query("retention_rate_from_state", rounded=True)
def _rate_state(spark, sf_dir):
    lg, fs, _ = _state(spark, sf_dir)
    return US.retention_rate_from_state(lg.feed, lg.messages, fs, P.AS_OF, P.RETENTION_COHORTS)


# ---------------------------------------------------------------- activity bitsets, bitmaps, sketches
from datetime import date as _date  # noqa: E402

from pulsekit.operators import activity_bits as AB, audience_sketches as AS, drilldown  # noqa: E402

_ACTIVITY: dict[tuple[str, str], str] = {}


def _activity(spark, sf_dir):
    """The bitset state, built once a session: a backfill, a day loaded ahead, a late day, a repeated day and the rest."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _ACTIVITY:
        lg, root = logs(spark, sf_dir), shared_dir(spark, "activity-bits")
        AB.load_activity(spark, root, lg.feed, lg.messages, _date(1970, 1, 1), P.AS_OF - _td(days=5))
        for before in (3, 4, 3):
            AB.load_activity(spark, root, lg.feed, lg.messages, P.AS_OF - _td(days=before))
        AB.load_activity(spark, root, lg.feed, lg.messages, P.AS_OF - _td(days=2), P.AS_OF)
        _ACTIVITY[at] = root
    return AB.read_activity(spark, _ACTIVITY[at])


def _bits(fn, *args, **kw):
    return lambda s, d: fn(_activity(s, d), P.AS_OF, *args, **kw)


QUERIES["retention_from_bits"] = _bits(AB.retention_from_bits)
QUERIES["acquisition_from_bits"] = _bits(AB.acquisition_from_bits)
QUERIES["ads_cohort_dau_from_bits"] = _bits(AB.cohort_dau_from_bits, "ads", P.CAMPAIGN_START, P.CAMPAIGN_END)
QUERIES["ads_cohort_feed_dau_from_bits"] = _bits(AB.cohort_dau_from_bits, "ads", P.CAMPAIGN_START, P.CAMPAIGN_END, True)
QUERIES["dau_segments_from_bits"] = _bits(AB.dau_segments_from_bits)
QUERIES["dau_both_same_day_from_bits"] = _bits(AB.dau_both_same_day_from_bits)
query("retention_rate_from_bits", rounded=True)(_bits(AB.retention_rate_from_bits, P.RETENTION_COHORTS))
for _source in ("organic", "ads"):
    QUERIES[f"retention_matrix_{_source}_from_bits"] = lambda s, d, _source=_source: pivots.retention_matrix_from(
        AB.retention_from_bits(_activity(s, d), P.AS_OF), P.AS_OF, _source)
query("dau_drop_by_dimension", rounded=True)(_feed_only(drilldown.dau_change_by_dimensions))


@query("audience_from_sketches")
def _audience_sketches(spark, sf_dir):
    """Segments from day sketches of up to 65,536 users each (exact while a service has no more)."""
    lg = logs(spark, sf_dir)
    sketches = AS.daily_sketches(lg.feed, lg.messages, _date(1970, 1, 1), P.AS_OF, lg_k=16)
    return AS.segments_from_sketches(sketches, P.AS_OF, lg_k=16).drop("margin")

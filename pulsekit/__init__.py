"""pulsekit: product analytics and experiment analysis on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame. Dates, windows,
seeds and sizes are explicit arguments; nothing is collected to the driver
except bounded summaries (quantile edges, per-group sizes, histogram ranges).

Main entry points:
  sources.read_log / logs_from_events        the feed and message logs
  operators.etl.metrics_mart                 the daily sliced metrics mart
  operators.audience / plans.reports         DAU, cohorts, acquisition, report data
  operators.experiment                       per-user CTR, smoothing, linearization, buckets
  operators.hypothesis                       Welch t-test, Mann-Whitney U
  operators.resampling                       bootstraps and the A/A simulation
  operators.user_state                       incremental history state
  plans.daily                                one call per daily job
  streaming.live                             live feed metrics
"""

from pulsekit.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]

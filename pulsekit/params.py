"""Default parameters of the analyses (all overridable per call).

Fixed values (they define the fixture calendar and the experiment design):
  as_of ("today")            2024-01-31
  report / ETL day           as_of - 1 = 2024-01-30
  trailing window            7 full days before as_of: 2024-01-24 .. 2024-01-30
  experiment window          2024-01-24 .. 2024-01-30
  pre-period window          2024-01-12 .. 2024-01-23
  A/B arms                   control 1, test 2
  A/A arms                   2, 3
  linearization pairs        (0, 3), (1, 2)
  smoothing alpha            5
  buckets                    50
  CTR split threshold        0.2
  histogram bins             100 (metrics), 50 (A/A p-values)
  replicates                 2000
  A/A iterations             10000, samples of 500 of about 4300 users an arm: the same share here
"""

from datetime import date

AS_OF = date(2024, 1, 31)
EXPERIMENT_START = date(2024, 1, 24)
EXPERIMENT_END = date(2024, 1, 30)
PRE_PERIOD_START = date(2024, 1, 12)
PRE_PERIOD_END = date(2024, 1, 23)
AB_CONTROL, AB_TEST = 1, 2
AA_GROUPS = (2, 3)
LINEARIZATION_PAIRS = ((0, 3), (1, 2))
ALL_GROUPS = (0, 1, 2, 3)
SMOOTHING_ALPHA = 5.0
N_BUCKETS = 50
CTR_SPLIT_THRESHOLD = 0.2
HIST_BINS = 100
PVALUE_BINS = 50
REPLICATES = 2000
AA_ITERATIONS = 10000
AA_SHARE = 500 / 4300  # A/A sample as a share of the smaller arm
SEED = 42
ALTERNATIVES = ("less", "greater", "two-sided")
# ad campaign cohort for the cohort-DAU analysis
CAMPAIGN_START = date(2024, 1, 8)
CAMPAIGN_END = date(2024, 1, 14)
RETENTION_COHORTS = 20

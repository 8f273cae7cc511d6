"""cohortflow: early-warning cohort analytics on entity/event data, on Spark.

Audits raw tables, builds leakage-safe features as of several cutoff days in
one distributed pass, restricts to the cohort still active at each cutoff,
prepares model-ready matrices and evaluates classifiers with stratified folds.
"""

__version__ = "0.1.0"

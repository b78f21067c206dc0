"""foldwise — model-study analytics as Spark DataFrame jobs.

Every study (splits, encoders, neighbour joins, linear paths, trees,
clustering, projections, metrics, searches) is expressed as DataFrame /
SQL work so Catalyst plans it and the cluster runs it; results come back
as tidy DataFrames.
"""

from foldwise.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"

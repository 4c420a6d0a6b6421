"""dwkit: data-quality scoring, rule-driven cleaning and star-schema building on Spark.

Layout
------
``sources``    readers, sinks, reconciliation and the driver-table bindings
``functions``  ``Column -> Column`` expressions (value repair, buckets, rules)
``operators``  DataFrame operators (quality scoring, profiling, outliers, joins,
               windows, warehouse build, KPIs)
``plans``      multi-step plans: cleaning with an audit trail, schema contracts,
               warehouse build, run log
``streaming``  nothing: the studied system has no stream operators
"""

from .session import get_spark, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]

"""hourgrid: hourly building-energy panels, features and forecasts on Spark.

Layers, from the inside out:

* ``functions``  column expressions (time parsing, calendar parts, error terms)
* ``operators``  DataFrame -> DataFrame steps, lazy and without actions
* ``models``     forecasters fitted and scored as Spark jobs
* ``sources``    schema'd readers and writers
* ``plans``      the end-to-end pipelines, the query catalog and its SQL oracle
"""

from hourgrid.config import (
    BoostedTreeParams,
    FeatureSpec,
    QualityThresholds,
    TrendSeasonalParams,
)

__all__ = [
    "BoostedTreeParams",
    "FeatureSpec",
    "QualityThresholds",
    "TrendSeasonalParams",
]

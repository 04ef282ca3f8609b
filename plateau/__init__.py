"""plateau — interaction analytics and ranking as Spark DataFrame plans.

Sub-packages:
  functions/  Column -> Column expressions (event cleaning, parsing, calendar, sets, hashing)
  sources/    scans, sinks, validation and the fixture views over the driver tables
  operators/  DataFrame -> DataFrame operators (profiles, pairs, features, text, splits,
              evaluation, exploration, reconciliation, recommendation, ranker)
  plans/      end-to-end jobs composed from operators (event cleaning, reconciliation,
              training data, batch recommendation)
  streaming/  the row-wise event-cleaning job on a streaming DataFrame
"""

from plateau.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

"""vatio: hourly power-generation analytics written as Spark DataFrame plans.

Layers:
  functions/  Column -> Column helpers (text cleaning, numerics, time, geo, energy)
  operators/  reusable DataFrame operators (latest-wins dedup, top-1, two-level
              aggregates, forward fill, sized broadcast, data quality, metrics)
  sources/    raw-table contracts, landing JSONL / page / archive readers and
              writers, partitioned table catalog, the testdata adapter
  plans/      the models (staging -> intermediate -> marts) and the pipeline
  streaming/  incremental (file-stream) loading of landed batches
"""

__version__ = "0.1.0"

"""mixlens: composition features and regression preparation as Spark DataFrame plans.

Modules:
  functions   expression builders (composition statistics, ratios, key-hash draws)
  operators   DataFrame -> DataFrame operators (composition, properties, binning,
              split, text, metrics, joins)
  sources     typed CSV / Parquet / text scans and the element dimension
  sinks       Parquet, split, bucketed and metrics writers
  ml          persistable composition stage, forest pipeline, save/load
  streaming   the map-only features on a file stream
  plans       inputs derived from the driver tables, registered queries, oracles
"""

__version__ = "0.1.0"

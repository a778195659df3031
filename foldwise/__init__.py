"""foldwise — Spark-native feature stages, metrics, validation splits and
training flows for tabular data.

Subpackages: `operators` (stages and relational building blocks),
`functions` (column expressions), `sources` (scans and sinks), `plans`
(folds, learners, flows), `streaming` (fitted stages on streams), and
`registry` (check queries with their SQL equivalents).
"""

__version__ = "0.1.0"

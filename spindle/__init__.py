"""spindle: batch and streaming text and sensor analytics written as Spark jobs.

Sub-packages:
  sources    - readers: text lines, CSV/TSV layouts, LIBSVM, JSON, Kafka, JDBC, socket
  functions  - Column-expression helpers (splitting, parsing, label rules)
  operators  - batch operators: word counts, running state, sliding windows,
               upserts, offset ranges, set operations, TF-IDF, classifiers
  streaming  - Structured Streaming twins of the stateful operators
  sinks      - keyed upsert table, model persistence, console / memory sinks
  plans      - stand-in inputs derived from the test tables and the query registry
"""

__version__ = "0.1.0"

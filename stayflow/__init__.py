"""stayflow: rental-marketplace analytics as PySpark DataFrame operators.

Layout:
  functions/  Column -> Column helpers (parsing, keys, masking, dates, ratios, bands)
  operators/  DataFrame -> DataFrame operators (dedupe, latest-wins, flatten,
              vocabulary pivot, gap-and-island, spans, censoring, shares, ranks)
  sources/    table readers, vocabulary seeds, the binding of the driver's
              tables to the rental concepts, and sinks
  plans/      the layered build (staging -> intermediate -> marts), the metric
              layer, the business questions and the data-quality checks
  llm/        operators for training corpora (optional; nothing else imports it)
"""

__version__ = "0.1.0"

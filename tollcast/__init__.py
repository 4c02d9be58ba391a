"""tollcast: time-window feature engineering and regression on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function that takes column
names as parameters, so the same code serves road-sensor tables and any other
table with a timestamp, a key and a measure.

Layout
------
``sources``    CSV/parquet scans and sinks, views, schema and shape listings.
``functions``  column expressions: time arithmetic, calendar, lists, metrics.
``operators``  relational and order-dependent operators (bins, lags, repair,
               gap fill, route features, profile, models).
``plans``      end-to-end feature jobs and the query catalogue.
``streaming``  the bin/count operator as a Structured Streaming job.
"""

__version__ = "0.1.0"

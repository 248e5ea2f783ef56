"""hostlens: short-term-rental analytics as Spark DataFrame operators.

Layout
------
sources/    schemas, CSV and Parquet readers/writers, bindings of the
            driver tables to the listings / calendar / reviews roles
functions/  Column -> Column building blocks (parsing, text, geo, dates)
operators/  DataFrame -> DataFrame steps (cleaning, joins, aggregates,
            windows, text statistics, pricing grid, ML stages)
plans/      the end-to-end jobs composed from operators
streaming/  incremental (Structured Streaming) ingest of the same cleaning
"""

__version__ = "0.1.0"

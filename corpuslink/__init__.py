"""Text and record analytics on Spark: DataFrame in, DataFrame out.

Sub-packages

``sources``    readers and writers (word lists, records, pages, tables, lists)
``functions``  Column expressions (geo, urls, words, grams, similarity)
``operators``  multi-step DataFrame operators built from them
``streaming``  the same operators over Structured Streaming inputs
``plans``      the registered queries over the sample tables and their SQL
"""

__version__ = "0.1.0"

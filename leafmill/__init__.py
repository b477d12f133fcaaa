"""leafmill: retail flyers in, queryable offer tables out, on PySpark.

``functions``  column expressions (no Spark job of their own)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and writers of messages, content and tables
``streaming``  the stateful fold and the three streaming queries around it
``plans``      dashboard reports, and the same operators over the test tables
"""

__version__ = "0.1.0"

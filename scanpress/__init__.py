"""scanpress: Spark-native newspaper scan-to-article corpus engine.

Every operator is a plain function ``DataFrame -> DataFrame`` or
``Column -> Column`` so it composes with ``df.transform`` and lets
Catalyst plan the whole job.
"""

__version__ = "0.1.0"

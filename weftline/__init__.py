"""weftline: finding reused passages in document collections, on Spark.

Everything is a DataFrame-to-DataFrame function or a Column expression.  Sub-packages:

* ``functions``  column expressions: text cleaning, tokens, vectors, edit distance
* ``sources``    readers and writers
* ``operators``  segmentation, embedding, similarity join, labelling, alignment
* ``plans``      configuration, whole pipelines, run-time helpers
* ``streaming``  the same projections over unbounded input
"""

__version__ = "0.1.0"

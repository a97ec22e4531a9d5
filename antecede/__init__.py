"""antecede: point-in-time analytics for head-to-head event data, on Spark.

Layers, from raw text to features:

* ``sources``    landing files, the exactly-once load, seeds, web-page tables
* ``streaming``  the same load as a Structured Streaming job
* ``functions``  ``Column -> Column`` parsers and key functions
* ``operators``  reusable DataFrame operators (latest version, two-sided rows,
  strictly-prior measures, data tests, contracts)
* ``plans``      the pipeline itself: staging, participants, career, marts,
  feature matrix, serving reads, declared checks
"""

__version__ = "0.1.0"

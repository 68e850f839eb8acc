"""feedloom: curation of landed web-feed records on Spark.

Every operator is either a ``Column -> Column`` expression builder
(``feedloom.functions``) or a ``DataFrame -> DataFrame`` transform
(``feedloom.operators``, ``feedloom.sources``, ``feedloom.streaming``)
meant to be chained with ``DataFrame.transform``.  Nothing here reads
a wall clock: time-dependent operators take an ``as_of`` parameter.
"""

__version__ = "0.1.0"

"""lotwise: Spark-native analytics over marketplace vehicle listings.

Every public operator is a pure ``DataFrame -> DataFrame`` (or ``Column``)
function: no actions inside, no Python UDFs, so Catalyst sees one plan.
"""

__version__ = "0.1.0"

"""panewise: order-event metrics over sliding event-time windows on Spark.

Every operator is a ``DataFrame -> DataFrame`` function that works on a
bounded DataFrame and, where the semantics allow it, on a streaming one.
"""

from panewise.schema import Params

__all__ = ["Params"]
__version__ = "0.1.0"

"""rivulet — named record flows on Spark DataFrames.

Sources, item steps, conditional routing to queues, keyed processing,
reference lookups, batch metrics and array-column steps, each a function
``DataFrame → DataFrame``; :class:`~rivulet.plans.flow.Flow` names them, and
:mod:`rivulet.streaming` runs the same steps on Structured Streaming.
"""

from .plans.flow import Flow  # noqa: F401

__version__ = "0.1.0"

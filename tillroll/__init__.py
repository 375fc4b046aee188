"""tillroll: shopping-receipt (market-basket) analytics as Spark DataFrame plans.

Three questions over receipts (a date and a list of items) and a price list:

* :func:`monthly_top_products` -- the k best-selling products of each month;
* :func:`monthly_revenue` -- units x price per product and month;
* :func:`pair_rules` -- support and confidence of every ordered product pair.

Everything is built from built-in Spark SQL expressions, aggregations,
windows and joins; there is no Python UDF.
"""

from tillroll.operators import *  # noqa: F401,F403
from tillroll.operators import __all__ as _ops
from tillroll.sources import *  # noqa: F401,F403
from tillroll.sources import __all__ as _srcs

__all__ = list(_ops) + list(_srcs)

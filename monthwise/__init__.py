"""monthwise: subscription-revenue analytics as Spark jobs.

Layers (each a plain function ``(DataFrames, Params) -> DataFrame``):

* ``sources``   - raw table contracts, adapters from the test tables, incremental loads
* ``functions`` - column-level helpers (money, epochs, surrogate keys, month spine)
* ``operators`` - reusable table operators (range expansion, movement classifier,
                  data-quality checks, sessionisation, SCD2 history)
* ``plans``     - named models: staging, periods, accounts, MRR fact, reports, growth
* ``streaming`` - Structured Streaming load of the append-only events table
"""

from monthwise.params import Params

__all__ = ["Params"]

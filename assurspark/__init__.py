"""assurspark: insurance reporting jobs and their data operators on Spark DataFrames.

Entry points: ``plans.claims`` (claims reported / outstanding / settled),
``plans.production`` (daily premium production), ``sources.catalog.Tables``
(input tables), ``session.configure`` (settings), ``cli`` (batch runs).
"""

__version__ = "0.1.0"

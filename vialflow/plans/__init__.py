"""Registered table jobs over the fixture tables, each with its SQL answer.

Importing this package registers every plan module.
"""

from vialflow.plans import (  # noqa: F401
    columns, evaluation, interfaces, joining, mining, models, planning, similarity, streaming, summaries, windows,
    wrangling)
from vialflow.plans.registry import HEADLINE, ORACLE, QUERIES  # noqa: F401

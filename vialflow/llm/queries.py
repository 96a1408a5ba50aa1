"""All queries and SQL of this package; importing it registers them."""

from vialflow.llm import (  # noqa: F401
    factors, idstore, linecrf, mixing, neardup, ngrams, packing, quality, ranking, suffixes, toolcalls, topk, whitening)
from vialflow.llm.common import ORACLE, QUERIES  # noqa: F401

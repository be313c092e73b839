"""All queries of this package."""

from barloom.llm import (  # noqa: F401
    interleave,
    jaccard,
    mixing,
    negatives,
    passages,
    periodic,
    pii,
    preferences,
    secret_scan,
    templates,
    toxicity,
    url_rules,
    vantage,
)
from barloom.llm.registry import ORACLES, QUERIES  # noqa: F401

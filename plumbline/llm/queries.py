"""All queries of this subpackage: importing the operators registers theirs."""

from plumbline.llm import (  # noqa: F401
    alignment,
    ann,
    chat,
    decontam,
    langid,
    licenses,
    linededup,
    ngrams,
    packing,
    passages,
    periodic,
    pii,
    simhash,
)
from plumbline.llm.registry import ORACLES, QUERIES  # noqa: F401

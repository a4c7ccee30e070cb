"""The registered queries of this package, one per operator."""

from forecourt.llm import alignment, decontaminate, divergence, exact, hamming, html, licenses, pieces, quality, simhash, suffixes, urls, warc  # noqa: F401
from forecourt.llm.common import ORACLE, QUERIES  # noqa: F401

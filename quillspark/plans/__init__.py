"""The registered queries of the core and their SQL."""

from quillspark.plans import corpus, pages, roundtrips, search, usage

_PARTS = (search, pages, corpus, usage, roundtrips)

QUERIES: dict = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
ORACLE: dict = {k: v for p in _PARTS for k, v in p.ORACLE.items()}

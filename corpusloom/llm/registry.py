"""The queries and oracle SQL of the corpus operators, for ``__spark_entry__``."""

from __future__ import annotations

from corpusloom.llm import ann, decontaminate, lexical, mixing, neardup, ngramjoin, quality, repeats, runs, sharding, toxicity, urlfilter, warc

MODULES = (urlfilter, quality, neardup, repeats, ann, sharding, toxicity, warc, mixing, decontaminate, lexical, ngramjoin, runs)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

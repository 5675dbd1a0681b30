"""The registered queries on the library's operators, with their oracle SQL."""

from corpusloom.plans import addresses, checks, gates, languages, matching, metrics, proofs, records, reviews, sequences, streams, texts, wholes
from corpusloom.plans.base import ORACLES, QUERIES

FLAGSHIP = QUERIES["gat2_run_gate"]
__all__ = ["FLAGSHIP", "ORACLES", "QUERIES", "addresses", "checks", "gates", "languages", "matching", "metrics", "proofs", "records", "reviews", "sequences", "streams", "texts", "wholes"]

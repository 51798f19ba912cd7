"""All queries of the engine and the SQL that checks them."""

from . import evaluation, gold, platform, prices, reports

MODULES = (prices, gold, evaluation, platform, reports)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in MODULES for name, q in m.SQL.items()}

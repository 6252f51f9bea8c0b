"""inkline: turn tables or streams of raw news pages into enriched article rows.

Everything is expressed as Spark DataFrame / Column operations so Catalyst can
push filters into the scan, prune the wide ``html`` column early and keep the
per-row work inside whole-stage codegen.  Python only runs on executors where
a user plugs in a classifier or scorer (``operators.enrich``).
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]

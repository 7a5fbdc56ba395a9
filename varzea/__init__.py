"""varzea — league-sport analytics as PySpark jobs.

Raw CSV / nested JSON match feeds are landed, standardised into typed silver
tables, merged by key (last write wins) and rolled up into gold tables,
served views, a parametrised query library, dashboard metrics and a set-wise
match-outcome model.  Everything is DataFrame / Spark SQL; no UDFs.
"""

from varzea.session import configure, get_session, scratch_dir

__all__ = ["configure", "get_session", "scratch_dir"]

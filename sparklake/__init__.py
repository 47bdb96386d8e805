"""Credit-portfolio analytics on Spark: landing -> bronze -> silver -> gold.

Every transform is a plain ``DataFrame -> DataFrame`` function that can be used
with ``df.transform(...)``; the jobs in :mod:`sparklake.plans` chain them.
"""

from sparklake.session import build_session, shared_dir, tune

__all__ = ["build_session", "shared_dir", "tune"]

"""Audit-log security analytics on Spark.

Batch and streaming feature engineering, rule scoring, named SQL reports and
Isolation-Forest anomaly detection over cloud audit events, written with the
DataFrame / SQL / Structured Streaming APIs.
"""

from auditlake.session import get_session, prepare

__all__ = ["get_session", "prepare"]

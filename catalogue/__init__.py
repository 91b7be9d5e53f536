"""Every query over the test tables, by name, and the SQL it is checked against."""

from catalogue.queries import QUERIES
from catalogue.sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]

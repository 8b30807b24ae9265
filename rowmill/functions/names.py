"""Column references by exact name.

``F.col("a.b")`` means field ``b`` of struct ``a``; names taken from a schema
or a spec are names, so they are quoted with backticks.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")

"""Small helpers of the query bindings."""

from pyspark.sql import functions as F


def rounded(df, digits=6):
    """Round every double column, so that engines agree."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

"""Tables stored by key, so that joins on the key read them without an exchange.

Facts and features are written once into the same number of buckets of the
key, and every later join reads bucket by bucket.  A key may hold a third of
all facts, so the stored key has a second part: a fact is dealt to one of
``salts`` by its own columns, and a key's features are stored once a salt.  A
hot key's facts then lie in up to ``salts`` buckets, and no join moves them.

Facts with a NULL key keep NULL features, repeated facts stay, features must
have one row a key (more would multiply facts, as in any join).  The tables lie
in ``spark.checkpoint.dir``; their names are good for the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Buckets of a stored key, and parts of one key's facts.
BUCKETS = 8
SALTS = 8
SALT = "_salt"
#: Stored rows that a bucket holds on average, where ``buckets_for`` chooses.
BUCKET_ROWS = 1_000_000


def buckets_for(facts: DataFrame, features: DataFrame, salts: int = SALTS) -> int:
    """So many buckets that neither table's rows in one of them, which a task sorts, grow with the tables."""
    return max(BUCKETS, -(-max(facts.count(), features.count() * salts) // BUCKET_ROWS))


def _store(df: DataFrame, name: str, keys, buckets: int) -> DataFrame:
    """One file a bucket: rows are dealt as the buckets are before they are written."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}"
    by = [*keys, SALT]
    (df.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*by)
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    return spark.table(table)


def store_facts(df: DataFrame, name: str, keys, buckets: int = BUCKETS, salts: int = SALTS) -> DataFrame:
    """Facts in buckets of (keys, salt); equal rows share a salt, so a retried task writes the same."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    return _store(df.withColumn(SALT, salt), name, keys, buckets)


def store_features(df: DataFrame, name: str, keys, buckets: int = BUCKETS, salts: int = SALTS) -> DataFrame:
    """A row a key and salt, in the buckets of the facts' table of the same numbers."""
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return _store(df.select("*", every.alias(SALT)), name, keys, buckets)


def stored_join(facts: DataFrame, features: DataFrame, keys) -> DataFrame:
    """J4 on stored tables: left equi join bucket by bucket."""
    return facts.join(features, [*keys, SALT], "left").drop(SALT)

"""Songs and users, parsed once per version of their files.

The version is a digest of the paths, times and lengths below the two paths. Its snapshot holds typed Parquet, the raw user
keys for validation, the users listed more than once, and the measured size of the songs. A batch takes one snapshot and
uses it in all of its stages, so two versions never mix and no stage parses text or measures again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtally import schemas
from playtally.operators.joins import measured_bytes
from playtally.plans.daily import repeated_users
from playtally.plans.state import References, songs_for_kpis
from playtally.sources import files, inputs
from playtally.sources.manifest import Snapshot, Store

SONGS, USERS, REPEATED = "songs", "users", "repeated_users"
_USERS = T.StructType([*schemas.USERS.fields, T.StructField("user_key", T.StringType())])
_REPEATED = T.StructType([T.StructField("user_id", T.IntegerType()), T.StructField("copies", T.LongType())])


@dataclass(frozen=True)
class ReferenceSnapshot:
    spark: SparkSession
    store: Store
    snapshot: Snapshot

    @property
    def songs(self) -> DataFrame:
        return self.store.read(self.spark, self.snapshot, SONGS, schemas.SONGS)

    @property
    def users(self) -> DataFrame:
        return self.store.read(self.spark, self.snapshot, USERS, _USERS).drop("user_key")

    @property
    def keys(self) -> tuple[DataFrame, DataFrame]:
        """Track and user keys as they were written, for validation."""
        users = self.store.read(self.spark, self.snapshot, USERS, _USERS).select(F.col("user_key").alias("user_id"))
        return self.songs.select("track_id"), users

    @property
    def for_kpis(self) -> References:
        notes = self.snapshot.notes
        repeated = self.store.read(self.spark, self.snapshot, REPEATED, _REPEATED)
        return References.measured(self.songs, self.users, notes["version"], notes["songs_bytes"], repeated, notes["repeated_bytes"])


def current(spark: SparkSession, store: Store, songs_path: str, users_path: str, multi_line: bool = True) -> ReferenceSnapshot:
    """The snapshot of the files as they are now; parsed and published if there is none. Raises AnalysisException
    where a reference is missing or lacks columns."""
    versions = [files.fingerprint(spark, path) for path in (songs_path, users_path)]
    base = store.snapshot(spark)
    if None not in versions and base.notes.get("version") == "/".join(versions):
        return ReferenceSnapshot(spark, store, base)
    songs, users = inputs.read_songs(spark, songs_path, multi_line), inputs.read_users_with_key(spark, users_path, multi_line)
    made = store.write(songs, SONGS) + store.write(users, USERS)
    # From here on the parsed rows are read, not the text.
    parsed = ReferenceSnapshot(spark, store, Snapshot(files=tuple(made)))
    made += store.write(repeated_users(parsed.users), REPEATED)
    songs_bytes, repeated_bytes = measured_bytes(songs_for_kpis(parsed.songs), store.read(spark, Snapshot(files=tuple(made)), REPEATED, _REPEATED))
    notes = {"version": "/".join(map(str, versions)), "songs_bytes": songs_bytes, "repeated_bytes": repeated_bytes}
    return ReferenceSnapshot(spark, store, store.publish(spark, base, made, notes=notes))

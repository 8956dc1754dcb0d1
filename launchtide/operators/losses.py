"""What profiles and users are left out for, counted along the pass that leaves them out.

Every filter and inner join of the job drops rows without a trace. Here observations stand
before and after them in the job's own plan: nothing is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from launchtide.functions.observed import observed
from launchtide.schemas import PLATFORM

#: What is read, and what becomes of it: the latter add up to the former.
PROFILES = ("other_platform", "no_app", "unlaunched", "launched")
USERS = ("undated", "unreadable", "negative", "kept")
SCHEMA = "step string, n bigint"


def _where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


class NoLosses:
    """Counts nothing."""

    def read(self, profiles: DataFrame) -> DataFrame:
        return profiles

    sighted = users = read

    def launched(self, launched: DataFrame) -> DataFrame:
        return launched.drop("n")


class Losses(NoLosses):
    """The counts of one run; they are there once its rows have been written or collected.

    Of profiles: ``other_platform``; ``no_app``, without an app (or, where undated apps are skipped, a
    dated one) or, where users without id are dropped, without that; ``unlaunched``, of a
    model that is not a launched one of the brand; and ``launched``. Of users (or users by month)
    with a launched model: ``undated`` if the first sighting has no date, ``unreadable`` if the launch
    has none, ``negative`` if they were first seen before it, and ``kept``.

    Spark adds observations up by task. A task that ran again because an executor was lost
    after its stage had ended is counted twice; :meth:`table` finds that in kept users. The
    written rows are right in any case.
    """

    def __init__(self, platform: str = PLATFORM):
        self.platform = platform
        self._read, self._sighted, self._launched, self._users = (Observation() for _ in range(4))

    def read(self, profiles: DataFrame) -> DataFrame:
        known = _where(F.lower("device.platform") == self.platform.lower())
        # Its columns are named, so that the scan reads no more than the job does.
        columns = [name for name in ("month", "ifa", "device", "app") if name in profiles.columns]
        return profiles.select(*columns).observe(self._read, F.count(F.lit(1)).alias("profiles"), known.alias("known"))

    def sighted(self, seen: DataFrame) -> DataFrame:
        return seen.observe(self._sighted, F.count(F.lit(1)).alias("sighted"))

    def launched(self, launched: DataFrame) -> DataFrame:
        n = F.sum("n") if "n" in launched.columns else F.count(F.lit(1))
        return launched.observe(self._launched, F.coalesce(n, F.lit(0)).alias("launched")).drop("n")

    def users(self, deltas: DataFrame) -> DataFrame:
        undated = F.col("first_seen").isNull()
        return deltas.observe(
            self._users,
            F.count(F.lit(1)).alias("users"),
            _where(undated).alias("undated"),
            _where(~undated & F.col("launch").isNull()).alias("unreadable"),
            _where(F.col("delta") < 0).alias("negative"),
        )

    def counts(self) -> dict[str, int | None]:
        """All counts, ``profiles`` and ``users`` first of their parts.

        Where no model is launched, Spark may not read the profiles: their counts are None.
        """
        found = {}
        for one in (self._read, self._sighted, self._launched, self._users):
            found |= observed(one)

        def less(whole: str, *parts: str) -> int | None:
            names = (whole, *parts)
            return found[whole] - sum(found[part] for part in parts) if all(x in found for x in names) else None

        # What nothing was joined to or chosen from is 0, not unknown.
        for step in ("launched", "users", "undated", "unreadable", "negative"):
            found.setdefault(step, 0)
        return {
            "profiles": less("profiles"),
            "other_platform": less("profiles", "known"),
            "no_app": less("known", "sighted"),
            "unlaunched": less("sighted", "launched"),
            "launched": found["launched"],
            "users": found["users"],
            "undated": found["undated"],
            "unreadable": found["unreadable"],
            "negative": found["negative"],
            "kept": less("users", "undated", "unreadable", "negative"),
        }

    def table(self, stored: DataFrame, kept: int | None = None) -> DataFrame:
        """``step, n``; an error if ``kept``, the users that were written, is given and differs.
        ``stored`` gives the session."""
        counts = self.counts()
        if kept is not None and counts["kept"] != kept:
            raise RuntimeError(f"losses don't add up: {counts}, {kept} users written")
        return stored.sparkSession.createDataFrame(list(counts.items()), SCHEMA)

"""Profile lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def one_profile_per_name(profiles: DataFrame) -> DataFrame:
    """username, karma, created -> one row per lower-cased name.

    Several spellings of a name keep the alphabetically first one.
    """
    named = profiles.where(F.col("username") != "")
    return (named.groupBy(F.lower("username").alias("user_key"))
            .agg(F.min_by(F.struct("karma", "created"), "username").alias("profile"))
            .select("user_key", "profile.karma", "profile.created"))


def with_profiles(users: DataFrame, profiles: DataFrame | None) -> DataFrame:
    """Adds karma and created by lower-cased user name; null where unknown.

    Both sides are unique on the key, so no key is hot. The join strategy is
    left to adaptive execution, which broadcasts only on measured size.
    """
    if profiles is None:
        return users.withColumns({"karma": F.lit(None).cast("bigint"),
                                  "created": F.lit(None).cast("bigint")})
    return users.join(one_profile_per_name(profiles), "user_key", "left")

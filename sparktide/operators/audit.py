"""Security and backup audit over exported server tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktide.functions import conversion, temporal
from sparktide.operators import joins, predicates
from sparktide.workspace import materialise

# Device types a backup can be written to; fixed values of the export.
DEVICE_TYPES = {2: "Disk", 5: "Tape", 7: "Virtual Device", 9: "Azure Storage"}
UNKNOWN_DEVICE = "UNKNOWN"

# Passwords everybody tries first.
WEAK_PASSWORDS = {"blank": "", "common password": "password"}


def built_in_admin(principals: DataFrame, sid: bytes = b"\x01") -> DataFrame:
    """Whether the built-in administrator is disabled."""
    return predicates.filter_binary_equals(principals, "sid", sid).select("name", "is_disabled")


def members_of(memberships: DataFrame, role: str) -> DataFrame:
    """The names that belong to a role, directly or through roles inside it.

    ``memberships`` has (role_name, member_name). Each round asks only for the members of
    names found in the last one, so roles inside each other end like any others.
    """
    pairs = memberships.where(F.col("member_name").isNotNull()).select("role_name", "member_name").distinct()
    fresh = materialise(pairs.where(F.col("role_name") == role).select(F.col("member_name").alias("name")).distinct(), "members")
    # Only roles can have members of their own.
    roles = materialise(pairs.join(pairs.select(F.col("role_name").alias("member_name")).distinct(), "member_name", "left_semi"), "nested_roles")
    inner = [fresh.join(roles.select(F.col("member_name").alias("name")).distinct(), "name", "left_semi")]
    found = [fresh]
    while not (last := inner[-1]).isEmpty():
        below = pairs.join(last.select(F.col("name").alias("role_name")), "role_name", "left_semi").select(F.col("member_name").alias("name"))
        fresh = materialise(below.distinct().join(reduce(DataFrame.union, found), "name", "left_anti"), "members")
        found.append(fresh)
        inner.append(fresh.join(roles.select(F.col("member_name").alias("name")).distinct(), "name", "left_semi"))
    return reduce(DataFrame.union, found)


def role_members(principals: DataFrame, memberships: DataFrame, role: str = "sysadmin") -> DataFrame:
    """Principals in a role by its name, members of members included, by name."""
    members = materialise(members_of(memberships, role), "role_members")
    found = principals.join(members, "name", "left_semi")
    return found.select("name", "type_desc", "is_disabled").orderBy("name")


def privileged_principals(principals: DataFrame, permissions: DataFrame) -> DataFrame:
    """Principals granted server control, without the internal ``##…##`` ones."""
    granted = permissions.where(
        F.col("state").isin("G", "W") & (F.col("class") == 100) & (F.col("type") == "CL")
    )
    named = principals.where(~F.col("name").like("##%##"))
    privileged = joins.semi_join_in(named, granted, "principal_id", "grantee_principal_id")
    return privileged.select("name", "type_desc", "is_disabled")


def weak_passwords(
    credentials: DataFrame, candidates: Mapping[str, str] = WEAK_PASSWORDS
) -> DataFrame:
    """Logins whose password is one of the candidates or their own name.

    ``candidates`` maps the reported weakness to the password. One row per
    login and rule that hit. The candidates are digested and compared row by
    row; nothing is joined.
    """
    digest = F.col("password_digest")
    rules = [F.when(digest == F.sha2(F.col("name"), 256), "same as login")]
    rules += [F.when(digest == F.sha2(F.lit(text), 256), label) for label, text in candidates.items()]
    hits = F.array_compact(F.array(*rules))
    return credentials.select("name", F.explode(hits).alias("weakness"))


def backup_media(sets: DataFrame, families: DataFrame) -> DataFrame:
    return sets.join(families, "media_set_id", "inner")


def backup_history(
    sets: DataFrame, families: DataFrame, kind: str, strict: bool = False
) -> DataFrame:
    """Backups of one kind (``D`` full, ``L`` log), newest first.

    A duration above 9,999 seconds is printed in full; ``strict`` prints ``*``
    as a four-character column would.
    """
    seconds = temporal.boundaries_between(
        "second", F.col("backup_start_date"), F.col("backup_finish_date")
    )
    shown = conversion.text_of_width(seconds, 4) if strict else seconds.cast("string")
    megabytes = conversion.whole_division(F.col("backup_size"), F.lit(1_000_000))
    return (
        backup_media(sets.where(F.col("type") == kind), families)
        .select(
            "server_name",
            "database_name",
            "recovery_model",
            "is_copy_only",
            "is_snapshot",
            "has_backup_checksums",
            "backup_start_date",
            "backup_finish_date",
            F.concat(shown, F.lit(" Seconds")).alias("duration"),
            F.concat(megabytes.cast("string"), F.lit(" MB")).alias("size_in_mb"),
            "physical_device_name",
            "logical_device_name",
            conversion.first_match(F.col("device_type"), DEVICE_TYPES, UNKNOWN_DEVICE).alias(
                "device_type"
            ),
            "user_name",
        )
        .orderBy(F.desc("backup_start_date"), "physical_device_name")
    )

"""Queries of the security, backup and history-state family."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktide.operators import audit, history
from sparktide.plans.registry import query


@query(
    "role_members",
    "D-01 F-15",
    """WITH inside AS (
         SELECT member_name FROM role_memberships WHERE role_name = 'sysadmin'
         UNION SELECT m.member_name FROM inside i JOIN role_memberships m ON m.role_name = i.member_name)
       SELECT name, type_desc, is_disabled FROM principals WHERE name IN (SELECT member_name FROM inside) ORDER BY name""",
    views="principals role_memberships",
    recursive=True,
)
def _(t):
    return audit.role_members(t.principals, t.role_memberships, "sysadmin")


@query(
    "built_in_admin_state",
    "D-01 P-29",
    "SELECT name, is_disabled FROM principals WHERE principal_id % 256 = 1",
    views="principals",
)
def _(t):
    sid = F.unhex(F.lpad(F.hex(F.col("principal_id") % 256), 2, "0"))
    return audit.built_in_admin(t.principals.withColumn("sid", sid))


@query(
    "weak_passwords",
    "D-02 F-16",
    """SELECT name, 'blank' AS weakness FROM credentials WHERE password_digest = sha256('')
       UNION ALL SELECT name, 'same as login' FROM credentials WHERE password_digest = sha256(name)
       UNION ALL SELECT name, 'common password' FROM credentials WHERE password_digest = sha256('password')""",
    views="credentials",
)
def _(t):
    return audit.weak_passwords(t.credentials)


# A backup and what is shown of it are put together first, its media last.
_BACKUP_SQL = """WITH devices(device_type, label) AS (
         VALUES (2, 'Disk'), (5, 'Tape'), (7, 'Virtual Device'), (9, 'Azure Storage')
       ), shown AS (
         SELECT media_set_id, server_name, database_name, recovery_model, is_copy_only, is_snapshot, has_backup_checksums,
                user_name, backup_start_date, backup_finish_date, epoch(date_trunc('second', backup_finish_date) - date_trunc('second', backup_start_date))::BIGINT AS took,
                format('{{}} MB', backup_size // 1000000) AS size_in_mb
         FROM backupset WHERE type = '{kind}'
       ), media AS (
         SELECT media_set_id, logical_device_name, physical_device_name, ifnull(label, 'UNKNOWN') AS device_type
         FROM backupmediafamily LEFT JOIN devices USING (device_type)
       )
       SELECT * EXCLUDE (media_set_id, took), format('{{}} Seconds', {seconds}) AS duration FROM shown JOIN media USING (media_set_id)"""
_PLAIN = "took"
_NARROW = "if(took > 9999, '*', took::VARCHAR)"


@query(
    "full_backup_history",
    "D-03 F-03 F-08 F-13",
    _BACKUP_SQL.format(seconds=_PLAIN, kind="D"),
    views="backupset backupmediafamily",
)
def _(t):
    return audit.backup_history(t.backupset, t.backupmediafamily, "D")


@query(
    "log_backup_history",
    "D-03",
    _BACKUP_SQL.format(seconds=_PLAIN, kind="L"),
    views="backupset backupmediafamily",
)
def _(t):
    return audit.backup_history(t.backupset, t.backupmediafamily, "L")


@query(
    "full_backup_history_strict",
    "D-03 F-05",
    _BACKUP_SQL.format(seconds=_NARROW, kind="D"),
    views="backupset backupmediafamily",
)
def _(t):
    return audit.backup_history(t.backupset, t.backupmediafamily, "D", strict=True)


@query(
    "history_status",
    "D-04",
    """SELECT database_name, actual_state_desc, readonly_reason, max_storage_size_mb,
              max_storage_size_mb - current_storage_size_mb AS query_store_free_space_mb,
              flush_interval_seconds, interval_length_minutes, stale_query_threshold_days, max_plans_per_query,
              query_capture_mode_desc, size_based_cleanup_mode_desc FROM history_options""",
    views="history_options",
)
def _(t):
    return history.history_status(t.history_options)

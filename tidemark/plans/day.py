"""A whole day, and days in sequence."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from tidemark.plans import groups, transactions, users
from tidemark.plans.report import report
from tidemark.sources.state import StateStore


def sync_day(spark, root: str, day: str, store: StateStore, sync_time: datetime, with_report: bool = True, only_new: bool = False) -> int:
    """Users, then groups (they need the users' status), then transactions; returns the last version.

    The day's report (integrity, circles, statuses) is recorded after the last commit. ``only_new`` passes over files that earlier runs
    have recorded; where there is nothing else, nothing is parsed, committed or recorded.
    """
    before = store.version
    after = users.run(spark, root, day, store, only_new=only_new)
    groups.run(spark, root, day, store, only_new=only_new, users_changed=after != before)
    version = transactions.run(spark, root, day, store, sync_time, only_new=only_new)
    if with_report and (version != before or not only_new):
        report(store, day)
    return version


def sync_days(spark, root: str, days: Iterable[str], store: StateStore, sync_time: datetime, **options) -> int:
    version = store.version
    for day in days:
        version = sync_day(spark, root, day, store, sync_time, **options)
    return version

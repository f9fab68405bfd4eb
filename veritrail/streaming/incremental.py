"""Structured Streaming twins of the incremental batch operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LEDGER = "url string, previous_sha256 string, current_sha256 string, first_seen string, last_seen string, http_status int, change_type string"
STATE = "first_seen string, ok_at string, ok_seq long, ok_sha string, before_at string, before_seq long, before_sha string, last_at string, last_seq long, last_status int, last_ok boolean"


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Two latest successes and the latest attempt by event time, whatever the order of arrival."""
    first, ok, before, last = (None, ("", -1, ""), ("", -1, ""), ("", -1, 0, False))
    if state.exists:
        s = state.get
        first, ok, before, last = s[0], tuple(s[1:4]), tuple(s[4:7]), tuple(s[7:11])
    for batch in batches:
        for at, seq, sha, status in zip(batch["retrieved_at"], batch["seq"], batch["sha256"], batch["http_status"], strict=True):
            good = isinstance(sha, str) and sha != ""
            if good:
                first = at if first is None or at < first else first
                new = (at, int(seq), sha)
                if new[:2] > ok[:2]:
                    ok, before = new, ok
                elif ok[:2] != new[:2] and new[:2] > before[:2]:
                    before = new
            if (at, int(seq)) > last[:2]:
                last = (at, int(seq), 0 if pd.isna(status) else int(status), good)
    state.update((first, *ok, *before, *last))
    previous, current = (before[2] or None, ok[2]) if last[3] else (ok[2] or None, None)
    change = ("ADDED" if previous is None else "UNCHANGED" if previous == current else "MODIFIED") if last[3] else ("REMOVED" if previous else "UNAVAILABLE")
    yield pd.DataFrame([(key[0], previous, current, first, ok[0] or None, last[2] or None, change)], columns=[c.split()[0] for c in LEDGER.split(", ")])


def stream_ledger(log: DataFrame) -> DataFrame:
    """A streaming log to updated ledger rows (update mode). State is eleven values for each url, so it does not grow with a url's history."""
    rows = log.select("url", "retrieved_at", "seq", "sha256", "http_status")
    return rows.groupBy("url").applyInPandasWithState(_fold, LEDGER, STATE, "update", GroupStateTimeout.NoTimeout)


def stream_links(links: DataFrame, delay: str = "7 days") -> DataFrame:
    """Links once for each key within the watermark."""
    return links.withWatermark("at", delay).dropDuplicatesWithinWatermark(["link_key"])


def stream_counts(events: DataFrame, window: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """events(at, key) counted by tumbling or sliding windows of event time; later than delay is dropped."""
    return events.withWatermark("at", delay).groupBy(F.window("at", window, slide or window), "key").agg(F.count(F.lit(1)).alias("n"))


def stream_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    return events.withWatermark("at", delay).groupBy(F.session_window("at", gap), "key").agg(F.count(F.lit(1)).alias("n"))


def stream_first_last(events: DataFrame) -> DataFrame:
    """First and last time of each key: monotone whatever the order of arrival."""
    return events.groupBy("key").agg(F.min("at").alias("first_seen"), F.max("at").alias("last_seen"))

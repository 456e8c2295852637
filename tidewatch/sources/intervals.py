"""Interval file pairs as a streaming source.

A row is an interval whose event file and article file are both there; the offset is
the last such interval.  The source looks at the next steps only, stops at the first
that lacks a file, and hands out a bounded number at a time, so a late file delays the
stream and never makes it fail or skip.  What the files hold is read by Spark, from the
paths; the source itself only asks whether they exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..functions import constants as C
from . import files

STAMP = "%Y%m%d%H%M%S"
EXPORT, ARTICLES = "{ts}.export.CSV", "{ts}.gkg.csv"


def following(ts: str, minutes: int = C.INTERVAL_MINUTES) -> str:
    return (datetime.strptime(ts, STAMP) + timedelta(minutes=minutes)).strftime(STAMP)


def complete_after(exports: str, articles: str, after: str, limit: int) -> list[str]:
    """The unbroken run of complete intervals after ``after``, at most ``limit``."""
    out, ts = [], following(after)
    while len(out) < limit and files.exists(f"{exports}/{EXPORT.format(ts=ts)}") and files.exists(f"{articles}/{ARTICLES.format(ts=ts)}"):
        out.append(ts)
        ts = following(ts)
    return out


class IntervalReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.exports, self.articles = (options[k].rstrip("/") for k in ("exports", "articles"))
        self.after, self.limit = options["after"], int(options.get("limit", C.MAX_INTERVALS))

    def _rows(self, intervals: list[str]) -> Iterator[tuple]:
        return iter([(ts, f"{self.exports}/{EXPORT.format(ts=ts)}", f"{self.articles}/{ARTICLES.format(ts=ts)}") for ts in intervals])

    def initialOffset(self) -> dict:
        return {"interval": self.after}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found = complete_after(self.exports, self.articles, start["interval"], self.limit)
        return self._rows(found), {"interval": found[-1] if found else start["interval"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        found, ts = [], following(start["interval"])
        while ts <= end["interval"]:
            found.append(ts)
            ts = following(ts)
        return self._rows(found)

    def commit(self, end: dict) -> None:
        """Nothing is held for an interval."""


class IntervalSource(DataSource):
    """Options: exports and articles (folders), after (the interval that the first start follows), limit (intervals a batch)."""

    @classmethod
    def name(cls) -> str:
        return "interval_pairs"

    def schema(self) -> str:
        return "ts string, export_path string, article_path string"

    def simpleStreamReader(self, schema) -> IntervalReader:
        return IntervalReader(self.options)

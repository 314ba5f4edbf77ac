"""URL filter: allow and block entries in a trie over reversed host labels and path segments.

An entry is ``host/path``. It fits its host and all subdomains of it, if the path of the URL starts
with the entry's. Of several fitting entries the longest decides: more host labels first, then the
longer path; if the same entry is both allowed and blocked, block wins. A URL that no entry fits
gets the default verdict.

The trie is broadcast. Its size is bounded: more than ``MAX_ENTRIES`` entries become several tries,
and the pages pass them one after the other, each pass keeping the longer entry; so no entry list
is too large and none is cut.

Null URLs and URLs without ``://`` have an empty host and path, which no entry fits. Repeated rows
are judged one by one; other columns pass through, and columns of the result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.columns import sets_aside

ALLOW, BLOCK = "allow", "block"
# Entries of one broadcast trie: some 100 bytes each, so 20 MB at most.
MAX_ENTRIES = 200_000
_FIT = "struct<labels:int,path:int,blocked:int,rule:string>"


class Trie:
    """Entries by reversed host label; below each host the entries' paths by segment."""

    def __init__(self, entries: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for verdict, entry in entries:
            self._add(verdict, entry)

    def _add(self, verdict: str, entry: str) -> None:
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"verdict {verdict!r} of {entry!r} is neither allow nor block")
        host, slash, rest = entry.partition("/")
        labels = host.lower().split(".")
        node = self.root
        for label in reversed(labels):
            node = node.setdefault("labels", {}).setdefault(label, {})
        path = slash + rest
        *whole, tail = path.split("/")
        node = node.setdefault("paths", {})
        for segment in whole:
            node = node.setdefault("segments", {}).setdefault(segment, {})
        fit = (len(labels), len(path), int(verdict == BLOCK), entry)
        tails = node.setdefault("tails", {})
        tails[tail] = max(tails.get(tail, fit), fit)

    def longest(self, host: str, path: str) -> tuple | None:
        if not host:
            return None
        best, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            best = self._longest_path(node.get("paths"), segments) or best
        return best

    @staticmethod
    def _longest_path(node: dict | None, segments: list[str]) -> tuple | None:
        best = None
        for k, segment in enumerate(segments):
            if node is None:
                break
            for tail, fit in node.get("tails", {}).items():
                if segment.startswith(tail) and (best is None or fit > best):
                    best = fit
            # The last segment is not closed by a slash.
            node = node.get("segments", {}).get(segment) if k < len(segments) - 1 else None
        return best


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Columns ``host`` and ``path``: of the text after the first ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)"))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumns({"host": F.coalesce(lower, F.lit("")),
                              "path": F.coalesce(path, F.lit(""))})


def _pass(spark, entries: list[tuple[str, str]]):
    trie = spark.sparkContext.broadcast(Trie(entries))

    @F.pandas_udf(_FIT)
    def longest(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        held = trie.value
        for hosts, paths in batches:
            fits = [held.longest(h, p) or (None, None, None, None) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(fits, columns=["labels", "path", "blocked", "rule"])

    return longest


@sets_aside("_best_entry", "_found")
def filter_urls(pages: DataFrame, entries: list[tuple[str, str]], default: str = ALLOW,
                url: str = "url", max_entries: int = MAX_ENTRIES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    spark = pages.sparkSession
    best = "_best_entry"
    judged = with_host_and_path(pages, url).withColumn(best, F.lit(None).cast(_FIT))
    for first in range(0, len(entries), max_entries):
        longest = _pass(spark, entries[first:first + max_entries])
        found = longest("host", "path")
        judged = judged.withColumn("_found", found).withColumn(
            best, F.when(F.col("_found.rule").isNull(), F.col(best))
            .when(F.col(f"{best}.rule").isNull(), F.col("_found"))
            .otherwise(F.greatest(best, "_found"))).drop("_found")
    verdict = (F.when(F.col(f"{best}.rule").isNull(), default)
               .when(F.col(f"{best}.blocked") == 1, BLOCK).otherwise(ALLOW))
    return judged.withColumns({"rule": F.col(f"{best}.rule"), "verdict": verdict}).drop(best)

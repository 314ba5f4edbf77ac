"""Task parameters: the date range, the session filters and the page flow."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Field names of the task-parameter JSON (fixed values).
_JSON_FIELDS = ("startDate", "endDate", "startAge", "endAge", "professionals", "cities", "sex",
                "keywords", "categoryIds", "targetPageFlow")


def _items(text: str | None) -> tuple[str, ...]:
    """Items of a comma list; no list and the empty list both mean "no restriction"."""
    return tuple(item.strip() for item in (text or "").split(",") if item.strip())


def _number(text: str | None) -> int | None:
    return int(text) if text not in (None, "") else None


@dataclass(frozen=True)
class TaskParams:
    """Parameters of one run. An absent filter lets every session pass."""

    start_date: dt.date
    end_date: dt.date
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    page_flow: tuple[int, ...] = ()
    task_id: str = "task"

    @classmethod
    def of(cls, start: str, end: str, *, start_age: int | str | None = None,
           end_age: int | str | None = None, professionals: str | None = None,
           cities: str | None = None, sex: str | None = None, keywords: str | None = None,
           category_ids: str | None = None, page_flow: str | None = None,
           task_id: str = "task") -> TaskParams:
        """Build from the textual form, in which ``""`` means "no restriction"."""
        return cls(
            start_date=dt.date.fromisoformat(start),
            end_date=dt.date.fromisoformat(end),
            start_age=_number(start_age),
            end_age=_number(end_age),
            professionals=_items(professionals),
            cities=_items(cities),
            sex=sex or None,
            keywords=_items(keywords),
            category_ids=tuple(int(item) for item in _items(category_ids)),
            page_flow=tuple(int(item) for item in _items(page_flow)),
            task_id=task_id,
        )

    @classmethod
    def from_json(cls, spark: SparkSession, text: str, task_id: str = "task") -> TaskParams:
        """Read the lenient JSON form (unquoted keys allowed) with Spark's own JSON reader."""
        schema = ", ".join(f"{name} string" for name in _JSON_FIELDS)
        fields = spark.sql(
            f"select from_json(:text, '{schema}', map('allowUnquotedFieldNames', 'true')) as p",
            args={"text": text},
        ).first()["p"]
        if fields is None or not fields["startDate"] or not fields["endDate"]:
            raise ValueError("task parameters need startDate and endDate")
        return cls.of(
            fields["startDate"], fields["endDate"],
            start_age=fields["startAge"], end_age=fields["endAge"],
            professionals=fields["professionals"], cities=fields["cities"], sex=fields["sex"],
            keywords=fields["keywords"], category_ids=fields["categoryIds"],
            page_flow=fields["targetPageFlow"], task_id=task_id,
        )

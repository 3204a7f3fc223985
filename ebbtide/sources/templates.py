"""SQL texts with ${name} placeholders: what is wrong with one, and the text of a day."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

KNOWN, NEEDED = ("bizdate", "publish_start", "publish_end"), ("bizdate",)
_MARK = re.compile(r"\$\{([^}]*)\}")


def problems(text: str | None, known: tuple[str, ...] = KNOWN, needed: tuple[str, ...] = NEEDED) -> list[str]:
    """What keeps a template from being rendered, by name; empty if nothing does."""
    if not text or not text.strip():
        return ["the template is empty"]
    found = _MARK.findall(text)
    return [f"missing ${{{n}}}" for n in needed if n not in found] + [f"unknown ${{{n}}}" for n in dict.fromkeys(found) if n not in known]


def day(pt: str) -> date:
    """The day of yyyyMMdd; anything else is an error, so a value never carries SQL."""
    if not re.fullmatch(r"[0-9]{8}", pt):
        raise ValueError(f"{pt!r} is no day of the form yyyyMMdd")
    return datetime.strptime(pt, "%Y%m%d").date()


def next_day(pt: str) -> date:
    return day(pt) + timedelta(days=1)


def default_partition(today: date) -> str:
    """The day before."""
    return f"{today - timedelta(days=1):%Y%m%d}"


def rendered(text: str, bizdate: str, publish_start: str | None = None, publish_end: str | None = None, limit: int | None = None) -> str:
    """The template of a day: the window starts with ``publish_start`` (the day itself) and ends
    before the day after ``publish_end`` (the day itself)."""
    if found := problems(text):
        raise ValueError("; ".join(found))
    values = {"bizdate": f"{day(bizdate):%Y%m%d}", "publish_start": f"{day(publish_start or bizdate):%Y-%m-%d}", "publish_end": f"{next_day(publish_end or bizdate):%Y-%m-%d}"}
    made = _MARK.sub(lambda m: values[m[1]], text)
    return made if limit is None else f"{made}\nLIMIT {int(limit)}"

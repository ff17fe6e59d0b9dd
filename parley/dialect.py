"""The two chat products differ in constants only; every operator takes a Dialect."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    name: str
    # Subtypes of a post written by a person. None in the tuple stands for SQL null.
    activity_subtypes: tuple[str | None, ...]
    # The shortest text up to the closing bracket, within one line.
    user_tag: str
    channel_tag: str | None
    link_tag: str | None
    # Countries and cities come from the zone tables, or are the constant ''.
    geo: bool
    # Reply pages, thread tables and the per-thread metrics exist.
    threads: bool
    # The count metrics are part of a run.
    counts: bool
    # Names of the exported metric columns.
    upper_case: bool
    user_column: str


# The first product has threads and nested records, the second flat records only.
# Subtypes and markup patterns of the two products. A tag ends at its bracket or
# with its line; the class says so, as the dot stops at other characters in Java.
THREADED = Dialect(
    name="threaded",
    activity_subtypes=(None, "thread_broadcast"),
    user_tag=r"<@([^>\n]*)>",
    channel_tag=r"<#([^>\n]*)>",
    link_tag=r"<([^>\n]*)>",
    geo=True,
    threads=True,
    counts=True,
    upper_case=False,
    user_column="user_id",
)

FLAT = Dialect(
    name="flat",
    activity_subtypes=("default",),
    user_tag=r"<@!([^>\n]*)>",
    channel_tag=None,
    link_tag=None,
    geo=False,
    threads=False,
    counts=False,
    upper_case=True,
    user_column="user",
)

"""Status and message of a result, by the reason its scan stopped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def status_for(reason: Column, reasons: Mapping[str, tuple[str, str]]) -> Column:
    table = F.create_map(*[F.lit(x) for name, (status, _) in reasons.items() for x in (name, status)])
    return F.try_element_at(table, reason)


def message_for(reason: Column, reasons: Mapping[str, tuple[str, str]], detail: Column) -> Column:
    table = F.create_map(*[F.lit(x) for name, (_, text) in reasons.items() for x in (name, text)])
    return F.replace(F.try_element_at(table, reason), F.lit("%s"), F.coalesce(detail, F.lit("")))

"""Who started a run (P1, P2) and whether its log is worth a request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runsift import fixed_values as fv

# JSON texts that count as "no actor given".
ABSENT = r"^\s*(null|false|0|\"\"|\{\s*\}|\[\s*\])?\s*$"


def is_human(actor: Column) -> Column:
    """Actor JSON names a person: a non-empty object, not of the bot type, login without a bot ending.

    The lambda binds the parsed object, so each actor is parsed once.
    """
    parsed = F.array(F.from_json(actor, "map<string,string>"))
    return F.coalesce(F.exists(parsed, _names_a_person), F.lit(False))


def _names_a_person(fields: Column) -> Column:
    login = F.lower(F.coalesce(fields.getItem("login"), F.lit("")))
    kind = F.lower(F.coalesce(fields.getItem("type"), F.lit("")))
    bot_login = F.lit(False)
    for ending in fv.BOT_LOGIN_ENDS:
        bot_login = bot_login | login.endswith(ending)
    return (F.size(fields) > 0) & (kind != fv.BOT_TYPE) & ~bot_login


def run_actor(triggering_actor: Column, actor: Column) -> Column:
    """The triggering actor, or the actor where the former is missing or empty."""
    return F.when(F.coalesce(triggering_actor.rlike(ABSENT), F.lit(True)), actor).otherwise(triggering_actor)


def worth_a_request(logs_url: Column, actor: Column) -> Column:
    return F.coalesce(logs_url != "", F.lit(False)) & is_human(actor)

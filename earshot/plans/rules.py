"""Rule sets of the four star tables."""

from __future__ import annotations

from earshot import schemas as S
from earshot.operators.validation import RuleSet, not_blank, not_null


def _required(schema) -> tuple:
    return tuple(not_null(f.name) for f in schema)


# Every column is required, descriptive ones included;
# ``RuleSet.allow_null`` relaxes that where wanted.
USER_RULES = RuleSet("users", "user_id", S.USERS, (*_required(S.USERS), not_blank("user_name")))
ARTIST_RULES = RuleSet("artists", "artist_id", S.ARTISTS, _required(S.ARTISTS))
TIME_RULES = RuleSet("time", "listen_time", S.TIME, _required(S.TIME))
LISTEN_RULES = RuleSet("user_listens", "listen_id", S.USER_LISTENS, _required(S.USER_LISTENS))

STAR_RULES = {r.name: r for r in (USER_RULES, ARTIST_RULES, TIME_RULES, LISTEN_RULES)}
